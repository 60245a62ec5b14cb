import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sievework.functions import patterns, text


def flags_of(spark, title, abstract="", **options):
    df = spark.createDataFrame([(title, abstract)], "title string, abstract string")
    row = text.text_flags(df, patterns.FLAG_PATTERNS, patterns.FLAG_LITERALS, **options).first().asDict()
    return {name for name in patterns.FLAG_PATTERNS if row[name] == 1}


@pytest.mark.parametrize(
    "title, expected",
    [
        ("Minimally-conscious", {"mentions_minimally_conscious", "mentions_consciousness"}),
        ("IIT", set()),
        ("anaesthesia", set()),
        ("Anesthesia", {"mentions_anesthesia"}),
        ("reported", set()),
        ("éconscious", set()),
        ("property dualism and substance dualism", {"mentions_dualism"}),
        (None, set()),
    ],
)
def test_flag_cases(spark, title, expected):
    assert flags_of(spark, title) == expected


def test_fold_case_lets_upper_case_alternatives_match(spark):
    assert "mentions_iit" in flags_of(spark, "IIT", fold_case=True)


def test_flags_agree_with_python_regex(spark):
    from sievework.catalog.base import PHRASES

    texts = [f"{a} {b}" for a in PHRASES for b in PHRASES[::7]] + [f"x{a}y" for a in PHRASES]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, title string").selectExpr("*", "'' AS abstract")
    for flags, literals in ((patterns.FLAG_PATTERNS, patterns.FLAG_LITERALS), (patterns.FIRST_PATTERNS, None)):
        for row in text.text_flags(df, flags, literals).collect():
            lowered = texts[row.i].lower() + "\n"
            assert {n: row[n] for n in flags} == {n: int(bool(re.search(p, lowered))) for n, p in flags.items()}


@settings(max_examples=20, deadline=None)
@given(st.data())
@pytest.mark.parametrize("name", list(patterns.FLAG_PATTERNS))
def test_every_match_holds_one_of_the_literals(name, data):
    found = data.draw(st.from_regex(patterns.FLAG_PATTERNS[name]))
    assert any(literal in found for literal in patterns.FLAG_LITERALS[name])


def test_number_of_flags():
    assert len(patterns.FLAG_PATTERNS) == 37 and len(patterns.FLAG_COLUMNS) == 38


@pytest.mark.parametrize("pattern", [r"\bs?-x", r"s\b", r"\w\b", r"(?:a|é)\b", r"\b(é|b)", r"a\Wb", r"\bab\b|\bcd", r"x\b-"])
def test_regex_translation_agrees_with_python(spark, pattern):
    words = ["s", "-x", "s-x", "é", "a", "ab", "cd", "b", "x-", "_", " ", "x"]
    texts = [p + q + r for p in words for q in words for r in ("", " ", "a", "é")]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    hits = {r.t for r in df.filter(df.t.rlike(text.unicode_regex(pattern))).collect()}
    assert hits == {t for t in texts if re.search(pattern, t)}
