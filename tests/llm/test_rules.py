import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sievework.llm import rules


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {j for at in places.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def stats(texts):
    found = rules.count_texts(pa.array(texts, pa.string()))
    return list(zip(*(found[name].tolist() for name in rules.COUNTS)))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\t#é日|", max_size=80)), min_size=1, max_size=6))
def test_statistics_are_those_of_brute_force(texts):
    assert stats(texts) == [brute(t) for t in texts]


def test_repeated_windows_and_lines():
    text = "a b c d e f g h\n" * 3 + "tail | tail\n\nx"
    assert stats([text]) == [brute(text)]
    assert brute(text)[3:] == (2, 24)


def test_learned_list_finds_planted_rule():
    rng = np.random.default_rng(1)
    table = {name: rng.random(3000) for name in rules.RATIOS}
    bad = (table["symbols_per_word"] > 0.7) & (table["words"] <= 0.5)
    found = rules.learn_rules(table, bad, rng.random(3000) < 1 / 3)
    hit = np.zeros(3000, bool)
    for rule in found:
        hit |= rule.matches(table)
    assert (hit & bad).sum() >= 0.95 * bad.sum() and (hit & ~bad).sum() <= 0.02 * (~bad).sum()


def test_no_labels_of_one_class_leave_the_base_rule(spark, edge_docs, edge_labels):
    good = edge_labels.filter("quality = 1")
    assert rules.fit_rules(edge_docs, good) == []
    assert rules.fit_rules(edge_docs, edge_labels.limit(0)) == []


def test_edge_rows(edge_docs, edge_rows, edge_labels):
    learned = rules.fit_rules(edge_docs, edge_labels)
    found = rules.judge(edge_docs, learned).collect()
    expected = sorted((str(r[0]), *brute(r[1])) for r in edge_rows)
    assert sorted((str(r.doc_id), *(r[name] for name in rules.COUNTS)) for r in found) == expected
    for r in found:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_filter_keeps_rows_as_they_are(edge_docs, edge_rows, edge_labels, empty_docs):
    kept = rules.filter_documents(edge_docs, []).collect()
    expected = [r for r in edge_rows if (b := brute(r[1]))[0] >= 20 and 100 * b[4] <= 30 * b[0]]
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, expected))
    assert rules.judge(empty_docs, []).count() == 0
    assert rules.filter_documents(empty_docs, rules.fit_rules(empty_docs, edge_labels)).count() == 0


@pytest.mark.parametrize("name", sorted(rules.RATIOS))
def test_conditions_are_spark_expressions(spark, name):
    rule = rules.Rule(((name, True, 0.5),), 1, 0)
    row = spark.range(1).selectExpr(*(f"0L AS {c}" for c in (*rules.COUNTS, *rules.EXTRA)))
    assert row.select(rule.column().alias("r")).first().r is False


def test_driver_sees_one_row_per_key(spark, monkeypatch):
    texts = [(i, f"word{i} " * (3 + i % 40)) for i in range(60)] + [(7, f"other{i} text of the same key") for i in range(3000)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, quality int")
    kind, seen = type(docs), []
    whole = kind.toPandas
    monkeypatch.setattr(kind, "toPandas", lambda self: seen.append(whole(self)) or seen[-1])
    rules.fit_rules(docs, labels)
    assert [len(rows) for rows in seen] == [60]
