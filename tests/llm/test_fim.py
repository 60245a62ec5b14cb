import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sievework.llm import fim

UNITS = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def expected(key, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    draws = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    found = UNITS.findall(text)
    n = len(found)
    low, high = sorted(d % (n + 1) for d in draws[:2])
    prefix, middle, suffix = ("".join(part) for part in (found[:low], found[low:high], found[high:]))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or draws[2] % 100 >= 90:
        return n, "plain", None, None, text
    if draws[3] % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def run(docs):
    found = fim.fill_in_middle(docs, ["doc_id"])
    return found.withColumn("back", fim.restore(F.col("output"), F.col("form"))).collect()


def check(rows, found):
    mine = sorted(((repr(r.doc_id), r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in found), key=repr)
    assert mine == sorted(((repr(key), *expected(key, text), text or "") for key, text in rows), key=repr)


def test_edge_rows(edge_docs, edge_rows):
    check([(r[0], r[1]) for r in edge_rows], run(edge_docs))


def test_no_documents(empty_docs):
    assert fim.fill_in_middle(empty_docs, ["doc_id", "n_words"]).collect() == []


def test_random_texts_of_all_widths(spark):
    rng = random.Random(4)
    stock = ["a", "Zebra", "z{", "@A", "[", "`", "é", "日本", "😀", "<P", "S>", "<M>", "<", ">", "\n", "\x00", " ", "9", "\u0300"]
    rows = [(i, "".join(rng.choice(stock) for _ in range(rng.randint(0, 40)))) for i in range(3000)]
    rows += [(5000 + i, "x" * i) for i in range(20)] + [(6000, "ab " * 600_000), (6001, " " * 1_500_000), (6002, "é" * 700_000)]
    found = run(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))
    check(rows, found)
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_forms_can_be_set_and_columns_kept(spark):
    rows = [(i, f"some words of text {i}", i) for i in range(200)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "meta.n"])
    made = fim.fill_in_middle(docs, ["doc_id", "meta.n"], plain_from=100, spm_below=100)
    assert made.columns[:2] == ["doc_id", "meta.n"]
    assert {(r.form, r["meta.n"] == r.doc_id) for r in made.collect()} == {("spm", True)}


def test_plan_has_no_shuffle(edge_docs):
    plan = fim.fill_in_middle(edge_docs.coalesce(1), ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="aZ@[`{é日😀 \n", max_size=30), min_size=1, max_size=6))
def test_marks(texts):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])]).astype(np.int64)
    ends, first = fim.units(data, offsets)
    wanted = [int(offset + len(text[: m.end()].encode())) - 1 for offset, text in zip(offsets, texts) for m in UNITS.finditer(text)]
    assert ends.select(np.arange(len(wanted))).tolist() == wanted
    places = np.arange(len(data) + 1)
    assert ends.rank(places).tolist() == np.searchsorted(wanted, places).tolist()
    starts = [i for i in range(len(data)) if data[i] & 0xC0 != 0x80]
    assert first.rank(places).tolist() == np.searchsorted(starts, places).tolist()


@pytest.mark.parametrize("byte", range(256))
def test_marks_of_single_bytes(byte):
    for at in range(8):
        word = np.array([byte << (8 * at)], np.uint64)
        top = 0x80 << (8 * at)
        assert bool(fim.letter_marks(word)[0] & np.uint64(top)) == chr(byte).encode("latin1").isalpha()
        assert bool(fim.continuation_marks(word)[0] & np.uint64(top)) == (0x80 <= byte < 0xC0)
