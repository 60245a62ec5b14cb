import re

import pytest
from pyspark.sql import functions as F

from sievework.llm import mixing


def targets(sizes):
    """Reshare what is over the limit until none is above it."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        open_ = [s for s in names if s not in capped]
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            return {**{s: 3.0 * sizes[s] for s in capped}, **share}
        capped |= over


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, "c": 10, "d": 5, None: 7}, {"a": 5}, {"a": 0, "b": 9}, {"é": 50, "z": 3, "Z": 3000},
])
def test_targets(spark, sizes):
    sums = spark.createDataFrame(list(sizes.items()), "_source string, _n bigint")
    found = {r["_source"]: r.target for r in mixing.source_targets(sums).collect()}
    assert found == pytest.approx(targets(sizes))


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(rows, given):
    by_source = {}
    for r in rows:
        assert r["_size"] == size(r.text) and 0 <= r["_taken"] <= 3 * r["_size"]
        by_source.setdefault(r.source, []).append(r)
    sizes = {s: sum(r["_size"] for r in group) for s, group in by_source.items()}
    wanted = targets(sizes)
    for s, group in by_source.items():
        assert group[0].source_size == sizes[s]
        assert group[0].target == pytest.approx(wanted[s])
        assert abs(sum(r["_taken"] for r in group) - wanted[s]) <= 1
        epochs = int(wanted[s] // sizes[s] + 1e-9) if sizes[s] else 0
        # Complete epochs come first: nobody is taken less or, but for one fraction, more.
        assert all(min(epochs, 3) * r["_size"] <= r["_taken"] <= (epochs + 1) * r["_size"] for r in group)
    assert len(rows) == given


def test_edge_rows(edge_docs, edge_rows, empty_docs):
    used = edge_docs.select("doc_id", "text", "source")
    rows = mixing.take_words(used).collect()
    check(rows, len(edge_rows))
    again = mixing.take_words(used.repartition(5)).collect()
    assert sorted((str(r.doc_id), r["_taken"]) for r in rows) == sorted((str(r.doc_id), r["_taken"]) for r in again)
    assert mixing.take_words(empty_docs.select("doc_id", "text", "source")).count() == 0
    assert mixing.mix(empty_docs).count() == 0


def test_mixed_rows_hold_the_words_taken(edge_docs):
    taken = mixing.take_words(edge_docs.select("doc_id", "text", "source"))
    wanted = {r.source: r.n for r in taken.groupBy("source").agg(F.sum("_taken").alias("n")).collect() if r.n}
    mixed = mixing.mix(edge_docs)
    assert mixed.columns == edge_docs.columns
    found = {}
    for r in mixed.collect():
        found[r.source] = found.get(r.source, 0) + size(r.text)
    assert found == wanted


def test_heavier_documents_come_first(spark):
    rows = [(i, "word " * 10 if i % 2 else "x" * 400 + " y" * 9, "big") for i in range(2000)] + [(9999, "w " * 9000, "a")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    taken = mixing.take_words(docs).filter("source = 'big' and _taken > 0").collect()
    assert sum(r.doc_id % 2 for r in taken) > 0.55 * len(taken)


def test_source_is_never_sorted_whole(spark, edge_docs):
    plan = mixing.take_words(edge_docs.select("doc_id", "text", "source"))._jdf.queryExecution().optimizedPlan().toString()
    assert "_slice" in plan and "_cut" in plan


def test_words_are_counted_once(edge_docs):
    docs = edge_docs.select("doc_id", "text", "source")
    for with_text in (True, False):
        taken = mixing.take_words(docs, with_text=with_text)
        # What gives the rows out reads stored sizes: no pattern meets a text again.
        assert "regexp" not in taken._jdf.queryExecution().optimizedPlan().toString().lower()
        assert ("text" in taken.columns) == with_text
    narrow = sorted((str(r.doc_id), r["_size"], r["_taken"]) for r in taken.collect())
    assert narrow == sorted((str(r.doc_id), r["_size"], r["_taken"]) for r in mixing.take_words(docs).collect())
