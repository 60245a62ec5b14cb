import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sievework.llm import secrets


@pytest.fixture(scope="module")
def folder(spark, edge_docs, edge_labels, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    edge_docs.write.parquet(f"{path}/documents.parquet")
    edge_labels.write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_on_edge_rows(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, counts = docs.columns, []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = str(tmp_path / str(number))
        stage(spark, docs, folder).write.parquet(out)
        docs = spark.read.parquet(out)
        counts.append(docs.count())
        if number < 4:
            assert docs.columns == columns
        if number == 1:
            assert sorted(str(r.doc_id) for r in docs.collect()) == sorted(["1", "2", "3", "6", "None", "13"])
    assert counts[0] == 9  # null, empty, short and repetitive ones are gone


def test_dotted_names_hot_rows_and_long_texts(spark, edge_docs, edge_labels, tmp_path):
    """Names with dots, a row that is a third of the table, a text with a million blanks and one over a slice."""
    rng = random.Random(6)
    words = [f"word{i}" for i in range(4000)]
    prose = [" ".join(rng.choice(words) for _ in range(80)) for _ in range(41)]
    rows = [(i, prose[i], "en", f"s{i % 3}") for i in range(40)] + [(500, prose[40], "en", "s0")] * 25
    rows += [(600, f"{prose[0][:300]}{' ' * 1_100_000}{prose[1][:300]} and then some", "en", "s1")]
    rows += [(601, " ".join(rng.choice(words) for _ in range(120_000)), "en", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    docs = docs.withColumn("n_chars", F.length("text")).withColumn("meta.url", F.lit("u")).withColumn("n_words", F.lit("x")).withColumn("_slice.no", F.lit(3))
    docs.repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    edge_labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns, seen = docs.columns, []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(str(tmp_path / str(number)))
        docs = spark.read.parquet(str(tmp_path / str(number)))
        if number < 4:
            assert docs.columns == columns
            seen.append(sorted(r.doc_id for r in docs.select("doc_id").collect()))
    assert seen[0].count(500) == 25 and {600, 601} <= set(seen[0])
    assert seen[1] == sorted([*range(40), 500, 600, 601]) == seen[2]
    assert {600, 601} & {r.doc_id for r in docs.collect()}


def test_stages_on_nothing(spark, edge_docs, edge_labels, tmp_path):
    edge_docs.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    edge_labels.write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_run_over_the_small_tables(spark):
    d = "/root/testdata/sf0.001"
    pieces = corpus_pipeline.run(spark, d).collect()
    ids = {r.doc_id for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    assert pieces and {p.doc_id for p in pieces} <= ids
    total = sum(p.length for p in pieces)
    assert max(p.sequence_id for p in pieces) == (total - 1) // 1024


def test_secrets_are_gone_after_their_stage(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    marked = corpus_pipeline.secret_scan(spark, docs, d).collect()
    assert len(marked) == docs.count()
    for r in marked:
        assert not secrets.ACCESS.search(r.text.encode()) and not re.search("[0-9a-f]{16}", r.text)
        assert r.n_chars == len(r.text)
