"""Plans that have to hold when one key has most of the rows, or the table is large."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sievework.operators import audit, features, labels, sampling
from sievework.plans import training


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def conf(spark):
    changed = {}

    def set_all(**values):
        for name, value in values.items():
            name = name.replace("__", ".")
            changed[name] = spark.conf.get(name, None)
            spark.conf.set(name, value)

    yield set_all
    for name, value in changed.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_term_in_most_documents_is_split(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="16k",
        spark__sql__shuffle__partitions="16",
    )
    rare = F.concat(F.lit("w"), F.col("id") % 2000)
    hot = F.when(F.col("id") % 10 > 0, "hot ").otherwise("")
    docs = spark.range(0, 20000, 1, 16).select(F.col("id").alias("pmid"), F.concat(hot, rare).alias("text"))
    weights = features.tfidf(docs, "text", bigrams=False)
    rows = weights.collect()
    assert len(rows) == 38000 and sum(r.term == "hot" for r in rows) == 18000
    assert "skew=true" in plan(weights)


def test_a_hot_bucket_is_cut_down_before_rows_are_shuffled(spark):
    rare = (F.col("id") % 400 == 5).cast("int")
    df = spark.range(1000).select(
        F.col("id").alias("pmid"), rare.alias("has_mesh_consciousness_major"), rare.alias("has_mesh_consciousness")
    )
    for sample in (sampling.bucket_samples(df), sampling.sample_n(df, 50), sampling.sample_n(df, 5_000_000)):
        text = plan(sample)
        # Rows are compared with a cut-off where they are read; one task gets counts, and one slice of the hashes.
        for below in re.findall(r"Exchange SinglePartition.*\n(.*)", text):
            assert "_left#" in below or "partial" in below or "_n#" in below, below
        assert "_lane" not in text
        assert not re.search(r"Exchange hashpartitioning\(bucket", text)
    assert Counter(r.bucket for r in sampling.bucket_samples(df).collect()) == {"major": 3, "none": 60}


def test_records_are_not_shuffled_for_few_labels(spark, tmp_path):
    spark.range(1000).select(F.col("id").alias("pmid"), F.lit("t").alias("title"), F.lit("u").alias("unused")).write.parquet(str(tmp_path / "r"))
    few = spark.createDataFrame([(1, 1), (2000, 0)], "pmid bigint, label int")
    few.write.parquet(str(tmp_path / "l"))
    few, records = spark.read.parquet(str(tmp_path / "l")), spark.read.parquet(str(tmp_path / "r"))
    text = plan(labels.join_labels(few, records.select("pmid", "title")))
    assert "SortMergeJoin" not in text and "unused" not in text
    assert not re.search(r"Exchange hashpartitioning.*title", text)
    assert {tuple(r) for r in labels.join_labels(few, records.select("pmid", "title")).collect()} == {(1, 1, "t"), (2000, 0, None)}


def test_hot_key_in_dedup_is_reduced_before_the_shuffle(spark):
    rows = spark.range(10000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("pmid"), F.lit("1").alias("label"), F.col("id").alias("row_pos")
    )
    merged = labels.dedup_keep_last(labels.union_labels(rows, rows))
    assert re.search(r"Exchange.*\n.*Aggregate.*partial_max_by", plan(merged))
    assert merged.count() == rows.select("pmid").distinct().count()


def test_weights_of_a_short_vocabulary_need_no_shuffle(spark, tmp_path):
    words = F.concat_ws(" ", *(F.concat(F.lit("w"), (F.col("id") * k) % 50) for k in (1, 3, 7)))
    spark.range(0, 500, 1, 4).select(F.col("id").alias("pmid"), words.alias("text")).write.parquet(str(tmp_path / "t"))
    docs = spark.read.parquet(str(tmp_path / "t"))
    for how in ({}, {"sublinear": True, "max_features": 20}):
        weights = features.tfidf(docs, "text", **how)
        # The vocabulary is sent out; texts, terms and weights stay where they are.
        assert not re.search(r"Exchange (hash|range|Single|RoundRobin)", plan(weights))
        rows = weights.collect()
        lengths = Counter()
        for r in rows:
            lengths[r.pmid] += r.weight**2
        assert set(lengths) <= set(range(500)) and all(abs(v - 1) < 1e-9 for v in lengths.values())


def test_flags_are_not_in_the_plan_that_sorts_the_audit(spark):
    rows = spark.range(50).select(
        F.col("id").alias("pmid"), F.lit("qualia").alias("title"), F.lit("x").alias("abstract"), (F.col("id") % 2).cast("int").alias("label"),
        (F.col("id") / 50.0).alias("model_prob"),
    )
    ranked = audit.audit_ranking(training.flagged(rows))
    assert "RLIKE" not in plan(ranked).upper() and "regexp" not in plan(ranked).lower()
    assert [r.mismatch for r in ranked.collect()] == sorted((r.mismatch for r in ranked.collect()), reverse=True)
