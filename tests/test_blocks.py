"""Terms that meet their vocabulary by blocks of documents."""

import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sievework.catalog import feature_queries
from sievework.operators import blocks, features, models
from sievework.sources import runs

TEXTS = ["the cat sat on the mat", "the cat ran", "a dog and the cat", "dog dog DOG the", "", None, "cat sat; the cat sat", "the cat sat"]


def docs(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)] + [(None, "the cat")], "pmid bigint, text string").repartition(3)


def records(spark, n=200):
    word = F.concat(F.lit("w"), (F.col("id") * 7) % 90)
    meta = {c: F.col("id") % (2 + i) for i, c in enumerate(models.META_COLUMNS)}
    return spark.range(n).select(
        F.col("id").alias("pmid"), F.concat_ws(" ", word, F.lit("same"), F.concat(F.lit("v"), F.col("id") % 40)).alias("title"),
        F.lit("x").alias("abstract"), *(v.cast("int").alias(c) for c, v in meta.items()), (F.col("id") % 3 == 0).cast("int").alias("label"),
    )


def test_counts_of_lists(spark):
    lists = [re.findall(r"\w{2,}", (t or "").lower()) for t in TEXTS]
    names, doc, code, tf = blocks.counted(pa.array(lists, pa.list_(pa.string())), True)
    found = {(d, names[c].as_py()): n for d, c, n in zip(doc.tolist(), code.tolist(), tf.tolist())}
    assert found == {(i, t): n for i, l in enumerate(lists) for t, n in Counter([*l, *(f"{a} {b}" for a, b in zip(l, l[1:]))]).items()}


@pytest.mark.parametrize("words, rows", [(1_000_000, 50_000), (4, 50_000), (1_000_000, 2)])
def test_a_long_vocabulary_gives_the_weights_of_a_short_one_without_joining_all_counts(spark, monkeypatch, words, rows):
    monkeypatch.setattr(blocks, "WORDS_PER_BLOCK", words)
    monkeypatch.setattr(blocks, "ROWS_PER_BLOCK", rows)
    for how in ({}, {"sublinear": True, "stop_words": ["the"], "max_features": 4}):
        short = Counter((r.pmid, r.term, r.tf, r.df, round(r.weight, 12)) for r in features.tfidf(docs(spark), "text", min_df=2, **how).collect())
        with monkeypatch.context() as m:
            m.setattr(features, "BROADCAST_TERMS", 1)
            table = features.tfidf(docs(spark), "text", min_df=2, **how)
        text = table._jdf.queryExecution().executedPlan().toString()
        assert "FlatMapCoGroups" in text and "Window" not in text
        assert Counter((r.pmid, r.term, r.tf, r.df, round(r.weight, 12)) for r in table.collect()) == short


def test_the_driver_gets_no_vocabulary(spark, monkeypatch, tmp_path):
    """Features, given weights, coefficients, scores and storage move a handful of rows to the driver, however many terms there are."""
    rows, gathered = records(spark), []
    plain = type(rows).toArrow

    def counted(df):
        table = plain(df)
        gathered.append(table.num_rows)
        return table

    monkeypatch.setattr(type(rows), "toArrow", counted)
    made = type(rows.sparkSession).createDataFrame

    def small(session, data, *args, **kwargs):
        gathered.append(len(data))
        return made(session, data, *args, **kwargs)

    monkeypatch.setattr(type(rows.sparkSession), "createDataFrame", small)
    stacked = models.stack_features(rows)
    model = models.from_weights(stacked, spark.range(1).select(F.lit("same").alias("feature"), F.lit(2.0).alias("weight")))
    runs.save_model(model, str(tmp_path / "m"))
    back = runs.load_model(str(tmp_path / "m"))
    assert stacked.terms.n_terms > 100
    assert models.top_coefficients(back).count() == 40 and models.meta_coefficients(back).count() == 4
    assert models.score_logistic(back, rows).count() == 200
    assert max(gathered, default=0) <= 10


def test_places_of_terms_and_repeated_rows(spark):
    rows = records(spark)
    stacked = models.stack_features(rows)
    table = sorted(stacked.terms.table.collect(), key=lambda r: r.place)
    assert [r.place for r in table] == list(range(len(table))) and table == sorted(table, key=lambda r: (-r.df, r.term))
    twice = rows.limit(5).unionByName(rows.limit(5)).withColumn("pmid", F.lit(None).cast("bigint"))
    assert stacked.transform(twice).count() == 10


def test_the_stored_model_query_trains_one(spark, monkeypatch):
    rows = records(spark).withColumn("is_test", F.col("pmid") % 4 == 0)
    monkeypatch.setattr(feature_queries, "_labelled", lambda *_: rows)
    found = feature_queries.save_model(spark, "").collect()
    assert len(found) == 200 and all(r.same for r in found) and len({r.model_prob for r in found}) > 10


def test_rows_that_the_vocabulary_was_fitted_on_are_counted_once(spark, monkeypatch):
    rows = records(spark).withColumn("is_test", F.col("pmid") % 4 == 0)
    plain, calls = blocks.block_rows, []
    monkeypatch.setattr(blocks, "block_rows", lambda *args, **how: calls.append(1) or plain(*args, **how))
    stacked = models.stack_features(rows)
    model = models.train_logistic(stacked, rows, held_out="is_test")
    scored = {r.pmid: r.model_prob for r in models.score_logistic(model, rows).collect()}
    assert len(calls) == 1
    learned = models.train_logistic(stacked, rows.filter(~F.col("is_test")))
    again = {r.pmid: r.model_prob for r in models.score_logistic(learned, rows.filter("true")).collect()}
    assert len(calls) == 3 and len(scored) == 200 and again == pytest.approx(scored, abs=1e-5)


def test_names_of_terms_are_shuffled_to_blocks_only_where_they_are_asked_for(spark):
    model = models.stack_features(records(spark))
    plan = model.transform(records(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroups" in plan
    assert not re.search(r"Project \[_block#\d+L?, term", plan) and not re.search(r"Project \[_block.*code.*term#", plan)
