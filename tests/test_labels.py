import pytest

from sievework.functions import scores
from sievework.operators import labels as ops
from sievework.plans.labelling import merge_label_files, merge_labels


def frame(spark, rows):
    return spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(rows)], "pmid bigint, label string, row_pos int")


@pytest.mark.parametrize(
    "raw, expected",
    [("1", 1), (" TRUE ", 1), ("Yes", 1), ("0", 0), ("false", 0), ("no", 0), ("1.0", None), ("y", None), ("", None), (None, None)],
)
def test_normalize_label(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "label string")
    assert df.select(scores.normalize_label("label")).first()[0] == expected
    assert scores.normalize_label_strict(df).count() == (expected is not None)
    assert ops.keep_known_labels(df).count() == (expected is not None)


def test_integer_labels_are_accepted(spark):
    df = spark.createDataFrame([(1,), (0,), (2,)], "label int")
    assert [r.label for r in scores.normalize_label_strict(df).collect()] == [1, 0]


def test_merge_case(spark):
    seed = frame(spark, [(1, "0"), (2, "1"), (3, None)])
    reviewed = frame(spark, [(2, "0"), (3, "1"), (1, None)])
    merged, duplicates = merge_labels(seed, reviewed)
    assert [tuple(r) for r in merged.collect()] == [(1, 0), (2, 0), (3, 1)]
    assert duplicates.first().n_duplicates == 3
    again, _ = merge_labels(merged.selectExpr("pmid", "string(label) AS label", "1 AS row_pos"), frame(spark, []))
    assert again.collect() == merged.collect()


def test_last_of_several_rows_wins_and_null_keys_count_as_one(spark):
    seed = frame(spark, [(1, "0"), (1, "1"), (None, "1"), (None, "0"), (1, "x")])
    combined = ops.union_labels(seed, frame(spark, []))
    assert ops.duplicate_count(combined).first().n_duplicates == 3
    assert {tuple(r) for r in ops.dedup_keep_last(combined).collect()} == {(1, 1), (None, 0)}


def test_merge_files(spark, tmp_path):
    (tmp_path / "seed.csv").write_text('pmid,title,label\n1,"a, ""b""",0\n2,"two\nlines",1\n3,c,\n1,d,yes\n')
    (tmp_path / "rev.csv").write_text("pmid,model_prob,Human label\n2,0.4,0\n3,0.6,1\n")
    duplicates = merge_label_files(spark, str(tmp_path / "seed.csv"), str(tmp_path / "rev.csv"), str(tmp_path / "out"))
    assert duplicates.first().n_duplicates == 3
    rows = spark.read.option("header", True).csv(str(tmp_path / "out")).collect()
    assert sorted(tuple(r) for r in rows) == [("1", "1"), ("2", "0"), ("3", "1")]


def test_join_keeps_every_label_and_renames_overlaps(spark):
    labels = spark.createDataFrame([(1, 1), (9, 0), (None, 1)], "pmid bigint, label int")
    records = spark.createDataFrame([(1, "t", 5), (1, "u", 6), (2, "v", 7)], "pmid bigint, title string, label int")
    joined = ops.join_labels(labels, records)
    assert joined.columns == ["pmid", "label", "title", "label_all"]
    expected = {(1, 1, "t", 5), (1, 1, "u", 6), (9, 0, None, None), (None, 1, None, None)}
    assert {tuple(r) for r in joined.collect()} == expected


def test_anti_join_keeps_rows_without_key(spark):
    records = spark.createDataFrame([(1,), (2,), (None,)], "pmid bigint")
    labels = spark.createDataFrame([(1,), (None,)], "pmid bigint")
    assert {r.pmid for r in ops.anti_join_labeled(records, labels).collect()} == {2, None}


def test_review_summary(spark):
    pred = spark.createDataFrame([(i, int(i < 6)) for i in range(10)], "pmid int, pred int")
    before = spark.createDataFrame([(i, int(i < 4)) for i in range(10)], "pmid int, label int")
    after = spark.createDataFrame([(i, int(i < 5)) for i in range(10)], "pmid int, label int")
    row = ops.label_review_summary(pred, before, after).first()
    assert tuple(row) == (10, 8, 2, 1, 1, 1)


def test_score_columns(spark):
    df = spark.createDataFrame([(0.5, 1), (0.4, 1), (0.9, 0)], "model_prob double, label int")
    rows = scores.score_columns(df).collect()
    assert [(r.pred, r.mismatch, round(r.abs_margin, 9)) for r in rows] == [(1, False, 0.0), (0, True, 0.1), (1, True, 0.4)]
