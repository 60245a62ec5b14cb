import pytest
from pyspark.sql import functions as F

from sievework.operators import audit, metrics


def table(spark, rows):
    return spark.createDataFrame(rows, "label int, model_prob double").withColumn("pred", (F.col("model_prob") >= 0.5).cast("int"))


def confusion(spark):
    rows = [(0, 0.1)] * 85 + [(0, 0.9)] * 15 + [(1, 0.1)] * 6 + [(1, 0.9)] * 19
    return table(spark, rows)


def test_confusion_arithmetic(spark):
    row = metrics.derived_rates(metrics.confusion_matrix(confusion(spark))).first()
    assert (row.tn, row.fp, row.fn, row.tp) == (85, 15, 6, 19)
    assert (row.tpr_recall, row.specificity_tnr, row.balanced_accuracy) == pytest.approx((0.76, 0.85, 0.805))
    both = metrics.accuracy_pos_rate(confusion(spark).withColumn("is_test", F.lit(True))).first()
    assert tuple(both) == (0, 125, pytest.approx(0.2), pytest.approx(0.832))


def test_ties(spark):
    df = table(spark, [(1, 0.9), (1, 0.5), (0, 0.5), (0, 0.1)])
    assert metrics.roc_auc(df).first()[0] == pytest.approx(0.875)
    assert metrics.average_precision(df).first()[0] == pytest.approx(1 / 2 + 1 / 3)
    points = [tuple(r) for r in metrics.pr_curve(df).orderBy(F.desc_nulls_first("threshold")).collect()]
    assert points == [(1.0, 0.0, None), (1.0, 0.5, 0.9), (pytest.approx(2 / 3), 1.0, 0.5), (0.5, 1.0, 0.1)]


@pytest.mark.parametrize("rows_per_range", [3, 10**6])
def test_curves_against_brute_force(spark, rows_per_range):
    rows = [(int(i * 7 % 11 < 4), (i * 37 % 101) / 40.0) for i in range(150)]
    pos = [s for y, s in rows if y]
    neg = [s for y, s in rows if not y]
    area = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    precision = sum(sum(q >= p for q in pos) / sum(s >= p for _, s in rows) for p in pos) / len(pos)
    df = table(spark, rows)
    assert metrics.roc_auc(df, rows_per_range=rows_per_range).first()[0] == pytest.approx(area)
    assert metrics.average_precision(df, rows_per_range=rows_per_range).first()[0] == pytest.approx(precision)


def test_one_class_has_no_area(spark):
    df = table(spark, [(0, 0.2), (0, 0.7)])
    assert metrics.roc_auc(df).first()[0] is None
    assert metrics.average_precision(df).first()[0] is None
    row = metrics.metrics_row(df.withColumn("is_test", F.lit(True))).first()
    assert row.roc_auc is None and row.tpr_recall is None and row.specificity_tnr == 0.5


def test_report(spark):
    rows = {r.row: r for r in metrics.classification_report(confusion(spark)).collect()}
    assert rows["1"].precision == pytest.approx(19 / 34) and rows["1"].recall == pytest.approx(0.76)
    assert rows["0"].support == 100 and rows["weighted avg"].support == 125
    assert rows["weighted avg"].recall == pytest.approx(rows["accuracy"].precision) == pytest.approx(0.832)
    empty = {r.row: r for r in metrics.classification_report(table(spark, [(0, 0.1)])).collect()}
    assert (empty["1"].precision, empty["1"].recall, empty["1"].f1, empty["1"].support) == (0.0, 0.0, 0.0, 0)


def test_class_weights(spark):
    df = spark.createDataFrame([(1,)] * 77 + [(0,)] * 298, "label int")
    weights = {r.label: r.weight for r in metrics.class_weights(df).collect()}
    assert weights == {1: pytest.approx(375 / (2 * 77)), 0: pytest.approx(375 / (2 * 298))}
    assert metrics.with_class_weight(df).agg(F.sum("weight")).first()[0] == pytest.approx(375)


def test_audit_order(spark):
    rows = [("a", 1, 0.9), ("b", 0, 0.95), ("c", 1, 0.4), ("d", 0, 0.1)]
    df = spark.createDataFrame(rows, "pmid string, label int, model_prob double").selectExpr("*", "'' AS title", "'' AS abstract")
    assert [r.pmid for r in audit.audit_ranking(df, flags=[]).collect()] == ["b", "c", "a", "d"]
    assert [r.pmid for r in audit.audit_ranking(df, flags=[], limit=1).collect()] == ["b"]


def test_unlabeled_sample(spark):
    recs = spark.range(50).selectExpr("id AS pmid", "'' AS title", "'' AS abstract")
    labels = spark.range(0, 50, 2).withColumnRenamed("id", "pmid")

    def score(df):
        return df.withColumn("model_prob", F.lit(0.25))

    rows = audit.unlabeled_audit_sample(recs, labels, score, n=10).collect()
    assert len(rows) == 10 and all(r.pmid % 2 and r.pred == 0 and r.abs_margin == 0.25 for r in rows)
    assert audit.unlabeled_audit_sample(recs, recs, score).count() == 0
