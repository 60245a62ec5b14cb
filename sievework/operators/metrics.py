"""Exact evaluation of a scored table with columns ``label`` and ``model_prob`` / ``pred``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.operators.ranking import ROWS_PER_RANGE, running_totals


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weights, one row per class: n / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    total = counts.agg(F.sum("n_class")).scalar()
    classes = counts.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("weight", total / (classes * F.col("n_class")))


def with_class_weight(df: DataFrame, label: str = "label", out: str = "weight", of: DataFrame | None = None) -> DataFrame:
    """Add each row's balanced weight. There are as many weights as classes; Spark sends them out if they are few.

    ``of`` is a table with the same labels that is cheaper to count than ``df``; its two or so weights are always sent out.
    """
    weights = class_weights(df if of is None else of, label).select(label, F.col("weight").alias(out))
    return df.join(weights if of is None else F.broadcast(weights), label)


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """One row: tn, fp, fn, tp."""
    y, p = F.col(label), F.col(pred)
    return df.agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def derived_rates(confusion: DataFrame) -> DataFrame:
    """Add recall, specificity and balanced accuracy; null where undefined."""
    recall = F.try_divide(F.col("tp"), F.col("tp") + F.col("fn"))
    specificity = F.try_divide(F.col("tn"), F.col("tn") + F.col("fp"))
    return confusion.withColumns(
        {
            "tpr_recall": recall,
            "specificity_tnr": specificity,
            "balanced_accuracy": (recall + specificity) / 2,
        }
    )


def accuracy_pos_rate(df: DataFrame, label: str = "label", pred: str = "pred", test: str = "is_test") -> DataFrame:
    """One row: sizes of both parts, and accuracy and share of positives of the test part."""
    is_test = F.col(test)
    return df.agg(
        F.count_if(~is_test).alias("n_train"),
        F.count_if(is_test).alias("n_test"),
        F.avg(F.when(is_test, F.col(label).cast("double"))).alias("test_pos_rate"),
        F.avg(F.when(is_test, (F.col(label) == F.col(pred)).cast("double"))).alias("accuracy"),
    )


def classification_report(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """Rows "0", "1", "accuracy", "macro avg" and "weighted avg" of precision, recall, f1, support."""

    def ratio(top: Column, bottom: Column) -> Column:
        return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))

    def scores(hit: str, false_alarm: str, miss: str) -> dict[str, Column]:
        h, a, m = F.col(hit), F.col(false_alarm), F.col(miss)
        return {
            "precision": ratio(h, h + a),
            "recall": ratio(h, h + m),
            "f1": ratio(2 * h, 2 * h + a + m),
            "support": h + m,
        }

    zero, one = scores("tn", "fn", "fp"), scores("tp", "fp", "fn")
    total = zero["support"] + one["support"]
    accuracy = ratio(F.col("tn") + F.col("tp"), total)
    measures = ("precision", "recall", "f1")
    macro = {m: (zero[m] + one[m]) / 2 for m in measures} | {"support": total}
    weighted = {m: ratio(zero[m] * zero["support"] + one[m] * one["support"], total) for m in measures}
    lines = {
        "0": zero,
        "1": one,
        "accuracy": {m: accuracy for m in measures} | {"support": total},
        "macro avg": macro,
        "weighted avg": weighted | {"support": total},
    }
    rows = F.array(
        *(F.struct(F.lit(name).alias("row"), *(c.alias(m) for m, c in line.items())) for name, line in lines.items())
    )
    return confusion_matrix(df, label, pred).select(F.inline(rows))


def score_steps(
    df: DataFrame, label: str = "label", score: str = "model_prob", rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """One row per distinct score: ``pos`` and ``neg`` at it, ``cum_pos`` and ``cum_neg`` at or above it."""
    per_score = df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    return running_totals(
        per_score, "score", {"cum_pos": "pos", "cum_neg": "neg"}, descending=True, rows_per_range=rows_per_range
    )


def _area(steps: DataFrame, name: str) -> DataFrame:
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    positives, negatives = F.sum(pos), F.sum(neg)
    if name == "roc_auc":
        # Each negative counts the positives above it, and half of those tied with it.
        area = F.try_divide(F.sum(neg * (F.col("cum_pos") - pos / 2)), positives * negatives)
    else:
        area = F.try_divide(F.sum(pos * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))), positives)
    return steps.agg(F.when((positives > 0) & (negatives > 0), area).alias(name))


def roc_auc(df: DataFrame, label: str = "label", score: str = "model_prob", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Area under the ROC curve, ties by trapezoid; null if there is one class only."""
    return _area(score_steps(df, label, score, rows_per_range), "roc_auc")


def average_precision(
    df: DataFrame, label: str = "label", score: str = "model_prob", rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Sum over distinct scores of the gain in recall times precision; null if there is one class only."""
    return _area(score_steps(df, label, score, rows_per_range), "average_precision")


def pr_curve(df: DataFrame, label: str = "label", score: str = "model_prob", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Precision and recall at each distinct score, and the end point (1, 0) without threshold."""
    steps = score_steps(df, label, score, rows_per_range)
    positives = steps.agg(F.sum("pos")).scalar()
    points = steps.select(
        (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
        F.try_divide(F.col("cum_pos"), positives).alias("recall"),
        F.col("score").cast("double").alias("threshold"),
    )
    end = df.sparkSession.range(1).select(
        F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"), F.lit(None).cast("double").alias("threshold")
    )
    return points.unionByName(end)


def metrics_row(
    scored: DataFrame,
    label: str = "label",
    score: str = "model_prob",
    pred: str = "pred",
    test: str = "is_test",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """The 13 measures of a run in one row; the scored table is read for counts once and for curves once."""
    tested = scored.filter(F.col(test))
    steps = score_steps(tested, label, score, rows_per_range)
    counts = derived_rates(confusion_matrix(tested, label, pred))
    total = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    return counts.select(
        scored.filter(~F.col(test)).agg(F.count(F.lit(1))).scalar().alias("n_train"),
        total.alias("n_test"),
        F.try_divide(F.col("fn") + F.col("tp"), total).alias("test_pos_rate"),
        F.try_divide(F.col("tn") + F.col("tp"), total).alias("accuracy"),
        _area(steps, "roc_auc").scalar().alias("roc_auc"),
        _area(steps, "average_precision").scalar().alias("pr_auc"),
        "tn", "fp", "fn", "tp", "tpr_recall", "specificity_tnr", "balanced_accuracy",
    )
