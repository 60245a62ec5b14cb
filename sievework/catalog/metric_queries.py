"""Registered queries: scores, evaluation, audit tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.catalog import base
from sievework.catalog.label_queries import _SPLIT
from sievework.functions import patterns
from sievework.functions.scores import score_columns
from sievework.operators import audit, labels as label_ops, metrics, sampling
from sievework.plans.training import flagged
from sievework.session import scratch_path
from sievework.sources import runs

PLACES = 6


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, PLACES) for c in columns})


def _scored(spark, sf):
    return base.scored_labels(spark, sf)


def _split_scored(spark, sf):
    return sampling.stratified_split(_scored(spark, sf))


def score_columns_query(spark, sf):
    return rounded(score_columns(_scored(spark, sf)), "abs_margin").select("pmid", "label", "model_prob", "pred", "mismatch", "abs_margin")


def class_weights(spark, sf):
    split = sampling.stratified_split(base.labels(spark, sf))
    return rounded(metrics.class_weights(split.filter(~F.col("is_test"))), "weight")


def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(_scored(spark, sf))


def derived_rates(spark, sf):
    rates = metrics.derived_rates(metrics.confusion_matrix(_scored(spark, sf)))
    return rounded(rates, "tpr_recall", "specificity_tnr", "balanced_accuracy")


def accuracy_pos_rate(spark, sf):
    return rounded(metrics.accuracy_pos_rate(_split_scored(spark, sf)), "test_pos_rate", "accuracy")


def classification_report(spark, sf):
    return rounded(metrics.classification_report(_scored(spark, sf)), "precision", "recall", "f1")


def roc_auc(spark, sf):
    return rounded(metrics.roc_auc(_scored(spark, sf)), "roc_auc")


def average_precision(spark, sf):
    return rounded(metrics.average_precision(_scored(spark, sf)), "average_precision")


def pr_curve(spark, sf):
    return rounded(metrics.pr_curve(_scored(spark, sf)), "precision", "recall")


def order_value_roc_auc(spark, sf):
    """A score with very many distinct values: does the price tell finished orders apart?"""
    orders = base.table(spark, sf, "orders").select(
        (F.col("o_orderstatus") == "F").cast("int").alias("label"), F.col("o_totalprice").alias("model_prob")
    )
    return rounded(metrics.roc_auc(orders, rows_per_range=1000), "roc_auc")


def write_metrics(spark, sf):
    path = scratch_path(spark, "metrics")
    runs.write_metrics(metrics.metrics_row(_split_scored(spark, sf)), path)
    return rounded(
        runs.read_metrics(spark, path),
        "test_pos_rate", "accuracy", "roc_auc", "pr_auc", "tpr_recall", "specificity_tnr", "balanced_accuracy",
    )


def _flagged(spark, sf):
    rec = base.records(spark, sf, phrases=True).select("pmid", "title", "abstract")
    return flagged(label_ops.join_labels(_scored(spark, sf).drop("pred"), rec))


def audit_ranking(spark, sf):
    return rounded(audit.audit_ranking(_flagged(spark, sf)), "abs_margin")


def audit_queue(spark, sf):
    """The first 50 rows of the ranking."""
    return rounded(audit.audit_ranking(_flagged(spark, sf), limit=50), "abs_margin")


def unlabeled_audit_sample(spark, sf):
    rec = base.records(spark, sf).select("pmid", "title", "abstract")
    sample = audit.unlabeled_audit_sample(
        rec, base.labels(spark, sf), lambda df: df.withColumn("model_prob", base.tie_score("pmid"))
    )
    return rounded(sample, "abs_margin")


def score_all(spark, sf):
    rec = base.records(spark, sf).select("pmid", "title", "abstract")
    return rounded(audit.score_all(rec, lambda df: df.withColumn("model_prob", base.tie_score("pmid"))), "abs_margin")


_SCORED = "WITH " + base.SQL_SCORED
_COUNTS = (
    "count(*) FILTER (label = 0 AND pred = 0) AS tn, count(*) FILTER (label = 0 AND pred = 1) AS fp, "
    "count(*) FILTER (label = 1 AND pred = 0) AS fn, count(*) FILTER (label = 1 AND pred = 1) AS tp"
)


def _ratio(top: str, bottom: str) -> str:
    return f"coalesce(CAST({top} AS DOUBLE) / nullif({bottom}, 0), 0)"


_RATES = (
    "round(tp / nullif(tp + fn, 0), 6) AS tpr_recall, round(tn / nullif(tn + fp, 0), 6) AS specificity_tnr, "
    "round((tp / nullif(tp + fn, 0) + tn / nullif(tn + fp, 0)) / 2, 6) AS balanced_accuracy"
)


def _steps(source: str) -> str:
    """Counts per distinct score and running counts from the top."""
    return (
        "per_score AS (SELECT model_prob AS score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg "
        f"FROM {source} GROUP BY model_prob), "
        "steps AS (SELECT *, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg FROM per_score WINDOW w AS (ORDER BY score DESC))"
    )


_ROC = "CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(neg * (cum_pos - pos / 2)) / (sum(pos) * sum(neg)) END"
_AP = "CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * cum_pos / (cum_pos + cum_neg)) / sum(pos) END"

def sql_report(ctes: str, source: str) -> str:
    """Classification report of ``source``, a table of ``ctes`` with label and pred."""
    return f"""
    {ctes}, c AS (SELECT {_COUNTS} FROM {source}),
    per_class AS (
      SELECT '0' AS row, {_ratio('tn', 'tn + fn')} AS precision, {_ratio('tn', 'tn + fp')} AS recall,
             {_ratio('2 * tn', '2 * tn + fn + fp')} AS f1, tn + fp AS support FROM c
      UNION ALL
      SELECT '1', {_ratio('tp', 'tp + fp')}, {_ratio('tp', 'tp + fn')}, {_ratio('2 * tp', '2 * tp + fn + fp')}, tp + fn FROM c),
    lines AS (
      SELECT * FROM per_class
      UNION ALL
      SELECT 'accuracy', a, a, a, n FROM (SELECT {_ratio('tn + tp', 'tn + fp + fn + tp')} AS a, tn + fp + fn + tp AS n FROM c)
      UNION ALL
      SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM per_class
      UNION ALL
      SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
             sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM per_class)
    SELECT row, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM lines"""


_SPLIT_SCORED = (
    f"WITH {base.SQL_SCORED}, split AS ({_SPLIT}), both_parts AS (SELECT scored.*, is_test FROM scored JOIN split USING (pmid)), "
    "tested AS (SELECT * FROM both_parts WHERE is_test)"
)
_PHRASED = "WITH " + base.sql_records(phrases=True) + ", " + base.SQL_SCORED


def _audit_sql() -> str:
    from sievework.catalog.record_queries import _sql_flags

    return (
        _PHRASED + f" SELECT pmid, title, abstract, label, model_prob, {_sql_flags(patterns.FLAG_PATTERNS)}, "
        "CAST(length(abstract) > 250 AS INTEGER) AS len_abstract_over_250, pred, pred <> label AS mismatch, "
        "round(abs(model_prob - 0.5), 6) AS abs_margin "
        "FROM (SELECT *, lower(concat(title, chr(10), abstract)) AS t FROM scored LEFT JOIN rec USING (pmid))"
    )


_REC_LAB = "WITH " + base.sql_records() + ", " + base.SQL_LABELS
_SCORE = base.sql_score("pmid")
_SCORED_REC = (
    f"SELECT pmid, title, abstract, {_SCORE} AS model_prob, CAST({_SCORE} >= 0.5 AS INTEGER) AS pred, "
    f"round(abs({_SCORE} - 0.5), 6) AS abs_margin FROM rec"
)

QUERIES = {
    "score_columns": (
        score_columns_query,
        _SCORED + " SELECT pmid, label, model_prob, pred, pred <> label AS mismatch, round(abs(model_prob - 0.5), 6) AS abs_margin FROM scored",
    ),
    "class_weights": (
        class_weights,
        f"WITH split AS ({_SPLIT}) SELECT label, count(*) AS n_class, "
        "round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight FROM split WHERE NOT is_test GROUP BY label",
    ),
    "confusion_matrix": (confusion_matrix, _SCORED + f" SELECT {_COUNTS} FROM scored"),
    "derived_rates": (derived_rates, _SCORED + f" SELECT *, {_RATES} FROM (SELECT {_COUNTS} FROM scored)"),
    "accuracy_pos_rate": (
        accuracy_pos_rate,
        _SPLIT_SCORED + " SELECT count(*) FILTER (NOT is_test) AS n_train, count(*) FILTER (is_test) AS n_test, "
        "round(avg(label) FILTER (is_test), 6) AS test_pos_rate, "
        "round(avg(CAST(pred = label AS INTEGER)) FILTER (is_test), 6) AS accuracy FROM both_parts",
    ),
    "classification_report": (classification_report, sql_report(_SCORED, "scored")),
    "roc_auc": (roc_auc, f"{_SCORED}, {_steps('scored')} SELECT round({_ROC}, 6) AS roc_auc FROM steps"),
    "average_precision": (
        average_precision,
        f"{_SCORED}, {_steps('scored')} SELECT round({_AP}, 6) AS average_precision FROM steps",
    ),
    "pr_curve": (
        pr_curve,
        f"{_SCORED}, {_steps('scored')} SELECT round(cum_pos / (cum_pos + cum_neg), 6) AS precision, "
        "round(cum_pos / (SELECT sum(pos) FROM per_score), 6) AS recall, score AS threshold FROM steps "
        "UNION ALL SELECT 1.0, 0.0, NULL",
    ),
    "order_value_roc_auc": (
        order_value_roc_auc,
        "WITH scored AS (SELECT CAST(o_orderstatus = 'F' AS INTEGER) AS label, o_totalprice AS model_prob FROM orders), "
        f"{_steps('scored')} SELECT round({_ROC}, 6) AS roc_auc FROM steps",
    ),
    "write_metrics": (
        write_metrics,
        f"{_SPLIT_SCORED}, {_steps('tested')}, c AS (SELECT {_COUNTS}, count(*) AS n_test, avg(label) AS rate, "
        "avg(CAST(pred = label AS INTEGER)) AS acc FROM tested) "
        "SELECT (SELECT count(*) FROM both_parts WHERE NOT is_test) AS n_train, n_test, round(rate, 6) AS test_pos_rate, "
        f"round(acc, 6) AS accuracy, (SELECT round({_ROC}, 6) FROM steps) AS roc_auc, (SELECT round({_AP}, 6) FROM steps) AS pr_auc, "
        f"tn, fp, fn, tp, {_RATES} FROM c",
    ),
    "audit_ranking": (audit_ranking, _audit_sql()),
    "audit_queue": (
        audit_queue,
        _audit_sql() + " ORDER BY mismatch DESC, round(abs(model_prob - 0.5), 12) DESC, pmid LIMIT 50",
    ),
    "unlabeled_audit_sample": (
        unlabeled_audit_sample,
        f"{_REC_LAB} {_SCORED_REC} WHERE pmid NOT IN (SELECT pmid FROM lab) "
        f"ORDER BY {base.sql_order('pmid', sampling.SEED)}, pmid LIMIT 200",
    ),
    "score_all": (score_all, f"{_REC_LAB} {_SCORED_REC}"),
}
