"""Labels and records to classifier, metrics, rule tree and audit tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.functions import patterns, text
from sievework.functions.scores import normalize_label_strict, predicted
from sievework.operators import audit, labels as label_ops, metrics, models
from sievework.operators.sampling import stratified_split
from sievework.session import settle
from sievework.sources import runs, tables


@dataclass(frozen=True)
class Run:
    """Models and tables of one training run."""

    model: models.TermModel
    tree: PipelineModel
    scored: DataFrame
    metrics: DataFrame
    report: DataFrame
    tree_report: DataFrame
    audit: DataFrame
    unlabeled: DataFrame

    def save(self, folder: str) -> None:
        runs.save_model(self.model, f"{folder}/model")
        runs.save_model(self.tree, f"{folder}/tree")
        runs.write_metrics(self.metrics, f"{folder}/metrics")
        tables.write_csv(self.audit, f"{folder}/audit")
        tables.write_csv(self.unlabeled, f"{folder}/unlabeled")


def flagged(rows: DataFrame) -> DataFrame:
    """Add the 37 pattern flags and the length flag."""
    return text.text_flags(rows, patterns.FLAG_PATTERNS, patterns.FLAG_LITERALS).withColumn(
        patterns.LENGTH_FLAG, text.length_flag()
    )


def labelled_rows(labels: DataFrame, records: DataFrame) -> DataFrame:
    """Labelled records with their split; computed once, as every later step reads it."""
    joined = label_ops.join_labels(normalize_label_strict(labels), records)
    return settle(stratified_split(joined))


def train(
    labels: DataFrame,
    records: DataFrame,
    fit_on: str = "all",
    max_iter: int = models.MAX_ITER,
    sample_size: int = 200,
) -> Run:
    """Train and evaluate on the labelled records, and score records for audit.

    With ``fit_on="all"`` vocabulary and document frequencies come from all labelled
    rows, those of the test part included; ``"train"`` keeps the test part out.
    """
    rows = labelled_rows(labels, records)
    train_rows = rows.filter(~F.col("is_test"))
    features = models.stack_features(rows if fit_on == "all" else train_rows)
    how = {"train": rows, "held_out": "is_test"} if fit_on == "all" else {"train": train_rows}
    model = models.train_logistic(features, **how, max_iter=max_iter)
    scored = settle(models.score_logistic(model, rows).withColumn("pred", predicted()))
    tested = scored.filter("is_test")

    with_flags = flagged(scored)
    tree = models.train_tree(with_flags.filter(~F.col("is_test")))
    tree_tested = models.score_tree(tree, with_flags.filter("is_test").drop("pred"))
    return Run(
        model=model,
        tree=tree,
        scored=scored,
        metrics=metrics.metrics_row(scored),
        report=metrics.classification_report(tested),
        tree_report=metrics.classification_report(tree_tested),
        audit=audit.audit_ranking(with_flags),
        unlabeled=audit.unlabeled_audit_sample(
            records, rows, lambda df: models.score_logistic(model, df), sample_size
        ),
    )
