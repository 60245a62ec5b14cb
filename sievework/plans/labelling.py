"""From records to a labelling batch, and from label files to the merged label set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sievework.operators import labels as ops
from sievework.operators.sampling import stratified_seed_batch
from sievework.sources import tables


def export_seed_batch(records: DataFrame, path: str) -> None:
    tables.write_csv(stratified_seed_batch(records), path)


def merge_labels(seed: DataFrame, reviewed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The merged, sorted labels, and the number of duplicates among all rows."""
    combined = ops.union_labels(seed, reviewed)
    return ops.sort_labels(ops.dedup_keep_last(combined)), ops.duplicate_count(combined)


def merge_label_files(
    spark: SparkSession, seed_path, reviewed_path, out_path: str, reviewed_column: str = "Human label"
) -> DataFrame:
    """Merge two label files, write the result as CSV and return the duplicate count."""
    merged, duplicates = merge_labels(
        tables.read_labels(spark, seed_path), tables.read_labels(spark, reviewed_path, reviewed_column)
    )
    tables.write_csv(merged, out_path)
    return duplicates
