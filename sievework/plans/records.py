"""Raw tagged files to the record table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sievework.sources import tables, tagged


def load_records(spark: SparkSession, path, newline: str = "\n", strip_star: bool = False) -> DataFrame:
    """Read, parse and flag in one narrow stage, without a shuffle."""
    records = tagged.read_tagged_records(spark, path, newline)
    return tagged.record_table(tagged.parse_tagged_fields(records), strip_star)


def export_records(spark: SparkSession, path, parquet_path: str, csv_path: str | None = None) -> DataFrame:
    """Write the record table and return it as read from the main store."""
    tables.write_records(load_records(spark, path), parquet_path)
    stored = spark.read.parquet(parquet_path)
    if csv_path is not None:
        tables.export_record_table(stored, csv_path)
    return stored
