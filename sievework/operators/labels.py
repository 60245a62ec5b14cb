"""Label life cycle: clean, merge, de-duplicate, join to records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.scores import label_in_set, normalize_label


def drop_unlabeled(df: DataFrame, label: str = "label") -> DataFrame:
    return df.na.drop(subset=[label])


def keep_known_labels(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows whose raw label is one of the accepted spellings."""
    return df.filter(label_in_set(label))


def rejected_labels(df: DataFrame, label: str = "label") -> DataFrame:
    """How often each spelling outside the accepted ones occurs."""
    return df.filter(~label_in_set(label)).groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def union_labels(seed: DataFrame, reviewed: DataFrame, key: str = "pmid", order: str = "row_pos") -> DataFrame:
    """Seed labels followed by reviewed labels, both normalised; ``src_prio`` says which."""

    def cleaned(df: DataFrame, prio: int) -> DataFrame:
        return df.select(key, normalize_label("label").alias("label"), F.lit(prio).alias("src_prio"), order)

    return cleaned(seed, 0).unionByName(cleaned(reviewed, 1))


def duplicate_count(labels: DataFrame, key: str = "pmid") -> DataFrame:
    """Rows beyond the first of each key, one row; null is a key like any other."""
    per_key = labels.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_duplicates"))


def dedup_keep_last(labels: DataFrame, key: str = "pmid", order: str = "row_pos") -> DataFrame:
    """Last non-null label of each key; a reviewed label beats a seed label.

    An aggregation, so a key with very many labels is reduced before the shuffle.
    """
    return (
        labels.filter(F.col("label").isNotNull())
        .groupBy(key)
        .agg(F.max_by("label", F.struct("src_prio", order)).alias("label"))
    )


def sort_labels(labels: DataFrame, key: str = "pmid") -> DataFrame:
    return labels.orderBy(key)


def join_labels(labels: DataFrame, records: DataFrame, key: str = "pmid", suffix: str = "_all") -> DataFrame:
    """Every label with its record; a label without a record keeps null text.

    Columns of the record that the labels have too get ``suffix``. The labels are
    the small side. An inner join lets Spark send them to the records, or split a
    skewed key if they are many (store them first then: an aggregation right below a
    join keeps Spark from splitting it). Labels without a record are added
    afterwards, from a pass over the key column alone.
    """
    shared = [c for c in records.columns if c in labels.columns and c != key]
    right = records.withColumnsRenamed({c: c + suffix for c in shared})
    found = labels.join(right, key)
    known = records.select(key).join(labels.select(key), key, "left_semi").distinct()
    missing = labels.join(known, key, "left_anti")
    return found.unionByName(missing, allowMissingColumns=True)


def anti_join_labeled(records: DataFrame, labels: DataFrame, key: str = "pmid") -> DataFrame:
    """Records whose key has no label; a record without a key is kept."""
    return records.join(labels.select(key), key, "left_anti")


exclude_labeled = anti_join_labeled


def attach_columns(df: DataFrame, *others: DataFrame, key: str = "pmid") -> DataFrame:
    """Put columns of tables with the same keys side by side."""
    for other in others:
        df = df.join(other, key)
    return df


def distinct_ids(ids: DataFrame, key: str = "pmid") -> DataFrame:
    return ids.select(key).distinct()


def label_review_summary(predictions: DataFrame, before: DataFrame, after: DataFrame, key: str = "pmid") -> DataFrame:
    """One row: model against human labels, and what human review changed.

    ``predictions`` has key and ``pred``; ``before`` and ``after`` have key and
    ``label``, before and after the review.
    """
    rows = (
        predictions.select(key, "pred")
        .join(before.select(key, F.col("label").alias("_before")), key)
        .join(after.select(key, F.col("label").alias("_after")), key)
    )
    differs: Column = F.col("pred") != F.col("_before")
    changed: Column = F.col("_before") != F.col("_after")
    return rows.agg(
        F.count(F.lit(1)).alias("n_reviewed"),
        F.count_if(~differs).alias("n_agree"),
        F.count_if(differs).alias("n_mismatch"),
        F.count_if(changed).alias("n_corrected"),
        F.count_if(differs & changed).alias("n_mismatch_corrected"),
        F.count_if(F.col("pred") != F.col("_after")).alias("n_overridden"),
    )
