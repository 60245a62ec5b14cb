"""Repeatable samples and splits. The order is the MD5 of seed and key, so a sample
does not depend on how the table is partitioned."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.operators.ranking import first_in_order, quota_cutoffs, value_order

# Seed, batch size, rows per bucket, sample size, share of test rows.
SEED = 1073
BATCH_SIZE = 300
BUCKET_SIZES = {"major": 120, "any": 120, "none": 60}
SAMPLE_SIZE = 200
TEST_SHARE = 0.25
# A split by a column with more values than this is taken for a mistake.
MAX_CLASSES = 10_000

# Columns of a labelling batch.
BATCH_COLUMNS = (
    "pmid", "year", "journal", "title", "abstract", "mesh_terms", "pub_types",
    "has_mesh_consciousness_major", "has_mesh_consciousness", "has_mesh_spirit_religion", "n_mesh",
)


def bucket(major: str = "has_mesh_consciousness_major", anywhere: str = "has_mesh_consciousness") -> Column:
    """Sampling bucket of a record: major heading, any heading, or none."""
    return (
        F.when(F.col(major) == 1, "major")
        .when((F.col(major) == 0) & (F.col(anywhere) == 1), "any")
        .when(F.col(anywhere) == 0, "none")
    )


def select_batch_columns(df: DataFrame) -> DataFrame:
    """Columns of a labelling batch, with an empty label to fill in."""
    return df.select(*BATCH_COLUMNS, F.lit("").alias("label"))


def bucket_samples(
    records: DataFrame, sizes: Mapping[str, int] = BUCKET_SIZES, seed: int = SEED, key: str = "pmid"
) -> DataFrame:
    """Up to ``sizes[b]`` records of each bucket ``b``, with the ``bucket`` column."""
    rows = records.withColumn("bucket", bucket()).filter(F.col("bucket").isNotNull())
    return first_in_order(rows, sizes, seed, key, "bucket").drop("_order")


def stratified_seed_batch(
    records: DataFrame,
    sizes: Mapping[str, int] = BUCKET_SIZES,
    n: int = BATCH_SIZE,
    seed: int = SEED,
    key: str = "pmid",
) -> DataFrame:
    """The first labelling batch: a sample of each bucket, shuffled, at most ``n`` rows."""
    # At most as many rows as the bucket sizes add up to.
    rows = bucket_samples(records, sizes, seed, key)
    if sum(sizes.values()) > n:
        rows = first_in_order(rows, n, seed + 1, key).drop("_order")
    return select_batch_columns(rows.orderBy(value_order(key, seed + 1), key))


def head_n(df: DataFrame, n: int, seed: int = SEED + 1, key: str = "pmid") -> DataFrame:
    """The first ``n`` rows after a repeatable shuffle."""
    return sample_n(df, n, seed, key)


def sample_n(df: DataFrame, n: int = SAMPLE_SIZE, seed: int = SEED, key: str = "pmid") -> DataFrame:
    """``n`` random rows, or all if there are fewer."""
    return first_in_order(df, n, seed, key).orderBy("_order", key).drop("_order")


def split_quotas(df: DataFrame, label: str = "label", test_share: float = TEST_SHARE) -> DataFrame:
    """Test rows per class: ceil(share * n) in all, shared out by largest remainder.

    Ties go to the larger class. Takes one small job; there are as many rows as classes, and more than ``MAX_CLASSES`` are an error.
    """
    sizes = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).limit(MAX_CLASSES + 1).collect()}
    if len(sizes) > MAX_CLASSES:
        raise ValueError(f"column {label} has more than {MAX_CLASSES} classes")
    total = sum(sizes.values())
    wanted = math.ceil(test_share * total)
    quotas = {c: wanted * n // total for c, n in sizes.items()}
    by_remainder = sorted(sizes, key=lambda c: (-(wanted * sizes[c] % total), -sizes[c], c))
    for c in by_remainder[: wanted - sum(quotas.values())]:
        quotas[c] += 1
    field = df.schema[label].dataType.simpleString()
    return df.sparkSession.createDataFrame(list(quotas.items()), f"`{label}` {field}, quota bigint")


def stratified_split(
    df: DataFrame,
    label: str = "label",
    key: str = "pmid",
    test_share: float = TEST_SHARE,
    seed: int = SEED,
    exact: bool = True,
) -> DataFrame:
    """Add boolean ``is_test``, with the class shares of the whole in both parts.

    Exact class sizes need distinct keys and a label on every row. Rows are never
    shuffled: each class has one cut-off in the MD5 order, found from counts, and is
    compared with it. ``exact=False`` draws every row on its own, in a single pass.
    """
    order = value_order(key, seed)
    if not exact:
        digits = 8
        drawn = F.conv(F.substring(order, 1, digits), 16, 10).cast("bigint")
        return df.withColumn("is_test", drawn < int(test_share * 16**digits))
    keyed = df.select(label, order.alias("_order"), F.col(key).alias("_key"))
    cutoffs = quota_cutoffs(keyed, label, split_quotas(df, label, test_share))
    inside = F.struct(order.alias("o"), F.col(key).alias("k")) <= F.struct(
        F.col("_last_order").alias("o"), F.col("_last_key").alias("k")
    )
    return (
        df.join(F.broadcast(cutoffs), label, "left")
        .withColumn("is_test", F.coalesce(inside, F.lit(False)))
        .select(*df.columns, "is_test")
    )


def manual_review_sample(audited: DataFrame, n: int = SAMPLE_SIZE, seed: int = SEED, key: str = "pmid") -> DataFrame:
    """A sample of labelled rows with probability and flags, for reading by hand."""
    return sample_n(audited, n, seed, key)
