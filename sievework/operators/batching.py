"""Bounded batches over large key sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.operators.ranking import ROWS_PER_RANGE, running_totals
from sievework.session import settle

# Most rows of a range, ids of a batch.
RANGE_LIMIT = 9000
IDS_PER_BATCH = 8000


def fixed_batches(
    ids: DataFrame, key: str = "pmid", batch_size: int = IDS_PER_BATCH, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Number the distinct ids in batches of ``batch_size``, in id order, from 1."""
    numbered = ids.select(key).filter(F.col(key).isNotNull()).distinct().withColumn("_one", F.lit(1).cast("bigint"))
    ranked = running_totals(numbered, key, {"_rank": "_one"}, rows_per_range=rows_per_range)
    return ranked.select(key, (F.floor((F.col("_rank") - 1) / batch_size) + 1).cast("bigint").alias("batch"))


def key_histogram(df: DataFrame, key: str, count: str | None = None) -> DataFrame:
    n = F.count(F.lit(1)) if count is None else F.sum(count)
    return df.groupBy(key).agg(n.alias("n"))


def _middle(low: Column, high: Column) -> Column:
    return F.shiftright(low + high, 1)


def range_bisect(
    histogram: DataFrame,
    low: int,
    high: int,
    limit: int = RANGE_LIMIT,
    key: str = "key",
    count: str = "n",
    levels: int = 6,
) -> DataFrame:
    """Halve [low, high] until no range holds more than ``limit`` rows.

    Returns ``lo, hi, n`` and ``over_limit``, which marks a single value above the
    limit; empty ranges are left out. Where a range is halved depends on its ends
    only, so one aggregation counts the next ``levels`` levels at once. Keys go on
    to the next round only while their range is still over the limit.
    """
    active = settle(
        histogram.filter(F.col(key).between(low, high)).select(
            F.col(key).cast("bigint").alias("_key"),
            F.col(count).alias("_n"),
            F.lit(low).cast("bigint").alias("_lo0"),
            F.lit(high).cast("bigint").alias("_hi0"),
        )
    )
    done, over = F.col("n") <= limit, F.col("n") > limit
    single = F.col("lo") == F.col("hi")
    leaves, first = [], True
    while True:
        path = active
        for i in range(levels):
            lo, hi, left = F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col("_key") <= F.col("_mid")
            path = path.withColumn("_mid", _middle(lo, hi)).withColumns(
                {
                    f"_lo{i + 1}": F.when(left, lo).otherwise(F.col("_mid") + 1),
                    f"_hi{i + 1}": F.when(left, F.col("_mid")).otherwise(hi),
                }
            )
        steps = F.array(
            *(
                F.struct(
                    F.lit(i).alias("depth"),
                    F.col(f"_lo{i}").alias("lo"),
                    F.col(f"_hi{i}").alias("hi"),
                    F.col(f"_lo{max(i - 1, 0)}").alias("parent_lo"),
                    F.col(f"_hi{max(i - 1, 0)}").alias("parent_hi"),
                )
                for i in range(levels + 1)
            )
        )
        nodes = settle(
            path.select("_n", F.explode_outer(steps).alias("_node"))
            .select("_n", "_node.*")
            .groupBy("depth", "lo", "hi", "parent_lo", "parent_hi")
            .agg(F.sum("_n").alias("n"))
        )
        split = nodes.filter(over & ~single).select(
            (F.col("depth") + 1).alias("depth"), F.col("lo").alias("parent_lo"), F.col("hi").alias("parent_hi")
        )
        children = nodes.filter("depth > 0").join(split, ["depth", "parent_lo", "parent_hi"], "left_semi")
        leaves.append(children.filter(done | single))
        if first:
            leaves.append(nodes.filter("depth = 0").filter(done | single))
            first = False
        still_over = nodes.filter(over & ~single & (F.col("depth") == levels)).select(
            F.col("lo").alias(f"_lo{levels}"), F.col("hi").alias(f"_hi{levels}")
        )
        if still_over.isEmpty():
            break
        active = settle(
            path.join(still_over, [f"_lo{levels}", f"_hi{levels}"], "left_semi").select(
                "_key", "_n", F.col(f"_lo{levels}").alias("_lo0"), F.col(f"_hi{levels}").alias("_hi0")
            )
        )
    return reduce(DataFrame.unionByName, leaves).select("lo", "hi", F.col("n").cast("bigint").alias("n"), over.alias("over_limit"))
