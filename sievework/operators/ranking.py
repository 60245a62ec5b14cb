"""Order-dependent work that no single task does alone."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.session import settle

# Values one task sorts.
ROWS_PER_RANGE = 1_000_000
# Tables of up to this many rows are small enough to send to every executor.
BROADCAST_ROWS = 100_000
# Samples of up to this many rows are merged from the tasks' own; Spark limits ranks of up to 1,000 rows before it shuffles them.
SMALL_SAMPLE = 999


def value_order(key: Column | str, seed: int) -> Column:
    """A repeatable random order: the MD5 of seed and key; a missing key counts as ""."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}-"), F.coalesce(key.cast("string"), F.lit(""))))


def running_totals(
    df: DataFrame,
    order: str,
    totals: Mapping[str, str],
    descending: bool = False,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add running sums over the whole table: ``totals`` maps new column to summed column.

    ``order`` holds distinct numbers; rows where it is null or NaN have no place in the order and are left out.
    The table is cut into value ranges of about equal size; each range is summed on its own and
    shifted by the sum of the ranges before it. Range sums are a table of the same kind, so
    where they are many they are summed in the same way.
    """
    placed = F.col(order).isNotNull() & ~F.isnan(F.col(order).cast("double"))
    table = settle(df.filter(placed))
    ranges = max(1, math.ceil(table.count() / rows_per_range))
    cuts: list[float] = []
    if ranges > 1:
        steps = [i / ranges for i in range(1, ranges)]
        cuts = sorted(set(table.approxQuantile(order, steps, 1 / (4 * ranges))))
    if cuts:
        ranged = (
            Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="_order", outputCol="_range")
            .transform(table.withColumn("_order", F.col(order).cast("double")))
            .withColumn("_range", F.col("_range").cast("int"))
            .drop("_order")
        )
    else:
        ranged = table.withColumn("_range", F.lit(0))

    def direction(name: str) -> Column:
        return F.desc(name) if descending else F.asc(name)

    within = (
        Window.partitionBy("_range").orderBy(direction(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = ranged.withColumns({new: F.sum(old).over(within) for new, old in totals.items()})
    if not cuts:
        return summed.drop("_range")
    # A sum of nothing but nulls counts 0 for the ranges behind it.
    sums = ranged.groupBy("_range").agg(*(F.coalesce(F.sum(old), F.lit(0)).alias(f"_sum_{new}") for new, old in totals.items()))
    if len(cuts) < rows_per_range:
        upto = Window.orderBy(direction("_range")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        upto_sums = sums.withColumns({f"_upto_{new}": F.sum(f"_sum_{new}").over(upto) for new in totals})
    else:
        placed_sums = sums.withColumnRenamed("_range", "_place")
        upto_names = {f"_upto_{new}": f"_sum_{new}" for new in totals}
        upto_sums = running_totals(placed_sums, "_place", upto_names, descending, rows_per_range)
        upto_sums = upto_sums.withColumnRenamed("_place", "_range")
    offsets = upto_sums.select("_range", *((F.col(f"_upto_{new}") - F.col(f"_sum_{new}")).alias(f"_before_{new}") for new in totals))
    if len(cuts) <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    return (
        summed.join(offsets, "_range")
        .withColumns({new: F.coalesce(new, F.lit(0)) + F.col(f"_before_{new}") for new in totals})
        .select(*df.columns, *totals)
    )


def first_in_order(df: DataFrame, limits: Mapping[object, int] | int, seed: int, key: str, group: str | None = None) -> DataFrame:
    """The first rows of each group (or of all) in the random order of their keys, with ``_order``.

    Two scans: one over key and group finds where each group's quota runs out, the other compares each row with that
    place where it is read, so only rows that stay go on. Rows that share the key at the cut-off are told apart by a hash of the
    whole row, and copies of one row by their number; only where there are such rows are they read once more.
    """
    ordered = df.withColumns({"_order": value_order(key, seed), "_group": F.col(group) if group else F.lit("")})
    quotas = {g: n for g, n in ({"": limits} if isinstance(limits, int) else dict(limits)).items() if n > 0}
    narrow = ordered.select("_group", "_order", F.col(key).alias("_key"))
    small = {g: n for g, n in quotas.items() if n <= SMALL_SAMPLE}
    cuts = {**_small_cuts(narrow, small), **_counted_cuts(narrow, {g: n for g, n in quotas.items() if g not in small})}
    inside, ties = F.lit(False), []
    for g, quota in quotas.items():
        here = F.col("_group") == F.lit(g)
        cut = cuts.get(g)
        if cut is None:  # the group is within its quota
            inside = inside | here
            continue
        same = F.col("_order") == cut.order
        before = (F.col("_order") < cut.order) | (same & _key_before(F.col(key), cut.key))
        at = same & F.col(key).eqNullSafe(F.lit(cut.key))
        if cut.beyond:
            inside = inside | (here & before)
            ties.append((here & at, cut.keep))
        else:
            inside = inside | (here & (before | at))
    kept = ordered.filter(inside)
    for at, keep in ties:
        kept = kept.unionByName(_some_of(ordered.filter(at), keep, df.columns))
    return kept.select(*df.columns, "_order")


@dataclass(frozen=True)
class Cut:
    """The last place inside a quota, how many rows of that place are inside, and whether there are more of them."""

    order: str
    key: object
    keep: int
    beyond: bool


def _key_before(key: Column, last: object) -> Column:
    """Whether ``key`` comes before ``last``; a missing key comes first."""
    if last is None:
        return F.lit(False)
    return key.isNull() | F.coalesce(key < F.lit(last), F.lit(False))


def _small_cuts(narrow: DataFrame, quotas: Mapping[object, int]) -> dict[object, Cut]:
    """Cuts of quotas of at most ``SMALL_SAMPLE`` rows: each task keeps its first rows of a group, and these are merged.

    One row more than the quota is looked at: it tells whether the group goes on, and with the same key. The driver sees no
    more than these rows' orders and keys.
    """
    if not quotas:
        return {}
    most = max(quotas.values()) + 1
    if len(quotas) == 1:
        only = next(iter(quotas))
        first = narrow.filter(F.col("_group") == F.lit(only)).orderBy("_order", "_key").limit(most)
    else:
        wanted = narrow.filter(F.col("_group").isin(*quotas))
        number = F.row_number().over(Window.partitionBy("_group").orderBy("_order", "_key"))
        first = wanted.withColumn("_number", number).filter(F.col("_number") <= most)
    seen: dict[object, list] = {}
    for row in first.select("_group", "_order", "_key").collect():
        seen.setdefault(row["_group"], []).append((row["_order"], row["_key"]))
    cuts = {}
    for g, quota in quotas.items():
        places = sorted(seen.get(g, []), key=lambda p: (p[0], p[1] is not None, p[1] if p[1] is not None else 0))
        if len(places) > quota:
            last = places[quota - 1]
            cuts[g] = Cut(*last, keep=sum(p == last for p in places[:quota]), beyond=places[quota] == last)
    return cuts


def _counted_cuts(narrow: DataFrame, quotas: Mapping[object, int]) -> dict[object, Cut]:
    """Cuts of larger quotas, from counts."""
    if not quotas:
        return {}
    field = narrow.schema["_group"].dataType.simpleString()
    sizes = {r["_group"]: r["n"] for r in narrow.filter(F.col("_group").isin(*quotas)).groupBy("_group").agg(F.count("*").alias("n")).collect()}
    over = [(g, n) for g, n in quotas.items() if sizes.get(g, 0) > n]
    if not over:
        return {}
    wanted = narrow.sparkSession.createDataFrame(over, f"_group {field}, quota bigint")
    found = quota_cutoffs(narrow, "_group", wanted).collect()
    return {r["_group"]: Cut(r["_last_order"], r["_last_key"], r["_keep"], r["_keep"] < r["_same"]) for r in found}


def _some_of(rows: DataFrame, keep: int, columns: list[str]) -> DataFrame:
    """``keep`` of rows that are all in one place of the order: the first by a hash of the row.

    The hash's cut-off comes from counts of hash slices, so that many rows are no one task's; rows that are equal in hash as well
    are copies, of which any will do.
    """
    hashed = rows.withColumn("_hash", F.xxhash64(*(F.col(f"`{c}`") for c in columns)))
    high = F.shiftright("_hash", 48).alias("_high")
    counts = hashed.groupBy(high).agg(F.count("*").alias("n")).toArrow().sort_by("_high")  # at most 65,536 rows
    upto = counts["n"].to_numpy().cumsum()
    at = int((upto < keep).sum())
    edge, left = counts["_high"][at].as_py(), keep - (int(upto[at - 1]) if at else 0)
    inside = hashed.filter(F.shiftright("_hash", 48) < edge)
    slice_ = hashed.filter(F.shiftright("_hash", 48) == edge)
    values = slice_.groupBy("_hash").agg(F.count("*").alias("_n"))
    upto_value = F.sum("_n").over(Window.orderBy("_hash").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # The slice has about 1/65536 of the different rows; copies count once.
    last = values.withColumn("_upto", upto_value).filter((F.col("_upto") >= left) & (F.col("_upto") - F.col("_n") < left)).first()
    copies = left - (last["_upto"] - last["_n"])
    whole = inside.unionByName(slice_.filter(F.col("_hash") < last["_hash"]))
    return whole.unionByName(slice_.filter(F.col("_hash") == last["_hash"]).limit(copies)).drop("_hash")


def quota_cutoffs(keyed: DataFrame, group: str, quotas: DataFrame) -> DataFrame:
    """Per group, the last (``_order``, ``_key``) that is inside the group's quota, how many rows of it are (``_keep``), and how many there are (``_same``).

    ``keyed`` has columns group, ``_order`` (an MD5) and ``_key``; ``quotas`` has
    group and ``quota``. MD5 values are counted by their first four digits; only
    the slice in which the quota runs out, about 1/65536 of a group's keys, is sorted, after its
    rows have been counted by key: a key with very many rows is one row there.
    """
    slices = keyed.groupBy(group, F.substring("_order", 1, 4).alias("_slice")).agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edges = (
        slices.withColumn("_upto", F.sum("_n").over(upto))
        .join(quotas, group)
        .filter((F.col("_upto") >= F.col("quota")) & (F.col("_upto") - F.col("_n") < F.col("quota")))
        .select(group, "_slice", (F.col("quota") - F.col("_upto") + F.col("_n")).alias("_left"))
    )
    keys = (
        keyed.withColumn("_slice", F.substring("_order", 1, 4))
        .join(F.broadcast(edges), [group, "_slice"])
        .groupBy(group, "_left", "_order", "_key").agg(F.count(F.lit(1)).alias("_same"))
    )
    inside = Window.partitionBy(group).orderBy("_order", "_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        keys.withColumn("_through", F.sum("_same").over(inside))
        .filter((F.col("_through") >= F.col("_left")) & (F.col("_through") - F.col("_same") < F.col("_left")))
        .select(
            group, F.col("_order").alias("_last_order"), F.col("_key").alias("_last_key"),
            (F.col("_left") - F.col("_through") + F.col("_same")).alias("_keep"), "_same",
        )
    )
