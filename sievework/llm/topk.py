"""Exact top-k inner products through a pivot-distance index.

Inner products become distances by one more coordinate: with M the largest norm, x' = (x,
sqrt(M^2 - |x|^2)) and q' = (q, 0) give |q' - x'|^2 = |q|^2 + M^2 - 2 q.x. Every vector is keyed by
its nearest pivot and its distance to it, and each pivot's vectors are cut into annuli of that
distance. A query first searches its own annulus, which bounds its k-th score; the bound is a
radius, and by the triangle inequality only vectors whose pivot distance is within that radius of
the query's can do better. Whole annuli outside it are never sent to the query, and inside an
annulus the sorted distances are searched outwards until the bound ends the expansion.

Rows of queries meet rows of vectors in blocks of bounded size: large annuli (ties, copies) are
split, and so are crowds of queries. Results are exact.

Components are floor(scale * x) as integers. Vectors that are null, have a null or non-finite
component, or have no id take no part. Shorter vectors count as padded with zeros. Ids may repeat:
each row is a query or a candidate of its own. Columns other than id and vector are not read. An
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.llm import columns as C
from sievework.session import stored

# Rows of a block, pivots and annuli of a pivot, at most; and the rows that pivots are chosen from.
BLOCK_ROWS = 2_000
MAX_PIVOTS = 256
MAX_ANNULI = 256
PIVOT_SAMPLE = 4_096
FOUND = "_query bigint, query_id bigint, vec_id bigint, score bigint"


def whole_vectors(vectors: DataFrame, scale: float, key: str, vector: str) -> DataFrame:
    """Stored table of the rows that take part: ``_row``, ``vec_id``, ``_ints``."""
    value = F.col(vector)
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = vectors.filter(F.col(key).isNotNull() & F.coalesce(finite, F.lit(False)))
    ints = F.transform(value, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    return stored(good.select(F.monotonically_increasing_id().alias("_row"), F.col(key).cast("bigint").alias("vec_id"), ints.alias("_ints")))


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """The vectors as rows of a matrix, padded with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), dim), np.int64)
    at = np.repeat(np.arange(len(column)) * dim - np.concatenate([[0], np.cumsum(sizes)])[:-1], sizes)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out.reshape(-1)[at + np.arange(len(flat))] = flat
    return out


def _pivots(sample: np.ndarray, most: int) -> np.ndarray:
    """Farthest-first choice of at most ``most`` rows of ``sample``."""
    chosen = [0]
    distance = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < most and distance.max() > 0:
        chosen.append(int(distance.argmax()))
        distance = np.minimum(distance, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def _lifted(ints: np.ndarray, largest: float) -> np.ndarray:
    values = ints.astype(np.float64)
    return np.column_stack([values, np.sqrt(np.maximum(largest - (values**2).sum(axis=1), 0.0))])


def _distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (points**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1)[None] - 2 * points @ pivots.T
    return np.sqrt(np.maximum(squares, 0.0))


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best by (score down, id up)."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
        return at[np.lexsort((ids[at], -scores[at]))[:k]]
    return np.lexsort((ids, -scores))


def _search(dim: int, largest: float, k: int, exact_floats: bool):
    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[list[np.ndarray]] = [[], [], [], []]
        if vectors.num_rows and queries.num_rows:
            order = np.argsort(vectors["_distance"].to_numpy(), kind="stable")
            distance = vectors["_distance"].to_numpy()[order]
            rows, ids = vectors["_row"].to_numpy()[order], vectors["vec_id"].to_numpy()[order]
            kind = np.float64 if exact_floats else np.int64
            matrix = _matrix(vectors["_ints"], dim)[order].astype(kind)
            asked = _matrix(queries["_ints"], dim).astype(kind)
            squares = (asked.astype(np.float64) ** 2).sum(axis=1)
            at, least = queries["_distance"].to_numpy(), queries["_least"].to_numpy()
            for i, row in enumerate(queries["_row"].to_numpy()):
                # The k-th score so far is a radius around the query, and so a range of pivot distances.
                radius = np.sqrt(max(squares[i] + largest - 2.0 * least[i], 0.0)) * (1 + 1e-9) + 1e-6
                low = np.searchsorted(distance, at[i] - radius, "left")
                high = np.searchsorted(distance, at[i] + radius, "right")
                scores = (matrix[low:high] @ asked[i]).astype(np.int64)
                good = np.flatnonzero((scores >= least[i]) & (rows[low:high] != row))
                if len(good):
                    top = good[_best(scores[good], ids[low:high][good], k)]
                    for into, values in zip(found, (np.full(len(top), row), np.full(len(top), queries["vec_id"][i].as_py()), ids[low:high][top], scores[top])):
                        into.append(values)
        columns = [np.concatenate(parts) if parts else np.zeros(0, np.int64) for parts in found]
        return pa.table([pa.array(c.astype(np.int64)) for c in columns], ["_query", "query_id", "vec_id", "score"])

    return run


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    scale: float = 64.0,
    key: str = "vec_id",
    vector: str = "embedding",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The ``k`` best rows of each query row: query_id, rank (from 1), vec_id, score.

    ``is_query`` is a condition on ``vec_id``.
    """
    spark = vectors.sparkSession
    C.ship(spark)
    whole = whole_vectors(vectors, scale, key, vector)
    square = F.aggregate("_ints", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    size = F.aggregate("_ints", F.lit(0).cast("bigint"), lambda most, x: F.greatest(most, F.abs(x)))
    n, dim, largest, most = whole.agg(F.count("*"), F.max(F.size("_ints")), F.max(square), F.max(size)).first()
    if not n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    if dim * most * most >= 1 << 62:
        raise ArithmeticError("components are too large for 64-bit scores")
    sample = whole.orderBy(F.xxhash64("_row")).limit(PIVOT_SAMPLE).select("_ints").toArrow()
    n_pivots = int(min(MAX_PIVOTS, max(2, n // (4 * block_rows))))
    pivots = _pivots(_lifted(_matrix(sample["_ints"], dim), largest), n_pivots)

    def nearest(batches):
        for batch in batches:
            distances = _distances(_lifted(_matrix(batch.column("_ints"), dim), largest), pivots)
            pivot = distances.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("_row", "vec_id", "_ints")), pa.array(pivot.astype(np.int64)), pa.array(distances[np.arange(len(pivot)), pivot])],
                ["_row", "vec_id", "_ints", "_pivot", "_distance"],
            )

    keyed = stored(whole.mapInArrow(nearest, "_row bigint, vec_id bigint, _ints array<bigint>, _pivot bigint, _distance double"))
    # One row per pivot, of at most MAX_PIVOTS: quantiles of its distances cut it into annuli.
    steps = [i / MAX_ANNULI for i in range(1, MAX_ANNULI)]
    cuts = keyed.groupBy("_pivot").agg(
        F.percentile_approx("_distance", F.array(*map(F.lit, steps)), 10_000).alias("_cuts"), F.count("*").alias("_n")
    )
    annuli = F.least(F.ceil(F.col("_n") / block_rows), F.lit(MAX_ANNULI))
    below = F.size(F.filter("_cuts", lambda cut: cut < F.col("_distance")))
    ringed = keyed.join(F.broadcast(cuts), "_pivot").withColumn("_annulus", F.floor(below * annuli / MAX_ANNULI).cast("bigint")).drop("_cuts", "_n")
    # One row per annulus, at most MAX_PIVOTS * MAX_ANNULI: its range of distances, and the blocks it is split into.
    rings = ringed.groupBy("_pivot", "_annulus").agg(
        F.min("_distance").alias("_from"), F.max("_distance").alias("_to"), F.ceil(F.count("*") / (2 * block_rows)).alias("_splits")
    )
    rings = stored(rings.coalesce(1))
    bounds = rings.select("_pivot", "_annulus", "_from", "_to", "_splits").orderBy("_pivot", "_annulus").toArrow()
    split = F.pmod(F.xxhash64("_row"), F.col("_splits"))
    blocks = stored(ringed.join(F.broadcast(rings.select("_pivot", "_annulus", "_splits")), ["_pivot", "_annulus"]).withColumn("_split", split).drop("_splits"))
    search = _search(dim, float(largest), k, dim * most * most < 1 << 52)

    def searched(queries: DataFrame) -> DataFrame:
        """``queries`` name the blocks they go to; a crowd of queries is split and its block repeated."""
        place = ["_pivot", "_annulus", "_split"]
        crowd = queries.groupBy(*place).agg(F.ceil(F.count("*") / (2 * block_rows)).alias("_crowds"))
        # A row per block that is asked: as many as there are blocks, which grow as the rows do; so no broadcast is forced.
        asked = blocks.join(crowd, place).withColumn("_crowd", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_crowds") - 1))).drop("_crowds")
        going = queries.join(crowd, place).withColumn("_crowd", F.pmod(F.xxhash64("_row", F.lit(1)), F.col("_crowds"))).drop("_crowds")
        by = [*place, "_crowd"]
        # toDF names the columns anew, as both sides come from one table.
        return asked.toDF(*asked.columns).groupBy(*by).cogroup(going.toDF(*going.columns).groupBy(*by)).applyInArrow(search, FOUND)

    queries = blocks.toDF(*blocks.columns).filter(is_query)
    no_bound = F.lit(-float(1 << 62))
    first = searched(queries.withColumn("_least", no_bound))
    least = first.groupBy(F.col("_query").alias("_row")).agg(F.when(F.count("*") >= k, F.min("score").cast("double")).alias("_kth"))
    bounded = queries.select("_row", "vec_id", "_ints").join(least, "_row", "left").withColumn("_least", F.coalesce("_kth", no_bound)).drop("_kth")
    pivot_of, from_, to, splits = (bounds[c].to_numpy() for c in ("_pivot", "_from", "_to", "_splits"))
    annulus_of = bounds["_annulus"].to_numpy()

    def spread(batches):
        for batch in batches:
            ints = _matrix(batch.column("_ints"), dim)
            asked = np.column_stack([ints.astype(np.float64), np.zeros(len(ints))])
            distances = _distances(asked, pivots)
            radius = np.sqrt(np.maximum((asked**2).sum(axis=1) + largest - 2 * batch.column("_least").to_numpy(), 0.0)) * (1 + 1e-9) + 1e-6
            for i in range(0, len(ints), 256):
                mine = distances[i : i + 256][:, pivot_of]
                reach = radius[i : i + 256, None]
                query, ring = np.nonzero((mine - reach <= to) & (mine + reach >= from_))
                times = splits[ring]
                split_no = C.ragged(np.zeros(len(times), np.int64), times)
                at, ring = np.repeat(query, times) + i, np.repeat(ring, times)
                taken = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(taken) for c in ("_row", "vec_id", "_ints", "_least")), pa.array(pivot_of[ring]), pa.array(annulus_of[ring]), pa.array(split_no), pa.array(distances[at, pivot_of[ring]])],
                    ["_row", "vec_id", "_ints", "_least", "_pivot", "_annulus", "_split", "_distance"],
                )

    going = bounded.mapInArrow(spread, "_row bigint, vec_id bigint, _ints array<bigint>, _least double, _pivot bigint, _annulus bigint, _split bigint, _distance double")
    rank = F.row_number().over(Window.partitionBy("_query").orderBy(F.desc("score"), "vec_id"))
    return searched(going).withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
