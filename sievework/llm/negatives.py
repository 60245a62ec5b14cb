"""Hard-negative mining by coordinate-based pruning of inner products, after LEMP.

Rows are put into buckets of similar length (norm), so that in a bucket an inner product asks for an angle: a row p of a
bucket whose longest row has length l can score s with the anchor q only if cos(q, p) >= s / (|q| l). If that is above 1,
the anchor skips the bucket. Otherwise p lies in a cone around q, and so its unit vector's value at any coordinate lies in
an interval around the anchor's. Buckets keep sorted lists of their unit vectors' values; for the anchor's ``FOCUS``
largest coordinates the feasible stretches of these lists are intersected, and what is left is scored exactly in integers.

Two searches: the best rows of the anchor's own label are its positives; each positive's score gives a band of scores, and
the best rows of other labels in each band are its negatives. Each search visits blocks from the longest rows to the
shortest, in rounds that grow ``GROWTH``-fold; the k-th score found so far bounds the next round. So the rows that blocks
give back grow with the logarithm of the number of blocks, not with it. In many dimensions angles are alike and cones
wide: the work then tends to anchors times rows, which is what an exact search of the whole table takes.

Blocks have at most about ``BLOCK_ROWS`` rows: a bucket with more (equal lengths, copies, a hot label) is split by row
hash, and anchors meet a block in crowds of about ``CROWD_ROWS``. Labels are dealt into bins, so that the first search
only visits the blocks of the anchor's bin.

Components are floor(scale * x). Rows that lack an id, a label or a vector, or have a null or non-finite component, take
no part. Shorter vectors count as padded with zeros. Ids may repeat: each row is an anchor or a candidate of its own, and
equal scores of equal ids give equal results. An anchor without other rows of its label, or a positive without a row in its
band (as where its score is negative), has no result. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.llm import columns as C
from sievework.session import stored

BLOCK_ROWS, CROWD_ROWS = 4_096, 2_048
LABEL_BINS, MAX_BUCKETS = 16, 256
FOCUS = 4
FIRST_BLOCKS, GROWTH = 4, 16
NO_BOUND = -(1 << 60)
SLACK = 1e-9
FOUND = "_anchor_row bigint, _slot int, _other bigint, _score bigint"


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """The vectors as rows, padded with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), dim), np.int64)
    out[np.repeat(np.arange(len(column)), sizes), C.ragged(np.zeros(len(column), np.int64), sizes)] = column.flatten().to_numpy(zero_copy_only=False)
    return out


class Block:
    """Rows of similar length with sorted lists of their unit vectors' coordinates."""

    def __init__(self, values: np.ndarray, exact_floats: bool):
        self.values = values.astype(np.float64) if exact_floats else values
        self.lengths = np.sqrt((values.astype(np.float64) ** 2).sum(axis=1))
        self.shortest, self.longest = self.lengths.min(), self.lengths.max()
        self.unit = values / np.where(self.lengths > 0, self.lengths, 1.0)[:, None]
        self.zeros = np.flatnonzero(self.lengths == 0)
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sorted_list(self, coordinate: int) -> tuple[np.ndarray, np.ndarray]:
        if coordinate not in self.lists:
            order = np.argsort(self.unit[:, coordinate], kind="stable")
            self.lists[coordinate] = order, self.unit[order, coordinate]
        return self.lists[coordinate]

    def feasible(self, anchor: np.ndarray, least: float) -> np.ndarray | None:
        """Rows that may score ``least`` or more with ``anchor``; None stands for all."""
        size = float(np.sqrt((anchor.astype(np.float64) ** 2).sum()))
        if size == 0 or (least <= 0 and self.shortest == 0):
            return None
        # A negative bound asks least of the shortest rows.
        cosine = least / (size * (self.longest if least > 0 else self.shortest)) if self.longest else np.inf
        if cosine > 1 + SLACK:
            return np.zeros(0, np.int64)
        if cosine <= -1:
            return None
        reach = np.arccos(min(cosine, 1.0))
        unit = anchor / size
        focus = np.argpartition(-np.abs(unit), min(FOCUS, len(unit)) - 1)[:FOCUS]
        at = np.arccos(np.clip(unit[focus], -1.0, 1.0))
        low = np.cos(np.minimum(np.pi, at + reach)) - SLACK
        high = np.cos(np.maximum(0.0, at - reach)) + SLACK
        stretches = []
        for coordinate, below, above in zip(focus.tolist(), low, high):
            order, values = self.sorted_list(coordinate)
            begin, end = np.searchsorted(values, below, "left"), np.searchsorted(values, above, "right")
            stretches.append((end - begin, coordinate, below, above, order[begin:end]))
        stretches.sort(key=lambda s: s[0])
        rows = stretches[0][-1]
        for _, coordinate, below, above, _ in stretches[1:]:
            if len(rows):
                value = self.unit[rows, coordinate]
                rows = rows[(value >= below) & (value <= above)]
        return rows

    def scores(self, anchor: np.ndarray, rows: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Rows and their exact scores."""
        anchor = anchor.astype(self.values.dtype)
        if rows is None or 2 * len(rows) > len(self.values):
            every = (self.values @ anchor).astype(np.int64)
            return (np.arange(len(every)), every) if rows is None else (rows, every[rows])
        return rows, (self.values[rows] @ anchor).astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best by (score down, id up)."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
        return at[np.lexsort((ids[at], -scores[at]))[:k]]
    return np.lexsort((ids, -scores))


def bands(positive: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores s with low * p <= 100 * s <= high * p, as whole numbers from and to."""
    return -((-low * positive) // 100), (high * positive) // 100


def _search(dim: int, k: int, exact_floats: bool, band: tuple[int, int] | None):
    """Task of a block and a crowd of anchors; without a band it looks for the best rows of the same label."""

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found: list[list[np.ndarray]] = [[], [], [], []]
        if rows.num_rows and anchors.num_rows:
            block = Block(matrix(rows["_ints"], dim), exact_floats)
            ids, numbers = rows["vec_id"].to_numpy(), rows["_row"].to_numpy()
            # Labels of both sides as numbers.
            codes = pa.chunked_array([*rows["_label"].chunks, *anchors["_label"].chunks]).combine_chunks().dictionary_encode().indices.to_numpy()
            labels, wanted = codes[: len(ids)], codes[len(ids) :]
            asked = matrix(anchors["_ints"], dim)
            least, scores_of = anchors["_least"].to_pylist(), anchors["_positive_scores"].to_pylist()
            for i, row in enumerate(anchors["_row"].to_numpy()):
                if band is None:
                    low, high = np.array([NO_BOUND]), np.array([-NO_BOUND])
                else:
                    low, high = bands(np.array(scores_of[i], np.int64), *band)
                low = np.maximum(low, np.array(least[i], np.int64))
                slots = np.flatnonzero(low <= high)
                if not len(slots):
                    continue
                at, scores = block.scores(asked[i], block.feasible(asked[i], float(low[slots].min())))
                good = (labels[at] == wanted[i]) & (numbers[at] != row) if band is None else labels[at] != wanted[i]
                at, scores = at[good], scores[good]
                for slot in slots:
                    within = np.flatnonzero((scores >= low[slot]) & (scores <= high[slot]))
                    if len(within):
                        top = within[best(scores[within], ids[at[within]], k)]
                        for into, values in zip(found, (np.full(len(top), row), np.full(len(top), slot), ids[at[top]], scores[top])):
                            into.append(values)
        columns = [np.concatenate(parts) if parts else np.zeros(0, np.int64) for parts in found]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        return pa.table([pa.array(c).cast(t) for c, t in zip(columns, kinds)], ["_anchor_row", "_slot", "_other", "_score"])

    return run


class Buckets:
    """Rows in blocks, and what the driver knows of their buckets: at most LABEL_BINS * MAX_BUCKETS rows."""

    def __init__(self, whole: DataFrame, block_rows: int):
        steps = [i / MAX_BUCKETS for i in range(1, MAX_BUCKETS)]
        cuts = whole.groupBy("_bin").agg(
            F.percentile_approx("_length", F.array(*map(F.lit, steps)), 10_000).alias("_cuts"),
            F.least(F.ceil(F.count("*") / block_rows), F.lit(MAX_BUCKETS)).alias("_buckets"),
        )
        below = F.size(F.filter("_cuts", lambda cut: cut < F.col("_length")))
        bucketed = whole.join(F.broadcast(cuts), "_bin").withColumn(
            "_bucket", F.floor(below * F.col("_buckets") / MAX_BUCKETS).cast("bigint")
        ).drop("_cuts", "_buckets")
        sizes = bucketed.groupBy("_bin", "_bucket").agg(
            F.min("_length").alias("_from"), F.max("_length").alias("_to"), F.ceil(F.count("*") / block_rows).alias("_splits")
        )
        sizes = stored(sizes.coalesce(1))
        split = F.pmod(F.xxhash64("_row"), F.col("_splits"))
        placed = bucketed.join(F.broadcast(sizes.select("_bin", "_bucket", "_splits")), ["_bin", "_bucket"])
        self.rows = stored(placed.withColumn("_block", self.number(F.col("_bin"), F.col("_bucket"), split)).drop("_splits", "_bucket"))
        known = sizes.orderBy(F.desc("_to"), "_bin", "_bucket").toArrow()
        self.bin, self.bucket, self.splits = (known[c].to_numpy() for c in ("_bin", "_bucket", "_splits"))
        self.shortest, self.longest = known["_from"].to_numpy(), known["_to"].to_numpy()

    @staticmethod
    def number(bin_, bucket, split):
        return (bin_ * MAX_BUCKETS + bucket) * (1 << 40) + split

    def order(self, own_bin: bool) -> np.ndarray:
        """Number of blocks that come before each bucket's own, among all or those of its bin."""
        before = np.zeros(len(self.splits), np.int64)
        for bin_ in np.unique(self.bin) if own_bin else [None]:
            of = np.flatnonzero(self.bin == bin_) if own_bin else np.arange(len(self.splits))
            before[of] = np.cumsum(self.splits[of]) - self.splits[of]
        return before

    def visits(self, anchors: DataFrame, own_bin: bool, begin: int, end: int, band: tuple[int, int] | None) -> DataFrame:
        """A row per anchor and block, for the blocks numbered ``begin`` up to ``end`` that the length bound lets through."""
        bins, buckets, splits, shortest, longest = self.bin, self.bucket, self.splits, self.shortest, self.longest
        before = self.order(own_bin)
        number = self.number

        def run(batches):
            for batch in batches:
                lengths, mine = batch.column("_length").to_numpy(), batch.column("_bin").to_numpy()
                bound = np.empty(batch.num_rows)
                least, scores = batch.column("_least").to_pylist(), batch.column("_positive_scores").to_pylist()
                for i in range(batch.num_rows):
                    low = np.array(least[i], np.int64)
                    if band is not None:
                        from_, to = bands(np.array(scores[i], np.int64), *band)
                        low = np.maximum(low, from_)[np.maximum(low, from_) <= to]
                    bound[i] = low.min() if len(low) else np.inf
                for i in range(0, batch.num_rows, 256):
                    some = slice(i, i + 256)
                    # The best score that a bucket allows; a negative bound is met by its shortest rows.
                    most = lengths[some, None] * longest[None] * (1 + SLACK) + SLACK
                    reached = bound[some, None] <= np.where(bound[some, None] > 0, most, np.inf)
                    reached &= np.isfinite(bound[some, None])
                    if own_bin:
                        reached &= mine[some, None] == bins[None]
                    first = np.maximum(begin - before, 0)
                    last = np.minimum(end - before, splits)
                    anchor, bucket = np.nonzero(reached & (last > first)[None])
                    times = (last - first)[bucket]
                    block = number(np.repeat(bins[bucket], times), np.repeat(buckets[bucket], times), C.ragged(first[bucket], times))
                    taken = pa.array(np.repeat(anchor, times) + i)
                    names = ["_row", "_label", "_ints", "_least", "_positive_scores"]
                    yield pa.RecordBatch.from_arrays([*(batch.column(c).take(taken) for c in names), pa.array(block)], [*names, "_block"])

        schema = "_row bigint, _label string, _ints array<bigint>, _least array<bigint>, _positive_scores array<bigint>, _block bigint"
        return C.map_batches(anchors, run, schema)


def _rounds(blocks: int):
    begin, size = 0, FIRST_BLOCKS
    while begin < blocks:
        yield begin, begin + size
        begin, size = begin + size, size * GROWTH


def _best_rows(buckets: Buckets, anchors: DataFrame, search, k: int, slots: int, own_bin: bool, crowds: int, band=None) -> DataFrame:
    """Stored table of the ``k`` best of each anchor and slot: FOUND and ``_rank``.

    ``anchors`` have one bound per slot, which rounds raise.
    """
    order = Window.partitionBy("_anchor_row", "_slot").orderBy(F.desc("_score"), "_other")
    blocks = int((buckets.order(own_bin) + buckets.splits).max())
    so_far = None
    for begin, end in _rounds(blocks):
        asking = anchors.withColumn("_least", F.array_repeat(F.lit(NO_BOUND).cast("bigint"), slots))
        if so_far is not None:
            kth = so_far.groupBy("_anchor_row", "_slot").agg(F.count("*").alias("_have"), F.min("_score").alias("_kth")).filter(F.col("_have") >= k)
            by_slot = kth.groupBy(F.col("_anchor_row").alias("_row")).agg(F.map_from_entries(F.collect_list(F.struct("_slot", "_kth"))).alias("_known"))
            raised = F.transform(F.sequence(F.lit(0), F.lit(slots - 1)), lambda slot: F.coalesce(F.try_element_at("_known", slot), F.lit(NO_BOUND).cast("bigint")))
            asking = anchors.join(by_slot, "_row", "left").withColumn("_least", raised).drop("_known")
        # Bounds stand in the positives' order, of which there may be fewer than slots.
        asking = asking.withColumn("_least", F.slice("_least", F.lit(1), F.size("_positive_scores")))
        visits = buckets.visits(asking, own_bin, begin, end, band).withColumn("_crowd", F.pmod(F.xxhash64("_row"), F.lit(crowds)))
        # A row per block and crowd: as many as cells of the grid of rows and anchors.
        cells = visits.select("_block", "_crowd").distinct()
        met = buckets.rows.select("_row", "vec_id", "_label", "_ints", "_block").join(cells, "_block")
        by = ["_block", "_crowd"]
        found = met.toDF(*met.columns).groupBy(*by).cogroup(visits.toDF(*visits.columns).groupBy(*by)).applyInArrow(search, FOUND)
        if so_far is not None:
            found = found.unionByName(so_far.drop("_rank"))
        so_far = stored(found.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= k))
    return so_far


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column | str = "label",
    positives: int = 5,
    negatives: int = 10,
    band: tuple[int, int] = (30, 90),
    scale: float = 256.0,
    key: str = "vec_id",
    vector: str = "embedding",
    block_rows: int = BLOCK_ROWS,
    crowd_rows: int = CROWD_ROWS,
) -> DataFrame:
    """Per anchor, positive and negative: anchor_id, positive_id, positive_rank, rank, negative_id and both scores.

    ``is_anchor`` and ``label`` are columns of ``vectors``. ``band`` is in hundredths of the positive's score. Of equal
    scores the smaller id comes first.
    """
    spark = vectors.sparkSession
    schema = "anchor_id bigint, positive_id bigint, positive_rank int, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    value, label = F.col(C.quoted(vector)), F.col(C.quoted(label)) if isinstance(label, str) else label
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    chosen = vectors.select(
        F.col(C.quoted(key)).cast("bigint").alias("vec_id"), label.cast("string").alias("_label"), F.coalesce(is_anchor, F.lit(False)).alias("_anchor"),
        F.coalesce(finite, F.lit(False)).alias("_good"), F.transform(value, lambda x: F.floor(x.cast("double") * scale).cast("bigint")).alias("_ints"),
    ).filter(F.col("_good") & F.col("vec_id").isNotNull() & F.col("_label").isNotNull())
    whole = stored(chosen.select(
        F.monotonically_increasing_id().alias("_row"), "vec_id", "_label", "_anchor", "_ints",
        F.sqrt(F.aggregate("_ints", F.lit(0.0), lambda total, x: total + x.cast("double") * x)).alias("_length"),
        F.pmod(F.xxhash64("_label"), F.lit(LABEL_BINS)).alias("_bin"),
    ))
    size = F.aggregate("_ints", F.lit(0).cast("bigint"), lambda most, x: F.greatest(most, F.abs(x)))
    n_anchors, dim, most = whole.agg(F.count_if("_anchor"), F.max(F.size("_ints")), F.max(size)).first()
    if not n_anchors:
        return spark.createDataFrame([], schema)
    dim = max(dim, 1)
    if dim * most * most >= 1 << 55:
        raise ArithmeticError("components are too large for 64-bit scores")
    exact = dim * most * most < 1 << 52
    crowds = -(-n_anchors // crowd_rows)
    buckets = Buckets(whole, block_rows)
    anchors = stored(buckets.rows.filter("_anchor").select("_row", "vec_id", "_label", "_ints", "_length", "_bin"))
    single = anchors.drop("vec_id").withColumn("_positive_scores", F.array(F.lit(0).cast("bigint")))
    near = _best_rows(buckets, single, _search(dim, positives, exact, None), positives, 1, True, crowds)
    scores = near.groupBy(F.col("_anchor_row").alias("_row")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("_rank", "_score"))), lambda p: p["_score"]).alias("_positive_scores")
    )
    banded = stored(anchors.drop("vec_id").join(scores, "_row"))
    far = _best_rows(buckets, banded, _search(dim, negatives, exact, band), negatives, positives, False, crowds, band)
    pairs = near.select(
        "_anchor_row", (F.col("_rank") - 1).alias("_slot"), F.col("_other").alias("positive_id"), F.col("_rank").alias("positive_rank"),
        F.col("_score").alias("positive_score"),
    )
    named = pairs.join(anchors.select(F.col("_row").alias("_anchor_row"), F.col("vec_id").alias("anchor_id")), "_anchor_row")
    return far.join(named, ["_anchor_row", "_slot"]).select(
        "anchor_id", "positive_id", "positive_rank", F.col("_rank").alias("rank"), F.col("_other").alias("negative_id"),
        "positive_score", F.col("_score").alias("negative_score"),
    )
