"""Near-duplicate documents by DartMinHash signatures.

A text is the weighted set of its five-word shingles, the weight being how often one occurs. Darts
are thrown at the plane of weight and rank of each element by a hash of the element, so all texts
see the same darts. A dart that lands below the element's weight counts for its coordinate, and each
coordinate keeps its earliest dart (lowest rank). Two texts agree in a coordinate with the
probability of their weighted Jaccard similarity. Only ranks up to about (ln t + 2) / weight of the text
are looked at, doubled for the few texts that still have an empty coordinate.

Texts are the units: exact copies share one signature from the first shuffle on. Bands of
coordinates are join keys.

1. In every bucket each text is compared with one hub, the first in a random order; pairs are kept
   if signatures agree well enough, and then checked exactly on the shingles. Texts that the hub rejects are compared by
   signature with each other and with those texts of the bucket that the hub's star doesn't answer for, in blocks; what
   leaves a task is one link for each two groups that it merges. Where very many are rejected they first elect next hubs.
2. Linked texts are connected. Texts that stars hold together, at a much lower agreement, are a family. A
   family that still has several components is searched once more, exactly, in blocks of texts: each text
   outside a block's largest component is looked up in an index of all shingles. What leaves a task is one link
   for each two components that it merges.

So no group's pairs are listed and no partner is capped: a text costs a comparison for each hub that it meets, one for
each text of its bucket if the hub rejects it, and one look-up more for each block of its family if it is not of the
largest component.

Texts with fewer than five words are one shingle. Null texts and texts without words form no group.
Repeated rows and exact copies share a class, whose id is its smallest key (rows without key count
last). An empty table gives an empty result. Columns other than key and text are not read, except
by :func:`drop_near_duplicates`, which returns them as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievework.llm import columns as C
from sievework.session import stored

SHINGLE = 5
SIMILARITY = 0.8
# A pair of similarity 0.8 shares no band four times in ten million.
BANDS, ROWS = 28, 4
DARTS = BANDS * ROWS
# How far below the similarity a pair's agreement of signatures may lie: five standard deviations at 0.8.
MARGIN = 0.19
# Texts of a bucket that agree less with their hub share it by chance and are not of its family.
FAMILY_AGREEMENT = 0.3
# Texts of a family, or of a bucket, that one task holds, half of them from each of two blocks.
BLOCK = 1_000
# Rounds in which buckets with over ``BLOCK`` rejected texts elect a hub; what is rejected then meets in blocks.
HUB_ROUNDS = 8
# Tables of keys of up to this many rows are sent to all executors; beyond that both sides are shuffled.
BROADCAST_TEXTS = 200_000
_FIRST_RANK = 2.0**-10
_TAIL = 64


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of all texts (hash and count), and the number of them before each text."""
    data, offsets = C.text_bytes(column)
    starts, ends, first = C.words(data, offsets)
    words = C.span_hash(C.prefix_hash(data), starts, ends)
    n_words = np.diff(first)
    doc = np.repeat(np.arange(len(column)), n_words)
    n = max(0, len(words) - SHINGLE + 1)
    value = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        value = C.mix(value + words[k : k + n])
    at = np.flatnonzero(doc[:n] == doc[SHINGLE - 1 :]) if n else np.zeros(0, np.int64)
    short = np.flatnonzero((n_words > 0) & (n_words < SHINGLE))
    few = []
    for i in short:
        h = np.zeros(1, np.uint64)
        for w in words[first[i] : first[i + 1]]:
            h = C.mix(h + w)
        few.append(h[0] ^ np.uint64(n_words[i]))
    owner = np.concatenate([doc[at], short])
    value = np.concatenate([value[at], np.array(few, np.uint64)])
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    places = np.flatnonzero(fresh)
    counts = np.diff(np.append(places, len(value)))
    return np.stack([value[places], counts.astype(np.uint64)]), owner[places], np.searchsorted(owner[places], np.arange(len(column) + 1))


def _poisson_table(mean: float) -> np.ndarray:
    """Cumulative probabilities of the counts of a Poisson variable."""
    terms = [np.exp(-mean)]
    for k in range(1, int(mean + 12 * np.sqrt(mean) + _TAIL)):
        terms.append(terms[-1] * mean / k)
    return np.cumsum(terms)


def _throw(cells: np.ndarray, owner: np.ndarray, band: int, earliest: np.ndarray) -> None:
    """All darts of unit cells of weight whose rank lies in the ``band``-th interval; keep the earliest per coordinate."""
    low = 0.0 if band == 0 else _FIRST_RANK * 2.0 ** (band - 1)
    width = _FIRST_RANK if band == 0 else low
    seed = C.mix(cells + np.uint64(0x632BE59BD9B4E019 * (band + 1) % (1 << 64)))
    count = np.searchsorted(_poisson_table(DARTS * width), (seed >> np.uint64(11)).astype(np.float64) / (1 << 53), "right")
    hit = np.flatnonzero(count)
    if not len(hit):
        return
    times = count[hit]
    number = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    dart = C.mix(np.repeat(seed[hit], times) + np.uint64(0x9E3779B97F4A7C15) * (number + 1).astype(np.uint64))
    # The upper half of a dart's hash gives the coordinate, the lower half the rank.
    coordinate = (((dart >> np.uint64(32)) * np.uint64(DARTS)) >> np.uint64(32)).astype(np.int64)
    rank = (dart & np.uint64(0xFFFFFFFF)).astype(np.float64)
    rank *= width / 2.0**32
    rank += low
    # Positive doubles sort as their bits do; the last bits tell darts of equal rank apart.
    bits = (rank.view(np.uint64) & ~np.uint64(0xFFFF)) | (dart >> np.uint64(48))
    coordinate += np.repeat(owner[hit] * DARTS, times)
    np.minimum.at(earliest, coordinate, bits)


def signatures(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Signatures (``n`` x ``DARTS``) of weighted sets; rows without elements hold the largest number."""
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    earliest = np.full(n * DARTS, top, np.uint64)
    weights = values[1].astype(np.int64)
    total = np.bincount(owner, weights, n)
    # A cell is an element and a unit of its weight.
    unit = np.arange(weights.sum()) - np.repeat(np.cumsum(weights) - weights, weights)
    cells = C.mix(np.repeat(values[0], weights) + np.uint64(0xA24BAED4963EE407) * unit.astype(np.uint64))
    of_cell = np.repeat(owner, weights)
    with np.errstate(divide="ignore"):
        reach = np.where(total > 0, np.ceil(np.log2((np.log(DARTS) + 2) / total / _FIRST_RANK)), -1)
    last = np.where(total > 0, np.maximum(reach, 0), -1).astype(np.int64)
    band, thrown = 0, np.full(n, -1)
    while True:
        want = last >= band
        if not want.any():
            empty = (earliest.reshape(n, DARTS) == top).any(axis=1) & (total > 0)
            if not empty.any():
                break
            last[empty] = band
            # Texts that were done at an earlier band catch up with the bands they have skipped.
            for b in range(int(thrown[empty].min()) + 1, band):
                late = empty & (thrown < b)
                chosen = late[of_cell]
                _throw(cells[chosen], of_cell[chosen], b, earliest)
                thrown[late] = b
            empty &= (earliest.reshape(n, DARTS) == top).any(axis=1)
            last[~empty] = np.minimum(last[~empty], band - 1)
            continue
        chosen = want[of_cell]
        _throw(cells[chosen], of_cell[chosen], band, earliest)
        thrown[want] = band
        band += 1
    return earliest.reshape(n, DARTS)


def _sign(batches):
    for part in C.slices(batches):
        n = part.num_rows
        values, owner, _ = shingles(part.column("text"))
        found = signatures(values, owner, n)
        keys = np.zeros((n, BANDS), np.uint64)
        for k in range(ROWS):
            keys = C.mix(keys + found[:, k::ROWS])
        keys = C.mix(keys + np.arange(BANDS, dtype=np.uint64))
        filled = np.bincount(owner, minlength=n) > 0
        short = C.mix(found).astype("<u2")
        bands = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * BANDS), pa.array(keys.reshape(-1).view(np.int64)))
        packed = pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(n + 1, dtype=np.int32) * 2 * DARTS), pa.py_buffer(np.ascontiguousarray(short))])
        rows = pa.RecordBatch.from_arrays([*(part.column(c) for c in ("_key", "_h1", "_h2")), bands, packed], ["_key", "_h1", "_h2", "_bands", "_signature"])
        yield rows.filter(pa.array(filled))


def _hashed(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumns(
        {"_h1": F.xxhash64("text"), "_h2": F.xxhash64("text", F.lit(1))}
    )


def distinct_texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Stored: ``_h1``, ``_h2``, ``_first`` (absent?, key, rows with it), ``_rows``, ``_bands``, ``_signature``; a row per text."""
    hashed = _hashed(docs, key, text)
    kind = hashed.schema["_key"].dataType.simpleString()
    signed = C.map_batches(hashed.select("_key", "_h1", "_h2", "text"), _sign, f"_key {kind}, _h1 bigint, _h2 bigint, _bands array<bigint>, _signature binary")
    per_key = signed.groupBy("_h1", "_h2", "_key").agg(F.count("*").alias("_n"), F.first("_bands").alias("_bands"), F.first("_signature").alias("_signature"))
    first = F.min(F.struct(F.col("_key").isNull().alias("absent"), F.col("_key").alias("key"), F.col("_n").alias("n")))
    return stored(
        per_key.groupBy("_h1", "_h2").agg(
            first.alias("_first"), F.sum("_n").alias("_rows"), F.first("_bands").alias("_bands"), F.first("_signature").alias("_signature")
        )
    )


def _agreeing(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Stored pairs (``_a``, ``_b``) and ``_agree``, the share of coordinates in which their signatures agree."""
    named = [texts.select(F.col("_h1").alias(side), F.col("_signature").alias(f"{side}s")) for side in ("_a", "_b")]
    both = pairs.join(named[0], "_a").join(named[1], "_b")

    def run(batches):
        for batch in batches:
            sides = [np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, DARTS) for c in ("_as", "_bs")]
            agree = (sides[0] == sides[1]).mean(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("_a"), batch.column("_b"), pa.array(agree)], ["_a", "_b", "_agree"])

    return stored(C.map_batches(both.select("_a", "_b", "_as", "_bs"), run, "_a bigint, _b bigint, _agree double"))


def _alike(h1: np.ndarray, met: np.ndarray, inner: bool, signed: np.ndarray, least: float) -> list[tuple[int, int, float]]:
    """Pairs whose signatures agree in ``least``, of two rejected texts (if ``inner``) or one and a met one; one for each merging."""
    pairs: list[tuple[int, int, float]] = []
    merged = np.arange(len(h1))
    for i in np.flatnonzero(~met):
        agree = (signed == signed[i]).mean(axis=1)
        for j in np.flatnonzero((agree >= least) & (met | inner)):
            one, other = merged[i], merged[j]
            if one != other:
                pairs.append((min(h1[i], h1[j]), max(h1[i], h1[j]), agree[j]))
                merged[merged == other] = one
    return pairs


def _inside_buckets(rows: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Pairs (``_a``, ``_b``, ``_agree``) of ``rows``: ``_band``, ``_h1``, ``_met`` (by the hub), ``_inner`` (do rejected ones meet?).

    Rejected and met texts of a bucket are cut into blocks. Blocks of rejected ones meet each other and those of met ones.
    """
    rejected, met = F.count_if(~F.col("_met")), F.count_if("_met")
    sizes = rows.groupBy("_band").agg(
        F.ceil(rejected / BLOCK).alias("_in"), F.ceil(met / BLOCK).alias("_out"), (F.first("_inner") & (rejected > 1) | (rejected > 0) & (met > 0)).alias("_some")
    )
    cut = rows.join(sizes.filter("_some").drop("_some"), "_band").join(texts.select("_h1", "_signature"), "_h1")
    number = F.xxhash64("_h1", F.lit(4))
    block = F.when(F.col("_met"), F.col("_in") + F.pmod(number, F.greatest("_out", F.lit(1)))).otherwise(F.pmod(number, F.greatest("_in", F.lit(1))))

    def meets(b):
        # A block of rejected texts meets itself on the way, if there is any other.
        among = F.col("_inner") & (b < F.col("_in")) & ((b != F.col("_block")) | (F.col("_in") + F.col("_out") == 1))
        return F.when(F.col("_met"), b < F.col("_in")).otherwise((b >= F.col("_in")) | among)

    others = F.filter(F.sequence(F.lit(0).cast("bigint"), F.col("_in") + F.col("_out") - 1), meets)
    dealt = cut.withColumn("_block", block).withColumn("_other", F.explode(others)).select(
        "_band", F.least("_block", "_other").alias("_i"), F.greatest("_block", "_other").alias("_j"), "_h1", "_met", "_inner", "_signature"
    )

    def run(batches):
        # Rows come in order of their cells; the last cell of a batch waits for the next one.
        left = None

        def search(rows):
            cells = np.stack([rows.column(c).to_numpy() for c in ("_band", "_i", "_j")])
            bounds = [0, *(np.flatnonzero((cells[:, 1:] != cells[:, :-1]).any(axis=0)) + 1).tolist(), rows.num_rows]
            h1 = rows.column("_h1").to_numpy()
            met, inner = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("_met", "_inner"))
            signed = np.frombuffer(b"".join(rows.column("_signature").to_pylist()), "<u2").reshape(-1, DARTS)
            found = []
            for low, high in zip(bounds[:-1], bounds[1:]):
                if high - low > 1:
                    found += _alike(h1[low:high], met[low:high], bool(inner[low]), signed[low:high], least)
            types = (pa.int64(), pa.int64(), pa.float64())
            columns = zip(*found) if found else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["_a", "_b", "_agree"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch if left is None else pa.concat_batches([left, batch])
            last = [rows.column(c).to_numpy() for c in ("_band", "_i", "_j")]
            # Where the last cell begins.
            other = np.flatnonzero(np.any([c != c[-1] for c in last], axis=0))
            begin = int(other[-1]) + 1 if len(other) else 0
            left = rows.slice(begin)
            if begin:
                yield search(rows.slice(0, begin))
        if left is not None:
            yield search(left)

    cell = ("_band", "_i", "_j")
    return C.map_batches(dealt.repartition(*cell).sortWithinPartitions(*cell), run, "_a bigint, _b bigint, _agree double")


def _stars(bands: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Pairs (``_a``, ``_b``, ``_agree``) that hold families together.

    Any two texts of a bucket whose signatures agree within ``MARGIN`` of the similarity are in one family: either both
    agree with a hub, or one is rejected and the two are compared. A text that agrees with the hub
    by ``sure`` or more can't be so near to one that the hub rejects, as disagreement is a distance.
    """
    least = similarity - MARGIN
    sure = FAMILY_AGREEMENT + 1 - least
    found, open_ = [], bands
    for step in range(HUB_ROUNDS):
        # The hub of a bucket is the first text in an order by hash, the same order in all buckets.
        hubs = open_.groupBy("_band").agg(F.min(F.struct(F.xxhash64("_h1", F.lit(2)).alias("o"), F.col("_h1").alias("hub"))).alias("_hub"), F.count("*").alias("_n"))
        placed = stored(
            open_.join(hubs.filter("_n > 1").select("_band", "_hub.hub"), "_band").filter("_h1 <> hub")
            .select("_band", "_h1", F.least("_h1", "hub").alias("_a"), F.greatest("_h1", "hub").alias("_b"))
        )
        agreed = _agreeing(placed.select("_a", "_b").distinct(), texts)
        found.append(agreed.filter(F.col("_agree") >= FAMILY_AGREEMENT))
        unsure = agreed.filter(F.col("_agree") < sure).select("_a", "_b", (F.col("_agree") >= FAMILY_AGREEMENT).alias("_met"))
        rest = placed.join(unsure, ["_a", "_b"]).select("_band", "_h1", "_met")
        sizes = rest.groupBy("_band").agg(F.count_if(~F.col("_met")).alias("_rejected"), F.count("*").alias("_n")).filter("_rejected > 0 and _n > 1")
        inner = (F.col("_rejected") <= BLOCK) | F.lit(step == HUB_ROUNDS - 1)
        rest = stored(rest.join(sizes.select("_band", inner.alias("_inner")), "_band"))
        if not rest.head(1):
            break
        found.append(stored(_inside_buckets(rest, texts, least)))
        open_ = rest.filter(~F.col("_inner") & ~F.col("_met")).select("_band", "_h1")
        if not open_.head(1):
            break
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs if len(found) == 1 else pairs.groupBy("_a", "_b").agg(F.max("_agree").alias("_agree"))


def _sized(table: DataFrame) -> DataFrame:
    """Stored table of narrow rows, to be broadcast if it is short."""
    table = stored(table)
    return F.broadcast(table) if table.count() <= BROADCAST_TEXTS else table


def _first_texts(needed: DataFrame, docs: DataFrame, texts: DataFrame, key: str, text: str) -> DataFrame:
    """Stored ``_h1`` and ``_text`` of the texts named in ``needed``, from the rows with their first keys; copies stay behind."""
    of_first = _sized(texts.join(needed.distinct(), "_h1", "left_semi").select("_h1", F.col("_first.key").alias("_key1")))
    rows = _hashed(docs, key, text).join(of_first, "_h1").filter(F.col("_key").eqNullSafe(F.col("_key1")))
    return stored(rows.dropDuplicates(["_h1"]).select("_h1", F.col("text").alias("_text")))


def _similar(pairs: DataFrame, whole: DataFrame, similarity: float) -> DataFrame:
    """Stored pairs whose weighted Jaccard similarity, on all shingles of the ``whole`` texts, reaches the threshold."""
    both = pairs.join(whole.select(F.col("_h1").alias("_a"), F.col("_text").alias("_at")), "_a").join(
        whole.select(F.col("_h1").alias("_b"), F.col("_text").alias("_bt")), "_b"
    )

    def run(batches):
        for batch in C.slices(batches, "_at"):
            sets = [shingles(batch.column(c)) for c in ("_at", "_bt")]
            good = []
            for i in range(batch.num_rows):
                (va, _, fa), (vb, _, fb) = sets
                a, b = va[:, fa[i] : fa[i + 1]], vb[:, fb[i] : fb[i + 1]]
                _, ia, ib = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
                shared = int(np.minimum(a[1, ia], b[1, ib]).sum())
                good.append(shared >= similarity * (int(a[1].sum()) + int(b[1].sum()) - shared) - 1e-9)
            yield pa.RecordBatch.from_arrays([batch.column("_a"), batch.column("_b")], ["_a", "_b"]).filter(pa.array(good))

    return stored(C.map_batches(both.select("_a", "_b", "_at", "_bt"), run, "_a bigint, _b bigint"))


def components(links: DataFrame) -> DataFrame:
    """Stored ``_h1``, ``_root`` of all texts with links, by alternating large and small stars.

    Each round points the neighbours of a node to the smallest of them; it ends when no link moves.
    Links of a node are met by joins that can be split, so a star of any size is dealt over tasks.
    """
    edges = stored(links.select(F.greatest("_a", "_b").alias("u"), F.least("_a", "_b").alias("v")).filter("u <> v").distinct())

    def mark(table: DataFrame):
        return table.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = mark(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = stored(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        edges = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        after = mark(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("u").alias("_h1"), F.col("v").alias("_root"))
    return stored(roots.unionByName(edges.select(F.col("v").alias("_h1"), F.col("v").alias("_root")).distinct()).groupBy("_h1").agg(F.min("_root").alias("_root")))


def _crossing(rows, similarity: float):
    """Links between components among the texts of a block (or two) of a family, one for each merging."""
    h1, root = rows["_h1"].to_numpy(), rows["_root"].to_numpy()
    _, component = np.unique(root, return_inverse=True)
    pairs: list[tuple[int, int]] = []
    if component.max(initial=0) > 0:
        values, owner, bounds = shingles(pa.array(rows["text"].to_pylist()))
        total = np.bincount(owner, values[1].astype(np.int64), len(h1))
        # Which texts hold a shingle, and how often.
        _, number = np.unique(values[0], return_inverse=True)
        by = np.argsort(number, kind="stable")
        lists = np.searchsorted(number[by], np.arange(number.max(initial=-1) + 2))
        holder, times = owner[by], values[1][by].astype(np.int64)
        largest = np.bincount(component).argmax()
        merged = np.arange(component.max() + 1)
        for i in np.flatnonzero(component != largest):
            mine = slice(bounds[i], bounds[i + 1])
            begin, size = lists[number[mine]], np.diff(lists)[number[mine]]
            at = C.ragged(begin, size)
            shared = np.bincount(holder[at], np.minimum(times[at], np.repeat(values[1][mine].astype(np.int64), size)), len(h1))
            alike = np.flatnonzero(shared >= similarity * (total + total[i] - shared) - 1e-9)
            for j in alike:
                one, other = merged[component[i]], merged[component[j]]
                if one != other:
                    pairs.append((min(h1[i], h1[j]), max(h1[i], h1[j])))
                    merged[merged == other] = one
    found = np.array(pairs, np.int64).reshape(-1, 2)
    return pa.table([pa.array(found[:, 0]), pa.array(found[:, 1])], ["_a", "_b"])


def _between_components(stars: DataFrame, roots: DataFrame, whole: DataFrame, similarity: float) -> DataFrame:
    """Links between components of one family, where families are what stars hold together.

    Families with several components are searched exactly, on all shingles. A large one is cut into blocks,
    and each two of them meet in a task.
    """
    families = components(stars).withColumnRenamed("_root", "_family")
    placed = families.join(roots, "_h1", "left").withColumn("_root", F.coalesce("_root", "_h1"))
    mixed = placed.groupBy("_family").agg(F.min("_root").alias("_low"), F.max("_root").alias("_high"), F.count("*").alias("_n")).filter("_low <> _high")
    rows = stored(placed.join(mixed.select("_family", F.ceil(F.col("_n") / BLOCK).alias("_blocks")), "_family"))
    rows = rows.withColumn("_block", F.pmod(F.xxhash64("_h1", F.lit(3)), F.col("_blocks")))
    # A block meets each other block once, and itself on the way; a family of one block meets itself.
    other = F.filter(F.sequence(F.lit(0).cast("bigint"), F.col("_blocks") - 1), lambda b: (b != F.col("_block")) | (F.col("_blocks") == 1))
    dealt = rows.withColumn("_other", F.explode(other)).select(
        "_h1", "_root", "_family", F.least("_block", "_other").alias("_i"), F.greatest("_block", "_other").alias("_j")
    )
    placed_texts = dealt.join(whole, "_h1").withColumnRenamed("_text", "text")

    def search(rows):
        return _crossing(rows, similarity)

    return placed_texts.groupBy("_family", "_i", "_j").applyInArrow(search, "_a bigint, _b bigint").distinct()


def text_classes(docs: DataFrame, key: str, text: str, similarity: float = SIMILARITY) -> DataFrame:
    """A row per text with words: ``_h1``, ``_h2``, ``_first``, ``_rows``, ``_class`` (key, or null) and ``_leads``."""
    texts = distinct_texts(docs, key, text)
    bands = texts.select("_h1", F.explode("_bands").alias("_band"))
    family_stars = stored(_stars(bands, texts, similarity))
    likely = family_stars.filter(F.col("_agree") >= similarity - MARGIN).select("_a", "_b")
    # Texts of families, fetched once: about as many as are like another one.
    whole = _first_texts(family_stars.select(F.explode(F.array("_a", "_b")).alias("_h1")), docs, texts, key, text)
    links = _similar(likely, whole, similarity)
    roots = components(links)
    extra = stored(_between_components(family_stars, roots, whole, similarity))
    if extra.head(1):
        roots = components(links.unionByName(extra))
    placed = texts.select("_h1", "_h2", "_first", "_rows").join(roots, "_h1", "left").withColumn("_root", F.coalesce("_root", "_h1"))
    leads = placed.groupBy("_root").agg(F.min(F.struct("_first", "_h1")).alias("_lead"), F.count("*").alias("_texts"))
    return placed.join(leads, "_root").select(
        "_h1", "_h2", "_first", "_rows", F.col("_lead._first.key").alias("_class"), (F.col("_lead._h1") == F.col("_h1")).alias("_leads"), "_texts"
    )


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: key, ``class_id`` (smallest key of its class) and ``class_texts`` (different texts in it)."""
    grouped = text_classes(docs, key, text, similarity).filter("_texts > 1 or _rows > 1")
    rows = _hashed(docs, key, text).drop("text")
    found = rows.join(grouped.select("_h1", "_h2", "_class", "_texts"), ["_h1", "_h2"], "left")
    alone = F.col("_texts").isNull()
    return found.select(F.col("_key").alias(key), F.when(alone, F.col("_key")).otherwise(F.col("_class")).alias("class_id"), F.coalesce("_texts", F.lit(1)).alias("class_texts"))


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The documents without all but one of each class: the row with the class's smallest key stays."""
    alias = {column: f"_doc{i}" for i, column in enumerate(docs.columns)}
    plain = docs.select(*(F.col(f"`{column}`").alias(name) for column, name in alias.items()))
    grouped = _sized(text_classes(plain, alias[key], alias[text], similarity).filter("_texts > 1 or _rows > 1").select("_h1", "_h2", "_first", "_leads"))
    value = F.coalesce(F.col(alias[text]), F.lit(""))
    rows = plain.withColumns({"_h1": F.xxhash64(value), "_h2": F.xxhash64(value, F.lit(1))}).join(grouped, ["_h1", "_h2"], "left")
    first = F.col("_leads") & F.col(alias[key]).eqNullSafe(F.col("_first.key"))
    # Only where the first key stands in several rows is one of them picked by rank.
    several = first & (F.col("_first.n") > 1)
    rank = F.row_number().over(Window.partitionBy("_h1", "_h2").orderBy(F.xxhash64(*alias.values())))
    one = rows.filter(F.col("_leads").isNull() | (first & (F.col("_first.n") == 1)))
    picked = rows.filter(several).withColumn("_rank", rank).filter("_rank = 1").drop("_rank")
    return one.unionByName(picked).select(*(F.col(name).alias(column) for column, name in alias.items()))
