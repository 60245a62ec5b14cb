"""Benchmark decontamination: a prefix-filtered set join of benchmark windows with documents.

A benchmark item is cut into windows of ``window`` words (an item of fewer words is one window), and a window is a set of
shingles of ``shingle`` words. A document holds a window only if it holds all of its shingles, so one shingle is prefix
enough: the rarest one, by its count over all documents. Only places where a document has some window's rarest shingle
become candidates; the shingle's offset in the window says where the window would have to begin (positional bound) and
its length whether it fits into the document (length bound); what is left is compared word by word.

Documents are read twice, in narrow stages: once to count benchmark shingles, summed inside each slice of texts before
anything is shuffled, and once for candidates, which carry the few words around them. What tasks get of the benchmark is a
bitmap of its shingles of at most ``MAX_BITS`` bits, however long the benchmark is: a fuller bitmap lets more candidates
through, and the join on the shingle decides. Hit words are counted as 64-bit masks of blocks of a document, so a very long
document is not one group; its list of items is one value, as long as there are items in it.

Words longer than ``LONG_WORD`` bytes are compared by SHA-256. A null or wordless text has no words: such a document has
no hits, such an item no windows. Items without an id mark hits, but are neither counted nor listed; rows that share an
item id are one item. Repeated documents are judged row by row. Other columns are not read. An empty benchmark leaves all
documents clean; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm import columns as C
from sievework.session import stored

WINDOW = 10
SHINGLE = 5
LONG_WORD = 64
MIN_BITS, MAX_BITS, BITS_PER_SHINGLE = 16, 26, 64
BATCH_ROWS = 4_096

# Words after lower-casing A-Z: digits, letters, and whatever is not ASCII.
WORD = np.zeros(256, bool)
WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_FACTORS = np.random.default_rng(23).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


class Words:
    """Words of a column of texts, and hashes of runs of words."""

    def __init__(self, column: pa.Array):
        data, offsets = C.text_bytes(column)
        self.data = C.LOWER[data]
        self.starts, self.ends, self.first = C.runs(WORD[data], offsets)
        self.hashes = C.span_hash(C.prefix_hash(self.data), self.starts, self.ends)
        self.count = np.diff(self.first)
        self.text = np.repeat(np.arange(len(column)), self.count)

    def shingles(self, size: int) -> np.ndarray:
        """Hashes of the ``size`` words from each word on; those that leave their text are of no use."""
        n = max(0, len(self.starts) - size + 1)
        total = np.full(n, size, np.uint64)
        for i in range(size):
            total += self.hashes[i : i + n] * _FACTORS[i]
        return C.mix(total)

    def whole(self, size: int) -> np.ndarray:
        """Which of :meth:`shingles` end in the text they begin in."""
        n = max(0, len(self.starts) - size + 1)
        return self.first[self.text[:n] + 1] - np.arange(n) >= size

    def tokens(self, begin: int, end: int) -> list[str]:
        words = (self.data[a:b].tobytes() for a, b in zip(self.starts[begin:end], self.ends[begin:end]))
        # No word has a number sign, so a digest is no other word.
        return [w.decode() if len(w) <= LONG_WORD else f"#{hashlib.sha256(w).hexdigest()}" for w in words]


class Bitmap:
    """A set of hashes, with errors on one side: what was put in is found."""

    def __init__(self, hashes: DataFrame, n: int):
        self.bits = int(np.clip(int(BITS_PER_SHINGLE * max(n, 1)).bit_length(), MIN_BITS, MAX_BITS))
        place = F.shiftrightunsigned("_hash", 64 - self.bits)
        bit = F.expr("shiftleft(1L, cast(_place & 63 AS int))")
        words = hashes.select(place.alias("_place")).groupBy(F.shiftright("_place", 6).alias("_word")).agg(F.bit_or(bit).alias("_mask"))
        # At most 2 ** (MAX_BITS - 6) rows, whatever the benchmark.
        found = words.toArrow()
        self.masks = np.zeros(1 << (self.bits - 6), np.uint64)
        self.masks[found["_word"].to_numpy()] = found["_mask"].to_numpy().view(np.uint64)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes >> np.uint64(64 - self.bits)
        return (self.masks[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def _batches(rows, names, kinds):
    """Record batches of at most BATCH_ROWS of the rows."""
    held: list[tuple] = []

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names)

    for row in rows:
        held.append(row)
        if len(held) == BATCH_ROWS:
            yield batch()
            held = []
    if held:
        yield batch()


def windows_of(benchmark: DataFrame, window: int, shingle: int, item: str, text: str) -> DataFrame:
    """Stored table of the windows of all items: ``_item`` (text), ``_words``, ``_size`` of shingles, ``_hashes``."""

    def run(batches):
        for part in C.slices(batches):
            words = Words(part.column("text"))
            hashes = {size: words.shingles(size).view(np.int64) for size in range(1, shingle + 1)}
            items = part.column("_item").to_pylist()

            def rows():
                for i, n in enumerate(words.count.tolist()):
                    if n:
                        begin, length = int(words.first[i]), min(window, n)
                        size = min(shingle, length)
                        tokens = words.tokens(begin, begin + n)
                        for at in range(n - length + 1):
                            mine = hashes[size][begin + at : begin + at + length - size + 1]
                            yield items[i], tokens[at : at + length], size, mine.tolist()

            yield from _batches(
                rows(), ["_item", "_words", "_size", "_hashes"], [pa.string(), pa.list_(pa.string()), pa.int32(), pa.list_(pa.int64())]
            )

    named = benchmark.select(F.col(C.quoted(item)).cast("string").alias("_item"), F.col(C.quoted(text)).alias("text"))
    return stored(C.map_batches(named, run, "_item string, _words array<string>, _size int, _hashes array<bigint>"))


def _places(words: Words, sizes: list[int], wanted: Bitmap):
    """Word places and hashes of the shingles that the bitmap lets through."""
    for size in sizes:
        hashes = words.shingles(size)
        at = np.flatnonzero(words.whole(size) & wanted.has(hashes))
        yield at, hashes[at]


def shingle_counts(texts: DataFrame, sizes: list[int], wanted: Bitmap) -> DataFrame:
    """How often each shingle of the bitmap stands in the texts: ``_hash``, ``_times``."""

    def run(batches):
        for part in C.slices(batches):
            found = [hashes for _, hashes in _places(Words(part.column("text")), sizes, wanted)]
            if found:
                hashes, times = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(times)], ["_hash", "_times"])

    counted = C.map_batches(texts.select("text"), run, "_hash bigint, _times bigint")
    return counted.groupBy("_hash").agg(F.sum("_times").alias("_times"))


def candidates(texts: DataFrame, sizes: list[int], wanted: Bitmap, window: int) -> DataFrame:
    """Stored table: a row per text with its ``_n`` words, and one per candidate.

    A candidate is the place ``_at`` of a shingle, with up to ``window - 1`` words before it (``_lead`` of them) and
    ``window`` words from it on.
    """

    def run(batches):
        for part in C.slices(batches):
            words = Words(part.column("text"))
            rows = part.column("_row").to_numpy()
            nothing = pa.nulls(part.num_rows, pa.int64())
            empty = pa.nulls(part.num_rows, pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [part.column("_row"), part.column("_key"), pa.array(words.count.astype(np.int64)), nothing, nothing, nothing, empty],
                ["_row", "_key", "_n", "_at", "_lead", "_hash", "_around"],
            )

            def found():
                for places, hashes in _places(words, sizes, wanted):
                    for place, hash_ in zip(places.tolist(), hashes.view(np.int64).tolist()):
                        text = int(words.text[place])
                        begin, end = int(words.first[text]), int(words.first[text + 1])
                        at = place - begin
                        lead = min(at, window - 1)
                        yield int(rows[text]), None, None, at, lead, hash_, words.tokens(place - lead, min(end, place + window))

            whole = pa.int64()
            yield from _batches(
                found(),
                ["_row", "_key", "_n", "_at", "_lead", "_hash", "_around"],
                [whole, part.schema.field("_key").type, whole, whole, whole, whole, pa.list_(pa.string())],
            )

    kind = texts.schema["_key"].dataType.simpleString()
    schema = f"_row bigint, _key {kind}, _n bigint, _at bigint, _lead bigint, _hash bigint, _around array<string>"
    return stored(C.map_batches(texts, run, schema))


def rarest_shingles(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Stored table of the windows that can occur: ``_window``, ``_words`` and the ``_hash`` and ``_offset`` of the rarest shingle."""
    parts = windows.select("_window", F.posexplode("_hashes").alias("_offset", "_hash"))
    # A shingle that no document has leaves its window out.
    ranked = parts.join(counts, "_hash", "left").groupBy("_window").agg(
        F.min(F.struct(F.coalesce("_times", F.lit(0)).alias("_times"), "_hash", "_offset")).alias("_least")
    )
    return stored(
        windows.join(ranked.filter(F.col("_least._times") > 0), "_window").select(
            "_window", "_words", F.col("_least._hash").alias("_hash"), F.col("_least._offset").alias("_offset")
        )
    )


def occurrences(found: DataFrame, index: DataFrame) -> DataFrame:
    """Verified occurrences of windows in texts: ``_row``, ``_window``, ``_start``, ``_length``."""
    met = found.filter(F.col("_hash").isNotNull()).join(index, "_hash")
    length = F.size("_words")
    fits = (F.col("_offset") <= F.col("_lead")) & (F.col("_lead") - F.col("_offset") + length <= F.size("_around"))
    begin = (F.col("_lead") - F.col("_offset") + 1).cast("int")
    same = F.slice("_around", F.when(fits, begin).otherwise(1), length) == F.col("_words")
    return met.filter(fits & same).select(
        "_row", "_window", (F.col("_at") - F.col("_offset")).alias("_start"), length.cast("bigint").alias("_length")
    )


def hit_words(spans: DataFrame) -> DataFrame:
    """Words inside at least one span, per ``_row``: ``_n_hit``. Spans are shorter than 64 words."""
    ones = F.expr("shiftrightunsigned(-1L, cast(64 - _length AS int))")
    within = F.col("_start") % 64
    low = F.expr("shiftleft(_ones, cast(_start % 64 AS int))")
    rest = F.expr("shiftrightunsigned(_ones, cast(64 - _start % 64 AS int))")
    block = F.floor(F.col("_start") / 64).cast("bigint")
    over = F.when(within + F.col("_length") > 64, F.struct((block + 1).alias("_block"), rest.alias("_mask")))
    masks = spans.withColumn("_ones", ones).select(
        "_row", F.inline(F.array_compact(F.array(F.struct(block.alias("_block"), low.alias("_mask")), over)))
    )
    blocks = masks.groupBy("_row", "_block").agg(F.bit_or("_mask").alias("_mask"))
    return blocks.groupBy("_row").agg(F.sum(F.bit_count("_mask")).cast("bigint").alias("_n_hit"))


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    shingle: int = SHINGLE,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Per document row: key, ``n_words``, ``n_hit`` and the sorted list ``items`` of the items that it holds windows of."""
    if not 1 <= shingle <= window < 64:
        raise ValueError("shingles are at most as long as windows, and windows shorter than 64 words")
    texts = docs.select(
        F.col(C.quoted(key)).alias("_key"), F.col(C.quoted(text)).alias("text"), F.monotonically_increasing_id().alias("_row")
    )
    windows = windows_of(benchmark, window, shingle, item, item_text)
    one = windows.groupBy("_words").agg(F.first("_size").alias("_size"), F.first("_hashes").alias("_hashes"))
    unique = stored(one.withColumn("_window", F.monotonically_increasing_id()))
    sizes = sorted(row[0] for row in unique.select("_size").distinct().collect())  # at most ``shingle`` numbers
    shingles = stored(unique.select(F.explode("_hashes").alias("_hash")).distinct())
    counts = shingle_counts(texts, sizes, Bitmap(shingles, shingles.count()))
    index = rarest_shingles(unique, counts)
    found = candidates(texts, sizes, Bitmap(index.select("_hash"), index.count()), window)
    spans = stored(occurrences(found, index))
    held = spans.select("_row", "_window").distinct()
    owners = windows.filter("_item IS NOT NULL").join(unique, "_words").select("_window", "_item").distinct()
    items = held.join(owners, "_window").groupBy("_row").agg(F.sort_array(F.collect_set("_item")).alias("_items"))
    rows = found.filter(F.col("_n").isNotNull()).select("_row", "_key", "_n")
    return (
        rows.join(hit_words(spans), "_row", "left").join(items, "_row", "left").select(
            F.col("_key").alias(key), F.col("_n").alias("n_words"), F.coalesce("_n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
            F.coalesce("_items", F.array().cast("array<string>")).alias("items"),
        )
    )
