"""Packing of documents into training sequences along a Hilbert curve.

A document's vector is a random projection of its token counts to ``DIMENSIONS`` numbers; their ranks in
a fixed grid give a point on a Hilbert curve. Documents are sorted by that key over the whole table,
laid end to end, and the stream is cut every ``length`` tokens, so neighbours share sequences and only
the last sequence is padded.

Tokens are made once and stored beside the key. The table is then cut by key into ranges of about equal
numbers of rows; token totals of ranges give each range its place in the stream, and each range is
sorted and cut on its own. The key ends in bits of a hash, so that equal documents don't fall into one range.

A null text counts as empty: its document is the end mark alone. Repeated rows are packed as often as they
occur; ties are ordered by document id and a row number. Columns other than key and text are not read. An
empty table gives an empty result.
"""

from __future__ import annotations

import base64
import zlib

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievework.llm import columns as C
from sievework.session import stored

LENGTH = 1024
END_ID = 0
DIMENSIONS = 3
BITS = 12
ROWS_PER_RANGE = 20_000
# Ranges, of which the driver knows the cuts; more rows make them longer.
MAX_RANGES = 20_000
# Texts with longer words or stretches of white space go to the library whose time and stack don't grow with them.
LONG_RUN = 2_000
# The pattern that splits texts of this vocabulary, and its one special token; fixed values.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256


def tokenizer_paths() -> tuple[str, str]:
    """The vocabulary for ``tokenizers``, and the same one as ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder:
    """Ids of ``tokenizers`` for the vocabulary at ``paths``, through a faster library with the same vocabulary as ranks."""

    def __init__(self, paths: tuple[str, str]):
        import tiktoken
        from tokenizers import Tokenizer

        with open(paths[1], "rb") as lines:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("texts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={SPECIAL: SPECIAL_ID})
        self.plain = Tokenizer.from_file(paths[0])

    def one(self, text: str, longest: int) -> np.ndarray:
        if longest > LONG_RUN:
            return np.array(self.plain.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, allowed_special="all")

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by ``END_ID``, and the offsets of the texts in them."""
        data, offsets = C.text_bytes(column)
        longest = np.zeros(len(column), np.int64)
        blank = C.SPACE[data]
        for inside in (blank, ~blank):
            starts, ends, first = C.runs(inside, offsets)
            np.maximum.at(longest, np.repeat(np.arange(len(column)), np.diff(first)), ends - starts)
        end = np.array([END_ID], np.uint32)
        parts = []
        for text, size in zip(column.to_pylist(), longest):
            parts += [self.one(text or "", size), end]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        return np.concatenate(parts).astype(np.uint16), np.concatenate([[0], np.cumsum(sizes)[1::2]])


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Place of grid points (rows of integers below 2**bits) on a Hilbert curve."""
    x = points.astype(np.uint64).T.copy()
    n = len(x)
    one = np.uint64(1)
    level = np.uint64(1 << (bits - 1))
    # Undo the rotations and reflections of each level, from the coarsest on.
    while level > one:
        low = level - one
        for i in range(n):
            flip = (x[i] & level) > 0
            swapped = np.where(flip, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swapped)
            x[i] ^= swapped if i else np.uint64(0)
        level >>= one
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flips = np.zeros_like(x[0])
    level = np.uint64(1 << (bits - 1))
    while level > one:
        flips ^= np.where((x[n - 1] & level) > 0, level - one, np.uint64(0))
        level >>= one
    x ^= flips
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << one) | ((x[i] >> np.uint64(bit)) & one)
    return key


def projection(vocabulary: int) -> np.ndarray:
    return np.random.default_rng(5).standard_normal((vocabulary, DIMENSIONS)).astype(np.float32)


def curve_keys(stream: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Hilbert keys of documents from their token ids."""
    points = np.empty((len(offsets) - 1, DIMENSIONS))
    size = np.maximum(np.diff(offsets), 1)
    for d in range(DIMENSIONS):
        points[:, d] = C.segment_sums(table[stream, d].astype(np.float64), offsets) / np.sqrt(size)
    # A squashed sum lies in (0, 1); the scale leaves room for words that occur together.
    grid = (1 / (1 + np.exp(-np.clip(points / 2, -30, 30))) * (1 << BITS)).astype(np.int64)
    return hilbert(np.clip(grid, 0, (1 << BITS) - 1), BITS)


def tokenized(docs: DataFrame, key: str, text: str, paths: tuple[str, str]) -> DataFrame:
    """Stored table: ``_key``, ``_row``, ``_order`` (curve key and hash bits), ``_n`` and ``_ids`` (16-bit)."""
    table: list = []

    def run(batches):
        if not table:
            table.extend([Encoder(paths), projection(SPECIAL_ID + 1)])
        encoder, projected = table
        for part in C.slices(batches):
            stream, offsets = encoder.encode(part.column("text"))
            keys = curve_keys(stream, offsets, projected)
            spread = part.column("_hash").to_numpy().astype(np.uint64) & np.uint64((1 << 16) - 1)
            packed = pa.BinaryArray.from_buffers(
                pa.binary(), part.num_rows, [None, pa.py_buffer((offsets * 2).astype(np.int32)), pa.py_buffer(stream.astype("<u2"))]
            )
            yield pa.RecordBatch.from_arrays(
                [part.column("_key"), part.column("_row"), pa.array(((keys << np.uint64(16)) | spread).astype(np.int64)), pa.array(np.diff(offsets)), packed],
                ["_key", "_row", "_order", "_n", "_ids"],
            )

    row = F.monotonically_increasing_id()
    named = docs.select(F.col(key).alias("_key"), F.col(text).alias("text"), row.alias("_row")).withColumn("_hash", F.xxhash64("_key", "_row"))
    kind = named.schema["_key"].dataType.simpleString()
    made = C.map_batches(named, run, f"_key {kind}, _row bigint, _order bigint, _n bigint, _ids binary")
    return stored(made, compression="zstd")


def _pieces(length: int):
    def run(batches):
        """Rows of a range come in order; ``_base`` is where the range begins in the stream."""
        at, current = 0, None
        for batch in batches:
            ranges, base, sizes = batch.column("_range").to_pylist(), batch.column("_base").to_pylist(), batch.column("_n").to_pylist()
            buffers, keys = batch.column("_ids"), batch.column("_key").to_pylist()
            out: list[tuple] = []
            for i in range(batch.num_rows):
                if ranges[i] != current:
                    current, at = ranges[i], base[i]
                ids = np.frombuffer(buffers[i].as_buffer(), "<u2").astype("<u4")
                start = 0
                while start < sizes[i]:
                    size = min(sizes[i] - start, length - at % length)
                    out.append((keys[i], start, size, zlib.crc32(ids[start : start + size]), sizes[i], at // length, at % length))
                    start, at = start + size, at + size
            if out:
                columns = list(zip(*out))
                kinds = [batch.schema.field("_key").type, *[pa.int64()] * 6]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds)],
                    ["_key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
                )

    return run


def pack(
    docs: DataFrame,
    length: int = LENGTH,
    key: str = "doc_id",
    text: str = "text",
    paths: tuple[str, str] | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """One row per piece of a document: key, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    table = tokenized(docs, key, text, paths or tokenizer_paths())
    ranges = min(MAX_RANGES, -(-table.count() // rows_per_range))
    cuts = sorted(set(table.approxQuantile("_order", [i / ranges for i in range(1, ranges)], 1 / (4 * ranges)))) if ranges > 1 else []
    ranged = table.withColumn("_range", F.lit(0))
    if cuts:
        splits = [-float("inf"), *cuts, float("inf")]
        numbered = Bucketizer(splits=splits, inputCol="_at", outputCol="_range").transform(
            table.withColumn("_at", F.col("_order").cast("double"))
        )
        ranged = numbered.withColumn("_range", F.col("_range").cast("int")).drop("_at")
    # A row per range, MAX_RANGES at most.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_range").agg(F.sum("_n").alias("_total"))
    bases = totals.select("_range", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base"))
    # A task gets one range.
    dealt = ranged.join(F.broadcast(bases), "_range").repartitionById(len(cuts) + 1, "_range")
    placed = dealt.sortWithinPartitions("_range", "_order", "_key", "_row")
    kind = docs.schema[key].dataType.simpleString()
    pieces = C.map_batches(
        placed.select("_key", "_range", "_base", "_n", "_ids"),
        _pieces(length),
        f"_key {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    )
    return pieces.withColumnRenamed("_key", key)
