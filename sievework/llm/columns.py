"""Numpy views of Arrow text columns: byte buffers, words and segment hashes without a string per word.

Arrow hands a task batches of rows. Work runs over slices of half a megabyte of text, so memory is bounded by a few
times the slice or the longest single text, not by the partition, but for what an operator says that it keeps.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from sievework.session import ship as ship_package

SLICE_BYTES = 512 << 10

# White space of the contracts: space, and tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_BYTE_CODES = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


def ship(spark: SparkSession) -> None:
    """Let Python workers of this session import the package, also if it isn't installed.

    Batches of rows are limited by bytes, unless the session says otherwise: by rows alone,
    a batch of long texts can take more memory than a worker has.
    """
    if spark.conf.get(BATCH_SETTING, "64m") in ("64m", f"{64 << 20}b"):
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    ship_package(spark)


def map_batches(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` over slices of bounded text size."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def slices(batches: Iterable[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``most`` bytes of text; one text is never cut."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        begin = 0
        while begin < batch.num_rows:
            base = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, base + most, "right")))
            yield batch.slice(begin, end - begin)
            begin = end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts of a column and their offsets (one more than rows); null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets.astype(np.int64) - int(offsets[0])


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes, cut at text ends, and the number of runs before each text."""
    inside = np.append(inside, False)
    cut = np.zeros(len(inside), bool)
    cut[offsets] = True
    before = np.concatenate([[False], inside[:-1]])
    starts = np.flatnonzero(inside & (~before | cut))
    ends = np.flatnonzero(before & (~inside | cut))
    return starts, ends, np.searchsorted(starts, offsets)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs without white space."""
    return runs(~SPACE[data], offsets)


def _power(kind: str, n: int) -> np.ndarray:
    """Powers of the multiplier ("up") or of its inverse ("down") modulo 2**64."""
    have = _powers[kind]
    if len(have) < n:
        base = _MULTIPLIER if kind == "up" else pow(_MULTIPLIER, -1, 1 << 64)
        n = max(n, 2 * len(have), SLICE_BYTES + 1)
        have = np.full(n, base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _powers[kind] = have
    return have


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that all bits of the result depend on all bits of the input."""
    x = values.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash; :func:`span_hash` reads any segment's hash from it."""
    running = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[data] * _power("up", len(data))[: len(data)], out=running[1:])
    return running


def span_hash(running: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte segments; equal segments have equal hashes wherever they stand."""
    return mix((running[ends] - running[starts]) * _power("down", len(running))[starts] + (ends - starts).astype(np.uint64))


def rebased(differences: np.ndarray) -> np.ndarray:
    """Differences of :func:`prefix_hash` of segments that begin at places 0, 1, 2, ... freed from their place."""
    return differences * _power("down", len(differences))[: len(differences)]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all elements of the ranges (start, length), one range after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def segment_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive bounds; empty segments give 0."""
    running = np.concatenate([np.zeros((1, *values.shape[1:]), values.dtype), np.cumsum(values, axis=0)])
    return running[bounds[1:]] - running[bounds[:-1]]


def add_columns(df: DataFrame, compute, fields: list[StructField], keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` of ``df`` and the arrays that ``compute(slice)`` returns, in one narrow stage.

    A slice has the text and the columns that aren't kept under their names. Kept ones have numbers in there, as
    Spark's Arrow functions take no name with a dot.
    """
    inner = [f"_kept{i}" for i in range(len(keep))]
    others = [name for name in df.columns if name != text and name not in keep]
    used = df.select(
        *(F.col(quoted(name)).alias(alias) for name, alias in zip(keep, inner)), *(F.col(quoted(name)) for name in [text, *others])
    )
    names = [*inner, *(field.name for field in fields)]
    schema = StructType([*(used.schema[name] for name in inner), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            columns = [part.column(name) for name in inner]
            yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, compute(part))], names)

    ship(df.sparkSession)
    return used.mapInArrow(run, schema).toDF(*keep, *(field.name for field in fields))


def quoted(name: str) -> str:
    """``name`` as a column reference, also with a dot in it."""
    return "`" + name.replace("`", "``") + "`"


def picked(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The columns of these names, each once."""
    return df.select(*(F.col(quoted(name)) for name in dict.fromkeys(names)))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def held_out(key: Column | str = "doc_id") -> Column:
    """True for the fifth of rows that nothing may learn from; a missing key is held out."""
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(True))
