"""Fill-in-middle: texts cut in three at unit ends and put in another order, by arithmetic on 64-bit words of UTF-8.

A unit is a run of ASCII letters or any other single code point. The bytes of a slice of texts are viewed as uint64, eight
at a time. A byte ends a unit unless the next byte continues its code point or both are letters; that is one mark in the
top bit of each byte, found for a whole word by additions that cannot carry from one byte into the next. ``bitwise_count``
gives the marks of each word and a running sum those before it. To find the unit with a given number, the running sum is
searched for its word, and in the word the marks are summed by byte with one multiplication and compared at once.

A document's choices come from the SHA-256 of a seed and its key, so reruns agree however rows are dealt out. One narrow
stage, no shuffle; memory is bounded by a slice or the longest text.

A null text counts as empty; empty texts and those that hold a mark of the format stay plain. A null key is hashed as an
empty string. Repeated rows get the same result each. Other columns are not read, unless they are asked for by ``keep``. An
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from sievework.llm import columns as C

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"


def _every_byte(value: int) -> np.uint64:
    return np.uint64(int.from_bytes(bytes([value]) * 8, "little"))


TOP, LOW7, ONES, CASE = _every_byte(0x80), _every_byte(0x7F), _every_byte(0x01), _every_byte(0x20)
FROM_A, PAST_Z = _every_byte(0x80 - ord("a")), _every_byte(0x80 - ord("z") - 1)
BYTE, LAST = np.uint64(8), np.uint64(56)


def as_words(data: np.ndarray) -> np.ndarray:
    """Bytes as little-endian uint64, with zeros after the last and at least one whole word of zeros."""
    padded = np.zeros(-(-len(data) // 8) * 8 + 8, np.uint8)
    padded[: len(data)] = data
    return padded.view("<u8")


def letter_marks(words: np.ndarray) -> np.ndarray:
    """The top bit of each byte that is an ASCII letter."""
    folded = (words | CASE) & LOW7
    return (folded + FROM_A) & ~(folded + PAST_Z) & ~words & TOP


def continuation_marks(words: np.ndarray) -> np.ndarray:
    """The top bit of each byte that continues a code point."""
    return words & ~(words << np.uint64(1)) & TOP


def _next_byte(marks: np.ndarray) -> np.ndarray:
    """Marks moved to the byte before."""
    moved = marks >> BYTE
    moved[:-1] |= marks[1:] << LAST
    return moved


class Marks:
    """Marked bytes, counted and searched by number."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(marks), dtype=np.int64)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` bytes are marked."""
        word = at >> 3
        below = (np.uint64(1) << (BYTE * (at & 7).astype(np.uint64))) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.marks[word] & below)

    def select(self, number: np.ndarray) -> np.ndarray:
        """Places of the marks with these numbers, counted from 0."""
        word = np.searchsorted(self.before, number, "right") - 1
        wanted = (number - self.before[word] + 1).astype(np.uint64)
        # Sums of the marks up to each byte; those that reach the wanted number keep their top bit.
        sums = (self.marks[word] >> np.uint64(7)) * ONES
        reached = ((sums | TOP) - wanted * ONES) & TOP
        return word * 8 + 8 - np.bitwise_count(reached)


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[Marks, Marks]:
    """Ends of units, and first bytes of code points, of texts that lie end to end."""
    words = as_words(data)
    letters, goes_on = letter_marks(words), continuation_marks(words)
    ends = ~(_next_byte(goes_on) | (letters & _next_byte(letters))) & TOP
    first = ~goes_on & TOP
    # A text ends its last unit, whatever the next one begins with; bytes after the last text count for nothing.
    last = offsets[1:][np.diff(offsets) > 0] - 1
    np.bitwise_or.at(ends, last >> 3, np.uint64(0x80) << (BYTE * (last & 7).astype(np.uint64)))
    used = len(data) >> 3
    within = (np.uint64(1) << (BYTE * np.uint64(len(data) & 7))) - np.uint64(1)
    for marks in (ends, first):
        marks[used] &= within
        marks[used + 1 :] = 0
    return Marks(ends), Marks(first)


def cuts(ends: Marks, offsets: np.ndarray, draws: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units of each text, and the two places where it is cut: after ``draw % (units + 1)`` units."""
    begun = ends.rank(offsets)
    n = np.diff(begun)
    places = []
    for draw in draws:
        taken = draw % (n + 1)
        at = offsets[:-1].copy()
        some = taken > 0
        at[some] = ends.select(begun[:-1][some] + taken[some] - 1) + 1
        places.append(at)
    return n, np.minimum(*places), np.maximum(*places)


def _transform(plain_from: int, spm_below: int):
    marks = [mark.encode() for mark in (PREFIX, SUFFIX, MIDDLE)]
    head, then, last = marks

    def run(part: pa.RecordBatch) -> list:
        data, offsets = C.text_bytes(part.column("text"))
        draws = [part.column(f"_draw{i}").to_numpy() for i in range(4)]
        ends, first = units(data, offsets)
        n, one, two = cuts(ends, offsets, (draws[0], draws[1]))
        before = {place: first.rank(at) for place, at in (("start", offsets[:-1]), ("one", one), ("two", two))}
        buffer = data.tobytes()
        forms, outputs = [], []
        for i, (start, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            text = buffer[start:end]
            if not text or draws[2][i] % 100 >= plain_from or any(mark in text for mark in marks):
                forms.append(PLAIN)
                outputs.append(text)
                continue
            prefix, middle, suffix = buffer[start : one[i]], buffer[one[i] : two[i]], buffer[two[i] : end]
            if draws[3][i] % 100 < spm_below:
                forms.append(SPM)
                outputs.append(b"".join((then, suffix, head, prefix, last, middle)))
            else:
                forms.append(PSM)
                outputs.append(b"".join((head, prefix, then, suffix, last, middle)))
        plain = np.array([form == PLAIN for form in forms], bool)
        return [
            pa.array(n),
            pa.array(forms, pa.string()),
            pa.array(before["one"] - before["start"], mask=plain),
            pa.array(before["two"] - before["one"], mask=plain),
            pa.array(outputs, pa.binary()).cast(pa.string()),
        ]

    return run


def fill_in_middle(
    docs: DataFrame,
    keep: list[str],
    plain_from: int = 90,
    spm_below: int = 20,
    seed: str = "1",
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Columns ``keep`` and ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    Of a hundred texts, those drawn from ``plain_from`` on stay plain; of the others, ``spm_below`` begin with the suffix.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(C.quoted(key)).cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint").alias(f"_draw{i}") for i in range(4)]
    kept = [F.col(C.quoted(name)).alias(f"_keep{i}") for i, name in enumerate(keep)]
    narrow = docs.select(*kept, F.col(C.quoted(text)).alias("text"), *draws)
    made = [
        StructField("n", LongType()),
        StructField("form", StringType()),
        StructField("prefix_chars", LongType()),
        StructField("middle_chars", LongType()),
        StructField("output", StringType()),
    ]
    found = C.add_columns(narrow, _transform(plain_from, spm_below), made, [f"_keep{i}" for i in range(len(keep))])
    return found.toDF(*keep, *(field.name for field in made))


def restore(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of. Texts with a mark stay plain, so each mark stands once."""

    def between(after: str, until: str | None) -> Column:
        rest = F.split_part(output, F.lit(after), F.lit(2))
        return rest if until is None else F.split_part(rest, F.lit(until), F.lit(1))

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX))
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)
