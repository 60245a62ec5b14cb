"""Quality rules: a decision list learned by sequential covering, applied as one Spark expression.

Statistics of whole texts come from one narrow numpy stage. Rules are grown and pruned on a
bounded sample of labelled rows and emitted as ordered ``CASE WHEN`` conditions.

Null texts count as empty: no words, so they fail the base rule. Each row is judged on its own,
so repeated rows get equal verdicts and an empty table gives an empty result. Columns other than
the text and those asked for are not read. Without labelled rows of both classes the list is
empty and the base rule alone decides.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField

from sievework.llm import columns as C

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_lines", "n_digits", "n_upper")
RATIOS = {
    "words": "n_words",
    "word_length": "word_chars / n_words",
    "symbols_per_word": "n_symbols / n_words",
    "dup_lines_per_line": "n_dup_lines / n_lines",
    "repeat_share": "n_repeat_words / n_words",
    "words_per_line": "n_words / n_lines",
    "digit_share": "n_digits / word_chars",
    "upper_share": "n_upper / word_chars",
}
WINDOW = 8
# Labelled rows that the list is learned from, at most.
MAX_LABELLED = 20_000

_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = 1
_DIGIT = np.zeros(256, np.int64)
_DIGIT[48:58] = 1
_UPPER = np.zeros(256, np.int64)
_UPPER[65:91] = 1


def count_texts(column: pa.Array) -> dict[str, np.ndarray]:
    """The statistics in ``COUNTS`` and ``EXTRA`` of each text."""
    data, offsets = C.text_bytes(column)
    starts, ends, first = C.words(data, offsets)
    running = C.prefix_hash(data)
    n_words = np.diff(first)
    letters = ((data & 0xC0) != 0x80) & ~C.SPACE[data]

    # Lines with a word, by their exact bytes.
    newline = np.flatnonzero(data == 10)
    line_starts = np.sort(np.concatenate([offsets[:-1], newline + 1]), kind="stable")
    line_ends = np.sort(np.concatenate([newline, offsets[1:]]), kind="stable")
    line_doc = np.repeat(np.arange(len(column)), np.diff(np.searchsorted(newline, offsets)) + 1)
    filled = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_doc, line_key = line_doc[filled], C.span_hash(running, line_starts[filled], line_ends[filled])
    n_lines = np.bincount(line_doc, minlength=len(column))
    distinct = np.unique(np.stack([line_doc.astype(np.uint64), line_key]), axis=1)[0].astype(np.int64)
    n_dup = n_lines - np.bincount(distinct, minlength=len(column))

    return {
        "n_words": n_words,
        "word_chars": C.segment_sums(letters.astype(np.int64), offsets),
        "n_symbols": C.segment_sums(_SYMBOL[data], offsets),
        "n_dup_lines": n_dup,
        "n_repeat_words": repeated_words(C.span_hash(running, starts, ends), first),
        "n_lines": n_lines,
        "n_digits": C.segment_sums(_DIGIT[data], offsets),
        "n_upper": C.segment_sums(_UPPER[data], offsets),
    }


def repeated_words(word_hash: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per text, the words inside windows of ``WINDOW`` words that stand in the text at least twice."""
    n_docs, n = len(first) - 1, len(word_hash)
    doc = np.repeat(np.arange(n_docs), np.diff(first))
    if n < WINDOW:
        return np.zeros(n_docs, np.int64)
    window = np.zeros(n - WINDOW + 1, np.uint64)
    for k in range(WINDOW):
        window = C.mix(window + word_hash[k : k + len(window)])
    at = np.flatnonzero(doc[: len(window)] == doc[WINDOW - 1 :])
    key = C.mix(window[at] ^ C.mix(doc[at].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    repeated = np.zeros(len(key), bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, at[repeated], 1)
    np.add.at(edges, at[repeated] + WINDOW, -1)
    covered = np.cumsum(edges)[:n] > 0
    return np.bincount(doc[covered], minlength=n_docs)


def with_statistics(docs: DataFrame, keep: Sequence[str], prefix: str = "", text: str = "text") -> DataFrame:
    """Columns ``keep`` and the statistics, each named with ``prefix``."""

    def compute(part: pa.RecordBatch) -> list[np.ndarray]:
        found = count_texts(part.column(text))
        return [found[name].astype(np.int64) for name in (*COUNTS, *EXTRA)]

    fields = [StructField(prefix + name, LongType()) for name in (*COUNTS, *EXTRA)]
    return C.add_columns(C.picked(docs, [*keep, text]), compute, fields, list(keep), text)


def ratios(prefix: str = "") -> dict[str, Column]:
    """The numbers that rules compare: ratios of statistics, 0 where there is nothing to divide by."""
    columns = {}
    for name, formula in RATIOS.items():
        top, _, below = formula.partition(" / ")
        value = F.col(prefix + top).cast("double")
        if below:
            value = F.when(F.col(prefix + below) > 0, value / F.col(prefix + below)).otherwise(0.0)
        columns[name] = value
    return columns


def base_failed(prefix: str = "") -> Column:
    words, repeats = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (words < 20) | (100 * repeats > 30 * words)


@dataclass(frozen=True)
class Rule:
    """A conjunction of (feature, above?, threshold); ``hits`` and ``misses`` on the rows it was learned from."""

    conditions: tuple[tuple[str, bool, float], ...]
    hits: int
    misses: int

    def column(self, prefix: str = "") -> Column:
        values, all_true = ratios(prefix), F.lit(True)
        for feature, above, threshold in self.conditions:
            all_true = all_true & ((values[feature] > threshold) if above else (values[feature] <= threshold))
        return all_true

    def matches(self, table: dict[str, np.ndarray]) -> np.ndarray:
        found = np.ones(len(next(iter(table.values()))), bool)
        for feature, above, threshold in self.conditions:
            found &= (table[feature] > threshold) if above else (table[feature] <= threshold)
        return found

    def __str__(self) -> str:
        return " and ".join(f"{f} {'>' if above else '<='} {t:g}" for f, above, t in self.conditions)


def _thresholds(values: np.ndarray, most: int = 48) -> np.ndarray:
    """Cuts halfway between neighbouring values, at quantiles if there are many values."""
    distinct = np.unique(values)
    if len(distinct) > most:
        distinct = np.unique(np.quantile(values, np.linspace(0, 1, most + 1), method="nearest"))
    return (distinct[1:] + distinct[:-1]) / 2


def _grow(table: dict[str, np.ndarray], bad: np.ndarray, most: int) -> list[tuple[str, bool, float]]:
    """Add the condition of the largest information gain until no good row is left or nothing gains."""
    inside, conditions = np.ones(len(bad), bool), []
    while len(conditions) < most and (bad & inside).any() and (~bad & inside).any():
        p0, n0 = (bad & inside).sum(), (~bad & inside).sum()
        best, chosen = 1e-9, None
        for feature, values in table.items():
            for threshold in _thresholds(values[inside]):
                high = inside & (values > threshold)
                for above, match in ((True, high), (False, inside & ~high)):
                    p, n = (match & bad).sum(), (match & ~bad).sum()
                    if p:
                        gain = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))
                        if gain > best:
                            best, chosen = gain, (feature, above, float(threshold))
        if chosen is None:
            break
        conditions.append(chosen)
        feature, above, threshold = chosen
        inside &= (table[feature] > threshold) if above else (table[feature] <= threshold)
    return conditions


def learn_rules(
    table: dict[str, np.ndarray],
    bad: np.ndarray,
    prune_part: np.ndarray,
    least_precision: float = 0.9,
    least_hits: int = 10,
    max_conditions: int = 4,
    max_rules: int = 16,
) -> list[Rule]:
    """Rules that find ``bad`` rows: grow on one part, prune on the other, remove what is covered, repeat.

    A rule is accepted if it reaches ``least_precision`` on both parts together and
    ``least_hits`` bad rows; the list ends with the first that isn't.
    """
    left, rules = np.ones(len(bad), bool), []

    def rows(mask: np.ndarray) -> dict[str, np.ndarray]:
        return {name: values[mask] for name, values in table.items()}

    while len(rules) < max_rules and (bad & left).any():
        grow, prune = left & ~prune_part, left & prune_part
        conditions = _grow(rows(grow), bad[grow], max_conditions)
        if not conditions:
            break

        def worth(cut: int) -> float:
            match = Rule(tuple(conditions[:cut]), 0, 0).matches(rows(prune))
            p, n = (match & bad[prune]).sum(), (match & ~bad[prune]).sum()
            return (p - n) / (p + n) if p + n else -1.0

        cut = max(range(1, len(conditions) + 1), key=lambda k: (worth(k), -k))
        match = Rule(tuple(conditions[:cut]), 0, 0).matches(table) & left
        hits, misses = int((match & bad).sum()), int((match & ~bad).sum())
        if hits < least_hits or hits < least_precision * (hits + misses):
            break
        rules.append(Rule(tuple(conditions[:cut]), hits, misses))
        left &= ~match
    return rules


def fit_rules(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", max_labelled: int = MAX_LABELLED
) -> list[Rule]:
    """Learn from at most ``max_labelled`` labelled documents, chosen by a hash of the key.

    A key with several labels takes the lowest; rows without key or label are left out.
    """
    chosen = (
        labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(key).alias("_key")).agg((F.min(label) == 0).alias("_bad"))
        .orderBy(F.xxhash64("_key"), "_key").limit(max_labelled)
    )
    # The sample's bound is ``max_labelled`` rows of a key and a flag.
    texts = docs.select(F.col(key).alias("_key"), F.col("text").alias("_text")).join(F.broadcast(chosen), "_key")
    stats = with_statistics(texts, ["_key", "_bad"], text="_text")
    values = F.struct(*(value.alias(name) for name, value in ratios().items()))
    # A key can be in the documents more than once: its lowest row is picked by partial aggregation, before the driver sees any.
    found = stats.groupBy("_key", "_bad").agg(F.min(values).alias("_least")).select("_key", "_bad", "_least.*").toPandas()
    found = found.sort_values([*found.columns])
    if not len(found) or found["_bad"].all() or not found["_bad"].any():
        return []
    table = {name: found[name].to_numpy() for name in RATIOS}
    turn = C.mix(np.arange(len(found), dtype=np.uint64)) % np.uint64(3) == 0
    return learn_rules(table, found["_bad"].to_numpy(bool), turn)


def kept(rules: Sequence[Rule], prefix: str = "") -> Column:
    """The verdict as one ordered condition: the base rule, then each learned rule; true if none applies."""
    verdict = F.when(base_failed(prefix), False)
    for rule in rules:
        verdict = verdict.when(rule.column(prefix), False)
    return verdict.otherwise(True)


def judge(docs: DataFrame, rules: Sequence[Rule], keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Per row: ``keep``, the statistics, ``base_failed``, ``kept`` and ``rule`` (0: base, then the list's number)."""
    which = F.when(base_failed(), 0)
    for number, rule in enumerate(rules, 1):
        which = which.when(rule.column(), number)
    return with_statistics(docs, keep).select(
        *(F.col(C.quoted(name)) for name in keep), *COUNTS, base_failed().alias("base_failed"), kept(rules).alias("kept"), which.alias("rule")
    )


def filter_documents(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The documents that are kept, with all their columns as they were."""
    prefix = C.fresh(docs, "_quality_")
    while any(column.lower().startswith(prefix) for column in docs.columns):
        prefix = f"_{prefix}"
    return C.picked(with_statistics(docs, docs.columns, prefix).filter(kept(rules, prefix)), docs.columns)
