"""Language identification by unigram pieces, summed over all segmentations of the text.

A language is a distribution over the pieces of a fixed public vocabulary. The probability of a
word is the sum over all ways to cut it into pieces (the forward algorithm), and a text's is the
product over its words. Words are runs of letters, in lower case, after a word mark.

Fitting takes two passes of expected counts (forward and backward) over a bounded sample of labelled
rows: first under equal piece probabilities, then under those of the first pass. The second
pass's counts are kept per language.

Words are scored in numpy, all words of a length class at once, and each distinct word of a
partition once. A run of more than ``LONGEST`` letters, as in text without spaces, is cut into parts that are worked on at
once: what a part makes of the forward values before it is a matrix, and the matrices of a run are applied one after
the other, so its score too is the sum over all its segmentations. (Fitting learns from such a run in stretches of
``LONGEST`` letters.)

A null text, or one without a letter, is ``und`` with score 0. Ties go to the language that comes
first by name. Rows are scored on their own, so repeated rows get equal results and an empty table
gives an empty result. Rows without language or key are not learned from; if nothing can be
learned from, every text is ``und``. Columns other than key, text and language are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField

from sievework.llm import columns as C

# Documents of a language that are learned from, about (all, if there are fewer).
SAMPLE_PER_LANGUAGE = 4_000
# Languages that are counted or scored at once; there can be any number of them.
LANGUAGES_AT_ONCE = 16
LONGEST = 32
# Parts of long runs that are worked on at once.
PARTS_AT_ONCE = 256
MARK = "▁"
# In front of a stretch that goes on with a run, in place of the word mark.
GOES_ON = "\0"
UNKNOWN = 1e-7
PER_LETTER = 32.0
_LETTERS = regex.compile(r"\p{L}+")
_BASE = np.uint64(0x5851F42D4C957F2D)
_SLOT_BITS = 19
_CACHED_WORDS = 400_000


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass
class Pieces:
    """Hash table of the pieces: slots hold a piece's hash and number; ``longest`` letters at most."""

    keys: np.ndarray
    numbers: np.ndarray
    count: int
    longest: int
    probes: int


def load_pieces(path: str) -> Pieces:
    """Pieces of letters, with or without the word mark in front, from a sentencepiece model."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    named = {model.id_to_piece(i) for i in range(model.get_piece_size()) if not model.is_control(i) and not model.is_byte(i)}
    wanted = regex.compile(rf"{MARK}?\p{{L}}*")
    pieces = sorted(p for p in named if p and wanted.fullmatch(p) and p == p.lower())
    hashes = np.array([_text_hash(p) for p in pieces], np.uint64)
    size = 1 << _SLOT_BITS
    keys, numbers, probes = np.zeros(size, np.uint64), np.full(size, -1, np.int64), 1
    for number, value in enumerate(hashes.tolist()):
        slot, step = value >> (64 - _SLOT_BITS), 1
        while numbers[slot] >= 0:
            slot, step = (slot + 1) % size, step + 1
        keys[slot], numbers[slot], probes = value, number, max(probes, step)
    return Pieces(keys, numbers, len(pieces), max(map(len, pieces)), probes)


def _spread(values: np.ndarray) -> np.ndarray:
    values = values * np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(29)) ^ (values << np.uint64(17))


def _text_hash(text: str) -> int:
    value = np.zeros(1, np.uint64)
    for letter in text:
        value = value * _BASE + np.uint64(ord(letter) + 1)
    return int(_spread(value)[0])


def _find(pieces: Pieces, hashes: np.ndarray) -> np.ndarray:
    """Numbers of the pieces with these hashes; -1 for none."""
    hashes = _spread(hashes)
    slots = (hashes >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
    found = np.where(pieces.keys[slots] == hashes, pieces.numbers[slots], -1)
    for step in range(1, pieces.probes):
        again = np.flatnonzero((found < 0) & (pieces.numbers[slots] >= 0))
        if not len(again):
            break
        at = (slots[again] + step) % len(pieces.keys)
        found[again] = np.where(pieces.keys[at] == hashes[again], pieces.numbers[at], -1)
    return found


def _find_text(pieces: Pieces, text: str) -> int:
    """Number of a piece; -1 if the text is none."""
    value = np.zeros(1, np.uint64)
    for letter in text:
        value = value * _BASE + np.uint64(ord(letter) + 1)
    return int(_find(pieces, value)[0])


def _length_classes(words: list[str]):
    """Words by length class: positions of the words, their letters (padded) and lengths, mark included."""
    words = [word[1:] if word[0] == GOES_ON else MARK + word for word in words]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for low, high in ((0, 4), (4, 6), (6, 8), (8, 11), (11, 16), (16, LONGEST + 1)):
        chosen = np.flatnonzero((lengths > low) & (lengths <= high))
        for begin in range(0, len(chosen), 20_000):
            at = chosen[begin : begin + 20_000]
            n = lengths[at]
            flat = np.frombuffer("".join(words[i] for i in at).encode("utf-32-le"), np.uint32)
            letters = np.zeros((len(at), high), np.uint64)
            letters[np.arange(high)[None] < n[:, None]] = flat
            yield at, letters.T.copy(), n


def _segments(pieces: Pieces, letters: np.ndarray, lengths: np.ndarray):
    """All (begin, end, words, piece numbers) that stand in the words; an unknown letter is the last number."""
    width = len(letters)
    prefix = np.zeros((width + 1, letters.shape[1]), np.uint64)
    for i in range(width):
        prefix[i + 1] = prefix[i] * _BASE + letters[i] + np.uint64(1)
    powers = [np.uint64(pow(int(_BASE), k, 1 << 64)) for k in range(pieces.longest + 1)]
    for begin in range(width):
        for size in range(1, min(pieces.longest, width - begin) + 1):
            inside = np.flatnonzero(lengths >= begin + size)
            if not len(inside):
                break
            number = _find(pieces, prefix[begin + size, inside] - prefix[begin, inside] * powers[size])
            if size == 1:
                number[number < 0] = pieces.count
            hit = number >= 0
            yield begin, begin + size, inside[hit], number[hit]


def word_scores(pieces: Pieces, probabilities: np.ndarray, words: list[str]) -> np.ndarray:
    """Log probability of each word under each language (columns of ``probabilities``)."""
    scores = np.zeros((len(words), probabilities.shape[1]))
    for at, letters, lengths in _length_classes(words):
        segments = _segments(pieces, letters, lengths)
        if probabilities.shape[1] > LANGUAGES_AT_ONCE:
            segments = list(segments)
        for low in range(0, probabilities.shape[1], LANGUAGES_AT_ONCE):
            some = probabilities[:, low : low + LANGUAGES_AT_ONCE]
            forward = np.zeros((len(letters) + 1, len(at), some.shape[1]))
            forward[0] = 1.0
            for begin, end, inside, number in segments:
                forward[end, inside] += forward[begin, inside] * (some[number] * PER_LETTER ** (end - begin))
            whole = np.maximum(forward[lengths, np.arange(len(at))], 1e-300)
            scores[at, low : low + LANGUAGES_AT_ONCE] = np.log(whole) - (lengths * np.log(PER_LETTER))[:, None]
    long = [i for i, word in enumerate(words) if len(word) > LONGEST]
    if long:
        scores[long] = long_scores(pieces, probabilities, [words[i] for i in long])
    return scores


def _part_matrices(pieces: Pieces, windows: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Forward values at all places of parts (columns of ``windows``), for a one at each of the last places before a part.

    The letters before a part are the first ``longest`` rows; axes: place, place of the one, part, language.
    """
    reach = pieces.longest
    values = np.zeros((len(windows) + 1, reach, windows.shape[1], some.shape[1]))
    values[np.arange(1, reach + 1), np.arange(reach)] = 1.0
    for begin, end, inside, number in _segments(pieces, windows, np.full(windows.shape[1], len(windows))):
        if begin and end > reach and len(inside):
            values[end][:, inside] += values[begin][:, inside] * (some[number] * PER_LETTER ** (end - begin))
    return values


def long_scores(pieces: Pieces, probabilities: np.ndarray, words: list[str]) -> np.ndarray:
    """As :func:`word_scores`, for words of any length, part by part."""
    reach = pieces.longest
    scores = np.zeros((len(words), probabilities.shape[1]))
    lengths = [len(word) + 1 for word in words]
    padded = [
        np.concatenate([
            np.zeros(reach, np.uint64), np.frombuffer((MARK + word).encode("utf-32-le"), np.uint32).astype(np.uint64), np.zeros(-n % LONGEST, np.uint64)
        ])
        for word, n in zip(words, lengths)
    ]
    parts = [(w, p) for w, n in enumerate(lengths) for p in range(-(-n // LONGEST))]
    for low in range(0, probabilities.shape[1], LANGUAGES_AT_ONCE):
        some = probabilities[:, low : low + LANGUAGES_AT_ONCE]
        state = logs = None
        for first in range(0, len(parts), PARTS_AT_ONCE):
            batch = parts[first : first + PARTS_AT_ONCE]
            windows = np.stack([padded[w][p * LONGEST : (p + 1) * LONGEST + reach] for w, p in batch], axis=1)
            values = _part_matrices(pieces, windows, some)
            for k, (w, p) in enumerate(batch):
                if p == 0:
                    state, logs = np.zeros((reach, some.shape[1])), np.zeros(some.shape[1])
                    state[-1] = 1.0
                size = min(LONGEST, lengths[w] - p * LONGEST)
                state = np.einsum("oil,il->ol", values[size + 1 : size + reach + 1, :, k], state)
                total = state.sum(axis=0)
                state, logs = state / total, logs + np.log(total)
                if p * LONGEST + size == lengths[w]:
                    scores[w, low : low + LANGUAGES_AT_ONCE] = logs + np.log(state[-1]) - lengths[w] * np.log(PER_LETTER)
    return scores


def expected_counts(pieces: Pieces, probability: np.ndarray, words: list[str], weights: np.ndarray) -> np.ndarray:
    """Expected uses of each piece (rows) for weighted words (``weights``: a column per language)."""
    total = np.zeros((pieces.count + 1, weights.shape[1]))
    for at, letters, lengths in _length_classes(words):
        segments = [(b, e, i, n, probability[n] * PER_LETTER ** (e - b)) for b, e, i, n in _segments(pieces, letters, lengths)]
        forward = np.zeros((len(letters) + 1, len(at)))
        backward = np.zeros_like(forward)
        forward[0] = 1.0
        for begin, end, inside, _, p in segments:
            forward[end, inside] += forward[begin, inside] * p
        backward[lengths, np.arange(len(at))] = 1.0
        for begin, end, inside, _, p in sorted(segments, key=lambda s: -s[0]):
            backward[begin, inside] += p * backward[end, inside]
        whole = np.maximum(backward[0], 1e-300)
        for begin, end, inside, number, p in segments:
            share = forward[begin, inside] * p * backward[end, inside] / whole[inside]
            for language in range(weights.shape[1]):
                total[:, language] += np.bincount(number, share * weights[at[inside], language], pieces.count + 1)
    return total


def _runs(word: str) -> list[str]:
    return _LETTERS.findall(word.lower())


def _stretches(word: str) -> list[str]:
    """Runs of letters in stretches of at most ``LONGEST``; only the first of a run gets a word mark."""
    return [
        (GOES_ON if i else "") + run[i : i + LONGEST] for run in _runs(word) for i in range(0, len(run), LONGEST)
    ]


def _distinct_words(column: pa.Array):
    """Hashes of the distinct words of a slice, where one of each stands, the word numbers, and words before each text."""
    data, offsets = C.text_bytes(column)
    starts, ends, first = C.words(data, offsets)
    hashes, at, inverse = np.unique(C.span_hash(C.prefix_hash(data), starts, ends), return_index=True, return_inverse=True)
    return data, hashes, starts[at], ends[at], inverse.reshape(-1), first


@dataclass
class LanguageModel:
    languages: list[str]
    probabilities: np.ndarray
    path: str


def _sample_counts(sample: DataFrame, pieces: Pieces, languages: list[str], probability: np.ndarray) -> np.ndarray:
    """Expected counts over the sample: partial sums per partition, added up by Spark."""
    place = {language: i for i, language in enumerate(languages)}

    def run(batches):
        # Words of each group of languages, with a number per language of the group.
        counted: dict[int, dict[str, np.ndarray]] = {}

        def flush():
            for group, words in counted.items():
                total = expected_counts(pieces, probability, list(words), np.array(list(words.values())))
                piece, language = np.nonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(piece), pa.array(language + group * LANGUAGES_AT_ONCE), pa.array(total[piece, language])], ["piece", "language", "n"]
                )
            counted.clear()

        for part in C.slices(batches):
            data, hashes, starts, ends, inverse, first = _distinct_words(part.column("text"))
            language = np.array([place[v] for v in part.column("_lang").to_pylist()], np.int64)
            of_word = np.repeat(language, np.diff(first))
            pairs, uses = np.unique(inverse * len(languages) + of_word, return_counts=True)
            last, found = -1, []
            for pair, times in zip(pairs.tolist(), uses.tolist()):
                i, (group, column) = pair // len(languages), divmod(pair % len(languages), LANGUAGES_AT_ONCE)
                if i != last:
                    last, found = i, _stretches(data[starts[i] : ends[i]].tobytes().decode())
                words = counted.setdefault(group, {})
                for piece in found:
                    have = words.get(piece)
                    if have is None:
                        have = words[piece] = np.zeros(min(LANGUAGES_AT_ONCE, len(languages) - group * LANGUAGES_AT_ONCE))
                    have[column] += times
            if sum(map(len, counted.values())) > _CACHED_WORDS:
                yield from flush()
        yield from flush()

    partial = C.map_batches(sample, run, "piece bigint, language bigint, n double")
    # A row per piece and language that has it.
    rows = partial.groupBy("piece", "language").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((pieces.count + 1, len(languages)))
    counts[rows["piece"].to_numpy(), rows["language"].to_numpy()] = rows["n"].to_numpy()
    return counts


def fit_languages(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    language: str = "lang",
    path: str | None = None,
    sample_per_language: int = SAMPLE_PER_LANGUAGE,
    smoothing: float = 2_000.0,
) -> LanguageModel:
    """Learn from the labelled rows that are not held out."""
    path = path or vocabulary_path()
    labelled = docs.filter(~C.held_out(key) & F.col(language).isNotNull() & F.col(text).isNotNull())
    labelled = labelled.select(F.col(text).alias("text"), F.col(language).alias("_lang"), F.col(key).alias("_key"))
    sizes = labelled.groupBy("_lang").count().collect()
    sizes = {row["_lang"]: row["count"] for row in sizes}
    languages = sorted(sizes)
    pieces = load_pieces(path)
    if not languages:
        return LanguageModel([], np.zeros((pieces.count + 1, 0)), path)
    # A hash of the key below its language's share: the sample doesn't depend on partitioning.
    shares = docs.sparkSession.createDataFrame([(k, min(1.0, sample_per_language / sizes[k])) for k in languages], "_lang string, _share double")
    draw = F.pmod(F.xxhash64("_key", F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
    sample = labelled.join(F.broadcast(shares), "_lang").filter(draw < F.col("_share")).select("text", "_lang")
    probability = np.full(pieces.count + 1, 1.0 / pieces.count)
    probability[-1] = UNKNOWN
    everything = _sample_counts(sample, pieces, languages, probability).sum(axis=1)
    shared = (everything[:-1] + 0.01) / (everything[:-1] + 0.01).sum()
    counts = _sample_counts(sample, pieces, languages, np.append(shared, UNKNOWN))[:-1]
    learned = (counts + smoothing * shared[:, None]) / (counts.sum(axis=0) + smoothing)
    return LanguageModel(languages, np.vstack([learned, np.full((1, len(languages)), UNKNOWN)]), path)


class _Scorer:
    """Word scores of a task, kept by word hash."""

    def __init__(self, model: LanguageModel):
        self.model, self.pieces = model, load_pieces(model.path)
        self.clear()

    def clear(self) -> None:
        self.hashes, self.values = np.zeros(0, np.uint64), np.zeros((0, len(self.model.languages) + 1))

    def texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Log probabilities of the texts (rows) under the languages, and their numbers of letter runs."""
        data, hashes, starts, ends, inverse, first = _distinct_words(column)
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(len(self.hashes) - 1, 0))
        known = self.hashes[at] == hashes if len(self.hashes) else np.zeros(len(hashes), bool)
        new = np.flatnonzero(~known)
        runs = [_runs(data[starts[i] : ends[i]].tobytes().decode()) for i in new]
        sizes = np.fromiter(map(len, runs), np.int64, len(runs))
        flat = [run for found in runs for run in found]
        distinct = {run: i for i, run in enumerate(dict.fromkeys(flat))}
        scored = word_scores(self.pieces, self.model.probabilities, list(distinct))
        scored = scored[np.fromiter((distinct[run] for run in flat), np.int64, len(flat))]
        fresh = np.column_stack([C.segment_sums(scored, np.concatenate([[0], np.cumsum(sizes)])), sizes])
        values = np.zeros((len(hashes), fresh.shape[1]))
        values[new] = fresh
        values[known] = self.values[at[known]]
        if (len(self.hashes) + len(new)) * max(1.0, len(self.model.languages) / LANGUAGES_AT_ONCE) > _CACHED_WORDS:
            self.clear()
        order = np.argsort(np.concatenate([self.hashes, hashes[new]]), kind="stable")
        self.hashes = np.concatenate([self.hashes, hashes[new]])[order]
        self.values = np.concatenate([self.values, fresh])[order]
        columns = range(0, values.shape[1], LANGUAGES_AT_ONCE)
        sums = np.concatenate([C.segment_sums(values[:, k : k + LANGUAGES_AT_ONCE][inverse], first) for k in columns], axis=1)
        return sums[:, :-1], np.rint(sums[:, -1]).astype(np.int64)


def identify(docs: DataFrame, model: LanguageModel, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep``, ``lang_pred``, ``score`` (posterior under equal priors) and ``n_runs`` (letter runs)."""
    names = np.array([*model.languages, "und"], object)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # vocabulary times languages
    scorer: list[_Scorer] = []

    def compute(part: pa.RecordBatch):
        if not scorer:
            scorer.append(_Scorer(shared.value))
        likelihood, runs = scorer[0].texts(part.column(text))
        none = (runs == 0) | (likelihood.shape[1] == 0)
        if not likelihood.shape[1]:
            return [["und"] * len(none), np.zeros(len(none)), runs]
        best = np.where(none, len(names) - 1, likelihood.argmax(axis=1))
        relative = np.exp(likelihood - likelihood.max(axis=1, keepdims=True))
        score = np.where(none, 0.0, 1.0 / relative.sum(axis=1))
        return [names[best].tolist(), score, runs]

    fields = [StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("n_runs", LongType())]
    used = C.picked(docs, [*keep, text])
    return C.add_columns(used, compute, fields, keep, text)
