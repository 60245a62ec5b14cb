"""Secret scan: base patterns, and spans found by a linear-chain conditional random field.

A text's tokens are tagged B (a secret begins), I (it goes on) or O, from the token's shape, its
neighbours' words and characters, and features of the whole text. The field is trained on windows of
a bounded sample of texts: some around what the base patterns find, some around other long tokens, and some with an
invented secret put between the words of a text (random letters and digits, bare, encoded, in parts, behind a prefix, as the
password of an address), so that it learns forms that no pattern has. In half of the windows the words
around are hidden, so that shapes have to tell as well. Tags are decoded by Viterbi over whole texts.

Decoding cuts chains where it may: if O leads by more than twice the range of the transition
weights, no best path has another tag there, whatever stands next to it. What remains between
such tokens is decoded exactly, many pieces at a time.

Spans are in code points, end exclusive, of whole matches. Base spans are cut out of a span of the field, and each part
that is left counts if it holds a token of at least ``LEAST_TOKEN`` characters with a letter and a digit, or the rest of
a token that a base span covers in part (but for what stands in front of an assignment's keyword, which is its name).

A null text counts as empty and has no spans. Rows are scanned on their own: repeated rows get equal
results and an empty table an empty result. Without any base match there is nothing to learn and
the field finds nothing. Columns that are not asked for are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from sievework.llm import columns as C

# Fixed patterns of the base scan, and the least length of what they must find.
ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
LEAST = {"assign": 12, "access": 18, "hex": 16}
KINDS = ("assign", "access", "hex", "crf")

# Texts that windows come from, about, and windows that the field is trained on, at most.
SAMPLE_TEXTS = 20_000
MAX_WINDOWS = 7_200
REACH = 12
LEAST_TOKEN = 12
WORD_BUCKETS = 1024

_CLASS = np.full(256, 5, np.uint8)  # digit, lower, upper, joiner, non-ASCII, other
_CLASS[48:58], _CLASS[97:123], _CLASS[65:91] = 0, 1, 2
_CLASS[[ord(c) for c in "+/_-."]] = 3
_CLASS[128:] = 4
_HEX = np.isin(np.arange(256), [ord(c) for c in "0123456789abcdef"])
_SIDE = np.full(257, 6, np.int64)
for _code, _chars in enumerate((" ", "\n\r\t", "\"'", "=", ":", ",;()[]{}<>")):
    _SIDE[[ord(c) for c in _chars]] = _code
_SIDE[256] = 1
_LENGTHS = np.array([4, 8, 12, 16, 20, 32, 48])
# Values of each feature: shape, changes of class, characters beside, words before (two) and after, the whole text.
SIZES = (8 * 64, 8 * 8, 49, WORD_BUCKETS + 1, WORD_BUCKETS + 1, WORD_BUCKETS + 1, 32)
HIDDEN = (3, 4, 5)


def base_spans(data: np.ndarray, offsets: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """Per text: (start byte in the text, kind number, end byte), ordered by start and kind."""
    n = len(offsets) - 1
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(n)]
    whole = data.tobytes()
    lower = C.LOWER[data].tobytes()

    def texts_with(needle: bytes, buffer: bytes) -> set[int]:
        texts, at = set(), buffer.find(needle)
        while at >= 0:
            text = int(np.searchsorted(offsets, at, "right")) - 1
            texts.add(text)
            at = buffer.find(needle, int(offsets[text + 1]))
        return texts

    for i in set().union(*(texts_with(word, lower) for word in KEYWORDS)):
        for m in ASSIGN.finditer(whole[offsets[i] : offsets[i + 1]]):
            if len(m.group(2)) >= LEAST["assign"]:
                found[i].append((m.start(), 0, m.end()))
    for i in texts_with(b"AKIA", whole):
        for m in ACCESS.finditer(whole[offsets[i] : offsets[i + 1]]):
            if m.end() - m.start() >= LEAST["access"]:
                found[i].append((m.start(), 1, m.end()))
    starts, ends, _ = C.runs(_HEX[data], offsets)
    long = ends - starts >= LEAST["hex"]
    for start, end in zip(starts[long].tolist(), ends[long].tolist()):
        i = int(np.searchsorted(offsets, start, "right")) - 1
        found[i].append((start - int(offsets[i]), 2, end - int(offsets[i])))
    for spans in found:
        spans.sort()
    return found


@dataclass
class Tokens:
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    features: np.ndarray  # a row per token, a column per feature
    strong: np.ndarray  # long, with a letter and a digit


def tokenize(data: np.ndarray, offsets: np.ndarray) -> Tokens:
    """Tokens (runs of letters, digits, joiners and non-ASCII) and their features."""
    kind = _CLASS[data]
    starts, ends, first = C.runs(kind < 5, offsets)
    n, n_docs = len(starts), len(offsets) - 1
    length = ends - starts
    bounds = np.stack([starts, ends])

    def total(values: np.ndarray) -> np.ndarray:
        running = np.concatenate([[0], np.cumsum(values, dtype=np.int32)])
        return running[bounds[1]] - running[bounds[0]]

    has = [total(kind == k) for k in range(5)]
    hexes = total(_HEX[data])
    changes = total(np.append(kind[1:] != kind[:-1], False)) if len(kind) else total(kind)
    size = np.searchsorted(_LENGTHS, length, "right")
    flags = sum((h > 0).astype(np.int64) << k for k, h in enumerate(has)) + ((hexes == length).astype(np.int64) << 5)
    beside = np.concatenate([[256], data.astype(np.int64), [256]])
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    left = np.where(edge[starts], 256, beside[starts])
    right = np.where(edge[ends], 256, beside[ends + 1])
    words = C.span_hash(C.prefix_hash(C.LOWER[data]), starts, ends)
    bucket = (words >> np.uint64(54)).astype(np.int64) + 1
    doc = np.repeat(np.arange(n_docs), np.diff(first))

    def shifted(by: int) -> np.ndarray:
        """The word ``by`` tokens on in the same text; 0 if there is none."""
        at = np.arange(n) + by
        inside = (at >= 0) & (at < n)
        at = np.clip(at, 0, max(n - 1, 0))
        return np.where(inside & (doc[at] == doc), bucket[at], 0) if n else bucket

    n_bytes = np.maximum(np.diff(offsets), 1)
    digits = C.segment_sums((kind == 0).astype(np.int32), offsets) / n_bytes
    others = C.segment_sums(((kind == 5) & ~C.SPACE[data]).astype(np.int32), offsets) / n_bytes
    file = np.searchsorted([0.01, 0.05, 0.15], digits) * 4 + np.searchsorted([0.02, 0.06, 0.15], others)
    features = np.stack(
        [
            size * 64 + flags,
            size * 8 + np.searchsorted([1, 2, 3, 5, 8, 12, 16], changes, "right"),
            _SIDE[left] * 7 + _SIDE[right],
            shifted(-1),
            shifted(-2),
            shifted(1),
            file[doc] * 2 + (length >= LEAST_TOKEN),
        ],
        axis=1,
    )
    strong = (length >= LEAST_TOKEN) & (has[0] > 0) & (has[1] + has[2] > 0)
    return Tokens(starts, ends, first, features, strong)


@dataclass
class Field:
    """Weights: emissions (feature value x tag), transitions (tag x tag), begin (tag). Tags: O, B, I."""

    emissions: list[np.ndarray]
    transitions: np.ndarray
    begin: np.ndarray

    def emit(self, features: np.ndarray) -> np.ndarray:
        return sum(w[features[:, k]] for k, w in enumerate(self.emissions))

    def certain(self) -> float:
        """A lead of O that no neighbours can make up for."""
        everything = np.concatenate([self.transitions, self.begin[None]])
        return 2 * float(everything.max() - everything.min())


def viterbi(scores: np.ndarray, lengths: np.ndarray, begin: np.ndarray, end: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Best tags of padded sequences: ``scores`` is time x sequence x tag; sequences are sorted by length, longest first."""
    steps, n, _ = scores.shape
    tags = np.zeros((steps, n), np.int64)
    if not n:
        return tags
    back = np.zeros((steps, n, 3), np.int8)
    best = begin + scores[0]
    active = np.searchsorted(-lengths, -np.arange(steps), "left")  # sequences longer than t
    for t in range(1, steps):
        m = active[t]
        ways = best[:m, :, None] + transitions[None]
        back[t, :m] = ways.argmax(axis=1)
        best[:m] = ways.max(axis=1) + scores[t, :m]
    tag = (best + end).argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        m = active[t]
        tags[t, :m] = tag[:m]
        tag[:m] = back[t, np.arange(m), tag[:m]]
    return tags


def decode(field: Field, features: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Best tags of all tokens; ``first`` has the number of tokens before each text."""
    n = len(features)
    tags = np.zeros(n, np.int64)
    if not n:
        return tags
    scores = field.emit(features)
    open_ = scores[:, 0] - scores[:, 1:].max(axis=1) <= field.certain()
    at_start = np.zeros(n + 1, bool)
    at_start[first] = True
    before = np.concatenate([[False], open_[:-1]])
    starts = np.flatnonzero(open_ & (~before | at_start[:-1]))
    after = np.append(open_[1:], False)
    ends = np.flatnonzero(open_ & (~after | at_start[1:])) + 1
    lengths = ends - starts
    order = np.argsort(-lengths, kind="stable")
    begin_o, end_o = field.transitions[0], field.transitions[:, 0]
    low = 0
    while low < len(order):
        # Groups of similar length, so that padding stays within a factor of two.
        high = low + int(np.searchsorted(-lengths[order[low:]], -(lengths[order[low]] // 2), "left"))
        group = order[low : max(high, low + 1)]
        low += len(group)
        steps = int(lengths[group[0]])
        inside = np.arange(steps)[:, None] < lengths[group]
        at = np.where(inside, starts[group] + np.arange(steps)[:, None], 0)
        begin = np.where(at_start[starts[group], None], field.begin, begin_o)
        end = np.where(at_start[ends[group], None], 0.0, end_o)
        found = viterbi(scores[at], lengths[group], begin, end, field.transitions)
        tags[at[inside]] = found[inside]
    return tags


def train_field(windows: list[np.ndarray], tags: list[np.ndarray], steps: int = 120, ridge: float = 1e-3) -> Field:
    """Maximum likelihood with a ridge, by full-batch steps of adaptive size; gradients by forward and backward."""
    field = Field([np.zeros((size, 3)) for size in SIZES], np.zeros((3, 3)), np.zeros(3))
    n = len(windows)
    if not n:
        return field
    lengths = np.array([len(w) for w in windows])
    width = int(lengths.max())
    inside = np.arange(width)[:, None] < lengths
    features = np.zeros((width, n, len(SIZES)), np.int64)
    truth = np.zeros((width, n), np.int64)
    for i, (window, tag) in enumerate(zip(windows, tags)):
        features[: len(window), i], truth[: len(tag), i] = window, tag
    flat, flat_truth = features[inside], truth[inside]
    pairs = inside[1:]
    weights = [*field.emissions, field.transitions, field.begin]
    squares = [np.full(w.shape, 1e-6) for w in weights]
    for _ in range(steps):
        emitted = np.zeros((width, n, 3))
        emitted[inside] = field.emit(flat)
        forward = np.zeros((width, n, 3))
        forward[0] = field.begin + emitted[0]
        for t in range(1, width):
            ways = forward[t - 1][:, :, None] + field.transitions
            forward[t] = np.where(inside[t, :, None], np.logaddexp.reduce(ways, axis=1) + emitted[t], forward[t - 1])
        whole = np.logaddexp.reduce(forward[-1], axis=1)
        backward = np.zeros((width, n, 3))
        expected_pairs = np.zeros((3, 3))
        for t in range(width - 2, -1, -1):
            onward = (emitted[t + 1] + backward[t + 1])[:, None, :] + field.transitions
            backward[t] = np.where(inside[t + 1, :, None], np.logaddexp.reduce(onward, axis=2), 0.0)
            joint = np.exp(forward[t][:, :, None] + onward - whole[:, None, None])
            expected_pairs += joint[inside[t + 1]].sum(axis=0)
        marginal = np.exp(forward + backward - whole[:, None])
        gap = marginal[inside]
        gap[np.arange(len(gap)), flat_truth] -= 1
        gradients = [
            np.stack([np.bincount(flat[:, k], gap[:, y], size) for y in range(3)], axis=1) for k, size in enumerate(SIZES)
        ]
        seen = np.bincount(truth[:-1][pairs] * 3 + truth[1:][pairs], minlength=9).reshape(3, 3)
        start = marginal[0].sum(axis=0) - np.bincount(truth[0], minlength=3)
        for w, s, g in zip(weights, squares, [*gradients, expected_pairs - seen, start]):
            g = g / n + ridge * w
            s += g * g
            w -= 0.3 * g / np.sqrt(s)
    return field


_LOWER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
_MIXED = _LOWER + _LOWER.upper() + _DIGITS


def invent(rng: np.random.Generator) -> tuple[str, str, str]:
    """A secret of some form, and what stands right before and after it."""

    def some(alphabet: str, low: int, high: int) -> str:
        return "".join(alphabet[i] for i in rng.integers(0, len(alphabet), rng.integers(low, high + 1)))

    def mixed(low: int, high: int, alphabet: str = _MIXED) -> str:
        # A letter and a digit are always there.
        return some(alphabet, low - 2, high - 2) + some(_LOWER, 1, 1) + some(_DIGITS, 1, 1)

    before, after = [(" ", " "), (" ", "."), ('"', '"'), ("'", "'"), ("=", " "), (": ", ","), (" (", ")"), ("\n", "\n")][rng.integers(0, 8)]
    form = rng.integers(0, 8)
    if form == 0:
        return mixed(16, 48), before, after
    if form == 1:
        return mixed(20, 64, _MIXED + "+/"), before, "=" * int(rng.integers(0, 3)) + after
    if form == 2:
        parts = [some(_LOWER, 2, 5) for _ in range(rng.integers(1, 3))]
        joint = "_-"[rng.integers(0, 2)]
        return joint.join([*parts, mixed(14, 40)]), before, after
    if form == 3:
        return mixed(13, 32), f" {some(_LOWER, 4, 8)}://{some(_LOWER, 3, 8)}:", f"@{some(_LOWER, 3, 8)}.{some(_LOWER, 2, 5)} "
    if form == 4:
        return ".".join(mixed(16, 40, _MIXED + "_-") for _ in range(3)), before, after
    if form == 5:
        return mixed(20, 40, _LOWER[:6] + _DIGITS).upper(), before, after
    return mixed(16, 40, _LOWER + _DIGITS).upper(), before, after


def _invented(data: np.ndarray, tokens: Tokens, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and tags of a window of a text (tokens ``low`` up to ``high``) with an invented secret in its middle."""
    rng = np.random.default_rng(zlib.crc32(data[tokens.starts[low] : tokens.ends[high - 1]].tobytes()))
    at = int(rng.integers(low, high))
    begin, end = max(low, at - REACH), min(high, at + REACH)
    secret, before, after = invent(rng)
    head = data[tokens.starts[begin] : tokens.ends[at]].tobytes() + before.encode()
    tail = after.encode() + (data[tokens.starts[at + 1] : tokens.ends[end - 1]].tobytes() if at + 1 < end else b"")
    whole = np.frombuffer(head + secret.encode() + tail, np.uint8)
    made = tokenize(whole, np.array([0, len(whole)]))
    tags = np.zeros(len(made.starts), np.int64)
    inside = np.flatnonzero((made.ends > len(head)) & (made.starts < len(head) + len(secret)))
    tags[inside], tags[inside[:1]] = 2, 1
    middle = int(inside[0])
    window = slice(max(0, middle - REACH), middle + REACH + 1)
    # What the text is like is known from the whole of it.
    made.features[:, 6] = tokens.features[low, 6] // 2 * 2 + made.features[:, 6] % 2
    return made.features[window], tags[window]


def _training_windows(docs: DataFrame, text: str, sample_texts: int, max_windows: int):
    """Windows around base spans, around the most secret-like other tokens of sampled texts, and with invented secrets."""
    n = max(1, docs.count())
    draw = F.pmod(F.xxhash64(text), F.lit(1 << 30)) / float(1 << 30)
    sample = docs.filter(draw < min(1.0, sample_texts / n)).select(F.col(text).alias("text"))

    def run(batches):
        for part in C.slices(batches):
            data, offsets = C.text_bytes(part.column("text"))
            tokens, spans = tokenize(data, offsets), base_spans(data, offsets)
            tags = np.zeros(len(tokens.starts), np.int64)
            centres, positive = [], []
            for i, found in enumerate(spans):
                low, high = tokens.first[i], tokens.first[i + 1]
                reached = -1
                for start, _, end in found:
                    a = low + np.searchsorted(tokens.ends[low:high], offsets[i] + start, "right")
                    b = low + np.searchsorted(tokens.starts[low:high], offsets[i] + end, "left")
                    if start >= reached:
                        tags[a:b] = 2
                        tags[a : a + 1] = 1
                        centres.append(int(a))
                        positive.append(True)
                    else:
                        tags[a:b] = np.maximum(tags[a:b], 2) - (tags[a:b] == 1)
                    reached = max(reached, end)
                if high > low:
                    # The longest token and one at random place, as examples of what is none.
                    others = np.flatnonzero(tags[low:high] == 0)
                    if len(others):
                        long = others[np.argmax((tokens.ends - tokens.starts)[low:high][others])]
                        for k in {int(long), int(others[(int(offsets[i + 1]) * 7919) % len(others)])}:
                            centres.append(int(low + k))
                            positive.append(False)
            doc = np.searchsorted(tokens.first, np.arange(len(tags)), "right") - 1
            rows = []
            for centre, good in zip(centres, positive):
                low = max(int(tokens.first[doc[centre]]), centre - REACH)
                high = min(int(tokens.first[doc[centre] + 1]), centre + REACH + 1)
                window = tokens.features[low:high]
                rows.append((int(good), window.reshape(-1).tolist(), tags[low:high].tolist()))
            for low, high in zip(tokens.first[:-1], tokens.first[1:]):
                if high > low:
                    window, tag = _invented(data, tokens, int(low), int(high))
                    rows.append((2, window.reshape(-1).tolist(), tag.tolist()))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.list_(pa.int32())), pa.array([r[2] for r in rows], pa.list_(pa.int32()))],
                    ["kind", "window", "tags"],
                )

    found = C.map_batches(sample, run, "kind int, window array<int>, tags array<int>")
    # Copies of a text bring the same windows; each counts once.
    found = found.distinct()
    order = F.xxhash64("window", "tags")
    parts = [found.filter(F.col("kind") == kind).orderBy(order, "window", "tags").limit((max_windows + 2 - kind) // 3) for kind in range(3)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("kind", "window", "tags").toArrow()


def fit_field(docs: DataFrame, text: str = "text", sample_texts: int = SAMPLE_TEXTS, max_windows: int = MAX_WINDOWS) -> Field:
    rows = _training_windows(docs, text, sample_texts, max_windows)
    tags = [np.array(t, np.int64) for t in rows["tags"].to_pylist()]
    windows = [np.array(w, np.int64).reshape(len(t), len(SIZES)) for w, t in zip(rows["window"].to_pylist(), tags)]
    if not any(t.any() and kind == 1 for t, kind in zip(tags, rows["kind"].to_pylist())):
        return train_field([], [])
    for i in range(0, len(windows), 2):
        windows[i][:, HIDDEN] = 0
    return train_field(windows, tags)


def _parts(tokens: Tokens, low: int, high: int, base: list[tuple[int, int, int]], data: np.ndarray, offset: int) -> list[tuple[int, int]]:
    """What base spans leave of a run of tokens, without parts that hold no secret; base spans are ordered by start."""
    at, end = int(tokens.starts[low]) - offset, int(tokens.ends[high - 1]) - offset
    gaps, assigned = [], {s for s, k, _ in base if k == 0}
    for s, _, e in base:
        if s < end and e > at:
            gaps.append((at, s))
            at = max(at, e)
    gaps.append((at, end))
    found = []
    for begin, stop in gaps:
        pieces, secret = [], False
        for k in range(low, high):
            first, last = int(tokens.starts[k]) - offset, int(tokens.ends[k]) - offset
            a, b = max(first, begin), min(last, stop)
            if a >= b:
                continue
            pieces += [a, b]
            if (a, b) == (first, last):
                secret |= bool(tokens.strong[k])
            elif b < last and b in assigned and a == first:
                kind = _CLASS[data[offset + a : offset + b]]
                secret |= b - a >= LEAST_TOKEN and bool((kind == 0).any() and ((kind == 1) | (kind == 2)).any())
            else:
                secret = True
        if secret:
            found.append((pieces[0], pieces[-1]))
    return found


def find_spans(data: np.ndarray, offsets: np.ndarray, field: Field) -> list[list[tuple[int, int, int]]]:
    """Per text: base spans and added ones, as (start byte, kind number, end byte)."""
    found = base_spans(data, offsets)
    tokens = tokenize(data, offsets)
    tags = decode(field, tokens.features, tokens.first)
    begins = np.zeros(len(tags) + 1, bool)
    begins[tokens.first] = True
    marked = np.flatnonzero(tags)
    if not len(marked):
        return found
    fresh = (tags[marked] == 1) | begins[marked] | np.concatenate([[True], np.diff(marked) > 1])
    bounds = np.append(np.flatnonzero(fresh), len(marked))
    touched = set()
    base = [list(spans) for spans in found]
    for a, b in zip(bounds[:-1], bounds[1:]):
        low, high = int(marked[a]), int(marked[b - 1]) + 1
        i = int(np.searchsorted(offsets, tokens.starts[low], "right")) - 1
        for start, end in _parts(tokens, low, high, base[i], data, int(offsets[i])):
            found[i].append((start, 3, end))
            touched.add(i)
    for i in touched:
        found[i].sort()
    return found


def _listed(spans, position: np.ndarray, offset: int) -> str:
    return ",".join(f"{KINDS[k]}:{position[offset + s] - position[offset]}:{position[offset + e] - position[offset]}" for s, k, e in spans)


def _positions(data: np.ndarray) -> np.ndarray:
    """Code points before each byte."""
    return np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])


def scan(docs: DataFrame, field: Field, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep``, n_assign, n_access, n_hex, base_sha256, spans, n_crf."""
    shared = docs.sparkSession.sparkContext.broadcast(field)  # SIZES bound it

    def compute(part: pa.RecordBatch):
        data, offsets = C.text_bytes(part.column(text))
        position = _positions(data)
        found = find_spans(data, offsets, shared.value)
        counts = np.zeros((4, part.num_rows), np.int64)
        digests, listed = [], []
        for i, spans in enumerate(found):
            for _, kind, _ in spans:
                counts[kind, i] += 1
            base = _listed([s for s in spans if s[1] < 3], position, int(offsets[i]))
            digests.append(hashlib.sha256(base.encode()).hexdigest())
            listed.append(_listed(spans, position, int(offsets[i])))
        return [*counts[:3], digests, listed, counts[3]]

    fields = [StructField(name, LongType()) for name in ("n_assign", "n_access", "n_hex")]
    fields += [StructField("base_sha256", StringType()), StructField("spans", StringType()), StructField("n_crf", LongType())]
    return C.add_columns(C.picked(docs, [*keep, text]), compute, fields, keep, text)


def redact(docs: DataFrame, field: Field, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span (overlapping ones as one) replaced by ``mark``; null texts stay null."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    # Numbers for names, as Spark's Arrow functions take no name with a dot.
    numbered = docs.toDF(*(f"_c{i}" for i in range(len(docs.columns))))
    text = f"_c{docs.columns.index(text)}"

    def run(batches):
        for part in C.slices(batches, text):
            data, offsets = C.text_bytes(part.column(text))
            found = find_spans(data, offsets, shared.value)
            if any(found):
                texts = part.column(text).to_pylist()
                for i, spans in enumerate(found):
                    if spans:
                        whole = data[offsets[i] : offsets[i + 1]].tobytes()
                        out, at = [], 0
                        for start, _, end in spans:
                            if start >= at:
                                out += [whole[at:start], mark.encode()]
                            at = max(at, end)
                        texts[i] = b"".join([*out, whole[at:]]).decode()
                column = part.schema.get_field_index(text)
                part = part.set_column(column, text, pa.array(texts, part.schema.field(text).type))
            yield part

    return C.map_batches(numbered, run, numbered.schema).toDF(*docs.columns)
