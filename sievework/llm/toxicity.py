"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

* Voters are lexicons (a short fixed one, and groups of words and word beginnings of 3 to 8 bytes that labelled rows
  show to go with the label) and patterns of writing. A text's votes are a bit mask of ``VOTERS`` bits.
* The label model is a latent class model with dependent voters. EM estimates how often each voter
  fires in each class (its accuracy); from the posteriors follow the correlations of voters within a class,
  the strongest of which are kept as a tree per class (Chow-Liu), and EM goes on with the tree. It
  reads the votes of all rows that may be learned from, as counts of masks: at most 2**VOTERS rows.
* The linear classifier is a logistic regression on hashed words and votes, fitted to the posteriors of at most
  ``max_labelled`` rows. Labels reach it through lexicons and label model only.

Lexicon words are counted in all labelled rows that are not held out, and votes in all rows that are not.

A null text counts as empty. A text without words scores what its votes and the intercept say. Rows
are scored on their own: repeated rows get equal scores and an empty table gives an empty result.
Without labels of both classes, the learned lexicons are empty and the prior stands in for the class
balance. Labels of held-out rows, and rows without key or label, are not learned from; a key with
several labels counts as toxic if any of them says so. Columns other than key and text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField

from sievework.llm import columns as C
from sievework.session import stored

VOTERS = 16
LEARNED_GROUPS = 8
# Labelled rows that the classifier is fitted on, at most.
MAX_LABELLED = 20_000
# Words of the learned lexicons, at most: those of largest z.
LEXICON_WORDS = 512
FEATURE_BITS = 18
PRIOR = 0.1
STEM_BYTES = 6
# Lengths in bytes of the word beginnings that lexicons know; a stem of any of them stands for words no labelled row has.
BEGINNINGS = range(3, 9)
# Toxic texts with a beginning, for each other text with it, at least.
PURITY = 9
VOTE_SCALE = 10.0

# Fixed lexicons: insults, and words that address the reader.
INSULTS = (
    "idiot", "idiots", "stupid", "moron", "morons", "dumb", "fool", "loser", "losers", "trash", "scum", "clown",
    "pathetic", "worthless", "disgusting", "garbage", "idiota", "imbécile", "dummkopf", "estúpido",
)
ADDRESS = ("you", "your", "youre", "du", "dein", "tu", "ton", "vous", "tú", "usted")

_TERM = np.zeros(256, bool)
_TERM[97:123] = True
_TERM[128:] = True
_IS = {name: np.isin(np.arange(256), [ord(c) for c in chars]).astype(np.int64) for name, chars in {
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "bang": "!", "question": "?", "star": "*", "digit": "0123456789", "mark": "#$%&@"}.items()}


def hash_words(words) -> np.ndarray:
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w.encode()) for w in words])
    return C.span_hash(C.prefix_hash(data), np.concatenate([[0], ends[:-1]]).astype(np.int64), ends.astype(np.int64))


def terms(column: pa.Array):
    """Distinct words and word beginnings of each text, in lower case (ASCII): text number, hash, start, end; and the bytes.

    Beginnings (of longer words) stand for the words that are made from the same stem.
    """
    raw, offsets = C.text_bytes(column)
    data = C.LOWER[raw]
    starts, ends, first = C.runs(_TERM[data], offsets)
    doc = np.repeat(np.arange(len(column)), np.diff(first))
    running = C.prefix_hash(data)
    hashes = C.span_hash(running, starts, ends)
    long = np.flatnonzero(ends - starts > STEM_BYTES)
    stems = C.mix(C.span_hash(running, starts[long], starts[long] + STEM_BYTES) + np.uint64(1))
    doc, hashes = np.concatenate([doc, doc[long]]), np.concatenate([hashes, stems])
    starts, ends = np.concatenate([starts, starts[long]]), np.concatenate([ends, starts[long] + STEM_BYTES])
    _, at = np.unique(C.mix(hashes ^ C.mix(doc.astype(np.uint64) + np.uint64(7))), return_index=True)
    at.sort()
    return doc[at], hashes[at], starts[at], ends[at], raw, data, offsets


def beginnings(found):
    """Distinct beginnings of the words of each text, of all lengths in ``BEGINNINGS``: text number, hash, start, end.

    ``found`` is what :func:`terms` gives. Words sorted by their first eight bytes are sorted by every shorter beginning as well.
    """
    doc, _, starts, ends, _, data, _ = found
    size = np.minimum(ends - starts, BEGINNINGS[-1])
    head = np.zeros(len(doc), np.uint64)
    for i in range(BEGINNINGS[-1]):
        here = np.flatnonzero(size > i)
        head[here] |= data[starts[here] + i].astype(np.uint64) << np.uint64(8 * (7 - i))
    order = np.lexsort((head, doc))
    doc, head, starts, size = doc[order], head[order], starts[order], size[order]
    parts = []
    for length in BEGINNINGS:
        at = np.flatnonzero(size >= length)
        cut, of = head[at] >> np.uint64(8 * (8 - length)), doc[at]
        new = np.flatnonzero(np.concatenate([[True], (cut[1:] != cut[:-1]) | (of[1:] != of[:-1])])[: len(at)])
        # Words hash differently, also those that are as long.
        parts.append((of[new], C.mix(C.mix(cut[new]) + np.uint64(length)), starts[at[new]], starts[at[new]] + length))
    return tuple(np.concatenate(column) for column in zip(*parts))


class Lexicons:
    """Words of the lexicon voters: sorted hashes and the voter of each."""

    def __init__(self, learned: dict[int, int]):
        entries = {int(h): LEARNED_GROUPS for h in hash_words(INSULTS)} | {int(h): LEARNED_GROUPS + 1 for h in hash_words(ADDRESS)}
        self.fixed = {h: voter for h, voter in entries.items()}
        pairs = sorted([*self.fixed.items(), *learned.items()])
        self.hashes = np.array([h for h, _ in pairs], np.uint64)
        self.voters = np.array([v for _, v in pairs], np.int64)


def votes(found, n: int, lexicons: Lexicons) -> np.ndarray:
    """Bit masks of the votes of ``n`` texts."""
    doc, hashes, _, _, raw, _, offsets = found
    started = beginnings(found)
    doc, hashes = np.concatenate([doc, started[0]]), np.concatenate([hashes, started[1]])
    masks = np.zeros(n, np.int64)
    left = np.searchsorted(lexicons.hashes, hashes, "left")
    right = np.searchsorted(lexicons.hashes, hashes, "right")
    hit = np.flatnonzero(right > left)
    sizes = (right - left)[hit]
    entries = C.ragged(left[hit], sizes)
    np.bitwise_or.at(masks, np.repeat(doc[hit], sizes), np.int64(1) << lexicons.voters[entries])
    length = np.maximum(np.diff(offsets), 1)
    share = {name: C.segment_sums(table[raw], offsets) for name, table in _IS.items()}
    patterns = (
        share["upper"] / length > 0.3,
        share["bang"] / length > 0.005,
        share["question"] / length > 0.005,
        share["star"] / length > 0.005,
        share["digit"] / length > 0.05,
        share["mark"] / length > 0.05,
    )
    for k, fires in enumerate(patterns, LEARNED_GROUPS + 2):
        masks |= fires.astype(np.int64) << k
    return masks


@dataclass
class LabelModel:
    """P(toxic) and, per class, each voter's parent in the class's tree and P(vote | parent's vote)."""

    prior: float
    parents: np.ndarray
    rates: np.ndarray

    def posterior(self, masks: np.ndarray) -> np.ndarray:
        bits = (masks[:, None] >> np.arange(VOTERS)) & 1
        log = np.log([[1 - self.prior], [self.prior]]) @ np.ones((1, len(masks)))
        for y in (0, 1):
            for j in range(VOTERS):
                parent = self.parents[y, j]
                given = bits[:, parent] if parent >= 0 else 0
                p = self.rates[y, j, given]
                log[y] += np.log(np.where(bits[:, j] == 1, p, 1 - p))
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))


def _tree(bits: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Parents in the maximum spanning tree of mutual information (Chow-Liu); -1 for the root and for independent voters."""
    total = max(weight.sum(), 1e-9)
    p1 = np.clip((weight @ bits) / total, 1e-6, 1 - 1e-6)
    both = (bits * weight[:, None]).T @ bits / total
    information = np.zeros((VOTERS, VOTERS))
    for a in (0, 1):
        for b in (0, 1):
            pa_, pb = (p1 if a else 1 - p1)[:, None], (p1 if b else 1 - p1)[None]
            joint = both if a and b else (p1[:, None] - both if a else (p1[None] - both if b else 1 - p1[:, None] - p1[None] + both))
            joint = np.clip(joint, 1e-12, 1)
            information += joint * np.log(joint / (pa_ * pb))
    parents, inside = np.full(VOTERS, -1), [0]
    while len(inside) < VOTERS:
        outside = [j for j in range(VOTERS) if j not in inside]
        block = information[np.ix_(inside, outside)]
        i, j = np.unravel_index(block.argmax(), block.shape)
        parents[outside[j]] = inside[i] if block[i, j] > 1e-4 else -1
        inside.append(outside[j])
    return parents


def fit_label_model(masks: np.ndarray, counts: np.ndarray, known: np.ndarray, prior: float = PRIOR, steps: int = 60) -> LabelModel:
    """EM over counted masks; ``known`` is the label (0, 1) or -1, and a known label is not re-estimated.

    Half of the steps treat voters as independent in a class, then trees of correlated voters are set.
    """
    bits = ((masks[:, None] >> np.arange(VOTERS)) & 1).astype(float)
    have = counts[known >= 0].sum()
    if have:
        prior = float(np.clip(counts[known == 1].sum() / have, 0.01, 0.5))
    parents = np.full((2, VOTERS), -1)
    start = np.where(np.arange(VOTERS) <= LEARNED_GROUPS, 0.5, 0.15)
    rates = np.stack([np.repeat(np.full(VOTERS, 0.05)[:, None], 2, 1), np.repeat(start[:, None], 2, 1)])
    model = LabelModel(prior, parents, rates)
    for step in range(steps):
        toxic = np.where(known >= 0, known, model.posterior(masks))
        weights = np.stack([(1 - toxic) * counts, toxic * counts])
        if step == steps // 2:
            model.parents = np.stack([_tree(bits, weights[y]) for y in (0, 1)])
        # Pseudo-counts in the direction of what a voter is for keep classes from changing places.
        for y in (0, 1):
            for j in range(VOTERS):
                parent = model.parents[y, j]
                for value in (0, 1):
                    w = weights[y] if parent < 0 else weights[y] * (bits[:, parent] == value)
                    marginal = (weights[y] @ bits[:, j] + rates[y, j, 0] * 2) / (weights[y].sum() + 2)
                    model.rates[y, j, value] = np.clip((w @ bits[:, j] + 4 * marginal) / (w.sum() + 4), 1e-4, 1 - 1e-4)
    return model


def fit_linear(rows: np.ndarray, features: np.ndarray, target: np.ndarray, width: int, ridge: float = 0.1, steps: int = 300):
    """Weights and intercept of a logistic regression on 0/1 features, by accelerated gradient steps.

    Features are scaled by one over the root of their frequency, so that rare words can tell as
    much as common ones; the rarest keep weight 0. Votes come last and are penalised less.
    """
    n = len(target)
    frequency = np.bincount(features, minlength=width)
    keep = frequency[features] >= min(20, max(3, n // 200))
    rows, features = rows[keep], features[keep]
    scale = 1 / np.sqrt(np.maximum(frequency, 1) / n + 1e-2)
    scale[-VOTERS:] *= VOTE_SCALE
    # A bound on the curvature gives the step.
    curvature = 0.25 * np.bincount(rows, scale[features] ** 2, n).mean() + ridge
    rate = 1 / curvature
    weights, bias = np.zeros(width), float(np.log((target.mean() + 1e-3) / (1 - target.mean() + 1e-3)))
    ahead, bias_ahead, momentum = weights.copy(), bias, 1.0
    for _ in range(steps):
        margin = np.bincount(rows, (scale * ahead)[features], n) + bias_ahead
        error = 1 / (1 + np.exp(-np.clip(margin, -500, 500))) - target
        stepped = ahead - rate * (scale * np.bincount(features, error[rows], width) / n + ridge * ahead)
        bias_stepped = bias_ahead - rate * error.mean()
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        pull = (momentum - 1) / following
        ahead, bias_ahead = stepped + pull * (stepped - weights), bias_stepped + pull * (bias_stepped - bias)
        weights, bias, momentum = stepped, bias_stepped, following
    return weights * scale, bias


@dataclass
class ToxicityModel:
    lexicons: Lexicons
    labels: LabelModel
    weights: np.ndarray
    bias: float


def _word_counts(labelled: DataFrame) -> DataFrame:
    """Documents with each word or beginning, and toxic ones among them: hash, word, whole (0: a beginning), n, n_toxic."""

    def run(batches):
        for part in C.slices(batches):
            found = terms(part.column("text"))
            data = found[5]
            doc, hashes, starts, ends = (np.concatenate(pair) for pair in zip(found[:4], beginnings(found)))
            whole = np.arange(len(doc)) < len(found[0])
            toxic = np.array(part.column("_toxic").to_pylist(), bool)[doc]
            distinct, at, inverse = np.unique(hashes, return_index=True, return_inverse=True)
            inverse = inverse.reshape(-1)
            n_toxic = np.bincount(inverse, toxic, len(at)).astype(np.int64)
            # Names are asked for where a text is toxic only.
            texts = [data[starts[i] : ends[i]].tobytes().decode("utf-8", "replace") if k else None for i, k in zip(at, n_toxic)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(distinct.view(np.int64)), pa.array(texts, pa.string()), pa.array(whole[at].astype(np.int8)),
                 pa.array(np.bincount(inverse, minlength=len(at))), pa.array(n_toxic)],
                ["hash", "word", "whole", "n", "n_toxic"],
            )

    found = C.map_batches(labelled, run, "hash bigint, word string, whole tinyint, n bigint, n_toxic bigint")
    return found.groupBy("hash").agg(F.min("word").alias("word"), F.max("whole").alias("whole"), F.sum("n").alias("n"), F.sum("n_toxic").alias("n_toxic"))


def learn_lexicons(labelled: DataFrame, least_z: float = 4.0, most: int = LEXICON_WORDS) -> dict[int, int]:
    """Words and beginnings that go with the label, dealt over the groups by rank: those of largest z, the root of the likelihood ratio statistic.

    The log odds over their standard error would put a word that is in toxic texts alone behind any that a few dozen copies of a text share.
    A beginning must be in ``PURITY`` times as many toxic texts as others: a short one goes with the label also where most of its words don't.
    """
    n, n_toxic = labelled.agg(F.count("*"), F.coalesce(F.sum("_toxic"), F.lit(0))).first()
    if not n_toxic or n_toxic == n:
        return {}
    a, b = F.col("n_toxic") + 0.5, F.col("n") - F.col("n_toxic") + 0.5
    c, d = F.lit(n_toxic) - F.col("n_toxic") + 0.5, F.lit(n - n_toxic) - F.col("n") + F.col("n_toxic") + 0.5
    total = F.lit(n + 2.0)
    cells = ((a, a + b, a + c), (b, a + b, b + d), (c, c + d, a + c), (d, c + d, b + d))
    ratio = 2 * sum((cell * F.log(cell * total / (row * column)) for cell, row, column in cells), F.lit(0.0))
    z = F.sqrt(F.greatest(ratio, F.lit(0.0))) * F.signum(a * d - b * c)
    top = _word_counts(labelled).withColumn("z", z).filter((F.col("z") > least_z) & ((F.col("whole") == 1) | (a > PURITY * b)))
    top = top.orderBy(F.desc("z"), F.desc("whole"), "word", "hash").limit(most)
    return {int(np.int64(row["hash"]).view(np.uint64)): i % LEARNED_GROUPS for i, row in enumerate(top.collect())}


def _features(found, n: int, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text numbers and feature numbers: hashed words, then votes."""
    doc, hashes = found[0], found[1]
    bits = (masks[:, None] >> np.arange(VOTERS)) & 1
    voted, voter = np.nonzero(bits)
    words = (hashes >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)
    return np.concatenate([doc, voted]), np.concatenate([words, voter + (1 << FEATURE_BITS)])


def one_text(labelled: DataFrame) -> DataFrame:
    """Stored ``_key``, ``text`` and ``_toxic``: of a key's texts the one of least hash; each task keeps one before anything is shuffled."""
    least = F.min_by("text", F.struct(F.xxhash64("text"), F.length("text"))).alias("text")
    return stored(labelled.groupBy("_key", "_toxic").agg(least))


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    max_labelled: int = MAX_LABELLED,
) -> ToxicityModel:
    """Lexicons, label model and classifier from the rows that are not held out."""
    named = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("text")).filter(~C.held_out("_key"))
    known = (
        labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & ~C.held_out(key))
        .groupBy(F.col(key).alias("_key")).agg(F.max((F.col(label) == 1).cast("int")).alias("_toxic"))
    )
    # A key's rows could be any number: it is one labelled text.
    labelled = one_text(named.join(known, "_key"))
    lexicons = Lexicons(learn_lexicons(labelled))

    def vote(batches):
        for part in C.slices(batches):
            n = part.num_rows
            yield pa.RecordBatch.from_arrays(
                [part.column("_key"), pa.array(votes(terms(part.column("text")), n, lexicons))], ["_key", "_mask"]
            )

    key_type = named.schema["_key"].dataType.simpleString()
    masks = C.map_batches(named, vote, f"_key {key_type}, _mask bigint")
    # Every label counts here: labels are joined to the votes, then only counts are left.
    counted = masks.join(known, "_key", "left").groupBy("_mask", F.coalesce("_toxic", F.lit(-1)).alias("_known")).count().toArrow()
    label_model = fit_label_model(counted["_mask"].to_numpy(), counted["count"].to_numpy().astype(float), counted["_known"].to_numpy())

    def features(batches):
        for part in C.slices(batches):
            n = part.num_rows
            found = terms(part.column("text"))
            mask = votes(found, n, lexicons)
            rows, numbers = _features(found, n, mask)
            order = np.argsort(rows, kind="stable")
            bounds = np.searchsorted(rows[order], np.arange(n + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(numbers[order].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([pa.array(mask), lists], ["_mask", "_features"])

    chosen = labelled.select("_key").orderBy(F.xxhash64("_key", F.lit("toxic")), "_key").limit(max_labelled)
    sample = labelled.join(F.broadcast(chosen), "_key").select("text")
    rows = C.map_batches(sample, features, "_mask bigint, _features array<int>").toArrow()
    width = (1 << FEATURE_BITS) + VOTERS
    if not rows.num_rows:
        return ToxicityModel(lexicons, label_model, np.zeros(width), float(np.log(PRIOR / (1 - PRIOR))))
    target = label_model.posterior(rows["_mask"].to_numpy())
    lists = rows["_features"].combine_chunks()
    sizes = lists.value_lengths().to_numpy()
    weights, bias = fit_linear(np.repeat(np.arange(len(sizes)), sizes), lists.flatten().to_numpy(), target, width)
    return ToxicityModel(lexicons, label_model, weights, bias)


def score(docs: DataFrame, model: ToxicityModel, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep``, ``score``, ``predicted``, ``votes`` (bit mask) and ``posterior`` (of the label model)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FEATURE_BITS and VOTERS bound its size

    def compute(part: pa.RecordBatch):
        m, n = shared.value, part.num_rows
        found = terms(part.column(text))
        masks = votes(found, n, m.lexicons)
        rows, numbers = _features(found, n, masks)
        margin = np.bincount(rows, m.weights[numbers], n) + m.bias
        value = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
        return [value, (value >= 0.5).astype(np.int32), masks, m.labels.posterior(masks)]

    fields = [
        StructField("score", DoubleType()), StructField("predicted", IntegerType()),
        StructField("votes", LongType()), StructField("posterior", DoubleType()),
    ]
    return C.add_columns(C.picked(docs, [*keep, text]), compute, fields, keep, text)
