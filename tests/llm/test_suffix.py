import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sievework.llm import suffix


def brute(rows):
    """Rows (key, text) to (key, bytes, removed, spans, digest)."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    seen, out = set(), []
    for i in order:
        data = (rows[i][1] or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - suffix.WIDTH + 1):
            window = data[s : s + suffix.WIDTH]
            if window in seen:
                gone[s : s + suffix.WIDTH] = b"\x01" * suffix.WIDTH
            seen.add(window)
        spans = sum(1 for j, g in enumerate(gone) if g and (j == 0 or not gone[j - 1]))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((str(rows[i][0]), len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def run(spark, rows, **how):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = suffix.remove_repeats(docs, **how).collect()
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found)


def corpus(seed, n):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(90, 400))) for _ in range(4)]
    rows = []
    for i in range(n):
        parts = [rng.choice([rng.choice(passages), "".join(rng.choice("xyz\x00ü") for _ in range(rng.randint(0, 150))), "ab" * 80])
                 for _ in range(rng.randint(0, 5))]
        rows.append((i * 3, "".join(parts)))
    rows += [(1, rows[4][1]), (2, rows[4][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard", [suffix.SHARD_CONTEXTS, 3])
def test_matches_brute_force(spark, shard):
    rows = corpus(shard, 60)
    assert run(spark, rows, shard_contexts=shard) == brute(rows)


def test_a_third_of_the_rows_are_one_row(spark, monkeypatch):
    monkeypatch.setattr(suffix, "COPIES_PER_TASK", 7)
    hot = "the same long line again " * 6
    rows = [(5, hot)] * 200 + [(7, hot)] * 30 + [(3, "x" + hot), (9, hot[:120])] + [(i, f"{i} " * 60) for i in range(100, 300)]
    assert run(spark, rows) == brute(rows)
    rows = [(None, hot)] * 40 + [(8, hot[10:])]
    assert run(spark, rows) == brute(rows)


def test_edge_rows(edge_docs, edge_rows, empty_docs):
    found = suffix.remove_repeats(edge_docs).collect()
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found)
    assert got == brute([(r[0], r[1]) for r in edge_rows])
    assert suffix.remove_repeats(empty_docs).count() == 0


def test_exact_length_and_one_less(spark):
    a, b = "q" + "0123456789" * 10, "r" + "0123456789" * 10
    rows = [(1, a), (2, b), (3, a[:100]), (4, b[:100])]
    assert run(spark, rows) == brute(rows)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=30).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=5))
def test_suffix_array_and_prefixes(texts):
    sizes = [len(t) for t in texts]
    if not sum(sizes):
        return
    data = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64) + 1
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    owner = np.repeat(np.arange(len(texts)), sizes)
    ends = bounds[1:][owner]
    order = suffix.suffix_array(data, ends, owner)
    suffixes = [(tuple(data[i : ends[i]]), owner[i]) for i in range(len(data))]
    assert [suffixes[i] for i in order] == sorted(suffixes)
    begins = np.zeros(len(data), bool)
    begins[bounds[:-1][np.array(sizes) > 0]] = True
    prefixes = suffix.common_prefixes(data, ends, order, begins)

    def common(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    expected = [0] + [common(suffixes[a][0], suffixes[b][0]) for a, b in zip(order, order[1:])]
    assert prefixes.tolist() == expected


def test_every_window_has_one_anchor():
    rng = np.random.default_rng(1)
    texts = [rng.integers(97, 101, n).astype(np.uint8) for n in (99, 100, 101, 2000)] + [np.full(500, 97, np.uint8)]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    anchor, _, low, high = suffix.window_anchors(np.concatenate(texts), offsets)
    windows = np.concatenate([np.arange(a, b + 1) for a, b in zip(low, high)])
    expected = [s for a, b in zip(offsets, offsets[1:]) for s in range(a, b - suffix.WIDTH + 1)]
    assert sorted(windows.tolist()) == expected
    assert ((anchor >= high) & (anchor + suffix.GRAM <= low + suffix.WIDTH)).all()
