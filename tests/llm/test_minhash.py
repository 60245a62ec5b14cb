import collections
import random

import numpy as np
import pyarrow as pa
import pytest

from sievework.llm import minhash


def shingles(text):
    words = (text or "").split()
    if not words:
        return collections.Counter()
    return collections.Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def similarity(a, b):
    shared = sum((a & b).values())
    return shared / max(1, sum(a.values()) + sum(b.values()) - shared)


def classes(rows):
    """Class id of each row by brute force; rows are (key, text)."""
    texts = sorted({t for _, t in rows if t is not None and t.split()})
    parent = {t: t for t in texts}

    def find(t):
        while parent[t] != t:
            t = parent[t]
        return t

    sets = {t: shingles(t) for t in texts}
    for i, a in enumerate(texts):
        for b in texts[:i]:
            if similarity(sets[a], sets[b]) >= 0.8 - 1e-9:
                parent[find(a)] = find(b)
    least = {}
    for key, text in rows:
        if text in parent and key is not None:
            root = find(text)
            least[root] = min(key, least.get(root, key))
    return sorted((str(k), str(least.get(find(t)) if t in parent else k)) for k, t in rows)


def family(rng, n, words, edits):
    stock = [f"w{i}" for i in range(400)]
    base = [rng.choice(stock) for _ in range(words)]
    out = []
    for _ in range(n):
        text = list(base)
        for _ in range(rng.randint(0, edits)):
            text[rng.randrange(words)] = rng.choice(stock)
        out.append(" ".join(text))
    return out


def run(spark, rows, **how):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    return sorted((str(r.doc_id), str(r.class_id)) for r in minhash.near_duplicates(docs, **how).collect())


def test_agreement_estimates_weighted_similarity():
    rng = random.Random(1)
    for edits in (1, 4, 10):
        errors = []
        for _ in range(6):
            a, b = family(rng, 2, 200, edits)
            a += " tail of words again and again" * 3
            values, owner, _ = minhash.shingles(pa.array([a, b]))
            found = minhash.signatures(values, owner, 2)
            errors.append((found[0] == found[1]).mean() - similarity(shingles(a), shingles(b)))
        assert abs(np.mean(errors)) < 0.06


def test_every_coordinate_is_filled_at_any_size():
    texts = ["one", "a b c d e f", " ".join(str(i) for i in range(30_000)), "x y z " * 5000, "", None]
    values, owner, _ = minhash.shingles(pa.array(texts))
    found = minhash.signatures(values, owner, len(texts))
    top = np.uint64(2**64 - 1)
    assert (found[:4] != top).all() and (found[4:] == top).all()


def test_signature_depends_on_the_text_alone():
    texts = ["a b c d e f g", " ".join(str(i) for i in range(3000)), "q r s"]
    values, owner, _ = minhash.shingles(pa.array(texts))
    together = minhash.signatures(values, owner, 3)
    for i, text in enumerate(texts):
        values, owner, _ = minhash.shingles(pa.array([text]))
        assert (minhash.signatures(values, owner, 1)[0] == together[i]).all()


def test_hot_family_and_copies_match_brute_force(spark):
    rng = random.Random(5)
    texts = family(rng, 120, 150, 9) + family(rng, 5, 60, 1) + [" ".join(f"u{i}x{j}" for j in range(40)) for i in range(60)]
    texts += [texts[0]] * 80
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    assert run(spark, rows) == classes(rows)


def test_large_families_are_cut_into_blocks(spark, monkeypatch):
    rng = random.Random(6)
    rows = list(enumerate(family(rng, 60, 100, 7)))
    monkeypatch.setattr(minhash, "BLOCK", 10)
    assert run(spark, rows) == classes(rows)


@pytest.mark.parametrize("chain", [2, 12])
def test_chains_become_one_class(spark, chain):
    words = [f"c{i}" for i in range(300)]
    texts = []
    for step in range(chain):
        texts.append(" ".join(words))
        words = words[:10 * step] + [f"n{step}x{i}" for i in range(10)] + words[10 * step + 10 :]
    assert run(spark, list(enumerate(texts))) == classes(list(enumerate(texts)))


def test_edge_rows(edge_docs, edge_rows, empty_docs):
    rows = [(r[0], r[1]) for r in edge_rows]
    found = sorted((str(r.doc_id), str(r.class_id)) for r in minhash.near_duplicates(edge_docs).collect())
    assert found == classes(rows)
    kept = minhash.drop_near_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert ids == sorted(["1", "2", "3", "6", "7", "8", "9", "10", "None", "None", "12", "13"])
    assert minhash.near_duplicates(empty_docs).count() == 0
    assert minhash.drop_near_duplicates(empty_docs).count() == 0


def test_components_of_long_paths(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1001)], "_a bigint, _b bigint")
    roots = {r["_h1"]: r["_root"] for r in minhash.components(links).collect()}
    assert all(roots[i] == 0 for i in range(201)) and roots[1001] == roots[1000] == 1000


def _late_pair(spark, words):
    """Two texts of similarity 0.82 that are among the last in the order of hubs."""
    from pyspark.sql import functions as F

    rows = [(kind, i, " ".join(words[:-4] + [f"{kind}{i}x{j}" for j in range(4)])) for kind in "st" for i in range(400)]
    texts = spark.createDataFrame(rows, "kind string, i int, text string").withColumn("h", F.xxhash64("text"))
    last = texts.groupBy("kind").agg(F.max_by("text", F.xxhash64("h", F.lit(2))).alias("text")).orderBy("kind").collect()
    return [r.text for r in last]


def test_pair_among_texts_that_embed_it(spark):
    rng = random.Random(8)
    words = [f"s{i}" for i in range(44)]
    one, other = _late_pair(spark, words)
    assert 0.8 <= similarity(shingles(one), shingles(other)) < 0.85
    texts = [one, other]
    for i in range(3000):
        own = [f"e{i}x{j}" for j in range(135)]
        at = rng.randrange(135)
        texts.append(" ".join(own[:at] + words[:40] + own[at:]))
    found = dict(run(spark, list(enumerate(texts))))
    assert found["1"] == "0"
    assert all(found[str(i)] == str(i) for i in range(2, len(texts)))


def test_rejected_texts_meet_in_blocks():
    rng = np.random.default_rng(1)
    signed = rng.integers(0, 60_000, (5, minhash.DARTS)).astype("<u2")
    signed[3, :100], signed[4, :100] = signed[0, :100], signed[1, :100]
    h1, met = np.arange(5), np.array([False, False, False, True, False])
    assert [p[:2] for p in minhash._alike(h1, met, True, signed, 0.6)] == [(0, 3), (1, 4)]
    assert [p[:2] for p in minhash._alike(h1, met, False, signed, 0.6)] == [(0, 3)]


def test_buckets_are_used_up(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 6)
    monkeypatch.setattr(minhash, "HUB_ROUNDS", 2)
    rng = np.random.default_rng(2)
    signed = rng.integers(0, 60_000, (40, minhash.DARTS)).astype("<u2")
    for i in range(20, 40):
        signed[i, :80] = signed[i - 20 if i < 30 else 20, :80]
    texts = spark.createDataFrame([(i, bytearray(v.tobytes())) for i, v in enumerate(signed)], "_h1 bigint, _signature binary")
    found = minhash._stars(texts.selectExpr("7L AS _band", "_h1"), texts, 0.8).collect()
    parent = list(range(40))

    def find(i):
        return i if parent[i] == i else find(parent[i])

    for r in found:
        parent[find(r["_a"])] = find(r["_b"])
    near = [(i, j) for i in range(40) for j in range(i) if (signed[i] == signed[j]).mean() >= 0.61]
    assert len(near) > 20 and all(find(i) == find(j) for i, j in near)
