import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.llm import negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int, _row int, rank string, _length int"


def brute(rows, positives=5, wanted=10, band=(30, 90)):
    good = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v], label)
        for i, v, label in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for at, (i, v, label) in enumerate(good):
        if i % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, other) for place, (j, w, other) in enumerate(good) if place != at)
        for s, j, _ in [x for x in scored if x[2] == label][:positives]:
            fits = [(n, b) for n, b, other in scored if other != label and band[0] * -s <= 100 * -n <= band[1] * -s][:wanted]
            out += [(i, j, rank, b, -s, -n) for rank, (n, b) in enumerate(fits, 1)]
    return sorted(out)


def run(spark, rows, **how):
    table = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(3)
    found = negatives.hard_negatives(table, F.col("vec_id") % 100 == 0, **how)
    return sorted(tuple(r) for r in found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def clusters(n, dim=8, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    sizes = np.exp(rng.normal(size=n))
    return [(i, (sizes[i] * (centres[i % 6] + 0.4 * rng.normal(size=dim))).astype("float32").tolist(), int(rng.integers(0, 4))) for i in range(n)]


def test_clusters_in_many_small_blocks(spark):
    rows = clusters(1200)
    # A hot vector under a hot label, and one of each other label.
    rows += [(2000 + i, rows[0][1], 1 if i % 9 else i % 4) for i in range(400)]
    found = run(spark, rows, block_rows=16, crowd_rows=5)
    assert found == brute(rows) and found
    assert run(spark, rows) == found


def test_edge_rows(spark):
    rows = [
        (0, [1.0, 2.0], 1), (100, None, 1), (200, [1.0, None], 1), (300, [float("nan"), 1.0], 2), (400, [float("inf"), 1.0], 2),
        (None, [1.0, 1.0], 1), (500, [-0.01, 0.5], None), (600, [0.0, 0.0], 1), (700, [], 2), (1, [1.0], 1), (2, [0.0, 0.0, 3.0], 2),
        (3, [0.5, 0.5], 2), (4, [0.2, 0.6], 3), (0, [1.0, 2.0], 1), (800, [-1.0, -2.0], 3), (5, [0.4, 0.9], 2), (5, [0.4, 0.9], 2), (900, [2.0], 9),
    ]
    found = run(spark, rows)
    assert found == brute(rows) and found
    assert run(spark, rows, block_rows=1, crowd_rows=1) == found


def test_signs_and_zero_scores(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-2, 3, 4).astype("float32").tolist(), int(rng.integers(0, 3))) for i in range(0, 1500, 10)]
    assert run(spark, rows, block_rows=8) == brute(rows)


def test_other_numbers(spark):
    rows = clusters(400, dim=5, seed=5)
    how = {"positives": 2, "negatives": 3, "band": (0, 120)}
    assert run(spark, rows, block_rows=32, **how) == brute(rows, 2, 3, (0, 120))


def test_one_label_or_none(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0], 1)]) == []
    assert run(spark, [(0, [1.0], 1), (1, [1.0], 1)]) == []
    assert run(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []


def test_many_labels(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=3).astype("float32").tolist(), i // 3) for i in range(600)]
    assert run(spark, rows, block_rows=20) == brute(rows)


def test_too_large_components_are_refused(spark):
    with pytest.raises(ArithmeticError):
        run(spark, [(0, [1e18], 1), (1, [1e18], 1)])


def test_feasible_rows_hold_all_that_score(spark):
    rng = np.random.default_rng(7)
    values = rng.integers(-50, 50, (500, 6))
    values[:5] = 0
    block = negatives.Block(values, True)
    for _ in range(200):
        anchor = rng.integers(-50, 50, 6)
        scores = values @ anchor
        least = int(rng.integers(-3000, 9000))
        rows = block.feasible(anchor, least)
        rows = np.arange(500) if rows is None else rows
        assert set(np.flatnonzero(scores >= least)) <= set(rows.tolist())
        at, found = block.scores(anchor, rows)
        assert (found == scores[at]).all()


def test_narrow_cones_leave_rows_out():
    rng = np.random.default_rng(8)
    unit = rng.normal(size=(4000, 3))
    values = np.round(1000 * unit / np.linalg.norm(unit, axis=1)[:, None]).astype(np.int64)
    block = negatives.Block(values, True)
    rows = block.feasible(values[0], 0.98 * 1e6)
    assert 0 < len(rows) < 400
    assert len(block.feasible(values[0], 1.1e6)) == 0
