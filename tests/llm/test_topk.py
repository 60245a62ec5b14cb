import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.llm import topk

SCHEMA = "vec_id bigint, embedding array<float>, label int, _row int, score int, rank int"


def brute(rows, k):
    good = [
        (i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v, *_ in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for at, (i, v) in enumerate(good):
        if i % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for b_at, (j, w) in enumerate(good) if b_at != at)
            out += [(i, r, j, -s) for r, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out)


def run(spark, rows, k=20, **how):
    table = spark.createDataFrame([(i, v, 1, 2, 3, 4) for i, v in rows], SCHEMA).repartition(3)
    found = topk.top_k(table, F.col("vec_id") % 20 == 0, k, **how)
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect())


def test_clusters_and_ties(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(5, 8))
    rows = [(i, (centres[i % 5] + 0.2 * rng.normal(size=8)).astype("float32").tolist()) for i in range(900)]
    rows += [(1000 + i, rows[0][1]) for i in range(300)]  # a hot vector
    assert run(spark, rows, block_rows=64) == brute(rows, 20)


def test_edge_rows(spark):
    rows = [
        (0, [1.0, 2.0]), (20, None), (40, [1.0, None]), (60, [float("nan"), 1.0]), (80, [float("inf"), 1.0]), (None, [1.0, 1.0]),
        (100, [-0.01, 0.5]), (1, [1.0]), (2, [0.0, 0.0, 3.0]), (3, []), (0, [1.0, 2.0]), (120, [2.0, 1.0]),
    ]
    assert run(spark, rows, k=3) == brute(rows, 3)
    assert run(spark, rows) == brute(rows, 20)  # fewer rows than k


def test_none_or_one(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0])]) == []


def test_too_large_components_are_refused(spark):
    with pytest.raises(ArithmeticError):
        run(spark, [(0, [1e18]), (1, [1e18])])
