"""Top-k search against brute force."""

import math
import random

from pyspark.sql import functions as F

from beaconry.llm import topk


def slow(rows, k):
    valid = {(i, tuple(math.floor(1024 * x) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q, a in valid:
        if q % 5 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in valid if i != q and len(b) == len(a))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def corpus():
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(300)]
    rows += [(1000 + i, [1.0, -1.0] * 4) for i in range(60)]  # ties
    rows += [(5, rows[5][1]), (2001, None), (2005, [None] * 8), (2010, [float("nan")] + [0.0] * 7), (2015, [float("inf")] * 8), (None, [0.5] * 8),
             (2020, [1.0, 2.0]), (2021, [3.0, -2.0]), (2025, []), (2026, []), (2030, [7.0] * 3), (2035, [0.0] * 8), (-10, [1e6] * 8)]
    return rows


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "ROWS", 50)
    monkeypatch.setattr(topk, "ASKING", 20)
    monkeypatch.setattr(topk, "STEP", 7)
    rows = corpus()
    data = spark.createDataFrame([(i, v, 0, 0.0) for i, v in rows], "vec_id long, embedding array<double>, rank int, score double")
    got = sorted(tuple(r) for r in topk.top_k(data, F.col("vec_id") % 5 == 0, 4).collect())
    assert got == slow(rows, 4)


def test_small_and_empty(spark):
    data = spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(data, F.col("vec_id") % 5 == 0, 10).collect()] == [(0, 1, 1, 512 * 1024 + 512 * 2048)]
    assert topk.top_k(data.limit(0), F.col("vec_id") % 5 == 0, 10).count() == 0
