"""Searches over vectors of several lengths, large components and repeated ids, against every product in Python's integers."""

import math

import numpy as np

from loomseq.llm import topk_search as T

SCHEMA = "vec_id long, embedding array<double>, label int, x int, dim int"


def by_hand(rows, k=5):
    whole = lambda v: [int(c) * 256 if abs(c) > 1e15 else math.floor(c * 256) for c in v]
    fit = [(i, v) for i, v in rows if i is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for q in sorted({i for i, _ in fit if i % 50 == 0}):
        asked = min(v for i, v in fit if i == q)
        scores = sorted((-sum(a * b for a, b in zip(whole(asked), whole(v), strict=True)), i) for i, v in fit if i != q and len(v) == len(asked))
        out += [(q, r + 1, i, -s if abs(s) < 1 << 63 else None) for r, (s, i) in enumerate(scores[:k])]
    return out


def check(spark, rows):
    df = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], SCHEMA).repartition(3)
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in T.top_five(df).collect())
    assert got == by_hand(rows)
    return got


def test_repeated_ids_lengths_and_large_components(spark):
    rng = np.random.default_rng(2)
    few = [(50, [1.0, 1.0]), (50, [None, 1.0]), (100, [1.0, 1.0]), (100, [float("-inf"), 1.0]), (3, [2.0, -1.0]), (4, [2.0, -1.0]), (150, [3.0]), (7, [1.0]), (200, [1.0] * 3)]
    assert {r[0] for r in check(spark, few)} == {50, 100, 150}  # the only vector of length 3 has no candidates
    grid = [(i, (rng.integers(-2, 3, 4) / 8).tolist()) for i in range(300)]
    large = [(1000 + i, (rng.normal(size=6) * 10.0 ** rng.integers(0, 31)).tolist()) for i in range(120)] + [(1000, [1e30] * 6), (1001, [1e30] * 6), (1002, [-1e30] * 6)]
    middle = [(2000 + i, (rng.normal(size=5) * 2e5).tolist()) for i in range(150)]
    got = check(spark, grid + large + middle + [(0, None), (50, []), (None, [0.5] * 4)])
    assert any(r[3] is None for r in got) and any(r[3] is not None and r[3] > 1 << 53 for r in got)


def test_numbers_sort_as_text():
    values = [-(10**40), -12, -11, -2, 0, 1, 9, 10, 99, 10**18, 10**40]
    assert sorted(values, key=T._sortable) == values
