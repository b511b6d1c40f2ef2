"""Maximal scoring stretches from their definition, over keys that span many partitions."""

import random

import pytest

from loomseq.operators import subsequences


def by_definition(v):
    s = [0]
    for x in v:
        s.append(s[-1] + x)
    ok = [(i, j) for i in range(len(v)) for j in range(i + 1, len(s)) if all(s[i] < x for x in s[i + 1 : j + 1]) and all(s[j] > x for x in s[i:j])]
    return sorted((i, j - 1, s[j] - s[i]) for i, j in ok if not any(a <= i and j <= b and (a, b) != (i, j) for a, b in ok))


def test_known_sequence():
    assert by_definition([5, 15, -30, 10, -50, 40, -5, 10, -1000, 1]) == [(0, 1, 20), (3, 3, 10), (5, 7, 45), (9, 9, 1)]


@pytest.mark.parametrize(("parts", "fan", "bias"), [(23, 2, 0), (40, 3, 1), (17, 64, -1), (1, 2, 0)])
def test_across_partitions(spark, parts, fan, bias):
    r = random.Random(parts)
    keys = {0: [r.randrange(-5, 6) + bias for _ in range(300)], 1: [r.randrange(-5, 6) for _ in range(40)], 2: [-1] * 30, 3: [3], 4: [x for k in range(60) for x in (60 - k, -1)], 5: [x for k in range(60) for x in (k, -k - 1)], 6: [1, -1] * 40, 7: [0] * 5}
    rows = [(k, 10 * i + 3, v) for k, vs in keys.items() for i, v in enumerate(vs)]
    r.shuffle(rows)
    rows += [(None, 1, 5), (7, 99, None)]
    df = spark.createDataFrame(rows, "who long, at long, v long")
    got = sorted((x.who, (x.first - 3) // 10, (x.last - 3) // 10, x.score) for x in subsequences.maximal_stretches(df, "who", "at", "v", fan, parts).collect())
    assert got == sorted((k, *x) for k, v in keys.items() for x in by_definition(v))


def test_empty_and_text_keys(spark):
    df = spark.createDataFrame([("a", 1, 2), ("a", 2, 3), ("b", 1, -1)], "k string, p int, s int")
    assert [tuple(x) for x in subsequences.maximal_stretches(df, "k", "p", "s").collect()] == [("a", 1, 2, 5)]
    assert subsequences.maximal_stretches(df.limit(0), "k", "p", "s").count() == 0
