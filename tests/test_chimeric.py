"""Division intervals against a scan with a window that moves, and sets of places."""

import random

import pytest

from loomseq.operators import chimeric

PRIMARY = {"a1", "a2"}


def runs(places):
    out = []
    for p in sorted(places):
        if out and out[-1][0] + out[-1][1] == p:
            out[-1][1] += 1
        else:
            out.append([p, 1])
    return [tuple(x) for x in out]


def union(ivs, gap=0):
    out = []
    for p, n in sorted(ivs):
        if out and p <= out[-1][0] + out[-1][1] + gap:
            out[-1][1] = max(out[-1][1], p + n - out[-1][0])
        else:
            out.append([p, n])
    return out


def by_hand(nodes, repeats, size, window, terminal, pct):
    """nodes: (pos, len, div) of one query of that size"""
    places = lambda ivs: {x for p, n in ivs for x in range(p, p + n)}
    tracks = {d: places([x[:2] for x in nodes if x[2] == d]) for d in sorted({x[2] for x in nodes})}
    top = max(tracks, key=lambda d: len(tracks[d]))
    use = {d for d in tracks if d == top or top in PRIMARY and d in PRIMARY}
    track = runs(set().union(*tracks.values()) - set().union(*(tracks[d] for d in use)) - places(repeats))
    found = []

    def capture(i, j):
        pos, end = track[i][0], track[j][0] + track[j][1]
        n = end - pos
        if 100 * sum(x[1] for x in track[i : j + 1]) / (1 + n) >= pct and (n >= window or n >= terminal and (end < window or pos + window > size)):
            found.append((pos, n))

    i = 0
    for j, (p, n) in enumerate(track):
        while i < j and p + n - track[i + 1][0] > window:
            i += 1
        capture(i, j)
    while track and i + 1 < len(track):
        i += 1
        capture(i, len(track) - 1)
    kept = [(p, n) for p, n in union(found) if max(len(t & set(range(p, p + n))) for t in tracks.values()) * 100 > n * pct]
    out = []
    for p, n in union(kept, window // 4):
        if out and out[-1][1] + n > 0.9 * (p + n - out[-1][0]):
            out[-1][1] = p + n - out[-1][0]
        else:
            out.append([p, n])
    if out:
        if out[0][0] - 1 < window // 4:
            out[0] = [1, out[0][1] + out[0][0] - 1]
        if size + 1 - sum(out[-1]) < window // 4:
            out[-1][1] = size + 1 - out[-1][0]
    rest = runs(set(range(1, size + 1)) - {x for p, n in out for x in range(p, p + n)})
    return [(p, n, True) for p, n in out] + [(p, n, False) for p, n in rest]


@pytest.mark.parametrize(("window", "terminal", "pct"), [(200, 50, 50), (60, 20, 30)])
def test_intervals(spark, window, terminal, pct):
    r = random.Random(window)
    nodes, repeats, whole = [], [], []
    for q in range(40):
        at = 1
        size = r.randrange(300, 2500)
        while at < size - 80:
            n, d = r.randrange(1, 80), r.choice(["a1", "a2", "b", "b", "c"] if at // 400 % 2 else ["a1", "a1", "a2", "b"])
            nodes.append((q, at, n, d))
            at += r.choice([1, n // 2, n, n + 5, n + 30, n + 200])
            if r.random() < 0.1:
                repeats.append((q, at, 15))
        nodes.append((q, 1, 1, "a1"))
        whole.append((q, 1, size))
    nodes += nodes[:5]
    whole.append((99, 1, 500))
    f = spark.createDataFrame
    got = chimeric.div_intervals(f(nodes, "q_id long, pos long, len long, div string"), f(repeats, "q_id long, pos long, len long"), f(whole, "q_id long, pos long, len long"), f([(q, d) for q in range(40) for d in PRIMARY], "q_id long, div string"), window, terminal, pct).collect()
    want = [(q, *x) for q, _, size in whole[:-1] for x in by_hand([n[1:] for n in nodes if n[0] == q], [x[1:] for x in repeats if x[0] == q], size, window, terminal, pct)] + [(99, 1, 500, False)]
    assert sorted(map(tuple, got)) == sorted(want) and sum(x[3] for x in want) > 10


def test_no_matches(spark):
    f = spark.createDataFrame
    none = f([], "q_id long, pos long, len long, div string")
    got = chimeric.div_intervals(none, none.drop("div"), f([(1, 1, 9)], "q_id long, pos long, len long"), none.select("q_id", "div")).collect()
    assert [tuple(x) for x in got] == [(1, 1, 9, False)]
