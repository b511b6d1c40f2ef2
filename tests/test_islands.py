"""Small primary islands against plain loops over spans."""

import random

from loomseq.operators import islands


def label(c, p):
    return "contaminant" if c >= p and c > 0 else "primary" if p > c else "grey"


def ranges(spans, big):
    """The groups, from their description: each large primary by itself but the last, which opens the rest; what lies between."""
    large = [i for i, s in enumerate(spans) if s["p"] >= big]
    if not large:
        return [(0, len(spans) - 1)]
    out, at = [], 0
    for b in large[:-1]:
        out += [(at, b - 1), (b, b)]
        at = b + 1
    return [(i, j) for i, j in [*out, (at, large[-1] - 1), (large[-1], len(spans) - 1)] if i <= j]


def merged(spans, big, share):
    out, todo = [], ranges(spans, big)
    while todo:
        lo, hi = todo.pop()
        if lo > hi:
            continue
        i, j = lo, hi
        while i < j:
            c, p = sum(s["c"] for s in spans[i : j + 1]), sum(s["p"] for s in spans[i : j + 1])
            if c > 0 and p > 0 and int(c * share) > p and p < big:
                out.append((i, j))
                todo += [(lo, i - 1), (j + 1, hi)]
                break
            res = [{"contaminant": s["c"], "primary": s["p"], "grey": s["g"]}[label(s["c"], s["p"])] for s in (spans[i], spans[j])]
            if res[0] >= res[1]:
                i += 1
            else:
                j -= 1
        else:
            out += [(k, k) for k in range(lo, hi + 1)]
    return sorted(out)


def trim(spans, good_len, good_abs, pct):
    index, bad, good, prev = 0, 0, 0, None
    for i, s in enumerate(spans):
        if s["label"] == "contaminant":
            bad += s["n"]
            if i > 0 and (prev is None or prev >= good_abs) and good / bad * 100 >= pct:
                break
            prev, index = None, i
        elif s["label"] == "primary":
            if s["n"] >= good_len:
                break
            prev, good = s["n"], good + s["n"]
    return index + 1 if index else 0


def test_islands(spark):
    r = random.Random(8)
    rows, want_merged, want_ends = [], [], []
    for q in range(120):
        spans, pos = [], 1
        for _ in range(r.randrange(1, 14)):
            n = r.choice([5, 20, 60, 150, 400])
            c, p, g = r.choice([(n, 0, 0), (n // 2, 0, 2), (0, n, 0), (0, n // 3, 0), (0, 0, n), (2, n // 2, 1)])
            spans.append({"pos": pos, "end": pos + n - 1, "n": n, "c": c, "p": p, "g": g})
            rows.append((q, pos, pos + n - 1, n, c, p, g, label(c, p)))
            pos += n
        out = []
        for i, j in merged(spans, 120, 0.3):
            part = spans[i : j + 1]
            s = {"pos": part[0]["pos"], "end": part[-1]["end"]} | {k: sum(x[k] for x in part) for k in "ncpg"}
            out.append(s | {"label": label(s["c"], s["p"])})
        want_merged += [(q, *s.values()) for s in out]
        f, b = trim(out, 100, 15, 30), trim(out[::-1], 100, 15, 30)
        if f + b > len(out):
            f, b = len(out), 0
        parts = ([out[:f]] if f else []) + [[s] for s in out[f : len(out) - b]] + ([out[len(out) - b :]] if b else [])
        for k, part in enumerate(parts):
            cut = f and k == 0 or b and k == len(parts) - 1
            s = {"pos": part[0]["pos"], "end": part[-1]["end"]} | {x: sum(y[x] for y in part) for x in "ncpg"}
            want_ends.append((q, *s.values(), "contaminant" if cut else part[0]["label"]))
    df = spark.createDataFrame(rows, "seq_id long, pos long, end long, ungap_len long, contam_len long, primary_len long, grey_len long, label string")
    one = islands.merge_islands(df, 120, 0.3)
    assert sorted(map(tuple, one.collect())) == sorted(want_merged) and len(want_merged) < len(rows)
    two = islands.discard_end_islands(one, 100, 15, 30)
    assert sorted(map(tuple, two.collect())) == sorted(want_ends) and len(want_ends) < len(want_merged)
    assert islands.merge_islands(df.limit(0)).count() == 0
