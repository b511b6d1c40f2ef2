"""Extension in rounds against one base after another on whole sequences."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomseq.operators import align
from loomseq.operators import extension as E

SEG = "q_oid long, s_oid long, minus boolean, q long, s long, len long"
TURN = str.maketrans("ACGT", "TGCA")


def one_way(flag, size, penalty):
    score = best = end = run = 0
    for i in range(size):
        if score + E.DROP < best:
            break
        ok = flag(i)
        run = run + 1 if ok else 1
        score += run if ok else -penalty
        if score >= best:
            best, end = score, i + 1
    return end


def by_hand(segs, query, subject):
    """segs of one query, subject and strand; query already turned, places from 0."""
    rows = []
    for q, s, n in sorted(segs, key=lambda x: (x[1], x[0], x[2])):
        t = E.TRIM if n > 2 * E.TRIM else 0
        rows.append([q + t, s + t, n - 2 * t])
    ok = lambda i, j: query[i] == subject[j] and query[i] != "N"
    for penalty in E.PENALTIES:
        for back in (False, True):
            for k in range(len(rows)) if not back else range(len(rows) - 1, -1, -1):
                q, s, n = rows[k]
                other = rows[k - 1] if back and k else rows[k + 1] if not back and k + 1 < len(rows) else None
                size = min(E.CAP, q, s) if back else min(E.CAP, len(query) - q - n, len(subject) - s - n)
                if other and other[1] - other[0] == s - q:
                    a, b = (other, rows[k]) if back else (rows[k], other)
                    if a[0] < b[0] and a[0] + a[2] < b[0] + b[2]:
                        size = min(size, max(0, b[0] - a[0] - a[2]))
                if back:
                    e = one_way(lambda i: ok(q - 1 - i, s - 1 - i), size, penalty)  # noqa: B023
                    rows[k] = [q - e, s - e, n + e]
                else:
                    rows[k][2] += one_way(lambda i: ok(q + n + i, s + n + i), size, penalty)  # noqa: B023
    return rows


def mutated(r, text, rate):
    return "".join(r.choice("ACGTN") if r.random() < rate else c for c in text)


@pytest.mark.parametrize("piece", [97, 8192])
def test_rounds(spark, piece, monkeypatch):
    monkeypatch.setattr(E.slices, "__defaults__", (piece,))
    r = random.Random(3)
    core = "".join(r.choice("ACGT") for _ in range(9000))
    subject = {1: core, 2: mutated(r, core[2000:5000], 0.25) + core[5000:5600], 3: "ACGT", 4: core[:700]}
    query = {7: core[100:8900], 8: mutated(r, core, 0.12), 9: core[300:900].translate(TURN)[::-1], 10: mutated(r, core[1900:5200], 0.3)}
    segs = []
    for q, qs in query.items():
        for s, ss in subject.items():
            for minus in (False, True):
                text = qs.translate(TURN)[::-1] if minus else qs
                for _ in range(12):
                    n = r.choice([10, 16, 17, 56, 60, 200])
                    if min(len(text), len(ss)) <= n:
                        continue
                    i = r.randrange(len(text) - n)
                    j = ss.find(text[i : i + 12]) if r.random() < 0.8 else r.randrange(len(ss) - n)
                    if 0 <= j < len(ss) - n:
                        segs.append((q, s, minus, i - len(text) if minus else i + 1, j + 1, n))
    segs += segs[:2]
    df = spark.createDataFrame(segs, SEG).repartition(5)
    seqs = lambda d: spark.createDataFrame(list(d.items()), "oid long, seq string")
    got = sorted(map(tuple, E.extension_rounds(df, seqs(query), seqs(subject), rows=7).collect()))
    want = []
    for key in {x[:3] for x in segs}:
        text = query[key[0]].translate(TURN)[::-1] if key[2] else query[key[0]]
        shift = -len(text) if key[2] else 1
        mine = {(x[3] - shift, x[4] - 1, x[5]) for x in segs if x[:3] == key}
        want += [(*key, q + shift, s + 1, n) for q, s, n in by_hand(mine, text, subject[key[1]])]
    assert got == sorted(want) and max(x[5] for x in got) > 4000 and any(x[2] for x in got)


def test_scan_is_one_base_after_another():
    rng = np.random.default_rng(1)
    same = rng.random((300, 60)) < rng.random((300, 1))
    room = rng.integers(0, 61, 300)
    for penalty in E.PENALTIES:
        assert E.scan(same, room, penalty).tolist() == [one_way(lambda i: bool(same[k, i]), int(room[k]), penalty) for k in range(300)]  # noqa: B023


def test_nothing(spark):
    seqs = spark.createDataFrame([(1, "ACGT"), (2, "")], "oid long, seq string")
    assert E.extension_rounds(spark.createDataFrame([], SEG), seqs, seqs).count() == 0
    assert E.extension_rounds(spark.createDataFrame([(1, 9, False, 1, 1, 4)], SEG), seqs, seqs).count() == 0
    whole = E.extension_rounds(spark.createDataFrame([(1, 1, None, 1, 1, 4)], SEG), seqs, seqs).first()
    assert tuple(whole) == (1, 1, False, 1, 1, 4)


def test_small_tables_are_dealt_out_to_several_tasks(spark):
    rows = [(q, s, False, 1 + 70 * k, 5 + 70 * k, 60) for q in range(12) for s in range(3) for k in range(2)]
    segments = spark.createDataFrame(rows, SEG)
    seqs = lambda n: spark.createDataFrame([(i, "ACGTTGCA" * 30) for i in range(n)], "oid long, seq string")
    query, subject = seqs(12), seqs(3)
    for got in (align.best_chain(segments, ["q_oid"]), align.drop_shadows(segments), align.measure(segments, query, subject), E.extension_rounds(segments, query, subject)):
        assert got.select(F.spark_partition_id().alias("p")).distinct().count() > 1
