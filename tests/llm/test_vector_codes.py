"""Codes against every distance in Python's integers: ties, lengths, large components, odd rows; and what the bounds leave out."""

import hashlib
import math

import numpy as np

from loomseq.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<double>, label int, code int, key string, x long"


def by_hand(rows, dim, rounds=V.ROUNDS):
    """{(vec_id, vector): (code, error)}, digest of the codebooks."""
    kept = sorted(((r[0] is None, r[0] or 0, r[1]) for r in rows if len(r[1]) == dim))
    xs = [[int(v) * 4096 if abs(v) > 1e15 else math.floor(v * 4096) for v in r[2]] for r in kept]
    cut = [[x[p * dim // 8 : (p + 1) * dim // 8] for x in xs] for p in range(8)]
    books = [[list(v) for v in part[:16]] for part in cut]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    for k in range(rounds + 1):
        codes = [[min((far(v, c), j) for j, c in enumerate(book)) for v in part] for part, book in zip(cut, books, strict=True)]
        if k < rounds:
            for part, code, book in zip(cut, codes, books, strict=True):
                for j in range(len(book)):
                    mine = [v for v, (_, e) in zip(part, code, strict=True) if e == j]
                    if mine:
                        book[j] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    out = [((None if r[0] else r[1], tuple(r[2])), "".join(f"{codes[p][i][1]:02x}" for p in range(8)), sum(codes[p][i][0] for p in range(8))) for i, r in enumerate(kept)]
    return out, hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()


def made():
    rng = np.random.default_rng(5)
    rows = [(i, (rng.integers(-3, 4, 16) / 4).tolist(), int(rng.integers(3)) if i % 5 else None) for i in range(300)]  # a grid: many ties
    rows += [(400 + i, rng.normal(size=8).tolist(), 7) for i in range(40)]
    rows += [(500 + i, rng.normal(size=24).tolist(), 8) for i in range(9)]  # fewer than the entries
    rows += [(600 + i, (rng.normal(size=32) * (1e30 if i % 2 else 1)).tolist(), 9) for i in range(30)]
    return rows + [rows[3], rows[3], (7, [0.25] * 16, 1), (None, [0.5] * 16, 2), (None, [-0.5] * 16, None)]


def test_codes(spark):
    rows = made()
    odd = [(1, None, 1), (2, [0.1, None] * 8, 1), (3, [float("nan")] * 16, 0), (4, [float("-inf")] * 16, 0), (905, [0.5] * 12, 4), (906, [], 5)]
    df = spark.createDataFrame([(*r, 1, "k", 2) for r in rows + odd], SCHEMA).repartition(5)
    got = V.vector_codes(df).collect()
    want, labels = [((905, None), None, None), ((906, None), "00" * 8, 0)], {4: [None], 5: [0]}
    digests = {905: None, 906: hashlib.sha256(b"").hexdigest()}
    label_of = {(r[0], tuple(r[1])): r[2] for r in rows}
    for dim in (16, 8, 24, 32):
        found, digest = by_hand(rows, dim)
        for who, code, error in found:
            error = error if error < 1 << 63 else None
            want.append(((who[0], None), code, error))
            labels.setdefault(label_of[who], []).append(error)
            digests.setdefault(who[0], digest)
    assert sorted(((r.vec_id, None), r.code, r.error) for r in got if r.vec_id is not None and r.error is not None) == sorted(w for w in want if w[0][0] is not None and w[2] is not None)
    assert sorted(map(repr, (((r.vec_id, None), r.code, r.error) for r in got))) == sorted(map(repr, want))
    totals = {k: None if None in v else sum(v) for k, v in labels.items()}
    ids = {r[0]: r[2] for r in rows + odd if r[1] and r[0] not in (None, 1, 2, 3, 4, 7)} | {906: 5}
    for r in got:
        if r.vec_id in ids:
            assert r.label_error == totals[ids[r.vec_id]], r
        if r.vec_id not in (None, 7):
            assert r.codebooks_sha256 == digests[r.vec_id]
    assert {r.codebooks_sha256 for r in got if r.vec_id == 905} == {None}


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert V.vector_codes(df).count() == 0
    assert V.vector_codes(spark.createDataFrame([(1, None, 1, 1, "k", 2)], SCHEMA)).count() == 0


def test_bounds_leave_out_distances_and_change_nothing():
    rng = np.random.default_rng(1)
    centres = rng.integers(-4000, 4000, (16, 8))
    x = centres[rng.integers(0, 16, 3000)] + rng.integers(-300, 300, (3000, 8))
    x[:200] = (x[:200] // 512) * 512  # ties
    entries, before = x[:16].copy(), None
    code, upper, lower = np.zeros(3000, np.uint8), np.full(3000, np.inf, np.float32), np.zeros((3000, 16), np.float32)
    looked = []
    for _ in range(7):
        moved = None if before is None else np.sqrt(((entries - before) ** 2).sum(1)) * (1 + 1e-12)
        V.assign(x, entries, code, upper, lower, moved, looked)
        d = ((x[:, None] - entries[None]) ** 2).sum(2)
        assert (code == d.argmin(1)).all() and (upper.astype(float) ** 2 >= d.min(1) * (1 - 1e-9)).all() and (lower <= np.sqrt(d)).all()
        before = entries
        entries = np.array([x[code == j].sum(0) // max(1, (code == j).sum()) if (code == j).any() else entries[j] for j in range(16)])
    assert looked[0] <= 16 * 3000 and sum(looked[1:]) < 0.35 * 6 * 16 * 3000


def test_sums_of_any_size():
    x = np.array([[3, -5], [1 << 140, -(1 << 141)], [-7, 2]], object)
    books = V.Books([np.array([[0, 0], [1, 1]], object)] * 2, 7)
    s = np.array([V._sums(x, np.array([0, 0, 0]), 2, 7)] * 2)
    assert books.refined(s).entries[0].tolist() == [[((1 << 140) - 4) // 3, (-(1 << 141) - 3) // 3], [1, 1]]
