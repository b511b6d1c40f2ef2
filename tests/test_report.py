"""Overlaps with several tracks, conserved places and best taxa against sets of places."""

import random

from loomseq.operators import report, taxify

IV = "q_id long, pos long, len long"


def places(ivs, q):
    return {x for k, p, n in ivs if k == q for x in range(p, p + n)}


def test_one_sweep_gives_all_overlaps(spark):
    r = random.Random(4)
    some = lambda n, size: [(r.randrange(5), r.randrange(1, 900), r.randrange(0, size)) for _ in range(n)]
    raw = {"xp": some(40, 60), "lc": some(25, 90), "n": [], "xc": some(3, 400)}
    asked = sorted({x for x in some(30, 500) if x[2]} | {(7, 1, 100), (0, 1, 1)})
    f = lambda x: spark.createDataFrame(x, IV)
    tracks, every = report.repeat_tracks(f(raw["xp"]), f(raw["lc"]), f(raw["xc"]), f(raw["n"]))
    got = {(x.q_id, x.pos, x.len): x for x in report.overlaps(f(asked), tracks).collect()}
    assert sorted(got) == asked
    union = {(x.q_id, p) for x in every.collect() for p in range(x.pos, x.pos + x.len)}
    for (q, p, n), x in got.items():
        xp, lc, co = (places(raw[k], q) for k in ("xp", "lc", "xc"))
        here = set(range(p, p + n))
        lc_ = lc - co
        assert (x.xp, x.lc, x.co, x.n) == (len((xp - lc_ - co) & here), len(lc_ & here), len(co & here), 0)
        assert {v for k, v in union if k == q} == xp | lc | co


def test_conserved_places(spark):
    r = random.Random(5)
    divs = ["anml:a", "plnt:b", "fung:c", "prst:d", "anml:e", "prok:f", "virs:g"]
    nodes = [(r.randrange(3), r.randrange(1, 600), r.randrange(1, 120), r.choice(divs)) for _ in range(260)]
    cells = {}
    for q, p, n, d in nodes:
        if d[:5] not in ("prok:", "virs:"):
            for x in range(p + 10, p + n, 20):
                cells.setdefault((q, x // 20), set()).add(d)
    want = []
    for q, c in sorted(k for k, v in cells.items() if len(v) >= 5 and k[1]):
        p = c * 20 - 10
        if want and want[-1][0] == q and p <= want[-1][1] + want[-1][2] + 20:
            want[-1] = (q, want[-1][1], p + 20 - want[-1][1])
        else:
            want.append((q, p, 20))
    got = report.ultraconserved(spark.createDataFrame(nodes, IV + ", div string")).collect()
    assert sorted(map(tuple, got)) == want and want


def test_best_taxa_of_intervals(spark):
    nodes = [(1, 1, 100, 5, "a:x", 1000.0), (1, 51, 100, 6, "a:x", 900.0), (1, 51, 100, 7, "a:x", 800.0), (1, 90, 20, 8, "v:virus", 700.0), (1, 200, 10, 9, "b:y", 10.0), (2, 1, 9, 5, "a:x", 9.0)]
    asked = [(1, 1, 100), (1, 101, 150), (3, 1, 5)]
    got = report.interval_taxa(spark.createDataFrame(nodes, IV + ", tax_id long, div string, score double"), spark.createDataFrame(asked, IV)).collect()
    rows = {(x.q_id, x.pos): [tuple(t) for t in x.taxa] for x in got}
    assert rows == {(1, 1): [(5, "a:x", 100, 100, 32), (6, "a:x", 100, 50, 21), (8, "v:virus", 11, 11, 20)], (1, 101): [(6, "a:x", 50, 50, 21), (7, "a:x", 50, 50, 20), (8, "v:virus", 9, 9, 18), (9, "b:y", 10, 10, 3)]}


def test_best_taxa_have_one_order(spark):
    # taxon 82 stands in two divisions with one score: the order must not depend on the partitions that rows come from
    rows = [(q, t, d, 5, 7.0) for q in range(200) for t, d in ((82, "purchase"), (82, "click"), (80, "click"))]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = taxify.best_taxa(spark.createDataFrame(rows, "q_id long, tax_id int, div string, cvg_by_tax long, score double").repartition(4)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert {(x["rank"], x["tax_id"], x["div"]) for x in got} == {(1, 80, "click"), (2, 82, "click"), (3, 82, "purchase")}
