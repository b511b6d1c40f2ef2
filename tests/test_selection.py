"""The greedy choice against one assembly after another."""

import random

import pytest
from pyspark.sql import functions as F

from loomseq.operators import select, selection
from loomseq.operators.dataflow import ordinal

DIVS = ["anml:fishes", "anml:birds", "prst:algae", "prok:firmicutes", "fung:fungi", None]


def by_hand(rows, proximity, divs):
    """rows: (id, tax, species, div, status, weight, projects, len, n50) -> {id: (order, status, neighbour)}"""
    near = {}
    for a, b, score in proximity:
        kinds = [divs.get(a) or "", divs.get(b) or ""]
        other = 0.7 if all(k[:5] in ("prst:", "prok:", "arch:", "virs:") for k in kinds) else 0.6
        if a != b and score > min(selection.PROXIMITY.get(k, other) for k in kinds):
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    count = lambda k: {v: sum(r[k] == v for r in rows) for v in {r[k] for r in rows}}
    of_div, of_tax = count(3), count(1)
    order = sorted(rows, key=lambda r: r[0])
    for key in (lambda r: r[8] / r[7], lambda r: of_tax[r[1]], lambda r: r[6], lambda r: r[5], lambda r: r[3], lambda r: of_div[r[3]]):
        order.sort(key=key, reverse=True)
    seen, out = {}, {}
    for i, (id_, tax, species, *_rest) in enumerate(order, 1):
        status = _rest[1]
        by = seen.get(tax) or seen.get(species)
        if by and (status == "ok" or status == "ok-reference" and by == tax):
            out[id_] = (i, "seen", by)
            continue
        out[id_] = (i, "needs-prescreen" if not by and status == "not-prescreened" else status, None)
        if status.startswith("ok"):
            seen |= {tax: tax}
            seen |= {species: species}
            seen |= dict.fromkeys(near.get(tax, ()), tax)
    return out


def made(n, taxa, seed):
    r = random.Random(seed)
    divs = {t: r.choice(DIVS[:-1]) for t in range(1, taxa + 1)}
    status = ["ok"] * 6 + ["ok-reference", "ok-reference", "ok-acceptlist", "not-prescreened", "denylist"]
    rows = []
    for i in range(n):
        t = 1 if r.random() < 0.33 else r.randrange(1, taxa + 1)  # a third of all are of one taxon
        rows.append((i, t, t if r.random() < 0.6 else r.randrange(1, taxa + 1), divs[t], r.choice(status), r.randrange(3), r.randrange(3), 100 + r.randrange(50), r.randrange(100)))
    px = [(r.randrange(1, taxa + 3), r.randrange(1, taxa + 3), r.random()) for _ in range(taxa * 6)]
    return rows, px, divs


def spark_rows(spark, rows, px, divs):
    a = spark.createDataFrame(rows, "id long, tax_id long, sp_tax_id long, div string, status string, weight int, projects int, len long, n50 long")
    got = selection.select_subjects(a, spark.createDataFrame(px, "t1 long, t2 long, score double"), spark.createDataFrame(list(divs.items()), "tax_id long, div string")).collect()
    return {r.id: (r.ord, r.status, r.nbr_tax_id) for r in got}


@pytest.mark.parametrize(("n", "taxa"), [(800, 90), (300, 4)])
def test_choice(spark, n, taxa):
    rows, px, divs = made(n, taxa, n)
    got = spark_rows(spark, rows, px, divs)
    assert got == by_hand(rows, px, divs)
    assert "seen" in {v[1] for v in got.values()}


def test_no_assemblies(spark):
    a = spark.createDataFrame([], "id long, tax_id long, sp_tax_id long, div string, status string, weight int, projects int, len long, n50 long")
    assert selection.select_subjects(a, spark.createDataFrame([], "t1 long, t2 long, score double"), a.select("tax_id", "div")).count() == 0


def test_numbers_of_a_larger_table_are_whole(spark):
    """Ranges are drawn by a sample; the partitions that are counted have to be those that are numbered."""
    df = spark.range(60_000).select(F.expr("hash(id)").alias("h"), "id").join(spark.range(60_000), "id")
    got = ordinal(df.groupBy("h").agg(F.min("id").alias("id"), F.count("*").alias("n")), [F.desc("n"), "h", "id"])
    n = got.count()
    assert got.select("ord").distinct().count() == n == got.agg(F.max("ord")).first()[0]


def test_greedy_of_classes_is_the_greedy_choice(spark):
    r = random.Random(8)
    rows = [(i, i % 3 if i % 17 else None, float(r.randrange(6)) if i % 11 else None) for i in range(400)]
    c = spark.createDataFrame(rows, "id long, grp int, preference double").withColumn("class", F.pmod("id", F.lit(7)))
    meets = [(g, a, b) for g in range(3) for a in range(7) for b in range(a, 7) if r.random() < 0.3]
    where = {(i, g): i % 7 for i, g, _ in rows}
    near = {(g, a, b) for g, a, b in meets} | {(g, b, a) for g, a, b in meets}
    edges = [(i, j) for (i, g), a in where.items() for (j, h), b in where.items() if i != j and g == h and (g, a, b) in near]
    got = select.greedy_of_classes(c, spark.createDataFrame(meets, "grp int, a long, b long"), "grp").collect()
    want = select.greedy(c.drop("class"), spark.createDataFrame(edges, "a long, b long"), "grp").collect()
    text = lambda rows: sorted(map(str, rows))
    assert text(got) == text(want) and 0 < len(got) < len(rows)
