"""An index build against words of whole sequences, filtered place by place."""

import random

from pyspark.sql import functions as F

from loomseq.operators import index_build, words

RAW = "source long, place long, seq_id string, defline string, seq string"


def test_build(spark):
    r = random.Random(2)
    letters = lambda n: "".join(r.choice("ACGT") for _ in range(n))
    rows = [(1, k, f"seq_{k}", "plain", letters(r.choice([30, 56, 300, 900]))) for k in range(8)]
    rows += [(1, 8, "seq_low", "plain", letters(150) + "AC" * 80 + letters(150)), (1, 9, "seq_n", "plain", letters(120) + "N" * 30 + letters(200)), (1, 10, "seq_out", "not known", letters(200)), (1, 11, "seq_alt", "an alternate locus", letters(200)), (1, 12, "seq_hard", "masked", letters(200))]
    rows += [(2, 0, "cds_a", "x [gene=g1]", "ATG" + letters(300)), (2, 1, "cds_b", "x [gene=g1]", "ATG" + letters(400)), (2, 2, "cds_c", "x [gene=g2]", letters(120) + "TAA"), (2, 3, "cds_d", "x [gene=g1]", letters(118) + "C"), (2, 4, "cds_e", "x", letters(147) + "TGA")]
    rows += [(3, 0, "seq_copy", "plain", rows[7][4])]
    tax = {x[2]: (i % 3 + 1 if x[2] != "seq_copy" else 7 % 3 + 1) for i, x in enumerate(rows)}
    f = spark.createDataFrame
    ids = f([(k, v) for k, v in tax.items() if k != "seq_out"], "seq_id string, tax_id int")
    taxa = f([(1, "prok:x"), (2, "anml:y")], "tax_id int, div string")
    hard, soft = [("seq_hard", 1, None), ("seq_2", 10, 30)], [("cds_b", 100, 57), ("seq_3", 1, 20)]
    mask = "seq_id string, pos long, len long"
    posts, seqs = index_build.build(f(rows, RAW), ids, taxa, f(hard, mask), f(soft, mask))
    gone = {"seq_out", "seq_alt", "seq_hard", "cds_a"}
    kept = [x for x in rows if x[2] not in gone]
    order = sorted(kept, key=lambda x: (tax[x[2]], -len(x[4]), x[2]))
    oid = {x[2]: i for i, x in enumerate(order, 1)}
    assert {x.seq_id: x.oid for x in seqs.collect()} == oid
    plain = f([(oid[x[2]], x[4]) for x in kept], "oid long, seq string")
    low = {(x.oid, p) for x in words.entropy_track(plain).collect() for p in range(x.pos, x.pos + x.len)}
    assert low
    masks = {(oid[k], p) for k, pos, n in [*hard, *soft] if k in oid for p in range(pos, pos + n)} | low | {(oid["seq_n"], p) for p in range(121, 151)}
    stride = {oid[x[2]]: 18 if x[2] in ("cds_b", "cds_c", "cds_e") else 11 if tax[x[2]] == 1 else 22 for x in kept}
    want = {}
    for w in words.spaced_words(plain).collect():
        start = w.pos if w.pos > 0 else -w.pos - 55
        if (start - 1) % stride[w.oid] == 0 and not any((w.oid, p) in masks for p in range(start, start + 56)):
            want.setdefault((w.word, next(tax[k] for k, v in oid.items() if v == w.oid)), []).append((w.oid, w.pos))
    want = {(k[0], k[1], *p) for k, v in want.items() for p in sorted(v)[:2]}
    assert {(x.word, x.tax_id, x.oid, x.pos) for x in posts.collect()} == want and len(want) > 100
    assert posts.filter(F.length("key30") != 30).count() == 0


def test_side_tables_of_a_build_do_without_texts(spark):
    from loomseq.plans import builds

    raw, *others = builds.frames(spark, "/root/testdata/sf0.001")
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    assert "text" in plan(raw) and not any("text" in plan(x) for x in others)
