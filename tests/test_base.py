import math
import os
import random

import duckdb
import numpy as np
import pandas as pd
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomseq.functions import scalars as x
from loomseq.operators import actions, align, hits, intervals, sketch, words
from loomseq.operators.align import maximal_subarrays
from loomseq.plans.queries import SQL, Q
from loomseq.sources import files, sinks
from loomseq.streaming import events

SF = "/root/testdata/sf0.001"
SOME = ["where", "group_adjacent", "in_groups_of", "sliding_window", "take_while", "zip_with", "foldl", "enumerated", "iv_merge", "iv_invert_whole", "iv_intersect", "iv_subtract", "iv_session", "windows_sliding", "index_keep2", "seed_join_tiered", "seed_coalesce", "split_runs", "hash64", "top2_per_div_top4", "running_div_stats", "chimeric_intervals", "div_report", "spans", "seq_stats", "apply_actions", "summary_rollup", "flagship", "taxon_norms", "candidate_taxa", "neighbourhoods", "second_round", "drop_self", "tag_extrachromosomal", "batches", "repeat_source", "n_counts", "endosymbiont_chimeras", "run_info", "hosted_integrants", "assembly_status", "hit_rows"]


def rows(df: pd.DataFrame):
    def one(v):
        if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
            return None
        return round(float(v), 6) if isinstance(v, float) else str(v)

    return sorted((tuple(map(one, r)) for r in df[sorted(df.columns)].itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in os.listdir(SF):
        con.execute(f"create view {t.split('.')[0]} as select * from '{SF}/{t}'")
    return con


@pytest.mark.parametrize("name", SOME)
def test_query_equals_sql(spark, duck, name):
    assert rows(Q[name](spark, SF).toPandas()) == rows(duck.execute(SQL[name]).fetchdf())


@pytest.mark.parametrize("name", ["classify_rows", "decide_actions", "minhash_pairs", "select_greedy", "best_chain", "primary_divs", "align"])
def test_query_without_sql_runs(spark, name):
    assert Q[name](spark, SF).columns


def ivs(spark, pairs):
    return spark.createDataFrame([(1, a, n) for a, n in pairs], "seq_id int, pos long, len long")


def found(df):
    return sorted((r.pos, r.len) for r in df.collect())


def test_subtract_and_invert(spark):
    a, b = ivs(spark, [(8, 4), (15, 6), (22, 6), (30, 6)]), ivs(spark, [(10, 4), (19, 4), (24, 1)])
    assert found(intervals.subtract(a, b, ["seq_id"])) == [(8, 2), (15, 4), (23, 1), (25, 3), (30, 6)]
    assert found(intervals.invert(b, ["seq_id"])) == [(10, 0), (14, 5), (23, 1), (25, 0)]


def test_scalars(spark):
    one = lambda c: spark.range(1).select(c.alias("v")).first().v
    for k, v in ((0, 16294208416658607535), (1, 10451216379200822465), (42, 13679457532755275413)):
        assert one(x.hash64(F.lit(k).cast("long"))) % 2**64 == v
    assert [tuple(r) for r in one(x.parse_ranges(F.lit("100..200,300..350")))] == [(100, 101), (300, 51)]
    assert one(x.escape_tilde(F.lit("my-~~id~123..456~~123..456"))) == "my-{TILDE}{TILDE}id~123..456~~123..456"
    assert one(x.escape_tilde(F.lit("my-id~123..456"))) == "my-id~123..456"
    assert one(x.normal_id(F.lit(">gi|12345|ref|NC_12345.6| rest"))) == "NC_12345.6"
    assert one(x.gene_symbol(F.lit("x [gene=LOC100385748] y"))) == "LOC100385748"
    assert one(x.previous_accession(F.lit("GCF_000001405.40"))) == "GCF_000001405.39"
    assert one(x.readable(F.lit(123456))) == "123.46 Kbp"


def test_maximal_subarrays():
    assert maximal_subarrays([5, 15, -30, 10, -50, 40, -5, 10, -1000, 1]) == [(0, 2), (3, 4), (5, 8), (9, 10)]


def test_apply_actions(spark):
    seqs = spark.createDataFrame([("seq1", "ACGTA"), ("seq2", "A" * 16), ("seq3", "AA"), ("seq4", "ACGT"), ("seq5", "ACGTNNNNNTGCANNACGT")], "seq_id string, seq string")
    acts = spark.createDataFrame([("seq1", 1, 2, "TRIM"), ("seq1", 4, 1, "FIX"), ("seq2", 1, 16, "EXCLUDE"), ("seq3", 1, 2, "INFO"), ("seq4", 1, 4, "INFO"), ("seq5", 5, 5, "ACTION_TRIM"), ("seq5", 14, 2, "ACTION_TRIM")], "seq_id string, pos long, len long, action string")
    got = {r.id: r.seq for r in actions.apply_actions(seqs, acts, 3).collect()}
    assert got == {"seq1": "GNA", "seq4": "ACGT", "seq5~16..19": "ACGT", "seq5~10..13": "TGCA", "seq5~1..4": "ACGT"}


def test_fasta_and_tables(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">s1 first\nACGT\nacgt\n>s2\n\n>s3 x\nNNAC\n")
    got = {r.seq_id: r.seq for r in files.read_fasta(spark, str(tmp_path / "a.fa")).collect()}
    assert got == {"s1": "ACGTACGT", "s2": "", "s3": "NNAC"}
    (tmp_path / "t.tsv").write_text(files.make_metaline("taxa", 1, 0) + "\n# x\n9606\tHomo\thuman\tprimates\tanml:primates\n")
    assert files.check_metaline(str(tmp_path / "t.tsv"), spark, "taxa", 1)["minor"] == 0
    assert files.read_taxa(spark, str(tmp_path / "t.tsv")).count() == 2
    (tmp_path / "l.tsv").write_text("a\t1\t10\na\t8\t20\nb\t.\t.\n")
    assert sorted((r.seq_id, r.pos, r.len) for r in files.read_locations(spark, str(tmp_path / "l.tsv")).collect() if r.len) == [("a", 1, 20)]
    with pytest.raises(Exception, match="bad letter"):
        (tmp_path / "b.fa").write_text(">s1\nAC!T\n")
        files.read_fasta(spark, str(tmp_path / "b.fa")).collect()


def test_stream_equals_table(spark, tmp_path):
    table = spark.read.parquet(f"{SF}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    table.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(table.schema).parquet(str(tmp_path / "in"))
    q = events.windows(stream).writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("w").count() == events.windows(table).count()
    q = events.running_totals(stream).writeStream.format("memory").queryName("r").outputMode("update").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("r").agg(F.sum("events")).first()[0] == table.count()


def test_signature_of_equal_texts():
    assert sketch.signature("ACGTACGTACGTAA") == sketch.signature("ACGTACGTACGTAA")
    assert sketch.signature("short") is None


@given(st.lists(st.floats(-5, 5).map(round), max_size=30))
def test_maximal_subarrays_are_apart(values):
    got = maximal_subarrays(values)
    assert all(a < b for a, b in got) and all(x[1] <= y[0] for x, y in zip(got, got[1:], strict=False))


def bases(n, seed):
    return "".join(random.Random(seed).choices("ACGT", k=n))


def test_best_shift():
    a = np.frombuffer(bases(32, 1).encode(), np.uint8)
    b = np.frombuffer((bases(32, 1)[5:] + "ACGTA").encode(), np.uint8)
    assert align.best_shift(a, b) == (5, 24)
    assert align.best_shift(b, a) == (-5, 24)
    assert align.best_shift(a, a) == (0, 24)


@pytest.mark.parametrize("minus", [False, True])
def test_gapped_continuation_on_both_strands(spark, minus):
    left, right = bases(120, 2), bases(150, 3)
    query, subject = left + right, bases(40, 4) + left + "ACG" + right + bases(40, 5)
    if minus:
        query = query[::-1].translate(str.maketrans("ACGT", "TGCA"))
    q = spark.createDataFrame([(1, query)], "oid long, seq string")
    t = spark.createDataFrame([(2, subject)], "oid long, seq string")
    start = -len(query) if minus else 1
    seed = spark.createDataFrame([(1, 2, minus, start + 30, 71, 56)], align.SEGMENT)
    first = align.extend(seed, q, t)
    (one,) = first.collect()
    assert (one.q, one.s) == (start, 41) and 118 <= one.len <= 124
    both = sorted((r.s, r.len) for r in align.gapped(first, q, t).collect() if r.len > 20)
    assert len(both) == 2 and abs(both[1][0] - 164) <= 4 and both[1][0] + both[1][1] == 314
    m = align.measure(first, q, t).first()
    assert m.mismatches <= 2 and m.run_squares >= 118**2


def trimmed(spans, good_len, good_abs, pct):
    def take(items):
        taken = bad = good = 0
        last = None
        for i, (_, n, label) in enumerate(items):
            if label == "contaminant":
                bad += n
                if i and (last is None or last >= good_abs) and good * 100 >= bad * pct:
                    break
                last, taken = None, i
            elif label == "primary":
                if n >= good_len:
                    break
                last, good = n, good + n
        return taken + 1 if taken else 0

    one = lambda x: [(x[0][0], x[-1][0] + x[-1][1] - x[0][0], "contaminant")] if x else []
    f, b = take(spans), take(spans[::-1])
    return one(spans) if f + b > len(spans) else one(spans[:f]) + spans[f : len(spans) - b] + one(spans[len(spans) - b :])


def test_trim_ends(spark):
    rng, cases = random.Random(6), {}
    for k in range(300):
        at, cases[k] = 1, []
        for _ in range(rng.randint(1, 9)):
            n = rng.choice([3, 8, 20, 70])
            cases[k].append((at, n, rng.choice(["contaminant", "primary", "grey"])))
            at += n
    df = spark.createDataFrame([(k, *x) for k, xs in cases.items() for x in xs], "seq_id long, pos long, len long, label string")
    got = {k: [] for k in cases}
    for r in actions.trim_ends(df, 60, 15, 30).collect():
        got[r.seq_id].append((r.pos, r.len, r.label))
    assert {k: sorted(x) for k, x in got.items()} == {k: trimmed(x, 60, 15, 30) for k, x in cases.items()}
    assert actions.trim_ends(df.limit(0)).count() == 0


def test_running_total_over_stretches(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    got = {r.id: r.t for r in hits.running_total(df, "id", F.col("v"), "t", width=64).collect()}
    assert got == {i: sum(k % 7 for k in range(i)) for i in range(1000)}


def test_similar_pairs_are_all_pairs(spark):
    rng = random.Random(3)
    start = [rng.choice(sketch.DIGITS) for _ in range(sketch.SLOTS)]
    sigs = []
    for i in range(40):  # each keeps a share of the slots between 0.3 and 1
        keep = 0.3 + 0.7 * rng.random()
        sigs.append((i, "".join(c if rng.random() < keep else rng.choice(sketch.DIGITS) for c in start)))
    df = spark.createDataFrame([*sigs, (99, None)], "id long, signature string")
    f = lambda a, b: sum(x == y for x, y in zip(a, b, strict=True)) / sketch.SLOTS
    want = {(i, j) for i, a in sigs for j, b in sigs if i < j and f(a, b) - (1 - f(a, b)) / 64 >= 0.3}
    assert {(r.id_1, r.id_2) for r in sketch.similar_pairs(df).collect()} == want and want


def test_reports_are_read_back(spark, tmp_path):
    taxa = "array<struct<tax_id:int,div:string,cvg_by_div:int,cvg_by_tax:int,score:int>>"
    rows_ = [("a~1..9", 100, 1, 2, 3, 4, 5, 60, "Homo", [(9606, "anml:primates", 50, 40, 30), (2, "prok:x", 5, 4, 3)], "primary-div", "anml:primates"), ("b", 7, 0, 0, 0, 0, 0, 0, None, [], "low-coverage", "none")]
    df = spark.createDataFrame(rows_, f"seq_id string, len long, xp int, lc int, co int, n int, xc int, cvg_by_all long, tax_name string, taxa {taxa}, result string, result_div string")
    sinks.write_table(sinks.report_columns(df), str(tmp_path / "r"), "report", 3, run="x")
    assert files.check_metaline(str(tmp_path / "r"), spark, "report", 3)["content"] == {"run": "x"}
    got = {r.seq_id: r for r in files.read_report(spark, str(tmp_path / "r")).collect()}
    assert got["a~1..9"].len == 96 and [tuple(t) for t in got["a~1..9"].taxa] == rows_[0][9] and got["b"].taxa == []
    (c,) = sinks.classified_columns(df).filter("result = 'primary-div'").collect()
    assert len(c) == 34 and (c.result_div, c.div_pct_cvg) == ("anml:primates", "50")
    acts = spark.createDataFrame([("s{TILDE}1", 5, 10, 100, "TRIM", "d", 3, "t")], "seq_id string, pos long, len long, seq_len long, action string, div string, agg_cov int, top_tax_name string")
    sinks.write_table(sinks.action_columns(acts), str(tmp_path / "a"), "actions", 2)
    assert [tuple(r) for r in files.read_actions(spark, str(tmp_path / "a")).collect()] == [("s~1", 5, 10, "TRIM")]
    sinks.write_manifest(spark.createDataFrame([("f", 3, "d")], "path string, size long, digest string"), "1").coalesce(1).write.text(str(tmp_path / "m"))
    assert [tuple(r) for r in files.read_manifest(spark, str(tmp_path / "m")).collect()] == [("f", 3, "d")]


def test_seeds_are_not_made_in_masked_intervals(spark):
    r = random.Random(3)
    a, b, c = ("".join(r.choice("ACGT") for _ in range(n)) for n in (300, 300, 90))
    q = spark.createDataFrame([(1, a + "AC" * 150 + b), (2, a)], "oid long, seq string")
    index = spark.createDataFrame([("x", 1)], "word string, oid long")
    got = {(w.oid, w.pos if w.pos > 0 else -w.pos - 55) for w in align.query_words(q, index).collect()}
    assert {p for o, p in got if o == 2} == set(range(1, 246))
    assert not {p for o, p in got if o == 1} & set(range(340, 500)) and {(1, p) for p in [*range(1, 245), *range(602, 846)]} <= got
    hot = words.spaced_words(q).filter("oid = 2 and abs(pos) between 60 and 260").select("word", F.explode(F.sequence(F.lit(1), F.lit(600))).alias("oid"))
    left = {w.pos for w in align.query_words(q.filter("oid = 2"), hot).collect()}
    assert 0 < len(left) < 200
    basis = spark.createDataFrame([(k, "".join(r.choice("ACGT") for _ in range(2000)) + c) for k in range(60)], "oid long, seq string")
    rep = spark.createDataFrame([(9, a + c + c + b)], "oid long, seq string")
    away = {w.pos if w.pos > 0 else -w.pos - 55 for w in align.query_words(rep, index, basis).collect()}
    assert set(range(1, 230)) <= away and not away & set(range(305, 325))


def test_overlap_join_reads_whole_tables(spark, duck):
    got = Q["iv_overlap_join_whole"](spark, SF).toPandas()
    assert rows(got) == rows(duck.execute(SQL["iv_overlap_join_whole"]).fetchdf())
    n = duck.execute("SELECT count(*) FROM events").fetchone()[0]  # each interval meets at least the merged one that holds it
    assert got.id.nunique() == n
