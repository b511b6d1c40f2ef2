"""The packed store gives back what it got; words over any letters."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomseq import adapters
from loomseq.functions import letters, scalars
from loomseq.operators import anywords, words
from loomseq.plans import queries
from loomseq.sources import packed

SEQS = {1: "", 2: "A", 3: "ACGTN", 4: "NNNN", 5: "acgtACGTnNRYyk-" * 20, 6: None}


def seqs(spark, more=()):
    return spark.createDataFrame([*SEQS.items(), *more], "oid long, seq string")


@pytest.mark.parametrize("stride", [4, 20, 100_000])
def test_ranges_are_what_was_packed(spark, stride):
    r = random.Random(stride)
    long = [(k, "".join(r.choice("ACGT" * 9 + "NR") for _ in range(3000))) for k in (10, 11)]
    asks = [(f"{o}-{k}", o, p := r.randrange(1, len(s) + 1), r.randrange(1, len(s) - p + 2)) for o, s in [*SEQS.items(), *long] if s for k in range(25)]
    store = packed.pack(seqs(spark, long), stride)
    got = {x.ask: x.text for x in packed.fetch(store, spark.createDataFrame(asks, "ask string, oid long, pos long, len long"), stride).collect()}
    of = dict([*SEQS.items(), *long])
    assert got == {a: of[o][p - 1 : p - 1 + n] for a, o, p, n in asks}
    sizes = store.select("oid", "size", F.length("packed").alias("b")).collect()
    assert all(x.b == -(-x.size // 4) for x in sizes) and {x.oid for x in sizes} == {1, 2, 3, 4, 5, 10, 11}


def test_a_part_ends_with_a_byte(spark):
    with pytest.raises(ValueError, match="byte"):
        packed.pack(seqs(spark), 10)


def test_hash_is_the_same_in_numpy(spark):
    x = np.random.default_rng(1).integers(-(1 << 63), 1 << 63, 200)
    got = [r.h for r in spark.createDataFrame([(int(v),) for v in x], "v long").select(scalars.hash64(F.col("v")).alias("h")).collect()]
    assert letters.hashed(x).view(np.int64).tolist() == got


@pytest.mark.parametrize(("template", "stride", "piece"), [(56, 1, 70), (56, 11, 500), (44, 3, 65_536), (29, 1, 29)])
def test_words_over_bases_are_the_same(spark, template, stride, piece):
    r = random.Random(template)
    df = spark.createDataFrame([(k, "".join(r.choice("ACGT") for _ in range(n))) for k, n in enumerate((28, 56, 57, 300, 411))], "oid long, seq string")
    cols = ["oid", "pos", "word", "flipped"]
    rows = lambda d: sorted(map(tuple, d.select(*cols).collect()))
    assert rows(anywords.spaced_words(df, template, stride, piece)) == rows(words.spaced_words(df, template, stride))


def test_other_letters_have_words_that_depend_on_place_and_sequence(spark):
    a = "ACGT" * 20 + "N" * 100 + "TTGCA" * 20
    df = spark.createDataFrame([(1, a), (2, a), (3, a + "A"), (4, a.lower())], "oid long, seq string")
    got = {}
    for x in anywords.spaced_words(df, piece=64).collect():
        got.setdefault(x.oid, {})[abs(x.pos) if x.pos > 0 else -x.pos - 55] = x.word
    assert {k: len(v) for k, v in got.items()} == {1: len(a) - 55, 2: len(a) - 55, 3: len(a) - 54, 4: len(a) - 55}
    inside = [p for p in got[1] if 81 <= p and p + 55 <= 180]
    assert got[1] == got[2] and len({got[1][p] for p in inside}) == len(inside) and not {got[1][p] for p in inside} & {got[3][p] for p in inside}
    assert all(got[1][p] == got[4][p] for p in got[1] if p + 55 <= 80)


@pytest.mark.parametrize(("template", "stride"), [(56, 1), (56, 11), (44, 7), (29, 1), (29, 300)])
def test_words_across_pieces(spark, template, stride):
    r = random.Random(template + stride)
    seqs = [(i, "".join(r.choice("ACGT" if i != 3 else "ACGTN") for _ in range(n)), i % 2) for i, n in enumerate((template - 1, template, 631, 2900, 576 + template, 577 + template, 575 + template))]
    want = set()
    for i, x, _ in seqs:
        for p in range(0, len(x) - template + 1, stride):
            w = "".join({"A": "0", "G": "0", "C": "1", "T": "1"}.get(c, c) for k, c in enumerate(x[p : p + template]) if k % 3 < 2)
            if set(w) <= {"0", "1"}:
                back = w[::-1].translate(str.maketrans("01", "10"))
                want.add((i, -(p + template) if back < w else p + 1, min(w, back), back < w, i % 2))
    got = words.spaced_words(spark.createDataFrame(seqs, "oid long, seq string, tax_id int"), template, stride, "tax_id")
    assert {tuple(x) for x in got.collect()} == want and got.count() == len(want)


@pytest.mark.parametrize("few", [500_000, 0])
def test_seeds_of_asked_words(spark, few, monkeypatch):
    monkeypatch.setattr(words, "FEW", few)
    r = random.Random(9)
    text = "".join(r.choice("ACGT") for _ in range(1500))
    subjects = spark.createDataFrame([(k, text[k * 40 : 900 + k * 60], k % 3) for k in range(9)], "oid long, seq string, tax_id int")
    query = words.spaced_words(spark.createDataFrame([(1, text[300:420]), (2, text[700:790]), (3, None)], "oid long, seq string"))
    got, want = words.seeds_of(query, subjects), words.seed_join(query, words.build_index(subjects))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 0
    tiered = lambda index: sorted(map(tuple, words.seed_join_tiered(query, index).collect()))
    assert tiered(words.build_index(subjects, asked=query, by="key30")) == tiered(words.build_index(subjects))


def test_words_of_subjects_are_not_dealt_out_before_they_are_asked_for(spark):
    r = random.Random(4)
    text = "".join(r.choice("ACGT") for _ in range(700))
    odd = text[:200] + "é" + text[200:400] + "n" + text[400:] + "NN"
    rows = [(1, text, 1), (2, odd, 1), (3, None, 2), (4, "", 2), (5, text[:300], None), (5, text[:300], None)]
    subjects = spark.createDataFrame(rows, "oid long, seq string, tax_id int")
    query = words.spaced_words(spark.createDataFrame([(1, text[100:180]), (2, odd[190:420])], "oid long, seq string"))
    index = words.build_index(subjects, stride=1, asked=query)
    plan = index._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(code" in plan
    asked = {x.word for x in query.collect()}
    want = {}
    for x in set(words.spaced_words(subjects, 56, 1, "tax_id").collect()):
        if x.word in asked:
            want.setdefault((x.word, x.tax_id), []).append((x.oid, x.pos))
    got = [(x.word, x.tax_id, x.oid, x.pos) for x in index.collect()]
    assert sorted(got, key=str) == sorted(((*k, *p) for k, v in want.items() for p in sorted(v)[:2]), key=str) and got
    start = lambda x: x.pos if x.pos > 0 else -x.pos - 55
    has = {(x.oid, start(x)) for x in words.spaced_words(subjects).collect()}
    assert (2, 145) in has and (2, 202) in has and not any((2, p) in has for p in (201, 402))
    found = words.found_subjects(subjects, spark.createDataFrame([(2,), (2,), (9,)], "s_oid long"))
    assert [(x.oid, x.seq) for x in found.collect()] == [(2, odd)]


@pytest.mark.parametrize("by", ["word", "key30"])
def test_words_that_no_query_asks_for_stay_in_the_pass_over_texts(spark, by, monkeypatch):
    r = random.Random(11)
    texts = ["".join(r.choice("abcdefghijklmnopqrstuvwxyzXYZ ,.é") for _ in range(n)) for n in (900, 70, 30, 4000)]
    rows = [(k, x, k % 2) for k, x in enumerate([*texts, None, "", texts[0][100:700], texts[3] + texts[1]])]
    raw = spark.createDataFrame(rows, "oid long, seq string, tax_id int")
    subjects = adapters.sequences(raw, adapters.bases_of, "seq")
    query = words.spaced_words(adapters.sequences(spark.createDataFrame([(1, texts[0][90:400]), (2, texts[3][2000:2300])], "oid long, text string")))
    whole = words.build_index(raw, stride=1, read=adapters.bases_of)
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(map(tuple, words.build_index(subjects, stride=1).collect()), key=str)
    asked = {getattr(x, by) for x in words.split_key(query).collect()}
    want = sorted((tuple(x) for x in whole.collect() if getattr(x, by) in asked), key=str)
    index = words.build_index(raw, stride=1, asked=query, by=by, read=adapters.bases_of)
    assert "Join" not in index._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, index.collect()), key=str) == want and want
    monkeypatch.setattr(words, "FEW", 0)
    assert sorted(map(tuple, words.build_index(raw, stride=1, asked=query, by=by, read=adapters.bases_of).collect()), key=str) == want
    none = words.build_index(raw, asked=query.limit(0), by=by, read=adapters.bases_of)
    assert none.count() == 0


def test_a_task_deals_out_two_postings_of_a_common_word(spark):
    r = random.Random(6)
    text = "".join(r.choice("ACGT") for _ in range(90))
    rows = [(k // 2, text[: 90 - k % 3], k % 2 if k % 7 else None) for k in range(400)] + [(0, text, 1)] * 3
    subjects = spark.createDataFrame(rows, "oid long, seq string, tax_id int").repartition(4, "oid")
    query = words.spaced_words(spark.createDataFrame([(1, text)], "oid long, seq string"))
    index = words.build_index(subjects, stride=1, asked=query)
    plan = index._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.rindex("WindowGroupLimit") > plan.index("hashpartitioning(code")
    assert sorted(map(tuple, index.collect()), key=str) == sorted(map(tuple, words.build_index(subjects, stride=1).collect()), key=str)


def test_only_found_texts_become_sequences(spark):
    def read(x):
        assert x != b"not found"
        return adapters.bases_of(x)

    raw = spark.createDataFrame([(1, "not found", 5), (2, "a b, Z", 6), (3, None, 7), (4, "not found", 8)], "oid long, seq string, tax_id int")
    found = words.found_subjects(raw, spark.createDataFrame([(2,), (3,)], "s_oid long"), read)
    assert sorted(map(tuple, found.select("oid", "seq", "tax_id").collect())) == [(2, "ACC", 6), (3, None, 7)]


def test_portions_of_batches():
    b = pa.record_batch([pa.array(range(6)), pa.array(["aaa", None, "bb", "cccccccc", "", "é"])], names=["k", "text"])
    got = [[*p.column("k").to_pylist()] for p in adapters.portions([b, b.slice(0, 0), b.slice(4)], "text", 5)]
    assert got == [[0, 1, 2], [3], [4, 5], [4, 5]]


def test_documents_are_not_read_again_for_divisions(spark, monkeypatch):
    sf, read = "/root/testdata/sf0.001", []
    monkeypatch.setattr(queries, "taxa", lambda s, d: read.append(d) or adapters.taxa(s, d))
    assert queries.Q["candidate_taxa"](spark, sf).count() > 0 and len(read) == 1


def test_found_subjects_are_not_kept_for_their_lengths(spark, monkeypatch):
    sf, kept = "/root/testdata/sf0.001", []
    monkeypatch.setattr(words, "settled", lambda df: kept.append(df.columns) or adapters.settled(df))
    assert queries.Q["neighbourhoods"](spark, sf).count() > 0 and kept and not any("seq" in c for c in kept)
