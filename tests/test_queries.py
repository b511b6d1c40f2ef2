"""The queries of rules, files, dataflow pieces and screens against their SQL, and those without SQL against brute force."""

import os

import duckdb
import numpy as np
import pytest

from loomseq.operators import classify, screen, sketch, words
from loomseq.plans.queries import SQL, Q

from test_base import SF, rows

NAMES = ["classify_labels", "classify_rows", "select_divs", "adjust_divs", "division_kinds", "record_positions", "fasta_scan", "tsv_scan", "taxa_scan",
         "locations_scan", "metaline_round_trip", "report_rows", "report_scan", "classified_rows", "actions_scan", "subject_set", "masked_sequences",
         "stored_index", "manifest_of_files", "adapt_stage", "map_groups_if", "counter", "normal_ids", "escaped_tildes", "strides", "reduced_proteins",
         "stream_running_totals", "stream_tee", "in_scope", "repeat_track_union", "indexable_pieces", "repeat_windows", "augmented_seeds", "entropy_narrow", "entropy_wide", "low_complexity_report",
         "hot_list", "select_subjects", "maximal_stretches", "packed_fetch", "two_bit_codes", "words_of_any_letters", "div_intervals", "interval_report", "merged_islands", "end_islands", "index_build"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in os.listdir(SF):
        con.execute(f"create view {t.split('.')[0]} as select * from '{SF}/{t}'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_against_sql(name, spark, duck):
    got = rows(Q[name](spark, SF).toPandas())
    assert got == rows(duck.execute(SQL[name]).fetchdf()) and got


def test_every_class_occurs(spark):
    found = {r.result for r in Q["classify_labels"](spark, "/root/testdata/sf0.01").select("result").distinct().collect()}
    every = {*classify.LABELS["primary"], *classify.LABELS["contaminant"], "repeat", "low-coverage", "inconclusive", "inconclusive(metagenome)"}
    assert found >= every - {"contaminant", "contaminant(low-coverage)"}


def test_actions_with_another_length_are_an_error(spark):
    seqs = spark.createDataFrame([("a", "ACGT"), ("b", "AC")], "seq_id string, seq string")
    acts = spark.createDataFrame([("a", 5, "TRIM")], "seq_id string, seq_len long, action string")
    with pytest.raises(Exception, match="length differs"):
        screen.with_actions(seqs, acts).collect()
    assert screen.with_actions(seqs, acts.filter("seq_len < 5")).count() == 2


def _reference(proteins: list[str]) -> str:
    """A signature, number by number."""
    mask = (1 << 64) - 1

    def mixed(v):
        v = (v + 0x9E3779B97F4A7C15) & mask
        v = ((v ^ v >> 30) * 0xBF58476D1CE4E5B9) & mask
        v = ((v ^ v >> 27) * 0x94D049BB133111EB) & mask
        return v ^ v >> 31

    group = {c: k for k, cs in enumerate(["CFYW*", "MLIV", "GPATSN", "EDHQRK"]) for c in cs}
    words = set()
    for p in proteins:
        digits = [group.get(c, 3) for c in p + "*"]
        words |= {sum(x << 2 * (14 - j) for j, x in enumerate(digits[i : i + 15])) for i in range(len(digits) - 14)}
    hashes = [mixed(w) for w in words]
    return "".join(sketch.DIGITS[min(mixed(h ^ i << 32) for h in hashes) & 63] for i in range(1024))


def test_protein_signatures_and_pairs(spark):
    rng = np.random.default_rng(4)
    made = ["".join(rng.choice(list("ACDEFGHIKLMNPQRSTVWYX"), 45)) for _ in range(4)]
    sets = {1: made[:3], 2: made[1:], 3: [made[3], made[3], None], 4: ["short"]}
    df = spark.createDataFrame([(k, p) for k, ps in sets.items() for p in ps], "id long, seq string")
    got = {r.id: r.signature for r in sketch.protein_signatures(df).collect()}
    assert got == {k: _reference([p for p in ps if p]) for k, ps in sets.items() if k != 4}
    same = lambda a, b: sum(x == y for x, y in zip(got[a], got[b], strict=True)) / 1024
    want = {(a, b) for a in got for b in got if a < b and same(a, b) - (1 - same(a, b)) / 64 >= 0.3}
    pairs = sketch.similar_pairs(spark.createDataFrame(list(got.items()), "id long, signature string"))
    assert {(r.id_1, r.id_2) for r in pairs.collect()} == want and want


def test_bottom_sketch_keeps_the_least(spark):
    h = np.random.default_rng(1).integers(-(1 << 63), 1 << 63, 500)
    df = spark.createDataFrame([(1, int(x)) for x in h], "id long, h long")
    got = sorted(np.uint64(r.h & (1 << 64) - 1) for r in sketch.bottom_sketch(df, 40, 4).collect())
    assert got == sorted(h.view(np.uint64))[:40]


def test_entropy_track_is_the_same_in_pieces(spark):
    rng = np.random.default_rng(2)
    letters = lambda n: "".join(rng.choice(list("ACGTN"), n, p=[0.24, 0.24, 0.24, 0.24, 0.04]))
    seqs = [(1, letters(500) + "AC" * 90 + letters(300) + "A" * 120), (2, "ACG"), (3, ""), (4, "AT" * 400), (5, letters(49))]
    df = spark.createDataFrame(seqs, "oid long, seq string")
    one = sorted(map(tuple, words.entropy_track(df).collect()))
    assert one == sorted(map(tuple, words.entropy_track(df, chunk=60).collect()))
    assert {o for o, _, _ in one} == {1, 2, 4} and (4, 1, 800) in one
    assert words.entropy_track(df.filter("oid = 3")).count() == 0
