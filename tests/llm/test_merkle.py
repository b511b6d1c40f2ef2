"""The manifest against a tree built by hand, with several storeys, odd rows and other fan-outs."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from loomseq.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, place int, size string"


def digest(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], row[1])))


def tree(nodes, fanout):
    """The root and the siblings of each leaf."""
    proofs, at = [""] * len(nodes), list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + fanout] for i in range(0, len(nodes), fanout)]
        for i, a in enumerate(at):
            proofs[i] += "".join(x for k, x in enumerate(runs[a // fanout]) if k != a % fanout)
        at, nodes = [a // fanout for a in at], [digest("".join(r)) for r in runs]
    return nodes[0], proofs


def by_hand(rows, fanout):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    made = [(g, *tree([x[2] for x in sorted(groups[g])], fanout)) for g in names]
    root, tops = tree([m[1] for m in made], fanout)
    return sorted((x[1] if x[0] else None, x[2], m[1], root, p + top) for m, top in zip(made, tops, strict=True) for x, p in zip(sorted(groups[m[0]]), m[2], strict=True))


def made(n, langs, seed):
    r = random.Random(seed)
    out = [(i, r.choice([None, "", "x" * r.randrange(50), "é: 1"]), r.choice(langs), r.choice([None, "s"]), r.choice([None, 5, (1 << 63) - 1]), "clash", 1, "k") for i in range(n)]
    return [*out, *out[:3], (0, "the same id", langs[0], "s", 1, None, None, None), (9, "long " * 100_000, langs[0], None, 0, None, None, None)]


@pytest.mark.parametrize(("n", "langs", "fanout", "block"), [(60, ["a", None, "", "é", "b"], 2, 4), (41, ["a"], 3, 3), (30, [f"l{i}" for i in range(20)], 2, 2), (0, ["one"], 2, 4096)])
def test_manifest(spark, n, langs, fanout, block):
    rows = made(n, langs, n)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = merkle.manifest(df, F.col("lang"), F.col("doc_id"), merkle.leaf([F.col(c) for c in merkle.COLUMNS]), fanout=fanout, block=block)
    found = merkle.verify(got, fanout).collect()
    assert sorted((r.key, r.leaf, r.subroot, r.root, r.proof) for r in found) == by_hand(rows, fanout)
    assert all(r.verified and r.folded_root == r.root for r in found)


def test_query_finds_what_was_tampered_with(spark):
    rows = [r for r in made(50, ["a", "b", None], 3) if r[0]]
    got = merkle.document_manifest(spark.createDataFrame(rows, SCHEMA)).collect()
    want = {(r[0], leaf(r)): r for r in rows}
    proofs = {(k, x): (s, t, p) for k, x, s, t, p in by_hand(rows, 2)}
    hit = 0
    for r in got:
        row = want[r.doc_id, r.leaf]
        s, t, p = proofs[r.doc_id, r.leaf]
        changed = zlib.crc32(str(r.doc_id).encode()) % 7 == 0 and row[4] is not None
        hit += changed
        assert (r.subroot, r.root, r.verified) == (s, t, not changed) and (r.proof_sha256 == digest(p) or len([x for x in rows if x == row]) > 1)
        assert (r.folded_root == t) is not changed
    assert 0 < hit < len(got) == len(rows)


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert merkle.document_manifest(empty).count() == 0
    no_id = spark.createDataFrame([(None, None, None, None, None, None, None, None)] * 2 + [(1, "a", None, None, None, None, None, None)], SCHEMA)
    got = merkle.document_manifest(no_id).collect()
    assert len(got) == 3 and [r.doc_id for r in got].count(None) == 2 and {r.root for r in got} == {r.subroot for r in got}
    one = merkle.document_manifest(no_id.filter("doc_id = 1")).first()
    assert one.leaf == one.root and one.proof_sha256 == digest("")
