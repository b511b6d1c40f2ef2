"""A Merkle manifest of a data set: digests of rows, a tree for each group, a tree over the groups' roots, and proofs.

The leaf of a row is the sha256 of its columns, each written as its byte count, a colon and its value, or as `-` where it is null.
Within a group leaves ascend by key; every FANOUT consecutive nodes, and what is left at the end, become one node, the sha256 of
their hex digests, until one node remains. The groups' roots, in order of the group (null first, then by bytes), make the tree
above in the same way.

Leaves get their place in the group from range partitions, whose counts are summed. They are cut into aligned blocks of a power of
FANOUT; a block is one contiguous matrix of digests, which is reshaped by the fan-out and hashed level by level. Blocks' roots are the
leaves of the next storey, so a group of any size takes a few storeys and no task ever holds more than a block. From the
top storey down each block gets the siblings above it, and index arithmetic gives every sibling inside it.

Defined results: a null group is a group of its own, before all others; null keys come first; rows with one key are ordered by leaf,
and repeated rows are leaves of their own; a lone leaf is the root of its group; a tree of one node has the proof of an empty text; columns that
are not named are ignored; an empty table gives an empty manifest.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.dataflow import ordinal
from .common import groups, release, written

FANOUT, BLOCK = 2, 4096
#: Columns of a document that its leaf holds, in this order.
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
PROOFS = "key long, leaf string, later string, place long, size long, branch long, branches long, subroot string, root string, proof string"


def leaf(columns: list[Column]) -> Column:
    """The hex digest of the columns' values."""
    text = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*(F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in text)), 256)


def _height(fanout: int, block: int) -> int:
    """Levels of the largest aligned block of at most so many leaves."""
    h = 1
    while fanout ** (h + 1) <= block:
        h += 1
    return h


def _above(digests: np.ndarray, fanout: int) -> np.ndarray:
    """The next level of (n, 64) hex digits."""
    full = len(digests) // fanout
    rows = [r.tobytes() for r in digests[: full * fanout].reshape(full, 64 * fanout)]
    if full * fanout < len(digests):
        rows.append(digests[full * fanout :].tobytes())
    return np.frombuffer("".join(sha256(r).hexdigest() for r in rows).encode(), np.uint8).reshape(-1, 64)


def _levels(digests: np.ndarray, fanout: int, size: int, height: int) -> list[np.ndarray]:
    """All levels of a block of a tree with so many nodes: up to its root, or to the top of the block where the tree has more blocks."""
    out = [digests]
    while len(out) <= height if size > fanout**height else len(out[-1]) > 1:
        out.append(_above(out[-1], fanout))
    return out


def _siblings(levels: list[np.ndarray], fanout: int) -> list[bytes]:
    """For each leaf of the block its siblings, level by level, left to right."""
    n = len(levels[0])
    found, there = np.empty((n, (len(levels) - 1) * (fanout - 1), 64), np.uint8), np.empty((n, (len(levels) - 1) * (fanout - 1)), bool)
    other = np.arange(fanout - 1)
    at = np.arange(n)
    for k, level in enumerate(levels[:-1]):
        place = at % fanout
        member = (at - place)[:, None] + other + (other >= place[:, None])
        span = slice(k * (fanout - 1), (k + 1) * (fanout - 1))
        there[:, span] = member < len(level)
        found[:, span] = level[np.where(there[:, span], member, 0)]
        at = at // fanout
    whole = there.all(1)
    return [found[i].tobytes() if whole[i] else found[i][there[i]].tobytes() for i in range(n)]


def fold(digest: str, steps: list[tuple[int, int]], proof: str, fanout: int = FANOUT) -> str:
    """The root that a digest and its proof give; steps: (place, size) in each tree from below, whose levels follow from the sizes."""
    at = 0
    for place, size in steps:
        while size > 1:
            first = place - place % fanout
            others = min(fanout, size - first) - 1
            left = 64 * (place - first)
            run = proof[at : at + 64 * others]
            digest = sha256((run[:left] + digest + run[left:]).encode()).hexdigest()
            at, place, size = at + 64 * others, place // fanout, -(-size // fanout)
    return digest


def _matrix(column) -> np.ndarray:
    return np.frombuffer("".join(column.to_pylist()).encode(), np.uint8).reshape(-1, 64)


def _storeys(nodes: DataFrame, fanout: int, height: int, most: int, name: str, tag: str) -> list[DataFrame]:
    """nodes: (tree, place, size, digest) and maybe (key, later). For each storey the blocks' rows: their digests, the values carried,
    and top, the digest of the block."""
    block, out = fanout**height, []
    while True:
        carried = "key" in nodes.columns
        kind = "tree long, block long, size long, digests array<string>, top string" + (", keys array<long>, later array<string>" if carried else "")

        def pack(batches, carried=carried):
            for (tree, number, size), t in groups(batches, ["tree", "block", "size"]):
                top = _levels(_matrix(t.column("digest")), fanout, size, height)[-1].tobytes().decode()
                row = {"tree": [tree], "block": [number], "size": [size], "digests": [t.column("digest").to_pylist()], "top": [top]}
                types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.string()]
                if carried:
                    row |= {"keys": [t.column("key").to_pylist()], "later": [t.column("later").to_pylist()]}
                    types += [pa.list_(pa.int64()), pa.list_(pa.string())]
                yield pa.record_batch([pa.array(v, k) for v, k in zip(row.values(), types, strict=True)], names=list(row))

        cut = nodes.withColumn("block", F.floor(F.col("place") / block).cast("long"))
        out.append(written(cut.repartition("tree", "block").sortWithinPartitions("tree", "block", "place").mapInArrow(pack, kind), f"{name}{len(out)}", tag))
        if most <= block:
            return out
        most = -(-most // block)
        nodes = out[-1].select("tree", F.col("block").alias("place"), F.ceil(F.col("size") / block).cast("long").alias("size"), F.col("top").alias("digest")).filter("size > 1")


def _roots(storeys: list[DataFrame], fanout: int, height: int) -> DataFrame:
    """(tree, subroot): the block that is the last of its tree."""
    alone = F.col("size") <= fanout**height
    out = [s.filter(alone).select("tree", F.col("top").alias("subroot")) for s in storeys]
    for s in out[1:]:
        out[0] = out[0].unionAll(s)
    return out[0]


def _down(storeys: list[DataFrame], above: DataFrame, fanout: int, height: int, name: str, tag: str) -> DataFrame:
    """(tree, block, tail) for the blocks of the lowest storey; above: (tree, tail) with what follows the siblings inside the tree."""
    block = fanout**height
    alone = F.col("size") <= block
    tails = None
    for k in range(len(storeys) - 1, -1, -1):
        last = storeys[k].filter(alone).select("tree", "block").join(above, "tree")
        tails = last if tails is None else tails.unionByName(last)
        if k == 0:
            return tails

        def spread(batches):
            for b in batches:
                for tree, number, size, digests, tail in zip(*(b.column(c).to_pylist() for c in ("tree", "block", "size", "digests", "tail")), strict=True):
                    sib = _siblings(_levels(_matrix(pa.array(digests)), fanout, size, height), fanout)
                    first = number * block
                    yield pa.record_batch([pa.array([tree] * len(sib), pa.int64()), pa.array(range(first, first + len(sib)), pa.int64()), pa.array([s.decode() + tail for s in sib], pa.string())], names=["tree", "block", "tail"])

        rows = storeys[k].select("tree", "block", "size", "digests").join(tails, ["tree", "block"])
        tails = written(rows.mapInArrow(spread, "tree long, block long, tail string"), f"{name}{k}", tag)
    return tails


def manifest(rows: DataFrame, group: Column, key: Column, digest: Column, later: Column | None = None, fanout: int = FANOUT, block: int = BLOCK, tag: str = "") -> DataFrame:
    """One row for each row: key, leaf, later, place and size (in the tree of its group), branch and branches (the group's place in the tree
    of groups), subroot, root, and proof, the hex digests of all siblings. later: another digest that is carried along, to be held against the
    manifest."""
    spark, height = rows.sparkSession, _height(fanout, block)
    later = F.lit(None) if later is None else later
    name = F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))
    narrow = written(rows.select(name.alias("name"), key.cast("long").alias("key"), digest.alias("digest"), later.cast("string").alias("later"), F.monotonically_increasing_id().alias("u")), "leaves", tag)
    order = ["name", "key", "digest", "u"]
    placed = written(narrow.repartitionByRange(*order).sortWithinPartitions(*order).drop("u").withColumn("at", F.monotonically_increasing_id()), "placed", tag)
    part = F.shiftright("at", 33).alias("part")
    counts = written(placed.groupBy("name", part).agg(F.count("*").alias("n"), F.min("at").alias("first")), "counts", tag)
    sizes = written(ordinal(counts.groupBy("name").agg(F.sum("n").alias("size")), ["name"], "tree").withColumn("tree", F.col("tree") - 1), "trees", tag)
    whole = sizes.agg(F.max("size").alias("most"), F.count("*").alias("trees")).first()
    if not whole.trees:
        return spark.createDataFrame([], PROOFS)
    before = F.coalesce(F.sum("n").over(Window.partitionBy("name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("name", "part", (F.col("first") - before).alias("zero")).join(sizes, "name")
    leaves = placed.withColumn("part", part).join(starts, ["name", "part"]).select("tree", (F.col("at") - F.col("zero")).alias("place"), "size", "digest", "key", "later")
    low = _storeys(leaves, fanout, height, whole.most, "block", tag)
    subroots = written(_roots(low, fanout, height), "subroots", tag)
    high = _storeys(subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), F.lit(whole.trees).cast("long").alias("size"), F.col("subroot").alias("digest")), fanout, height, whole.trees, "branch", tag)
    root = _roots(high, fanout, height).first().subroot
    tops = _down(high, spark.range(1).select(F.col("id").alias("tree"), F.lit("").alias("tail")), fanout, height, "tops", tag)
    tops = _leaves(high[0].join(tops, ["tree", "block"]), fanout, height)
    above = written(tops.select(F.col("place").alias("tree"), F.col("proof").alias("tail")), "above", tag)
    tails = _down(low, above, fanout, height, "tails", tag)
    out = _leaves(low[0].join(tails, ["tree", "block"]).join(subroots, "tree"), fanout, height)
    trees = F.lit(whole.trees).cast("long")
    return out.select("key", "leaf", "later", "place", "size", F.col("tree").alias("branch"), trees.alias("branches"), "subroot", F.lit(root).alias("root"), "proof")


def _leaves(blocks: DataFrame, fanout: int, height: int) -> DataFrame:
    """Blocks with their tails, back as one row for each leaf with its whole proof."""
    block = fanout**height
    for c, kind in (("keys", "array<long>"), ("later", "array<string>"), ("subroot", "string")):
        if c not in blocks.columns:
            blocks = blocks.withColumn(c, F.lit(None).cast(kind))

    def each(batches):
        for b in batches:
            for row in b.to_pylist():
                n = len(row["digests"])
                sib = _siblings(_levels(_matrix(pa.array(row["digests"])), fanout, row["size"], height), fanout)
                first = row["block"] * block
                nothing = [None] * n
                columns = [row["keys"] or nothing, row["digests"], row["later"] or nothing, range(first, first + n), [row["size"]] * n, [row["tree"]] * n, [row["subroot"]] * n, [s.decode() + row["tail"] for s in sib]]
                kinds = [pa.int64(), pa.string(), pa.string(), *[pa.int64()] * 3, pa.string(), pa.string()]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["key", "leaf", "later", "place", "size", "tree", "subroot", "proof"])

    return blocks.mapInArrow(each, "key long, leaf string, later string, place long, size long, tree long, subroot string, proof string")


def verify(proofs: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """The rows of a manifest with folded_root, which the later digest (or the leaf, where there is none) and the proof give, and
    verified, whether it is the root."""
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in proofs.schema)}, folded_root string"

    def each(batches):
        for b in batches:
            columns = {c: b.column(c).to_pylist() for c in ("leaf", "later", "place", "size", "branch", "branches", "proof")}
            roots = [fold(t or x, [(p, s), (q, r)], proof, fanout) for x, t, p, s, q, r, proof in zip(*columns.values(), strict=True)]
            yield pa.record_batch([*b.columns, pa.array(roots, pa.string())], names=[*b.schema.names, "folded_root"])

    return proofs.mapInArrow(each, schema).withColumn("verified", F.col("folded_root") == F.col("root"))


def document_manifest(docs: DataFrame, tag: str = "merkle") -> DataFrame:
    """The manifest of documents by language, with every seventh document tampered with (by crc32 of its doc_id): n_chars + 1."""
    release(docs.sparkSession, tag)
    columns = {c: F.col(c) for c in COLUMNS}
    more = columns | {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    hit = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    later = F.when(hit, leaf(list(more.values())))
    out = verify(manifest(docs, F.col("lang"), F.col("doc_id"), leaf(list(columns.values())), later, tag=tag))
    return out.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")


_PARTS = " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in COLUMNS)
_LATER = _PARTS.replace("CAST(n_chars AS VARCHAR)", "CAST(CAST(n_chars AS HUGEINT) + 1 AS VARCHAR)")
#: Every level of both trees as rows; siblings are the other nodes of the same pair; crc32 is the usual one, bit by bit.
ORACLE = f"""
WITH RECURSIVE crc AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS s, 0 AS k, CAST(4294967295 AS BIGINT) AS c FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
  UNION ALL SELECT doc_id, s, k + 1, list_reduce([xor(c, CAST(ascii(s[k + 1]) AS BIGINT)), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda a, b: xor(a >> 1, CASE WHEN a & 1 = 1 THEN CAST(3988292384 AS BIGINT) ELSE CAST(0 AS BIGINT) END)) FROM crc WHERE k < length(s)),
hit AS (SELECT doc_id FROM crc WHERE k = length(s) AND xor(c, CAST(4294967295 AS BIGINT)) % 7 = 0),
leaves AS (SELECT d.doc_id, coalesce('=' || lang, '') AS g, sha256({_PARTS}) AS leaf, CASE WHEN h.doc_id IS NULL THEN sha256({_PARTS}) ELSE sha256({_LATER}) END AS later
  FROM (SELECT * FROM documents) d LEFT JOIN hit h USING (doc_id)),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n, dense_rank() OVER (ORDER BY g) - 1 AS branch FROM leaves),
low AS (SELECT g, 0 AS l, i, leaf AS d, n FROM placed
  UNION ALL SELECT g, l + 1, i // 2, sha256(string_agg(d, '' ORDER BY i)), (n + 1) // 2 FROM low WHERE n > 1 GROUP BY g, l, i // 2, n),
sub AS (SELECT g, d AS subroot, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM low WHERE n = 1),
high AS (SELECT 0 AS l, i, subroot AS d, n FROM sub
  UNION ALL SELECT l + 1, i // 2, sha256(string_agg(d, '' ORDER BY i)), (n + 1) // 2 FROM high WHERE n > 1 GROUP BY l, i // 2, n),
root AS (SELECT d AS root FROM high WHERE n = 1),
steps AS (SELECT p.g, p.i AS leaf_at, l.l, coalesce(s.d, '') AS d, l.i % 2 AS place FROM placed p JOIN low l ON l.g = p.g AND l.n > 1 AND l.i = p.i >> l.l LEFT JOIN low s ON s.g = l.g AND s.l = l.l AND s.i = xor(l.i, 1)
  UNION ALL SELECT p.g, p.i, 1000 + h.l, coalesce(s.d, ''), h.i % 2 FROM placed p JOIN high h ON h.n > 1 AND h.i = p.branch >> h.l LEFT JOIN high s ON s.l = h.l AND s.i = xor(h.i, 1)),
way AS (SELECT g, leaf_at, list(d ORDER BY l) AS ds, list(place ORDER BY l) AS places FROM steps GROUP BY g, leaf_at),
walk AS (SELECT p.g, p.i, 0 AS k, later AS d, coalesce(ds, []) AS ds, places FROM placed p LEFT JOIN way w ON w.g = p.g AND w.leaf_at = p.i
  UNION ALL SELECT g, i, k + 1, sha256(CASE places[k + 1] WHEN 0 THEN d || ds[k + 1] ELSE ds[k + 1] || d END), ds, places FROM walk WHERE k < len(ds))
SELECT p.doc_id, p.leaf, s.subroot, r.root, sha256(array_to_string(w.ds, '')) AS proof_sha256, w.d AS folded_root, w.d = r.root AS verified
FROM placed p JOIN sub s USING (g) CROSS JOIN root r JOIN walk w ON w.g = p.g AND w.i = p.i AND w.k = len(w.ds)
"""
