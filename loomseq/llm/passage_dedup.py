"""Repeated passages by suffix arrays.

Every byte covered by a string of ``length`` bytes that also starts anywhere else goes. Strings are compared within one
task by a suffix array of that task's shard; what makes equal strings meet in a shard is an anchor: the least hash of all
64-byte runs inside the string. A text is cut into runs of neighbouring strings with one anchor. Only anchors that occur more
than once are looked at, and of runs with equal bytes (copies) one goes on with their count. Shards of such runs get a suffix
array by induced sorting and permuted common prefixes; a string is repeated when it shares ``length`` bytes with a neighbour.

A string reaches 232 bytes (half of length and anchor together) from its anchor to the left or to the right. So of runs in which
the anchor stands once, only those go on that share the hash of these bytes on one side with another run of the anchor; any
run goes on whose anchor stands several times in some run.

An anchor with many different runs (a passage inside many texts) is dealt into sub-shards of at most HOT runs. Strings that
are alone in their sub-shard are then checked against the other sub-shards: each sub-shard names its distinct strings by hash,
in blocks dealt by hash, and gets back those that another one has too. No anchor, text or copy group meets in one task.

Defined results: null text counts as empty; texts shorter than ``length`` lose nothing; strings are judged on the input, and
occurrences may overlap or lie in one text; rows with equal text are occurrences of their own (all their bytes go from
``length`` bytes on); extra columns are untouched; an empty table gives an empty result. Texts and runs are told apart by
two 64-bit hashes each.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import free, groups, release, rows_of, written
from .suffix_array import common_prefixes, suffix_array

LENGTH, GRAM = 400, 64
SEGMENT = 2 << 20
HOT, SHARD_BYTES, TASK_BYTES = 256, 1 << 20, 3 << 20
MULT = 0x9E3779B97F4A7C15


def rolling(b: np.ndarray, size: int, mult: int = MULT) -> np.ndarray:
    """Polynomial hashes mod 2^64 of all runs of size bytes, by doubling; mixed."""
    power, have, out, done = mult, b.astype(np.uint64) + np.uint64(1), None, 0
    width = 1
    while True:
        if size & width:
            if out is None:
                out, done = have, width
            else:  # what is done stands in front
                n = len(b) - done - width + 1
                out = out[:n] * np.uint64(power) + have[done : done + n]
                done += width
        if width * 2 > size:
            break
        n = len(have) - width
        have = have[:n] * np.uint64(power) + have[width:]
        power = power * power % (1 << 64)
        width *= 2
    out = (out ^ (out >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return out ^ (out >> np.uint64(33))


def sliding_least(h: np.ndarray, window: int) -> np.ndarray:
    have, width = h, 1
    while width * 2 <= window:
        have = np.minimum(have[:-width], have[width:])
        width *= 2
    rest = window - width
    return np.minimum(have[: len(have) - rest], have[rest:]) if rest else have


def reach(length: int, gram: int = GRAM) -> int:
    """Bytes that every string has on the left (with the anchor) or on the right of its anchor."""
    return (length + gram) // 2


def runs(b: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(anchor, first start, number of starts, whether the anchor stands more than once in it, place of the anchor or -1) of runs of
    neighbouring strings with one anchor."""
    most = length - gram + 1
    h = rolling(b, gram)
    least = sliding_least(h, most)
    first = np.flatnonzero(np.diff(least, prepend=~least[:1]))
    n = np.diff(np.append(first, len(least)))
    # places of anchors: where a hash is the least of some window, that is the greatest of the minima of its windows
    edge = np.full(most - 1, np.uint64(0))
    place = np.flatnonzero(h == ~sliding_least(~np.concatenate([edge, least, edge]), most))
    low = np.searchsorted(first, np.maximum(place - most + 1, 0), side="right") - 1
    high = np.searchsorted(first, np.minimum(place, len(least) - 1), side="right") - 1
    times, stands = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
    for d in range(int((high - low).max()) + 1):
        r = np.minimum(low + d, len(first) - 1)
        here = (low + d <= high) & (h[place] == least[first[r]])
        np.add.at(times, r[here], 1)
        stands[r[here]] = place[here]
    again = times > 1
    stands[again] = -1
    if (n > most).any():  # only where the text repeats itself
        part = -(-n // most)
        up = np.repeat(np.arange(len(n)), part)
        k = np.arange(len(up)) - np.repeat(np.cumsum(part) - part, part)
        first, n, again, stands = first[up] + k * most, np.minimum(most, n[up] - k * most), again[up], stands[up]
    return least[first].view(np.int64), first, n, again, stands


def keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.xxhash64(text).alias("k"), F.xxhash64(F.lit(1), text).alias("k2"), "doc_id", "text")


def _runs_of(docs: DataFrame, length: int) -> DataFrame:
    wide = reach(length)

    def find(batches):
        for b in rows_of(batches, SEGMENT):
            row, out = [], [[] for _ in range(7)]
            for i, t in enumerate(b.column(3).to_pylist()):
                raw = t.encode() if t else b""
                for base in range(0, max(1, len(raw) - length + 1), SEGMENT):
                    part = raw[base : base + SEGMENT + length - 1]
                    if len(part) < length:
                        continue
                    x = np.frombuffer(part, np.uint8)
                    anchor, first, n, again, place = runs(x, length)
                    far, view = rolling(x, wide).view(np.int64), memoryview(part)
                    row.append(np.full(len(n), i))
                    hashes = [xxhash.xxh3_64_intdigest(view[i : i + m + length - 1]) for i, m in zip(first.tolist(), n.tolist(), strict=True)]
                    left = place + GRAM - wide
                    for k, v in enumerate((anchor, np.array(hashes, np.uint64).view(np.int64), first + base, n, again)):
                        out[k].append(v)
                    for k, at, ok in ((5, left, (left >= 0) & (place >= 0)), (6, place, (place >= 0) & (place < len(far)))):
                        out[k].append(np.where(ok, far[np.where(ok, at, 0)], 0))
            if row:
                cols = [pa.array(np.concatenate(v)) for v in out]
                at = pa.array(np.concatenate(row))
                yield pa.record_batch([*(b.column(c).take(at) for c in range(3)), *cols], names=["k", "k2", "doc_id", "anchor", "run", "lo", "n", "again", "left", "right"])

    # 0 stands for no such bytes; a real hash of 0 would only add a run that need not be looked at
    return keyed(docs).mapInArrow(find, "k long, k2 long, doc_id long, anchor long, run long, lo long, n long, again boolean, left long, right long")


def repeated_starts(parts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each byte string, whether the string of that length at each of its starts also starts elsewhere in parts."""
    text = np.concatenate([np.append(np.frombuffer(p, np.uint8).astype(np.int64) + 2, 1) for p in parts] + [np.zeros(1, np.int64)])
    sa = suffix_array(text, 258)
    p = common_prefixes(text, sa, max(map(len, parts)) + 2, 1)
    long = p >= length
    mark = long.copy()
    by_rank = long[sa]
    mark[sa[:-1][by_rank[1:]]] = True  # the suffix before a marked one shares as much
    at, out = 0, []
    for x in parts:
        out.append(mark[at : at + max(0, len(x) - length + 1)])
        at += len(x) + 1
    return out


def pairs(mark: np.ndarray) -> list[int]:
    """[a0, b0, a1, b1, ...] of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mark.astype(np.int8), [0]])))
    return edge.tolist()


def _suffix_marks(contexts: DataFrame, length: int, tasks: int) -> DataFrame:
    """(anchor, run, marks, sub, range, hashes): marks of runs that occur once; of split anchors also the blocks of hashes."""
    schema = "anchor long, run long, marks array<int>, sub int, range int, hashes binary"

    def solve(batches):
        held, size = [], 0

        def flush():
            nonlocal held, size
            parts, where = [], []
            for key, rows in held:
                where += [(key, r) for r in rows]
                parts += [r[2] for r in rows]
            marks = repeated_starts(parts, length)
            out = [(key[0], r[0], pairs(m), key[1], None, None) for (key, r), m in zip(where, marks, strict=True) if r[1] == 1 and m.any()]
            for key, rows in held:
                if rows[0][3] > 1:
                    h = np.unique(np.concatenate([rolling(np.frombuffer(r[2], np.uint8), length) for r in rows]))
                    ranges = -(-rows[0][3] // 4)
                    to = ((h >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
                    cut = np.searchsorted(to, np.arange(ranges + 1))
                    out += [(key[0], None, None, key[1], r, h[cut[r] : cut[r + 1]].tobytes()) for r in range(ranges) if cut[r + 1] > cut[r]]
            held, size = [], 0
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.int32(), pa.int32(), pa.binary())
            return pa.record_batch([pa.array([x[c] for x in out], t) for c, t in enumerate(kinds)], names=["anchor", "run", "marks", "sub", "range", "hashes"])

        for key, t in groups(batches, ["anchor", "sub"]):
            rows = {}
            for r in zip(*(t.column(c).to_pylist() for c in ("run", "c", "bytes", "subs")), strict=True):
                rows[r[0]] = r
            held.append((key, list(rows.values())))
            size += sum(len(r[2]) for r in rows.values())
            if size >= SHARD_BYTES:
                yield flush()
        if held:
            yield flush()

    return contexts.select("anchor", "sub", "run", "c", "bytes", "subs").repartition(tasks, "anchor", "sub").sortWithinPartitions("anchor", "sub").mapInArrow(solve, schema)


def _cross_marks(contexts: DataFrame, solved: DataFrame, length: int) -> DataFrame:
    """(anchor, run, marks) of strings that another sub-shard of their anchor has."""

    def meet(batches):
        for (anchor, _), t in groups(batches, ["anchor", "range"]):
            subs = t.column("sub").to_pylist()
            h = [np.frombuffer(x, np.uint64) for x in t.column("hashes").to_pylist()]
            got, n = np.unique(np.concatenate(h), return_counts=True)
            got = got[n > 1]
            out = [(anchor, s, x.tobytes()) for s, y in zip(subs, h, strict=True) if len(x := np.intersect1d(y, got, assume_unique=True))]
            yield pa.record_batch([pa.array([x[c] for x in out], t) for c, t in enumerate((pa.int64(), pa.int32(), pa.binary()))], names=["anchor", "sub", "hits"])

    def mark(batches):
        for (anchor, _), t in groups(batches, ["anchor", "sub"]):
            hits = [np.frombuffer(x, np.uint64) for x in t.column("hits").to_pylist() if x is not None]
            if not hits:
                continue
            known = np.sort(np.concatenate(hits))
            out = []
            for run, c, raw in zip(*(t.column(x).to_pylist() for x in ("run", "c", "bytes")), strict=True):
                if raw is not None and c == 1:
                    h = rolling(np.frombuffer(raw, np.uint8), length)
                    m = known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h
                    if m.any():
                        out.append((anchor, run, pairs(m)))
            yield pa.record_batch([pa.array([x[c] for x in out], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.list_(pa.int32())))], names=["anchor", "run", "marks"])

    blocks = solved.filter("hashes is not null").select("anchor", "range", "sub", "hashes")
    hits = blocks.repartition("anchor", "range").sortWithinPartitions("anchor", "range").mapInArrow(meet, "anchor long, sub int, hits binary")
    split = contexts.filter("subs > 1").select("anchor", "sub", "run", "c", "bytes")
    both = split.withColumn("hits", F.lit(None).cast("binary")).unionByName(hits, allowMissingColumns=True)
    return both.repartition("anchor", "sub").sortWithinPartitions("anchor", "sub").mapInArrow(mark, "anchor long, run long, marks array<int>")


def _asked(classes: DataFrame) -> DataFrame:
    """(anchor, run, c, k, subs) of the runs whose bytes are needed; subs: sub-shards of their anchor."""
    several = classes.filter("several")
    sides = F.array(F.struct(F.lit(0).alias("side"), F.col("left").alias("key")), F.struct(F.lit(1).alias("side"), F.col("right").alias("key")))
    keys = several.filter("not again").select("anchor", "run", F.explode(sides).alias("at")).select("anchor", "run", "at.side", "at.key").filter("key <> 0")
    shared = keys.groupBy("anchor", "side", "key").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    chosen = keys.join(shared, ["anchor", "side", "key"], "left_semi").select("anchor", "run").unionAll(several.filter("again").select("anchor", "run")).distinct()
    asked = several.select("anchor", "run", "c", "k").join(chosen, ["anchor", "run"])
    # an anchor all of whose runs have copies needs no suffix array: all their strings are repeated
    subs = asked.groupBy("anchor").agg(F.ceil(F.count("*") / HOT).cast("int").alias("subs"), F.min("c").alias("least")).filter("least = 1").drop("least")
    return asked.join(subs, "anchor")


def spans(docs: DataFrame, length: int = LENGTH, tag: str = "") -> DataFrame:
    """(k, k2, spans): of each text with repeated strings, runs of their starts as array<struct<a, b>>, b exclusive; written. Tables
    and shuffle files of the steps go as soon as nothing reads them."""
    spark, own = docs.sparkSession, f"spans-{uuid.uuid4().hex}"

    def step(df: DataFrame, name: str, until: str = "") -> DataFrame:
        out = written(df, name, own + until)
        free(spark)
        return out

    found = _runs_of(docs, length).groupBy("k", "k2", "anchor", "run", "lo", "n").agg(F.count("*").alias("rows"), F.min("doc_id").alias("rep"), F.max("again").alias("again"), F.min("left").alias("left"), F.min("right").alias("right"))
    found = step(found, "runs", ":live")
    often = found.groupBy("anchor").agg(F.sum("rows").alias("total"), F.min("run").alias("x"), F.max("run").alias("y"), F.max("again").alias("again")).filter("total > 1 or again")
    live = step(found.drop("again").join(often.select("anchor", "again", ((F.col("x") < F.col("y")) | F.col("again")).alias("several")), "anchor"), "live")
    release(spark, own + ":live")
    classes = step(live.groupBy("anchor", "run").agg(F.sum("rows").alias("c"), F.min("k").alias("k"), F.max("several").alias("several"), F.max("again").alias("again"), F.min("left").alias("left"), F.min("right").alias("right")), "classes")
    asked = live.filter("several").select("k", "k2", "rep", "anchor", "run", "lo", "n").join(_asked(classes), ["anchor", "run", "k"])
    asked = asked.select("k", "k2", "rep", F.struct("anchor", "run", "lo", "n", "c", "subs", F.pmod(F.xxhash64("run"), F.col("subs")).cast("int").alias("sub")).alias("ask"))
    asked = asked.groupBy("k", "k2", "rep").agg(F.collect_list("ask").alias("asks"))
    same = (F.col("d.k") == F.col("q.k")) & (F.col("d.k2") == F.col("q.k2")) & F.col("d.doc_id").eqNullSafe(F.col("q.rep"))
    at = keyed(docs).alias("d").join(asked.alias("q"), same).select("text", "asks")

    def cut(batches):
        names = ("anchor", "sub", "run", "c", "subs")
        for b in rows_of(batches, 1 << 20):
            out = []
            for t, asks in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                raw = t.encode()
                out += [(*(a[x] for x in names), raw[a["lo"] : a["lo"] + a["n"] + length - 1]) for a in asks]
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.record_batch([pa.array([x[c] for x in out], t) for c, t in enumerate(kinds)], names=[*names, "bytes"])

    contexts = step(at.mapInArrow(cut, "anchor long, sub int, run long, c long, subs int, bytes binary"), "contexts")
    size = contexts.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    solved = step(_suffix_marks(contexts, length, max(1, -(-size // TASK_BYTES))), "solved")
    marks = solved.filter("marks is not null").select("anchor", "run", "marks")
    if contexts.filter("subs > 1").limit(1).count():
        marks = marks.unionByName(_cross_marks(contexts, solved, length))
    pair = F.transform(F.sequence(F.lit(0), (F.size("marks") / 2 - 1).cast("int")), lambda i: F.struct(F.element_at("marks", i * 2 + 1).cast("long").alias("a"), F.element_at("marks", i * 2 + 2).cast("long").alias("b")))
    marks = marks.groupBy("anchor", "run").agg(F.flatten(F.collect_list(pair)).alias("p"))
    whole = F.when(F.col("c") > 1, F.array(F.struct(F.lit(0).cast("long").alias("a"), F.col("n").alias("b"))))
    rows = live.select("k", "k2", "anchor", "run", "lo", "n").join(classes.select("anchor", "run", "c"), ["anchor", "run"]).join(marks, ["anchor", "run"], "left")
    rows = rows.select("k", "k2", "lo", F.coalesce(whole, "p").alias("p")).filter("p is not null")
    rows = rows.select("k", "k2", F.transform("p", lambda x: F.struct((x["a"] + F.col("lo")).alias("a"), (x["b"] + F.col("lo")).alias("b"))).alias("p"))
    out = written(rows.groupBy("k", "k2").agg(F.flatten(F.collect_list("p")).alias("spans")), "spans", tag)
    release(spark, own)
    free(spark)
    return out


def cover(n: int, found: list | None, length: int) -> list[tuple[int, int]]:
    """Maximal removed runs [from, to) of a text of n bytes."""
    out: list[list[int]] = []
    for a, b in sorted((x["a"], x["b"]) for x in found or ()):
        lo, hi = a, min(n, b - 1 + length)
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def _with_spans(docs: DataFrame, length: int, tag: str) -> DataFrame:
    """(row: all columns of docs, text, spans)"""
    text = F.coalesce("text", F.lit(""))
    at = docs.select(F.struct(*docs.columns).alias("row"), "text", F.xxhash64(text).alias("k"), F.xxhash64(F.lit(1), text).alias("k2"))
    return at.join(spans(docs.select("doc_id", "text"), length, tag), ["k", "k2"], "left").select("row", "text", "spans")


def _kept(raw: bytes, gone: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for a, b in gone:
        out.append(raw[at:a])
        at = b
    return b"".join([*out, raw[at:]])


def passage_digest(docs: DataFrame, length: int = LENGTH, tag: str = "") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, text) of every row; text is what stays, without characters of which only a
    part stays."""

    def run(batches):
        for b in rows_of(batches):
            out = []
            for d, t, s in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                raw = t.encode() if t else b""
                gone = cover(len(raw), s, length)
                kept = _kept(raw, gone)
                out.append((d, len(raw), sum(y - x for x, y in gone), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore")))
            kinds = (pa.int64(),) * 4 + (pa.string(),) * 2
            yield pa.record_batch([pa.array([x[c] for x in out], t) for c, t in enumerate(kinds)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"])

    rows = _with_spans(docs.select("doc_id", "text"), length, tag).select("row.doc_id", "text", "spans")
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string")


def remove_passages(docs: DataFrame, length: int = LENGTH, tag: str = "") -> DataFrame:
    """docs without the repeated bytes; characters of which only a part is left go as well. A null text stays null; columns of
    any names and kinds stay as they are."""
    columns = docs.columns

    def run(batches):
        for b in rows_of(batches):
            text = []
            for t, s in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                text.append(_kept(raw := t.encode(), cover(len(raw), s, length)).decode("utf-8", "ignore") if t and s else t)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(text, pa.string())], names=["row", "kept"])

    rows = _with_spans(docs, length, tag)
    got = rows.mapInArrow(run, StructType([StructField("row", rows.schema["row"].dataType), StructField("kept", StringType())]))
    return got.select(*((F.col("kept") if c == "text" else F.col("row")[c]).alias(c) for c in columns))
