"""A store of sequences with two bits for each base.

A sequence is cut into parts of STRIDE bases, each a row of packed bytes, four bases to a byte. Letters
other than ACGT have drawn bits there, and are kept beside them as runs, so that what is read back is what was written. A range
read takes the bytes it needs out of each part it touches and unpacks only these.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import letters

STRIDE = 100_000
STORE = "oid long, part int, size int, packed binary, odd array<struct<at:int,len:int,letter:string>>"
_ODD = pa.list_(pa.struct([("at", pa.int32()), ("len", pa.int32()), ("letter", pa.string())]))


def pack(seqs: DataFrame, stride: int = STRIDE) -> DataFrame:
    """The store's rows of sequences (oid, seq) of single-byte letters; an empty sequence is one empty part."""
    if stride % 4:
        raise ValueError("a part has to end with a byte")
    at = F.explode(F.sequence(F.lit(0), F.floor(F.greatest(F.length("seq") - 1, F.lit(0)) / stride).cast("int")))
    parts = seqs.filter("seq is not null").select("oid", F.col("seq").cast("binary").alias("raw"), letters.marks(F.col("seq")).alias("marks"), at.alias("part"))
    parts = parts.select("oid", "part", "marks", F.substring("raw", F.col("part") * stride + 1, F.lit(stride)).alias("raw"))

    def run(batches):
        for b in batches:
            for oid, part, marks, raw in zip(*(b.column(c).to_pylist() for c in ("oid", "part", "marks", "raw")), strict=True):
                code, other = letters.coded(raw, part * stride, letters.salt(marks), letters.TWO, 2)
                four = np.resize(np.append(code, np.zeros(-len(code) % 4, np.uint8)), (-(-len(code) // 4), 4)) if len(code) else np.zeros((0, 4), np.uint8)
                packed = (four << np.array([6, 4, 2, 0], np.uint8)).sum(1).astype(np.uint8).tobytes()
                runs = []
                if other.any() or raw != raw.upper():
                    u = np.frombuffer(raw, np.uint8)
                    keep = other | ((u >= 97) & (u <= 122))  # small letters are kept as they are
                    edge = np.flatnonzero(np.append(True, (u[1:] != u[:-1]) | (keep[1:] != keep[:-1])))
                    runs = [{"at": int(a), "len": int(z - a), "letter": chr(u[a])} for a, z in zip(edge, np.append(edge[1:], len(u)), strict=True) if keep[a]]
                yield pa.record_batch([pa.array([oid], pa.int64()), pa.array([part], pa.int32()), pa.array([len(raw)], pa.int32()), pa.array([packed], pa.binary()), pa.array([runs], _ODD)], names=["oid", "part", "size", "packed", "odd"])

    return parts.mapInArrow(run, STORE)


def unpack(packed: bytes, skip: int, size: int, first: int, odd: list) -> str:
    """size letters after the first skip of the bytes; first: the place in the part of the letter after skip; odd: runs of the part."""
    u = np.frombuffer(packed, np.uint8)
    code = (u[:, None] >> np.array([6, 4, 2, 0], np.uint8) & 3).ravel()[skip : skip + size]
    text = np.frombuffer(b"ACGT", np.uint8)[code]
    for r in odd:
        a, z = max(0, r["at"] - first), min(size, r["at"] + r["len"] - first)
        if a < z:
            text[a:z] = ord(r["letter"])
    return text.tobytes().decode("ascii")


def fetch(store: DataFrame, asks: DataFrame, stride: int = STRIDE) -> DataFrame:
    """(ask, text) of ranges (ask, oid, pos, len) that lie inside their sequences; pos from 1."""
    first, last = F.floor((F.col("pos") - 1) / stride).cast("int"), F.floor((F.col("pos") + F.greatest(F.col("len"), F.lit(1)) - 2) / stride).cast("int")
    a = asks.select("ask", "oid", "pos", "len", F.explode(F.sequence(first, last)).alias("part"))
    begin = F.greatest(F.col("pos") - 1 - F.col("part") * stride, F.lit(0)).cast("int")
    end = F.least(F.col("pos") - 1 + F.col("len") - F.col("part") * stride, F.col("size")).cast("int")
    j = a.join(store, ["oid", "part"]).withColumns({"begin": begin, "end": end})
    byte = F.floor(F.col("begin") / 4).cast("int")
    cut = F.substring("packed", byte + 1, F.floor((F.col("end") + 3) / 4).cast("int") - byte)
    near = F.filter("odd", lambda r: (r["at"] < F.col("end")) & (r["at"] + r["len"] > F.col("begin")))
    j = j.select("ask", "part", "begin", (F.col("end") - F.col("begin")).alias("n"), cut.alias("packed"), near.alias("odd"))

    def run(batches):
        for b in batches:
            rows = zip(*(b.column(c).to_pylist() for c in ("packed", "begin", "n", "odd")), strict=True)
            text = [unpack(p, begin % 4, n, begin, odd) for p, begin, n, odd in rows]
            yield pa.record_batch([b.column("ask"), b.column("part"), pa.array(text, pa.string())], names=["ask", "part", "text"])

    kind = asks.schema["ask"].dataType.simpleString()
    some = j.mapInArrow(run, f"ask {kind}, part int, text string")
    return some.groupBy("ask").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "text"))), lambda x: x["text"]), "").alias("text"))
