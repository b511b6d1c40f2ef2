"""Min-hash signatures of sequences and their comparison."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SLOTS = 1024
DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signature(text: str | None, k: int = 10, most: int = 102_400) -> str | None:
    b = np.frombuffer((text or "").encode(), np.uint8)
    if len(b) < k:
        return None
    h = np.zeros(len(b) - k + 1, np.uint64)
    for i in range(k):
        h = h * np.uint64(257) + b[i : len(b) - k + 1 + i]
    h = np.unique(_mix(h))[:most]
    best = np.full(SLOTS, np.iinfo(np.uint64).max, np.uint64)
    salt = _mix(np.arange(1, SLOTS + 1, dtype=np.uint64))
    for lo in range(0, len(h), 512):
        best = np.minimum(best, _mix(h[lo : lo + 512, None] ^ salt[None, :]).min(0))
    return "".join(DIGITS[i] for i in (best & np.uint64(63)).tolist())


def signatures(seqs: DataFrame, text: str = "text") -> DataFrame:
    """(id, signature): 1024 letters of six bits each; null for sequences shorter than a word."""

    def run(parts):
        for pdf in parts:
            yield pd.DataFrame({"id": pdf["id"], "signature": [signature(t) for t in pdf[text]]})

    return seqs.select("id", text).mapInPandas(run, "id long, signature string")


def similarity(a, b):
    """Share of equal slots, corrected for six-bit chance."""
    at = F.sequence(F.lit(1), F.lit(SLOTS))
    f = F.size(F.filter(at, lambda i: F.substring(a, i, F.lit(1)) == F.substring(b, i, F.lit(1)))) / SLOTS
    return f - (1 - f) / 64


def similar_pairs(sigs: DataFrame, threshold: float = 0.3, band: int = 3) -> DataFrame:
    """(id_1, id_2, similarity) from pairs that share a band of slots; with bands of three a pair of similarity 0.3 is missed with
    probability 3e-5, of 0.35 with 8e-8, and one pair in 770 of unlike signatures is looked at."""
    s = sigs.filter("signature is not null")
    bands = s.select("id", "signature", F.posexplode(F.transform(F.sequence(F.lit(1), F.lit(SLOTS - band + 1), F.lit(band)), lambda i: F.substring("signature", i, F.lit(band)))).alias("b", "w"))
    pairs = bands.select("id", "b", "w").join(bands.select(F.col("id").alias("id_2"), "b", "w"), ["b", "w"]).filter("id < id_2").select("id", "id_2").distinct()
    j = pairs.join(s, "id").join(s.select(F.col("id").alias("id_2"), F.col("signature").alias("sig_2")), "id_2")
    return j.select(F.col("id").alias("id_1"), "id_2", similarity(F.col("signature"), F.col("sig_2")).alias("similarity")).filter(F.col("similarity") >= threshold)


def longest_per_symbol(rows: DataFrame, key: list[str], order: list[str], symbol: str, size: str) -> DataFrame:
    """Of neighbouring rows with one symbol the longest (the first of equals)."""
    from .dataflow import group_adjacent

    d = group_adjacent(rows, key, order, symbol, "_g")
    return d.withColumn("_r", F.row_number().over(Window.partitionBy(*key, "_g").orderBy(F.desc(size), *order))).filter("_r = 1").drop("_r", "_g")


# ---- signatures of protein sets -----------------------------------------------------------------------------------------
WORD, KEPT = 15, 102_400
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _hash(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mix(x + GOLDEN)


def protein_words(proteins: DataFrame) -> DataFrame:
    """(id, h) hashes of the distinct words of 15 residues in four groups (30 bits), of proteins (id, seq) closed by a stop."""
    from ..functions import scalars

    def run(parts):
        power = (np.uint64(1) << np.arange(2 * WORD - 2, -1, -2, dtype=np.uint64)).astype(np.uint64)
        for pdf in parts:
            for i, s in zip(pdf["id"].tolist(), pdf["groups"].tolist(), strict=True):
                b = np.frombuffer(s.encode(), np.uint8).astype(np.uint64) - np.uint64(48)
                if len(b) >= WORD:
                    mers = np.unique((np.lib.stride_tricks.sliding_window_view(b, WORD) * power).sum(1, dtype=np.uint64))
                    yield pd.DataFrame({"id": i, "h": _hash(mers).view(np.int64)})

    grouped = proteins.filter("seq is not null").select("id", scalars.reduced_protein(F.concat("seq", F.lit("*"))).alias("groups")).distinct()
    return grouped.mapInPandas(run, "id long, h long").distinct()


def bottom_sketch(words: DataFrame, most: int = KEPT, parts: int = 64) -> DataFrame:
    """The most smallest hashes (unsigned) of each id: of each of its parts first, so that no id is ranked in one task as a whole."""
    order = [F.col("h") < 0, "h"]  # non-negative longs come first
    near = Window.partitionBy("id", F.pmod("h", F.lit(parts))).orderBy(*order)
    some = words.withColumn("_r", F.row_number().over(near)).filter(F.col("_r") <= most)
    return some.withColumn("_r", F.row_number().over(Window.partitionBy("id").orderBy(*order))).filter(F.col("_r") <= most).drop("_r")


def protein_signatures(proteins: DataFrame, most: int = KEPT) -> DataFrame:
    """(id, signature) of sets of proteins: 1024 letters of six bits, one for the least hash of each of 1024 families over the bottom
    sketch. Parts of a set are reduced where they lie, and their least hashes are compared by slot."""

    def run(parts):
        best: dict[int, np.ndarray] = {}
        slot = np.arange(SLOTS, dtype=np.uint64) << np.uint64(32)
        for pdf in parts:
            for i, g in pdf.groupby("id"):
                h = g["h"].to_numpy().view(np.uint64)
                for lo in range(0, len(h), 512):
                    low = _hash(h[lo : lo + 512, None] ^ slot[None, :]).min(0)
                    best[i] = np.minimum(best[i], low) if i in best else low
            if len(best) > 500:
                yield _slots(best)
                best = {}
        if best:
            yield _slots(best)

    def _slots(best):
        ids = np.repeat(np.array(list(best), np.int64), SLOTS)
        low = np.concatenate(list(best.values())) ^ np.uint64(1 << 63)  # so that signed order is the unsigned one
        return pd.DataFrame({"id": ids, "slot": np.tile(np.arange(SLOTS), len(best)), "low": low.view(np.int64)})

    least = bottom_sketch(protein_words(proteins), most).mapInPandas(run, "id long, slot int, low long").groupBy("id", "slot").agg(F.min("low").alias("low"))
    letter = F.substring(F.lit(DIGITS), F.col("low").bitwiseAND(63).cast("int") + 1, F.lit(1))
    return least.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("slot", letter.alias("x")))), lambda s: s["x"]), "").alias("signature"))
