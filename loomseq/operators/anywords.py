"""Spaced words of sequences that hold any letters: those other than ACGT have drawn bits, so words over them exist and hardly ever
meet. Sequences are cut into overlapping pieces first, and the words of a piece come out of one matrix of bits."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import letters
from .words import spelled

PIECE = 65_536


def spaced_words(seqs: DataFrame, template: int = 56, stride: int = 1, piece: int = PIECE) -> DataFrame:
    """(oid, pos, word, flipped) of sequences (oid, seq): two of three places of the template, of both strands the lesser; pos is negative, from
    the other end, where that is the minus strand's. The same as words.spaced_words where there are only ACGT."""
    d = seqs.filter(F.length("seq") >= template)
    coded = words_between(pieces(d, template, max(stride, piece // stride * stride)).withColumns({"stride": F.lit(stride), "spans": F.lit(None).cast("array<struct<a:long,b:long>>")}), template)
    return spelled(coded, template).select("oid", "pos", "word", "flipped")


def pieces(seqs: DataFrame, template: int, step: int) -> DataFrame:
    """(oid, marks, at, raw): what sequences hold from each multiple of step on, up to the words that begin before the next one."""
    d = seqs.select("oid", F.col("seq").cast("binary").alias("raw"), letters.marks(F.col("seq")).alias("marks"), F.explode(F.sequence(F.lit(0), F.greatest(F.length("seq") - template, F.lit(0)), F.lit(step))).alias("at"))
    return d.select("oid", "marks", "at", F.substring("raw", F.col("at") + 1, F.lit(step + template - 1)).alias("raw"))


def words_between(d: DataFrame, template: int = 56, *also: str) -> DataFrame:
    """(oid, pos, code, flipped, also ...) of pieces (oid, marks, at, raw, stride, spans, also ...): words, as numbers, whose first place, from 0, is
    a multiple of the stride and lies in one of the spans (a to b, both inside); spans null: anywhere."""

    def run(batches):
        for b in batches:
            for k, (marks, at, raw, stride, spans) in enumerate(zip(*(b.column(c).to_pylist() for c in ("marks", "at", "raw", "stride", "spans")), strict=True)):
                if len(raw) < template:
                    continue
                bits, _ = letters.coded(raw, at, letters.salt(marks), letters.ONE, 1)
                place = np.arange(-at % stride, len(bits) - template + 1, stride)
                if spans is not None:
                    use = np.zeros(len(place), bool)
                    for s in spans:
                        use[np.searchsorted(place, s["a"] - at) : np.searchsorted(place, s["b"] - at, "right")] = True
                    place = place[use]
                code, flipped = letters.codes(bits, place, template)
                pos = place + (at + 1)
                rows = pa.array(np.full(len(place), k))
                yield pa.record_batch([b.column("oid").take(rows), pa.array(np.where(flipped, -(pos + template - 1), pos)), pa.array(code), pa.array(flipped), *(b.column(c).take(rows) for c in also)], names=["oid", "pos", "code", "flipped", *also])

    kind = lambda c: f"{c} {d.schema[c].dataType.simpleString()}"
    return d.select("oid", "marks", "at", "raw", "stride", "spans", *also).mapInArrow(run, ", ".join([kind("oid"), "pos long, code long, flipped boolean", *map(kind, also)]))
