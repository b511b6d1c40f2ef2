"""Spans of a sequence with small primary islands taken in: between contaminants first, then at the ends.

Spans carry sums of their rows: ungapped length, and what contaminants, primaries and greys cover. A stretch of spans becomes one contaminant
when its primaries cover something, but less than SHARE of its contaminants and less than BIG. Stretches are looked for from
both ends inwards, giving up the weaker end each time; what is left on either side of one is looked at again. A primary span of
BIG or more can be in no such stretch, so the spans between two of them are a group of their own: a sequence falls into independent
pieces wherever it is clearly primary.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .actions import _trim, in_spans

BIG, SHARE = 50_000, 0.30
SUMS = ["ungap_len", "contam_len", "primary_len", "grey_len"]
COLUMNS = ["seq_id", "pos", "end", *SUMS]


def _label() -> Column:
    contam, primary = F.col("contam_len"), F.col("primary_len")
    return F.when((contam >= primary) & (contam > 0), "contaminant").when(primary > contam, "primary").otherwise("grey")


def _result() -> Column:
    return F.when(F.col("label") == "contaminant", F.col("contam_len")).when(F.col("label") == "primary", F.col("primary_len")).otherwise(F.col("grey_len"))


def summed(rows: DataFrame) -> DataFrame:
    """Spans (seq_id, pos, end, ungap_len, contam_len, primary_len, grey_len, label) of rows (seq_id, at, pos, end, len, label, pct)."""
    part = F.floor(F.col("len") * F.col("pct") / 100).cast("long")
    by = lambda k: F.sum(F.when(F.col("label") == k, part).otherwise(0))
    d = in_spans(rows).groupBy("seq_id", "span").agg(F.min("pos").alias("pos"), F.max("end").alias("end"), F.sum("len").alias("ungap_len"), by("contaminant").alias("contam_len"), by("primary").alias("primary_len"), by("grey").alias("grey_len"))
    return d.select(*COLUMNS, _label().alias("label"))


def stretches(contam: list[int], primary: list[int], result: list[int], big: int = BIG, share: float = SHARE) -> list[tuple[int, int]]:
    """First and last span of each stretch, single spans included, of one group of spans."""
    c, p = [0], [0]
    for x, y in zip(contam, primary, strict=True):
        c.append(c[-1] + x)
        p.append(p[-1] + y)
    todo, out = [(0, len(contam) - 1)], []
    while todo:
        lo, hi = todo.pop()
        i, j = lo, hi
        while i < j:
            x, y = c[j + 1] - c[i], p[j + 1] - p[i]
            if 0 < y < big and int(x * share) > y:
                break
            if result[i] >= result[j]:
                i += 1
            else:
                j -= 1
        if i < j:
            out.append((i, j))
            todo += [(lo, i - 1), (j + 1, hi)]
        elif lo <= hi:
            out += [(k, k) for k in range(lo, hi + 1)]
    return sorted(out)


def merge_islands(spans: DataFrame, big: int = BIG, share: float = SHARE) -> DataFrame:
    """Spans after small primary islands between contaminants are taken in; label as in summed."""
    w = Window.partitionBy("seq_id").orderBy("pos")
    large = F.col("primary_len") >= big
    last = F.max(F.when(large, F.col("pos"))).over(Window.partitionBy("seq_id"))
    # each large primary is a group, but the last one, which opens the group that follows
    opens = large | F.coalesce(F.lag(large).over(w) & (F.lag("pos").over(w) != F.col("last")), F.lag("pos").over(w).isNull())
    d = spans.withColumn("last", last).withColumn("opens", opens.cast("int")).withColumn("group", F.sum("opens").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    kind = spans.schema["seq_id"].dataType.simpleString()
    d = d.select(*COLUMNS, _result().alias("result"), "group")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos", kind="stable").reset_index(drop=True)
        found = stretches(*(pdf[c].tolist() for c in ("contam_len", "primary_len", "result")), big, share)
        of = [k for k, (i, j) in enumerate(found) for _ in range(i, j + 1)]
        g = pdf.groupby(of)
        return pd.concat([g["seq_id"].first(), g["pos"].min(), g["end"].max(), g[SUMS].sum()], axis=1)[COLUMNS]

    merged = d.groupBy("seq_id", "group").applyInPandas(run, f"seq_id {kind}, pos long, end long, " + ", ".join(f"{c} long" for c in SUMS))
    return merged.withColumn("label", _label())


def discard_end_islands(spans: DataFrame, good_len: int = 50_000, good_abs: int = 200, pct: int = 30) -> DataFrame:
    """Spans after what lies within a trim at either end is one contaminant: from an end, contaminants and primaries add up to the last contaminant
    before a primary of good_len, or before a contaminant that no primary shorter than good_abs precedes and up to which primaries have pct
    percent of the contaminants. Where both trims meet, the whole is one."""
    item = F.struct("pos", F.col("ungap_len").alias("len"), "label", "end", *SUMS)
    d = spans.groupBy("seq_id").agg(F.array_sort(F.collect_list(item)).alias("x"))
    d = d.withColumns({"f": _trim(F.col("x"), good_len, good_abs, pct), "b": _trim(F.reverse("x"), good_len, good_abs, pct), "n": F.size("x")})
    d = d.select("seq_id", "f", "b", "n", F.posexplode("x").alias("i", "s")).select("seq_id", "f", "b", "n", "i", "s.*")
    front, back = F.col("i") < F.col("f"), F.col("i") >= F.col("n") - F.col("b")
    whole = F.col("f") + F.col("b") > F.col("n")
    d = d.withColumns({"part": F.when(whole | front, -1).when(back, -2).otherwise(F.col("i")), "trim": whole | front | back})
    g = d.groupBy("seq_id", "part", "trim").agg(F.min("pos").alias("pos"), F.max("end").alias("end"), *(F.sum(c).alias(c) for c in SUMS), F.first("label").alias("own"))
    return g.select(*COLUMNS, F.when(F.col("trim"), "contaminant").otherwise(F.col("own")).alias("label"))
