"""Interval algebra on rows (key, pos, len); the end pos + len is exclusive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BIN = 256


def _end(p: str = "") -> Column:
    return F.col(f"{p}pos") + F.col(f"{p}len")


def merge(df: DataFrame, key: list[str], gap: int = 0) -> DataFrame:
    """Union; neighbours not more than gap apart are joined (0: abutting ones). Empty intervals are left out."""
    w = Window.partitionBy(*key).orderBy("pos", "len")
    d = df.filter("len > 0").select(*key, "pos", "len")
    d = d.withColumn("_m", F.max(_end()).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    d = d.withColumn("_g", F.sum((F.col("_m").isNull() | (F.col("pos") > F.col("_m") + gap)).cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return d.groupBy(*key, "_g").agg(F.min("pos").alias("pos"), (F.max(_end()) - F.min("pos")).alias("len")).drop("_g")


def invert(df: DataFrame, key: list[str]) -> DataFrame:
    """Gaps between merged intervals, with empty markers at the first start and the last end."""
    w = Window.partitionBy(*key).orderBy("pos")
    inner = df.withColumn("_n", F.coalesce(F.lead("pos").over(w), _end())).select(*key, _end().alias("pos"), (F.col("_n") - _end()).alias("len"))
    return inner.unionByName(df.groupBy(*key).agg(F.min("pos").alias("pos")).withColumn("len", F.lit(0).cast("long")))


def invert_whole(df: DataFrame, key: list[str], whole: DataFrame) -> DataFrame:
    """What the merged intervals leave of whole (key, pos, len)."""
    ends = whole.select(*key, F.col("pos").alias("_a"), _end().alias("_b"))
    marks = ends.select(*key, F.col("_a").alias("pos"), F.lit(0).cast("long").alias("len")).unionByName(df.select(*key, "pos", "len")).unionByName(ends.select(*key, F.col("_b").alias("pos"), F.lit(0).cast("long").alias("len")))
    w = Window.partitionBy(*key).orderBy("pos", "len")
    gaps = marks.withColumn("_p", F.max(_end()).over(w.rowsBetween(Window.unboundedPreceding, -1))).filter("_p is not null and pos > _p")
    gaps = gaps.select(*key, F.col("_p").alias("pos"), (F.col("pos") - F.col("_p")).alias("len"))
    return clip(gaps, key, ends)


def clip(df, key, ends):
    j = df.join(ends, key)
    lo, hi = F.greatest("pos", "_a"), F.least(_end(), F.col("_b"))
    return j.select(*key, lo.alias("pos"), (hi - lo).alias("len")).filter("len > 0")


def overlap_join(a: DataFrame, b: DataFrame, key: list[str], width: int = BIN) -> DataFrame:
    """Pairs that overlap: a's columns, and b's as b_*. Both sides are dealt into bins, so a key with many rows spreads over
    bins; a pair counts in the first bin that both have."""
    def binned(d, p):
        lo, hi = F.floor(F.col(f"{p}pos") / width), F.floor((_end(p) - 1) / width)
        return d.filter(f"{p}len > 0").withColumn("_bin", F.explode(F.sequence(lo, hi)))

    b = b.select(*[F.col(c).alias(c if c in key else f"b_{c}") for c in b.columns])
    j = binned(a, "").join(binned(b, "b_"), [*key, "_bin"])
    j = j.filter((F.col("pos") < _end("b_")) & (F.col("b_pos") < _end()))
    return j.filter(F.col("_bin") == F.floor(F.greatest("pos", "b_pos") / width)).drop("_bin")


def intersect(a, b, key) -> DataFrame:
    lo, hi = F.greatest("pos", "b_pos"), F.least(_end(), _end("b_"))
    return overlap_join(a, b, key).select(*key, lo.alias("pos"), (hi - lo).alias("len"))


def intersect_len(a, b, key) -> DataFrame:
    return intersect(a, b, key).groupBy(*key).agg(F.sum("len").alias("len"))


def subtract(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """a without b, both merged within key: a meets the gaps of b, beyond its first and last intervals too."""
    hull = a.groupBy(*key).agg(F.min("pos").alias("pos"), F.max(_end()).alias("_e")).select(*key, "pos", (F.col("_e") - F.col("pos")).alias("len"))
    inside = intersect(b, hull, key)
    return intersect(a, invert_whole(inside, key, hull), key)


def exclude_overlapping(a: DataFrame, denied: DataFrame, key: list[str], ident: str, share: int = 3) -> DataFrame:
    """a without rows of which one denied interval covers more than a share-th."""
    lap = F.least(_end(), _end("b_")) - F.greatest("pos", "b_pos")
    bad = overlap_join(a, denied, key).filter(lap * share > F.col("len")).select(ident).distinct()
    return a.join(bad, ident, "left_anti")


def coverage(df: DataFrame, key: list[str]) -> DataFrame:
    return merge(df, key).groupBy(*key).agg(F.sum("len").alias("covered"))


def crowded_bins(df: DataFrame, key: list[str], label: str, width: int, least: int) -> DataFrame:
    """Bins that intervals of at least so many different labels touch."""
    d = df.filter("len > 0").withColumn("bin", F.explode(F.sequence(F.floor(F.col("pos") / width), F.floor((_end() - 1) / width))))
    return d.groupBy(*key, "bin").agg(F.count_distinct(label).alias("labels")).filter(F.col("labels") >= least)


def check(df: DataFrame, key: list[str]) -> DataFrame:
    """df; an error where it is not sorted apart: empty, not positive or overlapping."""
    before = F.lag(_end()).over(Window.partitionBy(*key).orderBy("pos", "len"))
    bad = (F.col("pos") < 1) | (F.col("len") < 1) | F.coalesce(before > F.col("pos"), F.lit(False))
    return df.withColumn("_ok", F.when(bad, F.raise_error(F.lit("intervals overlap or are empty"))).otherwise(F.lit(True))).filter("_ok").drop("_ok")
