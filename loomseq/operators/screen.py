"""What may enter an index or a report: scope of subjects, known taxa, tracks, and windows of segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import intervals


def in_scope(seqs: DataFrame, ids: DataFrame, masked: DataFrame) -> DataFrame:
    """seqs (seq_id, defline) with a known id (seq_id), no alternate locus, not unverified, and not masked as a whole: masked has
    (seq_id, len), where a null len is the whole sequence."""
    d = seqs.join(ids.select("seq_id").distinct(), "seq_id", "left_semi")
    d = d.filter(~F.col("defline").contains("alternate locus") & ~F.col("defline").contains("UNVERIFIED:"))
    return d.join(masked.filter("len is null").select("seq_id"), "seq_id", "left_anti")


def known_taxa(rows: DataFrame, taxa: DataFrame) -> DataFrame:
    return rows.join(taxa.select("tax_id").distinct(), "tax_id", "left_semi")


def unknown_taxa(rows: DataFrame, taxa: DataFrame, most: int = 10) -> DataFrame:
    """(tax_id, rows) of the first few ids that no taxon has, for a warning."""
    return rows.join(taxa.select("tax_id").distinct(), "tax_id", "left_anti").groupBy("tax_id").agg(F.count("*").alias("rows")).orderBy("tax_id").limit(most)


def with_actions(seqs: DataFrame, actions: DataFrame) -> DataFrame:
    """All sequences (seq_id, seq) with their actions (seq_id, seq_len, ...); another length than the report has is an error."""
    j = seqs.join(actions, "seq_id", "left")
    wrong = F.raise_error(F.concat(F.lit("length differs from the report: "), "seq_id"))
    return j.withColumn("seq_len", F.when(F.col("seq_len").isNull() | (F.col("seq_len") == F.length("seq")), F.col("seq_len")).otherwise(wrong.cast("long")))


def tracks(transposons: DataFrame, low: DataFrame, conserved: DataFrame, n_runs: DataFrame, key: list[str]) -> dict[str, DataFrame]:
    """The four tracks merged, each without what a later one has: low complexity without conserved, transposons without both; and combined,
    all of them together."""
    one = {k: intervals.merge(v, key) for k, v in (("xp", transposons), ("lc", low), ("co", conserved), ("n", n_runs))}
    every = one["xp"].unionByName(one["lc"]).unionByName(one["co"]).unionByName(one["n"])
    lc = intervals.subtract(one["lc"], one["co"], key)
    xp = intervals.subtract(intervals.subtract(one["xp"], lc, key), one["co"], key)
    return {"combined": intervals.merge(every, key), "xp": xp, "lc": lc, "co": one["co"], "n": one["n"]}


def indexable(whole: DataFrame, masks: DataFrame, key: list[str], least: int = 56) -> DataFrame:
    """What the masks leave of each sequence (key, len), in pieces of at least the template's length."""
    all_ = whole.select(*key, F.lit(1).cast("long").alias("pos"), F.col("len").cast("long").alias("len"))
    return intervals.subtract(all_, intervals.merge(masks, key), key).filter(F.col("len") >= least)


def drop_repeat_windows(segments: DataFrame, key: list[str], order: list[str], window: int = 100, span: int = 1000) -> DataFrame:
    """Where window + 1 neighbours in the order of q begin within span, hits are stacked: of such windows, joined where they meet, only
    segments of four times their mean length stay."""
    w = Window.partitionBy(*key).orderBy("q", *order)
    after = w.rowsBetween(0, Window.unboundedFollowing)
    d = segments.withColumn("_n", F.row_number().over(w)).withColumn("_hit", F.col("q") - F.lag("q", window).over(w) <= span)
    d = d.withColumn("_last", F.last(F.when(F.col("_hit"), F.col("_n")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    starts = F.col("_hit") & (F.col("_last").isNull() | (F.col("_n") - F.col("_last") > window + 1))
    d = d.withColumn("_island", F.sum(F.when(starts, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    d = d.withColumn("_next", F.first(F.when(F.col("_hit"), F.struct("_n", "_island")), ignorenulls=True).over(after))
    d = d.withColumn("_in", F.when(F.col("_next._n") - window <= F.col("_n"), F.col("_next._island")))
    mean = F.avg("len").over(Window.partitionBy(*key, "_in"))
    return d.withColumn("_mean", mean).filter(F.col("_in").isNull() | (F.col("len") >= F.col("_mean") * 4)).select(*segments.columns)


def hot_windows(segments: DataFrame, subject: str, diag: int, anti: int, least: int = 4000) -> DataFrame:
    """Segments (ident, diag, anti, len) with enough length in one of four half-shifted cells of diagonal and antidiagonal."""
    cell = lambda c, by, size: F.floor((F.col(c) + by) / size)
    shifts = [(0, 0), (diag // 2, 0), (0, anti // 2), (diag // 2, anti // 2)]
    cells = F.array(*(F.struct(cell("diag", a, diag).alias("x"), cell("anti", b, anti).alias("y")) for a, b in shifts))
    d = segments.select("ident", subject, "len", F.explode(cells).alias("c"))
    hot = d.groupBy(subject, "c").agg(F.sum("len").alias("_sum")).filter(F.col("_sum") >= least).select(subject, "c")
    return segments.join(d.join(hot, [subject, "c"]).select("ident").distinct(), "ident", "left_semi")


def augment(kept: DataFrame, seeds: DataFrame, subject: str, top: int = 20) -> DataFrame:
    """The kept seeds and all seeds of subjects that have more than the top-th of subjects by number of seeds."""
    counts = seeds.groupBy(subject).agg(F.count("*").alias("_n"))
    least = counts.orderBy(F.desc("_n")).limit(top).agg(F.min("_n").alias("_least"))
    rich = counts.crossJoin(F.broadcast(least)).filter("_n > _least").select(subject)
    return kept.unionByName(seeds.join(rich, subject, "left_semi")).distinct()


def banded_neighbours(segments: DataFrame, key: list[str], ident: list[str], diag: int = 5000, anti: int = 50_000) -> DataFrame:
    """Segments (q, s, ...) that have another one of their key within diag diagonals and anti antidiagonals, exactly. Two in one cell of
    that size are neighbours; only segments that are alone in their cell are compared with those of the cells around it."""
    d, a = F.col("q") - F.col("s"), F.col("q") + F.col("s")
    at = segments.withColumns({"_d": d, "_a": a, "_x": F.floor(d / diag), "_y": F.floor(a / anti)})
    sizes = at.groupBy(*key, "_x", "_y").agg(F.count("*").alias("_n"))
    at = at.join(sizes, [*key, "_x", "_y"])
    around = F.array(*(F.struct(F.lit(i).cast("long").alias("i"), F.lit(j).cast("long").alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j))
    alone = at.filter("_n = 1").select(*key, *ident, "_d", "_a", "_x", "_y", F.explode(around).alias("c"))
    alone = alone.select(*key, *ident, F.col("_d").alias("_e"), F.col("_a").alias("_b"), (F.col("_x") + F.col("c.i")).alias("_x"), (F.col("_y") + F.col("c.j")).alias("_y"))
    near = (F.abs(F.col("_d") - F.col("_e")) <= diag) & (F.abs(F.col("_a") - F.col("_b")) <= anti)
    found = alone.join(at.select(*key, "_x", "_y", "_d", "_a"), [*key, "_x", "_y"]).filter(near).select(*ident).distinct()
    return at.filter("_n > 1").select(*segments.columns).unionByName(segments.join(found, ident, "left_semi"))
