"""From match intervals (nodes: q_id, pos, len, tax_id, div, score) to a report for each query."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import intervals


def collapse_nodes(nodes: DataFrame, gap: int = 10) -> DataFrame:
    """Per query and taxon, neighbours less than gap apart become one; the score is the sum, less 0.8 of the overlap with what
    came before at the smaller of the two densities."""
    key = ["q_id", "tax_id"]
    w = Window.partitionBy(*key).orderBy("pos", "len", "id")
    end = F.col("pos") + F.col("len")
    d = nodes.withColumn("_m", F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    d = d.withColumn("_g", F.sum((F.col("_m").isNull() | (F.col("pos") - F.col("_m") >= gap)).cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    items = F.array_sort(F.collect_list(F.struct("pos", "len", "id", F.col("score").cast("double").alias("score"))))
    start = F.struct(F.lit(None).cast("long").alias("pos"), F.lit(0).cast("long").alias("len"), F.lit(0.0).alias("score"))

    def step(a, x):
        lap = F.greatest(F.lit(0), F.least(a["pos"] + a["len"], x["pos"] + x["len"]) - x["pos"])
        both = x["score"] + a["score"] - 0.8 * lap * F.least(a["score"] / a["len"], x["score"] / x["len"])
        hull = F.struct(a["pos"].alias("pos"), (F.greatest(a["pos"] + a["len"], x["pos"] + x["len"]) - a["pos"]).alias("len"), both.alias("score"))
        return F.when(a["pos"].isNull(), F.struct(x["pos"].alias("pos"), x["len"].alias("len"), x["score"].alias("score"))).otherwise(hull)

    out = d.groupBy(*key, "div", "_g").agg(F.aggregate(items, start, step).alias("n"))
    return out.select(*key, "div", "n.pos", "n.len", "n.score")


def tax_scores(nodes: DataFrame, whole: DataFrame) -> DataFrame:
    """Per query and taxon over whole (q_id, pos, len): clipped length, and score by the clipped share."""
    j = nodes.join(whole.select("q_id", F.col("pos").alias("w_pos"), F.col("len").alias("w_len")), "q_id")
    cut = F.least(F.col("pos") + F.col("len"), F.col("w_pos") + F.col("w_len")) - F.greatest("pos", "w_pos")
    j = j.withColumn("_c", cut).filter("_c > 0")
    return j.groupBy("q_id", "tax_id", "div").agg(F.sum("_c").alias("cvg_by_tax"), F.sum(F.col("score") * F.col("_c") / F.col("len")).alias("score"))


def best_taxa(scores: DataFrame, per_div: int = 2, most: int = 4) -> DataFrame:
    """The best per_div taxa of each division, of those the best most by score; ties to the smaller tax_id, then to the
    division first by name (a taxon may stand in several)."""
    a = Window.partitionBy("q_id", "div").orderBy(F.desc("score"), "tax_id")
    b = Window.partitionBy("q_id").orderBy(F.desc("score"), "tax_id", "div")
    top = scores.withColumn("_a", F.row_number().over(a)).filter(F.col("_a") <= per_div)
    return top.withColumn("rank", F.row_number().over(b)).filter(F.col("rank") <= most).drop("_a")


def running_div_stats(cover: DataFrame) -> DataFrame:
    """cover: (q_ord, div, len). After each query, every division's coverage so far, and which one leads (the first by name on
    ties). Sums over the order are per division; the grid is queries by divisions."""
    grid = cover.select("q_ord").distinct().crossJoin(F.broadcast(cover.select("div").distinct()))
    d = grid.join(cover.groupBy("q_ord", "div").agg(F.sum("len").alias("len")), ["q_ord", "div"], "left")
    d = d.withColumn("cvg_len", F.sum(F.coalesce("len", F.lit(0))).over(Window.partitionBy("div").orderBy("q_ord").rowsBetween(Window.unboundedPreceding, 0)))
    return d.withColumn("top", F.row_number().over(Window.partitionBy("q_ord").orderBy(F.desc("cvg_len"), "div")) == 1).select("q_ord", "div", "cvg_len", "top")


def primary_divs(stats: DataFrame) -> DataFrame:
    """stats: (div, cvg_len, cvg_nr, isect). In the order of their overlap with the leader, divisions join it while they share its
    first four letters, overlap by a good share, and by enough of the leader or of the one accepted before."""
    s = stats.withColumn("_top", F.max(F.struct("cvg_len", "div")).over(Window.partitionBy(F.lit(1))))
    items = F.array_sort(F.collect_list(F.struct((-F.col("isect")).alias("o"), "div", "cvg_nr", "isect")))
    s = s.groupBy().agg(items.alias("items"), F.max("_top.div").alias("top"), F.max(F.when(F.col("div") == F.col("_top.div"), F.col("cvg_nr"))).alias("nr"))
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).cast("long").alias("last"), F.lit(False).alias("stop"))

    def step(a, x):
        good = (F.substring(x["div"], 1, 4) == F.substring(F.col("top"), 1, 4)) & (x["isect"] > 0.3 * F.greatest(x["cvg_nr"], F.lit(1))) & ((20 * x["isect"] > F.col("nr")) | (x["isect"] > 0.9 * a["last"]))
        good = good | (x["div"] == F.col("top"))
        return F.when(a["stop"], a).when(good, F.struct(F.concat(a["out"], F.array(x["div"])).alias("out"), x["isect"].alias("last"), F.lit(False).alias("stop"))).otherwise(F.struct(a["out"].alias("out"), a["last"].alias("last"), F.lit(True).alias("stop")))

    return s.select(F.explode(F.aggregate("items", start, step)["out"]).alias("div"))


def chimeric_intervals(nodes: DataFrame, window: int = 2000, pct: int = 50) -> DataFrame:
    """(q_id, div, pos, len): merged hulls of neighbouring intervals of one division within a window, where they cover at least
    pct of it."""
    m = intervals.merge(nodes, ["q_id", "div"])
    w = Window.partitionBy("q_id", "div").orderBy("pos")
    prior = F.sum("len").over(w.rowsBetween(Window.unboundedPreceding, 0))
    d = m.withColumn("_c", prior)
    left = d.select("q_id", "div", F.col("pos").alias("a"), (F.col("_c") - F.col("len")).alias("ca"))
    right = d.select("q_id", "div", F.col("pos").alias("b"), (F.col("pos") + F.col("len")).alias("e"), F.col("_c").alias("cb"))
    cell = lambda c: F.floor(F.col(c) / window)
    j = left.withColumn("_k", F.explode(F.array(cell("a"), cell("a") + 1))).join(right.withColumn("_k", cell("b")), ["q_id", "div", "_k"])
    j = j.filter((F.col("b") >= F.col("a")) & (F.col("e") - F.col("a") <= window))
    good = j.filter((F.col("cb") - F.col("ca")) * 100 >= pct * (F.col("e") - F.col("a")))
    return intervals.merge(good.select("q_id", "div", F.col("a").alias("pos"), (F.col("e") - F.col("a")).alias("len")), ["q_id", "div"])


def report(nodes: DataFrame, whole: DataFrame) -> DataFrame:
    """One row for each query: length, coverage by all, and its best taxa as an array."""
    by_div = intervals.coverage(nodes, ["q_id", "div"]).withColumnRenamed("covered", "cvg_by_div")
    top = best_taxa(tax_scores(nodes, whole)).join(by_div, ["q_id", "div"])
    taxa = top.groupBy("q_id").agg(F.array_sort(F.collect_list(F.struct("rank", "tax_id", "div", "cvg_by_div", "cvg_by_tax", F.floor(F.col("score") + 0.5).cast("long").alias("score")))).alias("taxa"))
    return whole.select("q_id", F.col("len").alias("seq_len")).join(intervals.coverage(nodes, ["q_id"]).withColumnRenamed("covered", "cvg_by_all"), "q_id").join(taxa, "q_id")


def subject_regions(hits: DataFrame, gap: int = 1000) -> DataFrame:
    return intervals.merge(hits, ["s_id"], gap)
