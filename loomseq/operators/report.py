"""Report rows: for each interval of a query its overlaps with the repeat tracks, coverage, and best taxa."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..adapters import settled
from . import chimeric, intervals

Q = ["q_id"]
IV = ["q_id", "pos", "len"]


def ultraconserved(nodes: DataFrame, least: int = 5, stride: int = 20) -> DataFrame:
    """(q_id, pos, len): merged windows of stride places, half a stride before and after its multiples, that matches of at least so many divisions
    reach; prokaryotes and viruses don't count. A match reaches a window for every stride that begins half a stride after its start."""
    n = nodes.filter(~F.substring("div", 1, 5).isin("prok:", "arch:", "virs:") & (F.col("len") > stride // 2))
    at = F.explode(F.sequence(F.col("pos") + stride // 2, F.col("pos") + F.col("len") - 1, F.lit(stride).cast("long")))
    cells = n.select("q_id", "div", at.alias("at")).select("q_id", "div", F.floor(F.col("at") / stride).cast("long").alias("cell")).distinct()
    rich = cells.groupBy("q_id", "cell").agg(F.count("*").alias("n")).filter((F.col("n") >= least) & (F.col("cell") > 0))
    return intervals.merge(rich.select("q_id", (F.col("cell") * stride - stride // 2).alias("pos"), F.lit(stride).cast("long").alias("len")), Q, stride)


def repeat_tracks(xp: DataFrame, lc: DataFrame, co: DataFrame, n: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """The tracks of transposons, low complexity, conserved places and runs of N, merged and without what a later-named one of the first three
    has already (xp, then lc, then co); and the union of all."""
    xp, lc, co, n = (settled(intervals.merge(t, Q)) for t in (xp, lc, co, n))
    every = intervals.merge(xp.unionByName(lc).unionByName(co).unionByName(n), Q)
    lc = settled(intervals.subtract(lc, co, Q))
    xp = intervals.subtract(intervals.subtract(xp, lc, Q), co, Q)
    return {"xp": xp, "lc": lc, "co": co, "n": n}, every


def overlaps(asked: DataFrame, tracks: dict[str, DataFrame]) -> DataFrame:
    """asked (q_id, pos, len) with a column for each merged track: how much of the interval it covers. One sweep over all borders: what a track
    covers up to a place follows from how many of its starts and ends lie before it, and from their sums."""
    zero = F.lit(0).cast("long")

    def borders(df: DataFrame, name: str) -> DataFrame:
        end = F.col("pos") + F.col("len")
        both = df.filter("len > 0").select("q_id", F.explode(F.array(F.struct(F.col("pos").alias("at"), F.lit(1).cast("long").alias("step")), F.struct(end.alias("at"), F.lit(-1).cast("long").alias("step")))).alias("b"))
        own = lambda c: [(c if t == name else zero).alias(f"{'s' if c is step else 'w'}_{t}") for t in tracks]
        step, weight = F.col("b.step"), F.col("b.step") * F.col("b.at")
        return both.select("q_id", F.col("b.at").alias("at"), *own(step), *own(weight), F.lit(None).cast("struct<pos:long,len:long,last:int>").alias("ask"))

    marks = None
    for name, t in tracks.items():
        marks = borders(t, name) if marks is None else marks.unionByName(borders(t, name))
    ask = lambda last: F.struct(F.col("pos").cast("long").alias("pos"), F.col("len").cast("long").alias("len"), F.lit(last).alias("last"))
    none = [zero.alias(f"{k}_{t}") for k in "sw" for t in tracks]
    for last in (0, 1):
        marks = marks.unionByName(asked.select("q_id", (F.col("pos") + F.col("len") * last).cast("long").alias("at"), *none, ask(last).alias("ask")))
    w = Window.partitionBy("q_id").orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
    upto = marks.select("q_id", "ask", *((F.sum(f"s_{t}").over(w) * F.col("at") - F.sum(f"w_{t}").over(w)).alias(t) for t in tracks)).filter("ask is not null")
    sign = F.when(F.col("ask.last") == 1, 1).otherwise(-1)
    return upto.groupBy("q_id", "ask.pos", "ask.len").agg(*(F.sum(sign * F.col(t)).alias(t) for t in tracks))


def interval_taxa(nodes: DataFrame, asked: DataFrame, per_div: int = 2, most: int = 4) -> DataFrame:
    """(q_id, pos, len, taxa): the best taxa of each interval, as an array in order of their scores; tax_id, div, cvg_by_div, cvg_by_tax, score.
    nodes: matches (q_id, pos, len, tax_id, div, score). A match scores by the share of it that lies inside. Of each division the best
    per_div are taken, with synthetic ones and viruses counted one and a half times, and of all those the best most by score; ties go to
    the smaller tax_id."""
    j = intervals.overlap_join(asked.select(*IV), nodes, Q)
    lo = F.greatest("pos", "b_pos")
    n = F.least(F.col("pos") + F.col("len"), F.col("b_pos") + F.col("b_len")) - lo
    cut = settled(j.select(*IV, F.col("b_tax_id").alias("tax_id"), F.col("b_div").alias("div"), lo.alias("at"), n.alias("n"), (F.col("b_score") * n / F.col("b_len")).alias("part")))
    taxa = cut.groupBy(*IV, "tax_id", "div").agg(F.sum("n").alias("cvg_by_tax"), F.sum("part").alias("score"))
    cover = intervals.merge(cut.select(F.struct(*IV).alias("iv"), "div", F.col("at").alias("pos"), F.col("n").alias("len")), ["iv", "div"]).groupBy("iv", "div").agg(F.sum("len").alias("cvg_by_div")).select("iv.*", "div", "cvg_by_div")
    boost = F.when(F.col("div").startswith("synt") | F.col("div").contains("virus"), 1.5).otherwise(1.0)
    a = Window.partitionBy(*IV, "div").orderBy(F.desc(F.col("score") * boost), "tax_id")
    top = taxa.withColumn("r", F.row_number().over(a)).filter(F.col("r") <= per_div).join(cover, [*IV, "div"])
    row = F.struct((-F.col("score")).alias("o"), "tax_id", "div", "cvg_by_div", "cvg_by_tax", F.floor(F.sqrt("score") + 0.5).cast("long").alias("score"))
    return top.groupBy(*IV).agg(F.slice(F.array_sort(F.collect_list(row)), 1, most).alias("taxa")).withColumn("taxa", F.transform("taxa", lambda t: t.dropFields("o")))


def report(nodes: DataFrame, whole: DataFrame, primary: DataFrame, xp: DataFrame, lc: DataFrame, n: DataFrame, xc: DataFrame, names: DataFrame) -> DataFrame:
    """(seq_id, len, xp, lc, co, n, xc, cvg_by_all, tax_name, taxa) of each division interval of each query, as sinks.report_columns takes them. nodes:
    matches, collapsed by taxon; whole: (q_id, pos, len); primary: (q_id, div); tracks: (q_id, pos, len); names: (tax_id, species). An
    interval that is not the whole query has its places in its id."""
    nodes = settled(nodes)
    tracks, every = repeat_tracks(xp, lc, ultraconserved(nodes), n)
    asked = settled(chimeric.div_intervals(nodes, every, whole, primary))
    tracks |= {"xc": intervals.merge(xc, Q), "cvg_by_all": intervals.merge(nodes, Q)}
    d = overlaps(asked, tracks).join(interval_taxa(nodes, asked), IV, "left").join(whole.select("q_id", F.col("len").alias("q_len")), "q_id")
    d = d.withColumn("best", F.get("taxa", F.lit(0))["tax_id"]).join(names.select(F.col("tax_id").alias("best"), "species"), "best", "left")
    place = F.concat(F.lit("~~"), F.col("pos").cast("string"), F.lit(".."), (F.col("pos") + F.col("len") - 1).cast("string"))
    seq_id = F.concat(F.col("q_id").cast("string"), F.when((F.col("pos") == 1) & (F.col("len") == F.col("q_len")), "").otherwise(place))
    return d.select(seq_id.alias("seq_id"), "len", "xp", "lc", "co", "n", "xc", "cvg_by_all", F.coalesce("species", F.lit("")).alias("tax_name"), F.coalesce("taxa", F.array().cast("array<struct<tax_id:bigint,div:string,cvg_by_div:bigint,cvg_by_tax:bigint,score:bigint>>")).alias("taxa"))
