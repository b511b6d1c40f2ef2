"""Division intervals of a query: where matches of divisions other than the primary ones are dense, and what lies between.

All matches less those of the primary divisions and less repeats are scanned with a window; dense stretches that one division
covers well are kept, joined over small gaps and, where two are long beside the gap between them, over larger ones; at the ends of a query they
reach out to it. Everything is interval algebra over (q_id, pos, len); only the joining over larger gaps goes from row to row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..adapters import settled
from ..config import DEFAULT
from . import intervals
from .dataflow import adapt

Q = ["q_id"]


def _end() -> Column:
    return F.col("pos") + F.col("len")


def primary_track(tracks: DataFrame, primary: DataFrame) -> DataFrame:
    """(q_id, pos, len): the track of the division that covers most (the first by name on ties); if it is one of the query's primary
    divisions, of all those. tracks: merged within (q_id, div); primary: (q_id, div)."""
    sizes = tracks.groupBy("q_id", "div").agg(F.sum("len").alias("n"))
    named = sizes.join(primary.distinct().withColumn("prim", F.lit(True)), ["q_id", "div"], "left").withColumn("prim", F.coalesce("prim", F.lit(False)))
    w = Window.partitionBy("q_id").orderBy(F.desc("n"), "div")  # as many rows as divisions
    named = named.withColumns({"top": F.first("div").over(w), "top_prim": F.first("prim").over(w)})
    use = named.filter((F.col("div") == F.col("top")) | (F.col("top_prim") & F.col("prim"))).select("q_id", "div")
    return intervals.merge(tracks.join(use, ["q_id", "div"], "left_semi"), Q)


def dense_stretches(track: DataFrame, whole: DataFrame, window: int = DEFAULT.chimeric_window, terminal: int = DEFAULT.chimeric_terminal, pct: int = DEFAULT.chimeric_pct) -> DataFrame:
    """(q_id, pos, len): merged hulls of neighbouring intervals of the merged track that cover at least pct of their hull. The hull that ends with an
    interval begins with the last one before which a window, counted back from that end, holds no start; at the end of the track the window also
    shrinks. Hulls shorter than the window count only within a window of an end of the query, and not below terminal. whole: (q_id, pos, len)."""
    w = Window.partitionBy("q_id").orderBy("pos")
    d = settled(track.select("q_id", "pos", "len").withColumn("after", F.sum("len").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    start = F.struct("pos", (F.col("after") - F.col("len")).alias("before"))
    first = d.groupBy("q_id").agg(F.min(start).alias("first"), F.max(F.struct(_end().alias("end"), "after")).alias("last"))
    # the last start before end - window, found on one sweep over starts and ends
    none = F.lit(None)
    marks = d.select("q_id", F.col("pos").alias("at"), F.lit(1).alias("kind"), start.alias("start"), none.cast("struct<end:long,after:long>").alias("head"))
    marks = marks.unionByName(d.select("q_id", (_end() - window).alias("at"), F.lit(0).alias("kind"), none.cast("struct<pos:long,before:long>").alias("start"), F.struct(_end().alias("end"), "after").alias("head")))
    v = Window.partitionBy("q_id").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    heads = marks.withColumn("tail", F.last("start", True).over(v)).filter("head is not null").join(first.select("q_id", "first"), "q_id")
    hulls = heads.select("q_id", F.coalesce("tail", "first").alias("tail"), "head")
    ends = hulls.groupBy("q_id").agg(F.max_by("tail", "head.end").alias("tail"), F.max("head").alias("head"))
    shrunk = d.select("q_id", start.alias("x")).join(ends, "q_id").filter("x.pos > tail.pos").select("q_id", F.col("x").alias("tail"), "head")
    h = hulls.unionByName(shrunk).select("q_id", F.col("tail.pos").alias("pos"), (F.col("head.end") - F.col("tail.pos")).alias("len"), (F.col("head.after") - F.col("tail.before")).alias("covered"))
    h = h.join(whole.select("q_id", (_end() - 1).alias("q_end")), "q_id")
    size = (F.col("len") >= window) | ((F.col("len") >= terminal) & ((_end() < window) | (F.col("pos") + window > F.col("q_end"))))
    good = h.filter((100.0 * F.col("covered") / (1.0 + F.col("len")) >= pct) & size)
    return intervals.merge(good, Q)


def led_by_one(stretches: DataFrame, tracks: DataFrame, pct: int = DEFAULT.chimeric_pct) -> DataFrame:
    """Those of which one division covers more than pct."""
    laps = intervals.overlap_join(stretches, tracks, Q)
    lap = F.least(_end(), F.col("b_pos") + F.col("b_len")) - F.greatest("pos", "b_pos")
    by_div = laps.groupBy("q_id", "pos", "len", "b_div").agg(F.sum(lap).alias("n"))
    return by_div.groupBy("q_id", "pos", "len").agg(F.max("n").alias("n")).filter(F.col("n") * 100 > F.col("len") * pct).select("q_id", "pos", "len")


def join_long(stretches: DataFrame, share: float = 0.9) -> DataFrame:
    """Neighbours become one where both together are longer than that share of their hull; what has become one counts whole."""

    def step(rows):
        held = None
        for r in rows:
            if held is not None and held["len"] + r["len"] > (r["pos"] + r["len"] - held["pos"]) * share:
                held["len"] = r["pos"] + r["len"] - held["pos"]
                continue
            if held is not None:
                yield held
            held = {k: r[k] for k in ("q_id", "pos", "len")}
        if held is not None:
            yield held

    kind = stretches.schema["q_id"].dataType.simpleString()
    return adapt(stretches.select("q_id", "pos", "len"), Q, ["pos"], step, f"q_id {kind}, pos long, len long")


def reach_out(stretches: DataFrame, whole: DataFrame, near: int) -> DataFrame:
    """The first and last of a query, extended to its ends where those are less than near away."""
    d = stretches.join(whole.select("q_id", F.col("pos").alias("w_pos"), _end().alias("w_end")), "q_id")
    w = Window.partitionBy("q_id")
    first, last = F.col("pos") == F.min("pos").over(w), F.col("pos") == F.max("pos").over(w)
    a = F.when(first & (F.col("pos") - F.col("w_pos") < near), F.col("w_pos")).otherwise(F.col("pos"))
    b = F.when(last & (F.col("w_end") - _end() < near), F.col("w_end")).otherwise(_end())
    return d.select("q_id", a.alias("pos"), (b - a).alias("len"))


def div_intervals(nodes: DataFrame, repeats: DataFrame, whole: DataFrame, primary: DataFrame, window: int = DEFAULT.chimeric_window, terminal: int = DEFAULT.chimeric_terminal, pct: int = DEFAULT.chimeric_pct) -> DataFrame:
    """(q_id, pos, len, chimeric) that cover each query: the chimeric intervals and what is left between them; a query without any is one
    interval. nodes: matches (q_id, pos, len, div); repeats: (q_id, pos, len); whole: (q_id, pos, len) of queries; primary: (q_id, div)."""
    tracks = settled(intervals.merge(nodes, ["q_id", "div"]))
    rest = intervals.subtract(intervals.merge(nodes, Q), primary_track(tracks, primary), Q)
    rest = intervals.subtract(rest, intervals.merge(repeats, Q), Q)
    found = led_by_one(dense_stretches(rest, whole, window, terminal, pct), tracks, pct)
    found = settled(reach_out(join_long(intervals.merge(found, Q, window // 4)), whole, window // 4))
    between = intervals.invert_whole(found, Q, whole)
    return found.withColumn("chimeric", F.lit(True)).unionByName(between.withColumn("chimeric", F.lit(False)))
