"""What the second round of seeding needs: which taxa it looks at, where on their subjects, and its finer seeds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..adapters import barrier, settled
from . import intervals, words

NORMS = ["n", "sum_len", "sum_squares", "max_len", "mean_len", "mean_square"]


def taxon_norms(segments: DataFrame) -> DataFrame:
    """Per query and taxon: number, sum, sum of squares and maximum of segment lengths, their mean and mean square."""
    n = F.col("len").cast("long")
    g = segments.groupBy("q_oid", "tax_id").agg(F.count("*").alias("n"), F.sum(n).alias("sum_len"), F.sum(n * n).alias("sum_squares"), F.max(n).alias("max_len"))
    return g.withColumns({"mean_len": F.col("sum_len") / F.col("n"), "mean_square": F.col("sum_squares") / F.col("n")})


def candidate_taxa(norms: DataFrame, divs: DataFrame) -> DataFrame:
    """(q_oid, tax_id) that lead by any norm: the best two, and the best of another division than the first's. divs: (tax_id,
    div); ties go to the smaller tax_id."""
    d = norms.join(divs, "tax_id").select("q_oid", "tax_id", "div", F.explode(F.array(*(F.struct(F.lit(k).alias("norm"), F.col(c).cast("double").alias("v")) for k, c in enumerate(NORMS)))).alias("x"))
    w = Window.partitionBy("q_oid", "x.norm").orderBy(F.desc("x.v"), "tax_id")
    d = d.withColumns({"_r": F.row_number().over(w), "_d": F.first("div").over(w)})
    other = F.when((F.col("div") != F.col("_d")) & (F.col("_r") > 2), F.col("_r"))
    d = d.withColumn("_o", F.min(other).over(Window.partitionBy("q_oid", "x.norm")))
    return d.filter((F.col("_r") <= 2) | (F.col("_r") == F.col("_o"))).select("q_oid", "tax_id").distinct()


def neighbourhoods(segments: DataFrame, sizes: DataFrame, reach: int = 100_000, times: float = 2.0, wide: int = 50) -> DataFrame:
    """(q_oid, s_oid, pos, len) around and between the segments of a pair, up to min(reach, times * query length) away; gaps below
    30 are left out, and one interval serves a gap of less than twice that. sizes: (q_oid, s_oid, q_len, s_len)."""
    w = Window.partitionBy("q_oid", "s_oid").orderBy("s", "len", "q")
    d = segments.join(sizes, ["q_oid", "s_oid"]).withColumn("_n", F.least(F.lit(reach), F.floor(F.lit(times) * F.col("q_len"))).cast("long"))
    end = F.col("s") + F.col("len")
    d = d.withColumns({"_e": F.lag(end).over(w), "_f": F.lead("s").over(w)})
    piece = lambda a, b: F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    before, after = piece(F.col("s") - F.col("_n"), F.col("s")), piece(end, end + F.col("_n"))
    gap, ahead = F.col("s") - F.col("_e"), F.col("_f") - end
    left = F.when(F.col("_e").isNull() | (gap >= 2 * F.col("_n")), before).when(gap >= 30, piece(F.col("_e"), F.col("s")))
    right = F.when(F.col("_f").isNull() | (ahead >= 2 * F.col("_n")), after)
    d = d.select("q_oid", "s_oid", "s_len", F.explode(F.filter(F.array(left, right), lambda x: x.isNotNull())).alias("x"))
    a, b = F.greatest(F.col("x.a") - wide, F.lit(1)), F.least(F.col("x.b") + wide, F.col("s_len") + 1)
    d = d.select("q_oid", "s_oid", a.cast("long").alias("pos"), (b - a).cast("long").alias("len")).filter("len > 0")
    return intervals.merge(d, ["q_oid", "s_oid"], wide)


def second_round(segments: DataFrame, query: DataFrame, subject: DataFrame, template: int = 29, most: int = 10, least: int = 50, gap: int = 5, read: Callable[[bytes], bytes] | None = None) -> DataFrame:
    """Segments (q_oid, s_oid, minus, q, s, len) of at least ``least`` bases from short words, looked for only near the segments
    of leading taxa. A query's words that occur in it more often than ``most`` times are left out. subject has a column div if
    taxa belong to divisions, else all are one; read makes the sequence of its bytes, where its seq is not one yet."""
    segments = settled(segments)
    divs = subject.select("tax_id", "div") if "div" in subject.columns else segments.select("tax_id", F.lit("").alias("div"))
    taxa = candidate_taxa(taxon_norms(segments), divs.distinct())
    seg = settled(segments.join(taxa, ["q_oid", "tax_id"], "left_semi"))
    subject = words.found_subjects(subject, seg, read)
    q_len = query.select(F.col("oid").alias("q_oid"), F.length("seq").alias("q_len"))
    s_len = subject.select(F.col("oid").alias("s_oid"), F.length("seq").alias("s_len"))
    sizes = seg.select("q_oid", "s_oid").distinct().join(q_len, "q_oid").join(s_len, "s_oid")
    near = neighbourhoods(seg, sizes)
    cut = near.join(subject.select(F.col("oid").alias("s_oid"), "seq"), "s_oid")
    pieces = barrier(cut.select(F.struct("q_oid", "s_oid", "pos").alias("oid"), F.col("seq").substr(F.col("pos").cast("int"), F.col("len").cast("int")).alias("seq")))
    s = words.spaced_words(pieces, template).select(F.col("oid.q_oid").alias("q_oid"), F.col("oid.s_oid").alias("s_oid"), (F.col("oid.pos") - 1).alias("_o"), F.col("pos").alias("s"), "word")
    q = words.spaced_words(query, template).select(F.col("oid").alias("q_oid"), F.col("pos").alias("q"), "word")
    q = q.withColumn("_c", F.count("*").over(Window.partitionBy("q_oid", "word"))).filter(F.col("_c") <= most).drop("_c")
    j = q.join(s, ["q_oid", "word"])
    turn = F.col("s") < 0
    place = lambda c: F.when(turn, 1 - F.col(c) - template).otherwise(F.col(c))
    seeds = j.select("q_oid", place("q").alias("q_pos"), "s_oid", (place("s") + F.col("_o")).alias("s_pos")).distinct()
    return words.coalesce(seeds, template, gap).filter(F.col("len") >= least)
