"""Filters, tags, batches and totals of matches and of the sequences they belong to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def drop_self(hits: DataFrame) -> DataFrame:
    """Without matches of a query with the subject that it is (a part of): its id up to the first tilde is the subject's."""
    return hits.filter(F.split(F.col("q_id").cast("string"), "~")[0] != F.col("s_id").cast("string"))


def drop_taxa(hits: DataFrame, taxa: list[int]) -> DataFrame:
    return hits.filter(~F.col("tax_id").isin(taxa)) if taxa else hits


def tag_extrachromosomal(hits: DataFrame, ids: DataFrame, asserted: str) -> DataFrame:
    """With a flag where the subject is one of ids (s_id) and belongs to the asserted division."""
    known = ids.select("s_id").distinct().withColumn("_x", F.lit(True))
    return hits.join(known, "s_id", "left").withColumn("extra", F.coalesce("_x", F.lit(False)) & (F.col("div") == asserted)).drop("_x")


def running_total(df: DataFrame, order: str, value: Column, name: str, width: int = 1 << 16) -> DataFrame:
    """With the sum of value over the rows before, in the order of an integer column without ties. Rows are summed within stretches
    of width values of it; only one row for each stretch is summed in one task."""
    d = df.withColumns({"_b": F.floor(F.col(order) / width), "_v": value})
    part = d.groupBy("_b").agg(F.sum("_v").alias("_s"))
    part = part.withColumn("_before", F.sum("_s").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))).drop("_s")
    own = F.sum("_v").over(Window.partitionBy("_b").orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    return d.withColumn("_own", own).join(part, "_b").withColumn(name, F.coalesce("_before", F.lit(0)) + F.coalesce("_own", F.lit(0))).drop("_b", "_v", "_own", "_before")


def batches(seqs: DataFrame, order: str, size: Column, stride: int = 100_000) -> DataFrame:
    """With the number of the batch: by the length of all sequences before, divided by stride."""
    return running_total(seqs, order, size, "_t").withColumn("batch", F.floor(F.col("_t") / stride)).drop("_t")


def repeat_source(seqs: DataFrame, short: int = 1000, long: int = 100_000, share: int = 5) -> DataFrame:
    """(seq_id, len) that repeat statistics are taken from: not the short ones, all long ones, and of those between, by ascending
    length, none while what has been dropped stays below a fifth of the total. Sums run over distinct lengths, at most long - short
    rows, and within one length."""
    total = seqs.agg(F.sum("len").alias("_total"), F.coalesce(F.sum(F.when(F.col("len") < short, F.col("len"))), F.lit(0)).alias("_short"))
    mid = seqs.filter((F.col("len") >= short) & (F.col("len") < long))
    by = mid.groupBy("len").agg(F.sum("len").alias("_s"))
    by = by.withColumn("_before", F.coalesce(F.sum("_s").over(Window.orderBy("len").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_s")
    upto = F.col("_before") + F.sum("len").over(Window.partitionBy("len").orderBy("seq_id").rowsBetween(Window.unboundedPreceding, 0))
    kept = mid.join(by, "len").withColumn("_upto", upto).crossJoin(F.broadcast(total)).filter((F.col("_short") + F.col("_upto")) * share >= F.col("_total"))
    return kept.select("seq_id", "len").unionByName(seqs.filter(F.col("len") >= long).select("seq_id", "len"))


def n_counts(seqs: DataFrame) -> DataFrame:
    return seqs.select("oid", (F.length("seq") - F.length(F.replace("seq", F.lit("N"), F.lit("")))).cast("long").alias("n"))


def run_info(report: DataFrame, asserted: str, primary: DataFrame) -> DataFrame:
    """One row of JSON: sequences, length, the share of it covered by any match, the asserted and the inferred divisions (div)."""
    t = report.agg(F.count("*").alias("sequences"), F.sum("seq_len").alias("length"), F.round(F.sum("cvg_by_all") / F.sum("seq_len"), 6).alias("coverage"))
    p = primary.agg(F.array_sort(F.collect_set("div")).alias("primary_divs"))
    return t.crossJoin(F.broadcast(p)).select(F.to_json(F.struct("sequences", "length", "coverage", F.lit(asserted).alias("asserted_div"), "primary_divs")).alias("info"))
