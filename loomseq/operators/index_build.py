"""An index of subjects from raw rows in one build: which sequences come in, how they are numbered, which places of them hold words, at
which stride, and the postings.

Raw rows are (seq_id, defline, seq) with a source and a place in it. Of neighbouring coding sequences of one gene the longest comes in;
then scope is looked at. Sequences are numbered by taxon and falling length, so that those of a taxon are together. Runs of N, low
complexity and both kinds of masks hold no words; what is left of a sequence is looked at in pieces of at least a template. A coding sequence in
frame has a stride of 18, which keeps the frame, others 11 for prokaryotes and viruses and 22 for the rest; strides count from the
sequence's start, not from a piece's. Sequences are cut into overlapping slices for this, and slices meet the spans in which words may begin.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..adapters import settled
from ..functions import scalars
from . import anywords, intervals, screen, sketch, words
from .dataflow import ordinal

SLICE = 65_340  # a multiple of every stride


def coding(rows: DataFrame) -> DataFrame:
    """Raw rows without the shorter ones among neighbours of one gene; rows without a gene stay."""
    d = rows.withColumn("gene", scalars.gene_symbol(F.col("defline")))
    none = d.filter("gene = ''")
    some = sketch.longest_per_symbol(d.withColumn("size", F.length("seq")), ["source"], ["place"], "gene", "size").filter("gene <> ''")
    return none.drop("gene").unionByName(some.select(*rows.columns))


def in_frame(seq_id: Column, seq: Column) -> Column:
    stop = (F.length(seq) % 3 == 0) & F.substring(seq, -3, 3).isin("TAA", "TAG", "TGA")
    return seq_id.contains("cds_") & (seq.startswith("ATG") | stop)


def numbered(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Raw rows with tax_id and oid, from 1. ids: (seq_id, tax_id)."""
    d = rows.join(ids.distinct(), "seq_id").withColumn("_n", F.length("seq"))
    return ordinal(d, ["tax_id", F.desc("_n"), "seq_id"], "oid").drop("_n")


def spans(seqs: DataFrame, masks: DataFrame, least: int = 56, low_complexity: bool = True) -> DataFrame:
    """(oid, pos, len) of the pieces of sequences (oid, seq) that hold words; masks: (oid, pos, len)."""
    every = masks.select("oid", "pos", "len").unionByName(words.n_runs(seqs))
    if low_complexity:
        every = every.unionByName(words.entropy_track(seqs))
    whole = seqs.select("oid", F.length("seq").cast("long").alias("len"))
    return screen.indexable(whole, every, ["oid"], least)


def build(raw: DataFrame, ids: DataFrame, taxa: DataFrame, hard: DataFrame, soft: DataFrame, template: int = 56, low_complexity: bool = True) -> tuple[DataFrame, DataFrame]:
    """((word, key30, key8, tax_id, oid, pos), numbered sequences). raw: (source, place, seq_id, defline, seq); ids: (seq_id, tax_id); taxa:
    (tax_id, div); masks: (seq_id, pos, len), of the hard ones a null len is the whole sequence."""
    rows = coding(raw)
    rows = rows.join(screen.in_scope(rows.select("seq_id", "defline"), ids, hard).select("seq_id"), "seq_id", "left_semi")
    seqs = settled(numbered(rows, ids))
    masks = hard.filter("len is not null").unionByName(soft).join(seqs.select("seq_id", "oid"), "seq_id").select("oid", "pos", "len")
    # two bounds of where a word may begin, from 0, for each slice that they touch
    free = spans(seqs, masks, template, low_complexity).select("oid", (F.col("pos") - 1).alias("a"), (F.col("pos") + F.col("len") - 1 - template).alias("b"))
    cell = F.explode(F.sequence(F.floor(F.col("a") / SLICE), F.floor(F.col("b") / SLICE))).alias("cell")
    free = free.select("oid", "a", "b", cell).groupBy("oid", "cell").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("spans"))
    kind = seqs.join(taxa, "tax_id", "left").select("oid", "tax_id", _stride(F.col("seq_id"), F.col("seq"), F.coalesce("div", F.lit(""))).alias("stride"))
    slices = anywords.pieces(seqs.select("oid", "seq"), template, SLICE).withColumn("cell", F.floor(F.col("at") / SLICE))
    found = anywords.words_between(slices.join(free, ["oid", "cell"]).join(kind, "oid"), template, "tax_id")
    posts = words.spelled(words.keep_two(found, word="code"), template).select("word", "tax_id", "oid", "pos")
    posts = words.split_key(posts)
    return posts, seqs


def _stride(seq_id: Column, seq: Column, div: Column) -> Column:
    small = F.substring(div, 1, 5).isin("prok:", "arch:", "virs:")
    return F.when(in_frame(seq_id, seq), 18).when(small, 11).otherwise(22)
