"""Rows as the tables that other programs read: matches with their synthetic subjects, reports, edit actions, and side tables of an
index; and a writer that puts the header lines on top."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import hits
from .files import HITS, make_metaline

#: Subjects that stand for tracks of the query.
SELF, N_RUN, LOW_COMPLEXITY, TRANSPOSON = "_self", "_N_run", "_low_complexity", "_transposon"
HIT_COLUMNS = [x.split()[0] for x in HITS.split(", ")]
REPORT_NAMES = ["seq-id", "seq-len", "xp,lc,co,n,xc", "cvg-by-all", "sep1", "tax-name-1"] + [f"{c}-{i}" if c != "sep" else f"sep{i + 1}" for i in range(1, 5) for c in ("tax-id", "div", "cvg-by-div", "cvg-by-tax", "score", "sep")]
ACTION_NAMES = ["seq_id", "start_pos", "end_pos", "seq_len", "action", "div", "agg_cont_cov", "top_tax_name"]


def hit_rows(matches: DataFrame, query: DataFrame, n_runs: DataFrame, low_complexity: DataFrame, transposons: DataFrame) -> DataFrame:
    """Matches, tracks (q_id, pos, len) and one row for each query (q_id, seq) as the eight columns of a match table. A track has
    subject place 1 and no taxon; a query's own row has its length twice and its number of N."""
    def row(df, s_id, n, l2, mismatches, pos=None):
        zero = F.lit(0)
        return df.select("q_id", (pos if pos is not None else F.col("pos")).cast("int").alias("q_pos"), zero.cast("int").alias("tax_id"), F.lit(s_id).alias("s_id"), F.lit(1).cast("int").alias("s_pos"), n.cast("int").alias("len"), l2.cast("long").alias("l2"), mismatches.cast("int").alias("mismatches"))

    out = matches.select(*HIT_COLUMNS)
    for df, name in ((n_runs, N_RUN), (low_complexity, LOW_COMPLEXITY), (transposons, TRANSPOSON)):
        out = out.unionByName(row(df, name, F.col("len"), F.lit(0), F.lit(0)))
    size = F.length("seq")
    counted = query.select("q_id", size.alias("len")).join(hits.n_counts(query.select(F.col("q_id").alias("oid"), "seq")).withColumnRenamed("oid", "q_id"), "q_id")
    return out.unionByName(row(counted, SELF, F.col("len"), F.col("len"), F.col("n"), F.lit(1)))


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def _report() -> list[Column]:
    out = [F.col("seq_id"), F.col("len"), F.concat_ws(",", *(_text(F.col(c)) for c in ("xp", "lc", "co", "n", "xc"))), F.col("cvg_by_all"), F.lit("|"), F.col("tax_name")]
    for i in range(4):
        t = F.get("taxa", F.lit(i))
        out += [t["tax_id"], t["div"], t["cvg_by_div"], t["cvg_by_tax"], t["score"], F.lit("|")]
    return out


def report_columns(records: DataFrame) -> DataFrame:
    """The 30 columns of a taxonomy report from (seq_id, len, xp, lc, co, n, xc, cvg_by_all, tax_name, taxa)."""
    return records.select(*(_text(c).alias(n) for c, n in zip(_report(), REPORT_NAMES, strict=True)))


def classified_columns(records: DataFrame) -> DataFrame:
    """34 columns: a report's, then one reserved, the class, its division, and the percentage that the division covers."""
    own = F.get(F.filter("taxa", lambda x: x["div"] == F.col("result_div")), F.lit(0))
    pct = scalars.as_pct(F.coalesce(own["cvg_by_div"], F.lit(0)), F.greatest(F.col("len"), F.lit(1)))
    names = [*REPORT_NAMES, "reserved", "result", "result_div", "div_pct_cvg"]
    return records.select(*(_text(c).alias(n) for c, n in zip([*_report(), F.lit("n/a"), F.col("result"), F.col("result_div"), pct], names, strict=True)))


def action_columns(actions: DataFrame) -> DataFrame:
    """The eight columns of an action report from (seq_id, pos, len, seq_len, action, div, agg_cov, top_tax_name)."""
    end = F.col("pos") + F.col("len") - 1
    out = [scalars.unescape_tilde(F.col("seq_id")), F.col("pos"), end, F.col("seq_len"), F.col("action"), F.col("div"), F.col("agg_cov"), F.col("top_tax_name")]
    return actions.select(*(_text(c).alias(n) for c, n in zip(out, ACTION_NAMES, strict=True)))


def sequence_info(seqs: DataFrame, taxa: DataFrame) -> DataFrame:
    """(seq_id, length, tax_id, species, common_name, blast_div, div) of subjects (seq_id, seq, tax_id)."""
    j = seqs.select("seq_id", F.length("seq").cast("long").alias("length"), "tax_id").join(taxa, "tax_id")
    return j.select("seq_id", "length", "tax_id", "species", "common_name", "blast_div", "div")


def index_meta(info: DataFrame) -> DataFrame:
    """One row: number of sequences and billions of bases."""
    return info.agg(F.count("*").alias("seqs"), F.round(F.coalesce(F.sum("length"), F.lit(0)) / 1e9, 6).alias("Gbp"))


def write_table(df: DataFrame, path: str, name: str, major: int, minor: int = 0, **content) -> None:
    """Tab-separated text with the JSON line and the column names on top: the header is the first partition, so the first file."""
    spark = df.sparkSession
    top = spark.createDataFrame([(make_metaline(name, major, minor, **content) + "\n#" + "\t".join(df.columns),)], "value string").coalesce(1)
    top.unionByName(df.select(F.concat_ws("\t", *(_text(F.col(f"`{c}`")) for c in df.columns)).alias("value"))).write.text(path)


def write_manifest(files: DataFrame, version: str) -> DataFrame:
    """One JSON row for files (path, size, digest), to be written as text."""
    item = F.struct(F.col("path").alias("fileName"), F.col("size").alias("fileSize"), F.lit("md5").alias("hashAlgorithm"), F.col("digest").alias("hashValue"))
    g = files.agg(F.count("*").alias("totalFiles"), F.array_sort(F.collect_list(item)).alias("fileDetails"))
    return g.select(F.to_json(F.struct(F.lit(version).alias("version"), "totalFiles", "fileDetails")).alias("value"))
