"""The cascade of rules that turns the spans of a sequence into actions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import classify as cl

SILENT = ["ACCEPT", "KEEP", "MEH"]


def _is_euk(div: Column) -> Column:
    """The action side's rule: one of the four prefixes."""
    return F.substring(div, 1, 4).isin("anml", "fung", "plnt", "prst")


def _prok_or_arch(div: Column) -> Column:
    return F.substring(div, 1, 4).isin("prok", "arch")


def _case(rules: list[tuple[Column, str, str]]) -> Column:
    """(action, rule) of the first test that holds."""
    out = F
    for test, action, rule in rules:
        out = out.when(F.coalesce(test, F.lit(False)), F.struct(F.lit(action).alias("action"), F.lit(rule).alias("rule")))
    return out


def cascade(
    spans: DataFrame, stats: DataFrame, primary: str, low_coverage: int = 10, good_len: int = 50_000, good_pct: int = 30, good_abs: int = 200,
    demote_rare: bool = False, demote_same: bool = False, low_mode: bool = False, everything: bool = False,
) -> DataFrame:
    """(seq_id, pos, len, action, rule, div, cov) from spans (seq_id, pos, len, ungap_len, label, low, review, integrant, div, cov, tax_name,
    outside) and per-sequence stats (seq_id, seq_len, ungap_len, div, cov, chimera). label: primary, contaminant or grey; low: its class is a
    low-coverage contaminant; review: most of it is; integrant: a contaminant between hosts; outside: its extrachromosomal length; chimera:
    an endosymbiotic one. Spans are those left after trims. demote_rare marks bacteria and archaea for a rare review, demote_same accepts
    contaminants of the primary's kingdom, low_mode keeps low-coverage ones of it, everything returns silent actions too."""
    p, w = F.lit(primary), Window.partitionBy("seq_id")
    ordered = w.orderBy("pos")
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = stats.select("seq_id", "seq_len", F.col("ungap_len").alias("_ungap"), F.col("div").alias("_div"), F.col("cov").alias("_cov"), "chimera")
    good, bad = F.col("label") == "primary", F.col("label") == "contaminant"
    d = spans.join(s, "seq_id").withColumns({
        "_n": F.count("*").over(w), "_i": F.row_number().over(ordered), "_kept": F.sum(F.when(good, F.col("ungap_len")).otherwise(0)).over(w),
        "_bad": F.max(bad.cast("int")).over(w), "_out": F.sum("outside").over(w), "_last_low": F.last("low").over(whole)})
    div, cov = F.col("div"), F.col("cov")
    thin, rare = cov <= low_coverage, F.lit(demote_rare)
    akin, akin_pa = F.substring(div, 1, 5) == primary[:5], cl.same_prefix(div, p)
    endo = F.lower("tax_name").contains("wolbachia")
    one = _case([
        (good & _is_euk(p) & (F.col("_out") > 0.8 * F.col("seq_len")), "ORGANELLE", "S04"),
        (good, "ACCEPT", "S02"),
        (thin, "ACCEPT", "coverage too low to decide"),
        (~bad, "MEH", "S03"),
        (rare & _prok_or_arch(div), "REVIEW_RARE", "prok or arch of one kingdom"),
        (F.lit(demote_same) & akin, "ACCEPT", "same kingdom ignored"),
        (F.col("chimera"), "INFO", "endosymbiotic chimera"),
        (F.col("review"), "REVIEW", "low-coverage review"),
        (akin & (cov < 20), "REVIEW", "S01"),
        (F.lit(True), "EXCLUDE", "S01"),
    ])
    out_div, out_cov = F.col("_div"), F.col("_cov")
    all_ = _case([
        (out_cov <= low_coverage, "ACCEPT", "M05"),
        (rare & _prok_or_arch(out_div), "REVIEW_RARE", "prok or arch of one kingdom"),
        (F.col("_last_low"), "REVIEW", "low-coverage review"),
        (cl.same_prefix(out_div, p) & (out_cov < 20), "REVIEW", "same kingdom with coverage under 20 %"),
        (F.lit(True), "EXCLUDE", "M01"),
    ])
    edge = (F.col("pos") == 1) | (F.col("pos") + F.col("len") - 1 == F.col("seq_len"))
    held = F.col("integrant")
    same_review = F.lit(low_mode) & akin
    many = _case([
        (good, "KEEP", "primary"),
        (thin, "KEEP", "coverage too low to decide"),
        (F.lit(demote_same) & akin, "KEEP", "same kingdom ignored"),
        (~bad, "", ""),
        (_is_euk(p) & endo, "INFO", "Endosymbiont"),
        (held & (div.startswith("prok") | endo), "INFO", "Endosymbiont"),
        (held & div.contains("virus"), "KEEP", "integrant virus"),
        (~held & F.col("review") & same_review, "KEEP", "same kingdom low coverage contaminant"),
        (~held & F.col("review"), "REVIEW", "low-coverage review"),
        (~held & akin_pa & (F.col("len") * cov / 100 < 10_000), "KEEP", "same kingdom with effective length under 10000"),
        (~held & rare & _prok_or_arch(div), "REVIEW_RARE", "prok or arch of one kingdom"),
        (~held & akin_pa & same_review, "KEEP", "same kingdom low coverage contaminant"),
        (~held & akin_pa, "REVIEW", "same kingdom with effective length of 10000 or more"),
        (edge, "TRIM", "M02"),
        (F.lit(True), "FIX", "M03"),
    ])
    little = (F.col("_kept") < good_abs) | ((F.col("_bad") > 0) & (F.col("_kept") < good_len) & (F.col("_kept") / F.col("_ungap") * 100 < good_pct))
    kind = F.when(F.col("_n") == 1, "one").when(little, "all").otherwise("many")
    d = d.withColumn("_kind", kind).filter((F.col("_kind") != "all") | (F.col("_i") == 1))
    d = d.withColumn("_x", F.when(F.col("_kind") == "one", one).when(F.col("_kind") == "all", all_).otherwise(many))
    as_all, not_many = F.col("_kind") == "all", F.col("_kind") != "many"
    out = d.select(
        "seq_id", F.when(not_many, 1).otherwise(F.col("pos")).cast("long").alias("pos"), F.when(not_many, F.col("seq_len")).otherwise(F.col("len")).cast("long").alias("len"),
        "_x.action", "_x.rule", F.when(as_all, out_div).otherwise(div).alias("div"), F.when(as_all, out_cov).otherwise(cov).alias("cov"))
    return out.filter("action <> ''") if everything else out.filter((F.col("action") != "") & ~F.col("action").isin(SILENT))
