"""Choice of subjects: preference order, and a greedy pass that leaves out close neighbours of what was taken."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def neighbours(edges: DataFrame, least: float) -> DataFrame:
    """Both directions of edges (a, b, score) with at least that score."""
    e = edges.filter(F.col("score") >= least)
    return e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()


def greedy(candidates: DataFrame, edges: DataFrame, group: str) -> DataFrame:
    """candidates (id, group, preference): in each group, by falling preference, a candidate is taken unless one of its
    neighbours was. Groups must have no edges between them."""
    near = edges.groupBy("a").agg(F.collect_set("b").alias("near"))
    d = candidates.join(near, candidates["id"] == near["a"], "left").drop("a")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["preference", "id"], ascending=[False, True])
        taken, rows = set(), []
        for k, (i, near) in enumerate(zip(pdf["id"], pdf["near"], strict=True)):
            if near is None or not taken.intersection(near):
                taken.add(i)
                rows.append(k)
        return pdf.iloc[rows][["id", group, "preference"]]

    return d.groupBy(group).applyInPandas(run, candidates.select("id", group, "preference").schema)


def greedy_of_classes(candidates: DataFrame, meets: DataFrame, group: str) -> DataFrame:
    """The same choice where neighbourhood is a matter of classes: candidates (id, group, preference, class), meets (group, a, b): all
    candidates of class a of a group are neighbours of all others of class b there; null classes have none. No pair of candidates is made.

    A class is open to its first candidate or to none: if that one is left out, what was taken before it keeps all later ones out; if it is
    taken, no class that meets this one can follow, so all later ones are taken, unless the class meets itself. So only first candidates, a row
    for each class, go through the greedy pass."""
    c = candidates.withColumn("_p", F.nanvl(F.col("preference").cast("double"), F.lit(None)))
    both = meets.select(group, "a", "b").unionByName(meets.select(group, F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    order = F.struct(F.col("_p").isNull().alias("none"), (-F.col("_p")).alias("down"), "id")
    known = c.filter(F.col(group).isNotNull() & F.col("class").isNotNull())
    first = known.groupBy(group, "class").agg(F.min(order).alias("_f"))
    at = first.select(group, "class", F.col("_f.id").alias("id"))
    edges = both.join(at.select(group, F.col("class").alias("a"), F.col("id").alias("_a")), [group, "a"]).join(at.select(group, F.col("class").alias("b"), F.col("id").alias("_b")), [group, "b"])
    edges = edges.filter("_a <> _b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
    heads = first.select(F.col("_f.id").alias("id"), group, (-F.col("_f.down")).alias("preference"))
    won = greedy(heads, edges, group).select(F.col("id").alias("_head"))
    alone = both.filter("a = b").select(group, F.col("a").alias("class"), F.lit(True).alias("_alone"))
    classes = at.withColumnRenamed("id", "_head").join(won, "_head", "left_semi").join(alone, [group, "class"], "left")
    taken = known.join(classes, [group, "class"]).filter(F.col("_alone").isNull() | (F.col("id") == F.col("_head")))
    free = c.filter(F.col(group).isNull() | F.col("class").isNull())
    columns = ["id", group, "preference"]
    return taken.select(*columns).unionByName(free.select(*columns))


def group_summary(df: DataFrame, by: str, value: str) -> DataFrame:
    return df.groupBy(by).agg(F.count("*").alias("n"), F.count_distinct(value).alias("n_unique"), F.sum(value).alias("total"), F.percentile(value, 0.5).alias("median"))


def load_dict(df: DataFrame, key: str, value: str) -> DataFrame:
    """Key, its first value, and whether it has several."""
    return df.groupBy(key).agg(F.min(value).alias(value), (F.count_distinct(value) > 1).alias("conflict"))


def sync_status(manifest: DataFrame, found: DataFrame) -> DataFrame:
    """(path, status) of manifest and found files (path, size, digest)."""
    f = found.select("path", F.col("size").alias("_s"), F.col("digest").alias("_d"))
    j = manifest.join(f, "path", "full_outer")
    return j.select("path", F.when(F.col("_s").isNull(), "missing").when(F.col("size").isNull(), "extra").when(F.col("size") != F.col("_s"), "size").when(F.col("digest") != F.col("_d"), "checksum").otherwise("up-to-date").alias("status"))


def assembly_weight(a: DataFrame) -> DataFrame:
    """With the preference of each assembly: refused -1, accepted 10, from the curated collection 7 to 5 by its category, from the other
    4 to 2 where that is in scope for its division, else 1 with a category and 0 without. Columns: accept, refuse, curated_id,
    category, div, excluded (array)."""
    reference, representative = F.col("category").startswith("reference"), F.col("category").startswith("representative")
    king, why = F.substring("div", 1, 4), F.col("excluded")
    scope = F.col("div").isin("anml:rotifers", "anml:nematodes", "plnt:green algae") | king.isin("fung", "prst") | (king.isin("prok", "arch") & (why == F.array(F.lit("derived from metagenome")))) | ((king == "virs") & (F.size(why) == 0))
    curated = F.coalesce("curated_id", F.lit("")) != ""
    rank = lambda high: F.when(reference, high).when(representative, high - 1).otherwise(high - 2)
    return a.withColumn("weight", F.when(F.col("refuse"), -1).when(F.col("accept"), 10).when(curated, rank(7)).when(scope, rank(4)).when(reference | representative, 1).otherwise(0))


def assembly_status(a: DataFrame, large: float = 4.3e9) -> DataFrame:
    """With the first reason that holds: not in scope, accepted, refused, reference, too large, too fragmented, not screened; else
    ok. Further columns: ftp_path, weight, len, n50, screened."""
    king = F.substring("div", 1, 4)
    whole = (F.col("n50") == F.col("len")) | (F.col("n50") > 20_000) | (((F.coalesce("curated_id", F.lit("")) != "") | (king == "prst")) & (F.col("n50") > 10_000)) | (king == "virs")
    status = F.when(F.coalesce("ftp_path", F.lit("")) == "", "not-in-scope").when(F.col("accept"), "ok-acceptlist").when(F.col("refuse"), "denylist").when(F.col("category").startswith("reference"), "ok-reference").when((F.col("weight") < 2) | (F.col("div") == "unkn:unknown"), "not-in-scope").when(F.col("len") > large, "too-large").when(~whole, "low-n50").when(~F.col("screened"), "not-prescreened").otherwise("ok")
    return a.withColumn("status", status)
