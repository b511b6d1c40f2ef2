"""Greedy choice of subjects: in order of preference an assembly is taken unless its taxon, its species or a close neighbour of its
taxon has been.

The order is one over all assemblies, so the choice is not made group by group: in each round an assembly is settled as soon as what
was taken before decides it, or as soon as nothing before it that could matter is open any more. Rounds see, for each taxon, only
the first open and the first taken assembly that touches it; a taxon with any number of assemblies is one row there, no pair of assemblies is
ever made, and all assemblies of a taxon are settled together. Rounds are few where preference has nothing to do with neighbourhood, and as many as the longest chain of open neighbours
in falling preference at worst.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..adapters import settled
from .dataflow import ordinal

# Divisions that are well represented, and the proximity from which taxa count as neighbours there.
PROXIMITY = {
    "anml:fishes": 0.25,
    "plnt:plants": 0.25,
    "anml:insects": 0.4,
    "fung:ascomycetes": 0.4,
    "anml:reptiles": 0.4,
    "anml:rodents": 0.4,
    "anml:birds": 0.45,
    "anml:mammals": 0.45,
    "anml:marsupials": 0.45,
    "anml:placentals": 0.45,
}
SMALL, SMALL_PROXIMITY, OTHER_PROXIMITY = ("prst", "prok", "arch", "virs"), 0.7, 0.6


def close_taxa(proximity: DataFrame, divs: DataFrame) -> DataFrame:
    """Both directions (a, b) of taxa closer than the lower threshold of their divisions. proximity: (t1, t2, score); divs: (tax_id, div)."""
    own = F.create_map(*(F.lit(x) for kv in PROXIMITY.items() for x in kv))
    of = lambda k: divs.select(F.col("tax_id").alias(f"t{k}"), F.col("div").alias(f"d{k}"))
    p = proximity.filter("t1 <> t2").join(of(1), "t1", "left").join(of(2), "t2", "left")
    small = lambda d: F.coalesce(F.substring(d, 1, 4).isin(*SMALL) & (F.substring(d, 5, 1) == ":"), F.lit(False))
    default = F.when(small(F.col("d1")) & small(F.col("d2")), SMALL_PROXIMITY).otherwise(OTHER_PROXIMITY)
    least = F.least(*(F.coalesce(F.try_element_at(own, F.coalesce(F.col(d), F.lit(""))), default) for d in ("d1", "d2")))
    e = p.filter(F.col("score") > least)
    return e.select(F.col("t1").alias("a"), F.col("t2").alias("b")).unionByName(e.select(F.col("t2").alias("a"), F.col("t1").alias("b"))).distinct()


def in_preference(assemblies: DataFrame, name: str = "ord") -> DataFrame:
    """Numbered by falling size of the division, division, weight, number of projects, size of the taxon, and share of n50 in the length; then by
    id."""
    by = lambda c: assemblies.groupBy(c).agg(F.count("*").alias(f"_{c}"))
    a = assemblies.join(by("div"), "div").join(by("tax_id"), "tax_id").withColumn("_share", F.col("n50") / F.col("len"))
    order = [F.desc("_div"), F.desc("div"), F.desc("weight"), F.desc("projects"), F.desc("_tax_id"), F.desc("_share"), F.asc("id")]
    return ordinal(a, order, name).select(*assemblies.columns, name)


def _touched(taken: DataFrame, close: DataFrame, *values: str) -> DataFrame:
    """(key, part, ...) of all taxa that assemblies (tax_id, sp_tax_id, ...) touch: their own, their species', their neighbours'."""
    own = taken.select(F.col("tax_id").alias("key"), F.lit(0).alias("part"), "tax_id", *values)
    species = taken.select(F.col("sp_tax_id").alias("key"), F.lit(1).alias("part"), F.col("sp_tax_id").alias("tax_id"), *values)
    near = taken.join(close, F.col("tax_id") == F.col("a")).select(F.col("b").alias("key"), F.lit(2).alias("part"), "tax_id", *values)
    return own.unionAll(species).unionAll(near)


def _references(rows: DataFrame, taken: DataFrame, close: DataFrame) -> DataFrame:
    """Those of the references (ord, tax_id, sp_tax_id) that are taken, all others that touch their taxa before them being settled: after each
    touch by another taxon the first one, which then is the last touch for those that follow."""
    touch = F.struct("ord", "part", "tax_id").alias("touch")
    history = _touched(taken, close, "ord").join(rows.select(F.col("tax_id").alias("key")).distinct(), "key", "left_semi").select("key", touch)
    history = history.groupBy("key").agg(F.array_sort(F.collect_list("touch")).alias("h"))
    earlier = F.filter("h", lambda x: x["ord"] < F.col("ord"))
    last = rows.join(history, rows["tax_id"] == history["key"], "left").withColumn("last", F.get(earlier, F.size(earlier) - 1))
    mine = last.filter("last is null or last.tax_id <> tax_id").groupBy("tax_id", "last").agg(F.min(F.struct("ord", "sp_tax_id")).alias("x"))
    return mine.select("x.ord", "tax_id", "x.sp_tax_id")


def _last_seen(rows: DataFrame, taken: DataFrame, close: DataFrame) -> DataFrame:
    """rows (ord, tax_id, sp_tax_id, ...) with seen: the taxon for which their taxon, or else their species, was last touched by an assembly
    taken before them. A taxon's history holds what was taken, which is little beside what was looked at."""
    history = _touched(taken, close, "ord").groupBy("key").agg(F.array_sort(F.collect_list(F.struct("ord", "part", "tax_id"))).alias("h"))

    def before(h: Column) -> Column:
        earlier = F.filter(h, lambda x: x["ord"] < F.col("ord"))
        return F.get(earlier, F.size(earlier) - 1)["tax_id"]

    out = rows
    for c, k in (("tax_id", "_t"), ("sp_tax_id", "_s")):
        out = out.join(history.select(F.col("key").alias(c), F.col("h").alias(k)), c, "left")
    return out.withColumn("seen", F.coalesce(before(F.col("_t")), before(F.col("_s")))).drop("_t", "_s")


def choose(assemblies: DataFrame, close: DataFrame) -> DataFrame:
    """assemblies (id, tax_id, sp_tax_id, status, ord) with what becomes of them. Status ok is taken unless touched, ok-reference unless its
    own taxon was the last to touch it, every other ok- status in any case; what is not taken has the status seen and the
    neighbour's taxon. Those that are not screened yet need it only if they are not touched."""
    a = settled(assemblies)
    ok = F.col("status").startswith("ok")
    kind = F.when(F.col("status") == "ok", "plain").when(F.col("status") == "ok-reference", "reference").otherwise("forced")
    some = a.filter(ok).select("ord", "tax_id", "sp_tax_id", kind.alias("kind"))
    taken = some.filter("kind = 'forced'").select("ord", "tax_id", "sp_tax_id")
    left = some.filter("kind <> 'forced'")
    nothing = F.lit(None).cast("long")
    while True:
        first = left.groupBy("tax_id", "sp_tax_id", "kind").agg(F.min("ord").alias("open"), nothing.alias("took"))
        first = first.unionAll(taken.groupBy("tax_id", "sp_tax_id").agg(F.min("ord").alias("took")).select("tax_id", "sp_tax_id", F.lit("taken"), nothing, "took")).withColumn("own", F.col("tax_id"))
        first = _touched(first, close, "own", "kind", "open", "took")
        others = F.when((F.col("kind") != "reference") | (F.col("key") != F.col("own")), F.col("open"))  # a reference does not wait for those of its taxon
        first = first.groupBy("key").agg(F.min("open").alias("open"), F.min("took").alias("took"), F.min(others).alias("others"))
        seen = left
        for c, k in (("tax_id", "t"), ("sp_tax_id", "s")):
            seen = seen.join(first.select(F.col("key").alias(c), *(F.col(x).alias(f"{x}_{k}") for x in ("open", "took", "others"))), c, "left")
        free = F.coalesce(F.least("open_t", "open_s") >= F.col("ord"), F.lit(True))
        hit = F.coalesce(F.least("took_t", "took_s") < F.col("ord"), F.lit(False))
        ready = F.coalesce(F.col("others_t") >= F.col("ord"), F.lit(True))
        step = F.when(F.col("kind") == "reference", F.when(ready, "look").otherwise("wait")).when(hit, "drop").when(free, "take").otherwise("wait")
        seen = settled(seen.select("ord", "tax_id", "sp_tax_id", "kind", step.alias("step")))
        counts = {r["step"]: r["count"] for r in seen.groupBy("step").count().collect()}
        new = seen.filter("step = 'take'").select("ord", "tax_id", "sp_tax_id")
        if counts.get("look"):
            new = new.unionAll(_references(seen.filter("step = 'look'"), taken, close))
        taken = settled(taken.unionByName(new))
        left = seen.filter("step = 'wait'").drop("step")
        if not counts.get("wait"):
            break
    asks = a.filter(ok | (F.col("status") == "not-prescreened"))
    said = _last_seen(asks.select("ord", "tax_id", "sp_tax_id"), taken, close).select("ord", "seen")
    out = a.join(said, "ord", "left").join(taken.select("ord", F.lit(True).alias("_in")), "ord", "left")
    gone = ok & F.col("_in").isNull()
    status = F.when(gone, "seen").when((F.col("status") == "not-prescreened") & F.col("seen").isNull(), "needs-prescreen").otherwise(F.col("status"))
    return out.withColumns({"nbr_tax_id": F.when(gone, F.col("seen")), "status": status}).select(*assemblies.columns, "nbr_tax_id")


def select_subjects(assemblies: DataFrame, proximity: DataFrame, divs: DataFrame) -> DataFrame:
    """The whole choice: order, neighbourhood, greedy pass."""
    return choose(in_preference(assemblies), settled(close_taxa(proximity, divs)))
