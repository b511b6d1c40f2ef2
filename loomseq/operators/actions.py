"""From classified rows to spans, statistics, edit actions, and edited sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import intervals


def in_spans(rows: DataFrame) -> DataFrame:
    """rows: (seq_id, at, len, label, pct), label primary, contaminant or grey, with the number and label of their span. Runs of one decided
    label become spans. Greys between two of a kind join it. Between a contaminant and a primary they join the primary's row if the contaminant has 75 %
    or more, else the contaminant's if the primary has, else the primary's; between a primary and a contaminant the same holds
    with the contaminant's percentage looked at first."""
    w = Window.partitionBy("seq_id").orderBy("at")
    before, after = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    decided = F.col("label") != "grey"
    s = F.struct("label", "pct")
    d = rows.withColumn("_p", F.last(F.when(decided, s), ignorenulls=True).over(before)).withColumn("_n", F.first(F.when(decided, s), ignorenulls=True).over(after))
    p, n = F.col("_p"), F.col("_n")
    contaminated = p["label"] == "contaminant"
    right = F.when(contaminated, F.when(p["pct"] >= 75, True).when(n["pct"] >= 75, False).otherwise(True)).otherwise(F.when(n["pct"] >= 75, False).when(p["pct"] >= 75, True).otherwise(False))
    own = F.when(decided, F.col("label")).when(p.isNull() & n.isNull(), "grey").when(p.isNull(), n["label"]).when(n.isNull() | (p["label"] == n["label"]), p["label"]).when(right, n["label"]).otherwise(p["label"])
    d = d.withColumn("span_label", own)
    d = d.withColumn("_new", (~F.lag("span_label").over(w).eqNullSafe(F.col("span_label"))).cast("int"))
    return d.withColumn("span", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_p", "_n", "_new")


def spans(rows: DataFrame) -> DataFrame:
    """The spans of rows, with their places, length and number of rows."""
    return in_spans(rows).groupBy("seq_id", "span", "span_label").agg(F.min("at").alias("first_at"), F.max("at").alias("last_at"), F.sum("len").alias("len"), F.count("*").alias("rows"))


def seq_stats(rows: DataFrame) -> DataFrame:
    """Per sequence: covered length of each class by len * pct div 100, the leading label, and the longest division."""
    part = F.floor(F.col("len") * F.col("pct") / 100).cast("long")
    by = lambda k: F.sum(F.when(F.col("label") == k, part).otherwise(0)).alias(f"{k}_len")
    base = rows.groupBy("seq_id").agg(by("primary"), by("contaminant"), by("grey"), F.sum("len").alias("seq_len"))
    def lead(c, name):
        t = rows.groupBy("seq_id", c).agg(F.sum("len").alias("_l"))
        return t.withColumn("_r", F.row_number().over(Window.partitionBy("seq_id").orderBy(F.desc("_l"), c))).filter("_r = 1").select("seq_id", F.col(c).alias(name))
    return base.join(lead("label", "top_label"), "seq_id").join(lead("div", "top_div"), "seq_id")


def div_stats(rows: DataFrame, review: int = 250_000) -> DataFrame:
    bad = F.col("label") == "contaminant"
    return rows.groupBy("div").agg(F.count("*").alias("rows"), F.sum("len").alias("total_len"), F.sum(F.when(bad, F.col("len")).otherwise(0)).alias("contaminant_len"), F.count_if(bad).alias("contaminants")).withColumn("review", F.col("contaminant_len") >= review)


def promote_low_coverage(rows: DataFrame, stats: DataFrame, pct: int = 10) -> DataFrame:
    """Grey rows of divisions under review with enough coverage become contaminants."""
    j = rows.join(F.broadcast(stats.filter("review").select("div").withColumn("_r", F.lit(True))), "div", "left")
    up = F.coalesce("_r", F.lit(False)) & (F.col("label") == "grey") & (F.col("pct") >= pct)
    return j.withColumn("label", F.when(up, "contaminant").otherwise(F.col("label"))).drop("_r")


def production_limits(actions: DataFrame) -> DataFrame:
    """One row of counts against limits: kingdoms, divisions, fixed and trimmed length, excluded and reviewed length."""
    is_in = lambda *a: F.col("action").isin(*a)
    d = actions.agg(F.count_distinct(F.when(is_in("EXCLUDE"), F.substring("div", 1, 4))).alias("kingdoms"), F.count_distinct(F.when(is_in("EXCLUDE"), F.col("div"))).alias("divs"), F.sum(F.when(is_in("FIX", "TRIM"), F.col("len")).otherwise(0)).alias("cut_len"), F.count_if(is_in("FIX", "TRIM")).alias("cuts"), F.sum(F.when(is_in("EXCLUDE", "REVIEW"), F.col("len")).otherwise(0)).alias("out_len"), F.sum("len").alias("total_len"))
    return d.withColumn("over", (F.col("kingdoms") > 1) | (F.col("divs") > 4) | (F.col("cut_len") > 50_000) | (F.col("cuts") > 2) | (F.col("out_len") > 50_000_000) | (F.col("out_len") * 5 > F.col("total_len")))


def review_needs_exclude(actions: DataFrame) -> DataFrame:
    """REVIEW rows become INFO where their division has no EXCLUDE."""
    has = actions.filter("action = 'EXCLUDE'").select("div").distinct().withColumn("_e", F.lit(True))
    j = actions.join(F.broadcast(has), "div", "left")
    return j.withColumn("action", F.when((F.col("action") == "REVIEW") & F.col("_e").isNull(), "INFO").otherwise(F.col("action"))).drop("_e")


def integrants(rows: DataFrame) -> DataFrame:
    """Contaminant rows with primary rows on both sides in their sequence."""
    w = Window.partitionBy("seq_id").orderBy("at")
    prim = F.when(F.col("label") == "primary", 1)
    d = rows.withColumn("_b", F.max(prim).over(w.rowsBetween(Window.unboundedPreceding, -1))).withColumn("_a", F.max(prim).over(w.rowsBetween(1, Window.unboundedFollowing)))
    return d.filter("label = 'contaminant' and _a = 1 and _b = 1").drop("_a", "_b")


def hosted_integrants(spans_: DataFrame, pattern: str = "(?i)wolbachia") -> DataFrame:
    """Spans (seq_id, pos, len, label, div, tax_name) that are probably part of the genome: between two neighbouring primary spans that
    both are prokaryotes or both are not, every decided span is an endosymbiont in a eukaryote, or a virus that the host on the
    left can have, with no gap between a primary span and a contaminant next to it."""
    w = Window.partitionBy("seq_id").orderBy("pos")
    prim = F.col("label") == "primary"
    prok = lambda c: F.substring(c, 1, 4) == "prok"
    me = F.struct("div", F.col("pos").alias("at"))
    d = spans_.withColumns({"_l": F.last(F.when(prim, me), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)), "_r": F.first(F.when(prim, me), ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))})
    end = F.col("pos") + F.col("len")
    turn = lambda c: F.coalesce((prim & (c == "contaminant")) | ((F.col("label") == "contaminant") & (c == "primary")), F.lit(False))
    before = turn(F.lag("label").over(w)) & (F.lag(end).over(w) < F.col("pos"))
    after = turn(F.lead("label").over(w)) & (end < F.lead("pos").over(w))
    d = d.withColumn("_gap", before | after).filter(~prim & F.col("_l").isNotNull() & F.col("_r").isNotNull())
    inside = Window.partitionBy("seq_id", "_l.at")
    host, div = F.col("_l.div"), F.col("div")
    guest = F.coalesce(F.col("tax_name").rlike(pattern), F.lit(False)) & F.substring(host, 1, 4).isin("anml", "fung", "plnt", "prst")
    virus = div.contains("virus") & ~host.startswith("virs:") & div.startswith(F.when(prok(host), "virs:prokaryotic").otherwise("virs:eukaryotic")) & ~F.max("_gap").over(inside)
    fits = (F.col("label") == "grey") | guest | virus
    return d.withColumn("_ok", F.min(fits).over(inside)).filter(F.col("_ok") & (prok(host) == prok(F.col("_r.div")))).select(*spans_.columns)


def endosymbiont_chimeras(rows: DataFrame, hosts: list[str], pattern: str = "Wolbachia|Rickettsia") -> DataFrame:
    """(seq_id) of sequences made of nothing but rows of a host division (primary, repeat or low coverage) and contaminant rows of
    endosymbionts, with some of both. rows: (seq_id, label, div, tax_name)."""
    guest = F.coalesce(F.col("tax_name").rlike(pattern), F.lit(False)) & (F.col("label") == "contaminant")
    host = ~guest & F.col("label").isin("primary", "repeat", "low-coverage") & F.col("div").isin(hosts)
    g = rows.groupBy("seq_id").agg(F.every(guest | host).alias("only"), F.some(guest).alias("guest"), F.some(host).alias("host"))
    return g.filter("only and guest and host").select("seq_id")


def _trim(items: Column, good_len: int, good_abs: int, pct: int) -> Column:
    """How many spans, from the first on, one trim takes: it goes on from contaminant to contaminant while the primary spans passed
    are short, alone and against the contaminated length."""
    start = F.struct(*(F.lit(0).cast("long").alias(c) for c in ("i", "taken", "bad", "good")), F.lit(None).cast("long").alias("last"), F.lit(False).alias("stop"))

    def state(a, **change):
        return F.struct(*((change[c] if c in change else a[c]).alias(c) for c in ("i", "taken", "bad", "good", "last", "stop")))

    def step(a, x):
        bad, nothing = a["bad"] + x["len"], F.lit(None).cast("long")
        enough = (a["i"] > 0) & (a["last"].isNull() | (a["last"] >= good_abs)) & (a["good"] * 100 >= bad * pct)
        contaminant = F.when(enough, state(a, stop=F.lit(True))).otherwise(state(a, i=a["i"] + 1, bad=bad, last=nothing, taken=a["i"]))
        primary = F.when(x["len"] >= good_len, state(a, stop=F.lit(True))).otherwise(state(a, i=a["i"] + 1, good=a["good"] + x["len"], last=x["len"]))
        return F.when(a["stop"], a).when(x["label"] == "contaminant", contaminant).when(x["label"] == "primary", primary).otherwise(state(a, i=a["i"] + 1))

    taken = F.aggregate(items, start, step)["taken"]
    return F.when(taken > 0, taken + 1).otherwise(0).cast("int")


def trim_ends(spans_: DataFrame, good_len: int = 50_000, good_abs: int = 200, pct: int = 30) -> DataFrame:
    """Spans (seq_id, pos, len, label) with what lies within a trim at either end made one contaminant span. Where both trims meet,
    the whole sequence is one."""
    d = spans_.groupBy("seq_id").agg(F.array_sort(F.collect_list(F.struct(F.col("pos").cast("long").alias("pos"), F.col("len").cast("long").alias("len"), "label"))).alias("x"))
    d = d.withColumns({"f": _trim(F.col("x"), good_len, good_abs, pct), "b": _trim(F.reverse("x"), good_len, good_abs, pct)})
    n = F.size("x")

    def one(part):
        first, last = F.element_at(part, 1), F.element_at(part, -1)
        return F.array(F.struct(first["pos"].alias("pos"), (last["pos"] + last["len"] - first["pos"]).alias("len"), F.lit("contaminant").alias("label")))

    some = lambda part, taken: F.when(taken > 0, one(part)).otherwise(F.slice("x", 1, 0))
    ends = F.concat(some(F.slice("x", 1, F.greatest("f", F.lit(1))), F.col("f")), F.slice("x", F.col("f") + 1, F.greatest(n - F.col("f") - F.col("b"), F.lit(0))), some(F.slice("x", n - F.greatest("b", F.lit(1)) + 1, F.greatest("b", F.lit(1))), F.col("b")))
    return d.select("seq_id", F.inline(F.when(F.col("f") + F.col("b") > n, one(F.col("x"))).otherwise(ends)))


def decide(spans_: DataFrame, seqs: DataFrame, short: int = 50_000, share: float = 0.3, least: int = 200) -> DataFrame:
    """Actions (seq_id, pos, len, action) from spans (seq_id, pos, len, label, pct, same_kingdom) and lengths (seq_id, seq_len)."""
    n = spans_.groupBy("seq_id").agg(F.count("*").alias("n"), F.sum(F.when(F.col("label") != "contaminant", F.col("len")).otherwise(0)).alias("kept"))
    d = spans_.join(n, "seq_id").join(seqs, "seq_id")
    bad = F.col("label") == "contaminant"
    whole = (F.col("kept") < least) | ((F.col("kept") < short) & (F.col("kept") < share * F.col("seq_len")))
    edge = (F.col("pos") == 1) | (F.col("pos") + F.col("len") - 1 == F.col("seq_len"))
    one = F.when(~bad, "ACCEPT").when(F.col("pct") <= 10, "ACCEPT").when(F.col("same_kingdom") & (F.col("pct") < 20), "REVIEW").otherwise("EXCLUDE")
    many = F.when(~bad, "KEEP").when(edge, "TRIM").otherwise("FIX")
    act = F.when(F.col("n") == 1, one).when(whole, "EXCLUDE").otherwise(many)
    d = d.withColumn("action", act)
    all_out = (F.col("n") > 1) & whole
    d = d.withColumn("_r", F.row_number().over(Window.partitionBy("seq_id").orderBy("pos"))).filter(~all_out | (F.col("_r") == 1))
    d = d.withColumns({"pos": F.when(all_out, F.lit(1)).otherwise(F.col("pos")), "len": F.when(all_out, F.col("seq_len")).otherwise(F.col("len"))})
    return d.filter(~F.col("action").isin("KEEP", "ACCEPT")).select("seq_id", F.col("pos").cast("long").alias("pos"), F.col("len").cast("long").alias("len"), "action")


def apply_actions(seqs: DataFrame, actions: DataFrame, min_length: int = 200) -> DataFrame:
    """(id, seq) after the actions (seq_id, pos, len, action): TRIM and EXCLUDE erase, FIX masks by N, SPLIT and ACTION_TRIM cut
    the sequence into pieces named id~from..to; others are ignored. Whole sequences shorter than min_length go, pieces not
    longer than it too."""
    kind = F.when(F.col("action").isin("TRIM", "EXCLUDE", "ACTION_EXCLUDE"), "erase").when(F.col("action") == "FIX", "mask").when(F.col("action").isin("SPLIT", "ACTION_TRIM"), "split")
    a = actions.withColumn("kind", kind).filter("kind is not null")
    size = seqs.select("seq_id", F.lit(1).cast("long").alias("pos"), F.length("seq").cast("long").alias("len"))
    cut = intervals.merge(a.filter("kind = 'split'"), ["seq_id"])
    kept = intervals.invert_whole(cut, ["seq_id"], size)
    parts = kept.select("seq_id", "pos", "len", F.lit(True).alias("piece")).join(cut.select("seq_id").distinct(), "seq_id", "left_semi").unionByName(size.join(cut.select("seq_id").distinct(), "seq_id", "left_anti").withColumn("piece", F.lit(False)))
    other = a.filter("kind <> 'split'").groupBy("seq_id").agg(F.array_sort(F.collect_list(F.struct("pos", "len", "kind"))).alias("edits"))
    d = parts.join(seqs, "seq_id").join(other, "seq_id", "left")
    d = d.withColumn("edits", F.reverse(F.filter(F.coalesce("edits", F.array().cast("array<struct<pos:bigint,len:bigint,kind:string>>")), lambda e: (e["pos"] >= F.col("pos")) & (e["pos"] < F.col("pos") + F.col("len")))))
    text = F.col("seq").substr(F.col("pos").cast("int"), F.col("len").cast("int"))

    def edit(s, e):
        at = (e["pos"] - F.col("pos")).cast("int")
        return F.concat(F.substring(s, F.lit(1), at), F.when(e["kind"] == "mask", F.repeat(F.lit("N"), e["len"].cast("int"))).otherwise(""), F.substring(s, (at + e["len"] + 1).cast("int"), F.length(s)))

    d = d.withColumn("out", F.aggregate("edits", text, edit))
    name = F.when(F.col("piece"), F.concat("seq_id", F.lit("~"), F.col("pos"), F.lit(".."), F.col("pos") + F.col("len") - 1)).otherwise(F.col("seq_id"))
    long = F.when(F.col("piece"), F.length("out") > min_length).otherwise(F.length("out") >= min_length)
    return d.filter(long).select(name.alias("id"), F.col("out").alias("seq"))


def summary(rows: DataFrame, by: str) -> DataFrame:
    """Count and length by a column, with a TOTAL row."""
    return rows.rollup(by).agg(F.count("*").alias("n"), F.sum("len").alias("len")).withColumn(by, F.coalesce(F.col(by).cast("string"), F.lit("TOTAL")))
