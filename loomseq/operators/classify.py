"""Classes of report rows (seq_id, len, xp, lc, co, n, cvg_by_all, taxa array<struct<tax_id, div, cvg_by_div, cvg_by_tax, score>>)
by an ordered cascade of rules, and the divisions that the rules look at. len counts the sequence without its n unknown letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of divisions and of classes.
VERTEBRATES = ["mammals", "fishes", "reptiles", "amphibians", "rodents", "birds", "vertebrates", "primates", "marsupials"]
WELL_KNOWN = [
    "prok:firmicutes",
    "prok:high GC Gram+",
    "prok:g-proteobacteria",
    "prok:a-proteobacteria",
    "prok:CFB group bacteria",
    "fung:ascomycetes",
    "prok:b-proteobacteria",
    "fung:basidiomycetes",
    "fung:budding yeasts",
    "prok:cyanobacteria",
    "prok:d-proteobacteria",
    "prok:proteobacteria",
    "prok:actinobacteria",
    "prok:mycoplasmas",
    "prok:spirochetes",
]
VIRUSES = ["virs:viruses", "virs:eukaryotic viruses", "virs:prokaryotic viruses"]
METAGENOMES = "unkn:metagenomes"
WEAK_NAMES = ["^bacterium", " bacterium", " phylum", " genomosp.", "symbiont"]
LABELS = {
    "primary": ["primary-div", "primary-div(virus)", "transposon"],
    "contaminant": ["contaminant(human)", "contaminant(div)", "same-kingdom-chimeric", "contaminant(virus)", "contaminant(cross-kingdom)",
                    "contaminant(cross-div)", "contaminant", "contaminant(low-coverage)"],
}


# ---- kinds of divisions -------------------------------------------------------------------------------------------------
def vertebrates() -> list[str]:
    return [f"anml:{x}" for x in VERTEBRATES]


def kingdom(div: Column) -> Column:
    """The first four letters; animals are split into vertebrates and the others."""
    return F.when(div.isin(vertebrates()), "vrbt").when(div.startswith("anml:"), "ivrt").otherwise(F.substring(div, 1, 4))


def is_prok(div: Column) -> Column:
    return div.startswith("prok:") | div.startswith("arch:")


def is_virus(div: Column) -> Column:
    """Viruses and synthetic sequences."""
    return div.startswith("virs:") | div.startswith("synt")


def is_euk(div: Column) -> Column:
    return ~is_prok(div) & ~is_virus(div)


def same_kingdom(a: Column, b: Column) -> Column:
    return ~a.isin("NULL", "synthetic") & ~b.isin("NULL", "synthetic") & (kingdom(a) == kingdom(b))


def same_prefix(a: Column, b: Column) -> Column:
    """The rule of the action side: one prefix, or bacteria and archaea."""
    both = lambda c: F.substring(c, 1, 4).isin("prok", "arch")
    return (F.substring(a, 1, 5) == F.substring(b, 1, 5)) | (both(a) & both(b))


def can_host_virus(div: Column, virus: Column) -> Column:
    kind = F.when(div.startswith("prok"), "virs:prokaryotic").otherwise("virs:eukaryotic")
    return ~div.startswith("virs:") & virus.startswith(kind)


def label_group(result: Column) -> Column:
    """primary, contaminant or grey."""
    return F.when(result.isin(LABELS["contaminant"]), "contaminant").when(result.isin(LABELS["primary"]), "primary").otherwise("grey")


# ---- divisions of a table of records ------------------------------------------------------------------------------------
def div_totals(records: DataFrame) -> DataFrame:
    """Over all rows and their taxa: per division the rows, their length, and coverage and score of the leading taxon."""
    t = records.select("len", F.posexplode("taxa").alias("rank", "t"))
    lead = lambda c: F.sum(F.when(F.col("rank") == 0, c).otherwise(0))
    return t.groupBy(F.col("t.div").alias("div")).agg(
        F.count("*").alias("rows"), F.sum("len").alias("total_len"), lead(F.col("len")).alias("first_len"),
        lead(F.col("t.cvg_by_div")).alias("first_cvg"), lead(F.col("t.score")).alias("first_score"))


def select_divs(records: DataFrame, primary: str, sensitive: bool = False) -> DataFrame:
    """(div, cvg, by_repeats, by_transposons, by_primary, own): well represented divisions, and the one with the most coverage in any
    case. Taxa near the leading score count, if they score over 150 or cover 80 % of their sequence."""
    repeats = F.col("lc") + F.col("co")
    by_primary = F.coalesce(F.array_max(F.transform(F.filter("taxa", lambda t: t["div"] == primary), lambda t: t["cvg_by_div"])), F.lit(0))
    t = records.select(
        "len", "xp", repeats.alias("rep"), by_primary.alias("by_primary"), F.element_at("taxa", 1)["score"].alias("top"), F.explode("taxa").alias("t")
    )
    c = F.col("t.cvg_by_div")
    t = t.filter((F.col("t.score") > F.col("top") * 0.8) & ((F.col("t.score") > 150) | (F.col("t.cvg_by_tax") > F.col("len") * 0.8)))
    sums = t.groupBy(F.col("t.div").alias("div")).agg(
        F.sum(c).alias("cvg"), F.sum(F.least(c, F.col("rep"))).alias("by_repeats"), F.sum(F.least(c, F.col("xp"))).alias("by_transposons"),
        F.sum(F.least(c, F.col("by_primary"))).alias("by_primary"), F.sum(F.greatest(F.lit(0), c - F.col("rep") - F.col("xp"))).alias("own"))
    most = F.greatest("by_repeats", "by_transposons", "by_primary")
    strict = F.lit(not sensitive) & is_euk(F.col("div")) & is_euk(F.lit(primary))
    chosen = F.when(strict, (most < F.col("cvg") * 0.5) & (F.col("own") > 25_000)).otherwise((most < F.col("cvg") * 0.75) & (F.col("own") > 10_000))
    first = sums.agg(F.max(F.struct("cvg", "div"))["div"].alias("first"))
    return sums.crossJoin(F.broadcast(first)).filter(chosen | (F.col("div") == F.col("first"))).drop("first")


def adjust_divs(runs: DataFrame) -> DataFrame:
    """runs (species, asserted_div, inferred array) with primary and contaminants, the divisions to take as such."""
    d, inferred, species = F.col("asserted_div"), F.col("inferred"), F.col("species")
    none = F.array().cast("array<string>")
    texts = lambda values: F.array(*map(F.lit, values))
    any_ = lambda test: F.exists(inferred, test)
    empty = F.size(inferred) == 0
    marked = F.concat(F.lit("^"), species)
    weak = F.coalesce(F.exists(texts(WEAK_NAMES), lambda w: marked.contains(w)), F.lit(False)) | F.coalesce((species == "genus_undefined") & is_prok(d), F.lit(False))
    fits = (
        empty
        | ((d == "prok:proteobacteria") & any_(lambda p: p.contains("proteobacteria")))
        | ((d == "prok:actinobacteria") & any_(lambda p: p == "prok:high GC Gram+"))
        | ((d == "prok:bacteria") & any_(lambda p: p.contains("prok:")))
        | (d.contains("prok:") & any_(lambda p: p == "prok:bacteria"))
    )
    well_known = d.isin(WELL_KNOWN)
    akin = same_kingdom(d, F.coalesce(F.get(inferred, 0), F.lit("NULL")))
    kept = F.coalesce(d.isNull() | F.array_contains(inferred, d), F.lit(True))
    added = empty | (weak & fits) | (akin & ~well_known)
    case = (
        F.when(d == VIRUSES[0], 1).when(d.isin(VIRUSES[1:]), 2).when(d == METAGENOMES, 3).when(kept, 4).when(added, 5).otherwise(6)
    )
    primary = (
        F.when(case == 1, texts(VIRUSES)).when(case == 2, F.array_append(inferred, F.lit(VIRUSES[0]))).when(case == 3, texts([METAGENOMES]))
        .when(case == 4, inferred).when(case == 5, F.concat(F.array(d), inferred)).otherwise(F.array(d))
    )
    bad = F.when(case == 3, texts(vertebrates())).when(case == 6, inferred).otherwise(none)
    return runs.withColumns({"primary": primary, "contaminants": bad})


# ---- classes ------------------------------------------------------------------------------------------------------------
def effective_fraction() -> Column:
    """Share of the leading division in what is not masked."""
    whole = F.greatest(F.col("len") - F.col("lc") - F.col("co") - F.col("xp"), F.col("cvg_by_all"))
    return F.element_at("taxa", 1)["cvg_by_div"] / F.greatest(whole, F.lit(1))


def high_evidence() -> Column:
    t = F.element_at("taxa", 1)
    return (t["cvg_by_tax"] > 200) & (t["score"] * t["score"] > 15 * t["cvg_by_tax"]) & (effective_fraction() > 0.5)


def classify(
    records: DataFrame, primary: list[str], contaminants: list[str], min_fraction: float = 0.2, min_scores=(30, 25, 40), outlier: bool = False
) -> DataFrame:
    """records with result and result_div; the first rule that holds decides. outlier: hits of the primary's kingdom are primary."""
    texts = lambda values: F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")
    ours, theirs, p0 = texts(primary), texts(contaminants), F.lit(primary[0])
    none, meta = F.size("taxa") == 0, F.lit(primary[0] == METAGENOMES)
    d = records.withColumn("_t", F.when(~none, F.try_element_at("taxa", F.lit(1))))
    t, div, size = F.col("_t"), F.col("_t.div"), F.col("len")
    worth = lambda x: x["score"] * x["cvg_by_div"]
    factor = lambda x: F.when(F.array_contains(ours, x["div"]) | is_virus(x["div"]), 0.5).otherwise(0.8)
    d = d.withColumn("_near", F.filter("taxa", lambda x: worth(x) > worth(t) * factor(x)))
    divs = F.transform("_near", lambda x: x["div"])
    kingdoms = F.array_distinct(F.transform(divs, kingdom))
    same, one = F.array_contains(kingdoms, kingdom(p0)), F.size(kingdoms) == 1
    first = lambda test: F.get(F.filter(divs, test), 0)
    low = none | (t["cvg_by_div"] < min_fraction * size)
    high = t["cvg_by_div"] > 0.8 * size
    repeat = F.col("lc") + F.col("co") + F.col("xp") > F.least(F.col("cvg_by_all").cast("double"), 0.66 * size)
    least = F.element_at(texts([str(x) for x in min_scores]).cast("array<int>"), is_euk(div).cast("int") + is_euk(p0).cast("int") + 1)
    part, chimeric = F.col("seq_id").contains("~"), F.col("seq_id").contains("~~")
    strong = high_evidence()
    human = (
        (div == "anml:primates") & (p0 != "anml:primates") & F.exists(F.slice("taxa", 1, 2), lambda x: x["tax_id"] == 9606)
        & (effective_fraction() > 0.7) & strong & ~chimeric & ~F.exists("_near", lambda x: (x["score"] > t["score"] * 0.8) & (x["div"] != div))
    )
    found = first(lambda x: F.array_contains(ours, x) | (meta & (is_prok(x) | is_virus(x))) | (same & F.lit(outlier)))
    virus = first(lambda x: x.startswith("virs:"))
    fitting = lambda kind: virus.isin("virs:viruses", f"virs:{kind} viruses")
    resident = (is_prok(p0) & fitting("prokaryotic")) | (is_euk(p0) & fitting("eukaryotic") & part)
    foreign = (F.array_contains(theirs, div) & one) | F.forall(divs, lambda x: F.array_contains(theirs, x))
    rules = [
        (low | (F.col("xp") > t["cvg_by_div"]), F.when(repeat, "repeat").when(low, "low-coverage").otherwise("transposon"), F.coalesce(div, F.lit("none"))),
        (human, F.lit("contaminant(human)"), div),
        (found.isNotNull(), F.lit("primary-div"), found),
        (virus.isNotNull() & (t["score"] > least), F.when(resident, "primary-div(virus)").otherwise("contaminant(virus)"), virus),
        (chimeric & same & (size < 10_000) & (t["score"] > least), F.lit("same-kingdom-chimeric"), div),
        (foreign & ((t["score"] > 50) | ((t["score"] > least) & high & ~same)), F.lit("contaminant(div)"), div),
        (meta, F.lit("inconclusive(metagenome)"), div),
        (one & ~same & (t["score"] > 100) & strong, F.lit("contaminant(cross-kingdom)"), div),
        ((F.size(divs) == 1) & ~F.array_contains(ours, div) & (t["score"] > 100) & strong & (~repeat | (div == "anml:primates")),
         F.lit("contaminant(cross-div)"), div),
        (repeat, F.lit("repeat"), div),
        (F.lit(True), F.lit("inconclusive"), div),
    ]
    result = where = F
    for test, label, at in rules:
        test = F.coalesce(test, F.lit(False))
        result, where = result.when(test, label), where.when(test, at)
    return d.withColumns({"result": result, "result_div": where}).drop("_t", "_near")


def scored(taxa: Column, least: int = 25) -> Column:
    """Taxa above the noise; the action side looks at these only."""
    return F.filter(taxa, lambda t: t["score"] > least)
