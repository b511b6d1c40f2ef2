"""Queries of the classification rules over made-up report rows in which every class occurs, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..adapters import barrier, table
from ..functions import scalars
from ..operators import classify as cl

DIVS = ["anml:primates", "anml:mammals", "anml:fishes", "anml:nematodes", "prok:firmicutes", "prok:bacteria", "arch:archaea", "fung:fungi",
        "plnt:plants", "prst:protists", "virs:viruses", "virs:prokaryotic viruses", "virs:eukaryotic viruses", "synt:synthetic"]
SETTINGS = [
    ("mammal", ["anml:mammals"], ["prok:firmicutes", "fung:fungi"], False),
    ("outlier", ["anml:mammals", "anml:rodents"], ["prok:bacteria"], True),
    ("bacterium", ["prok:firmicutes", "prok:bacteria"], ["anml:primates", "anml:mammals"], False),
    ("metagenome", ["unkn:metagenomes"], ["anml:primates", "anml:fishes"], False),
]
_list = lambda x: "[" + ", ".join(f"'{v}'" for v in x) + "]"

REC = f"""rec AS (SELECT k, 'q' || k || CASE k % 6 WHEN 1 THEN '~11..' || (10 + len) WHEN 2 THEN '~~1..' || len
    WHEN 3 THEN '~101..' || (100 + 2 * len) || '~~' || (1 + k % 2 * 20) || '..' || len ELSE '' END AS seq_id, len,
  len * (k * 3 % 13) // 40 AS xp, len * (k * 5 % 11) // 40 AS lc, 0 AS co, 0 AS n,
  least(len, len * (k * 31 % 101) // 100 + k % 500) AS cvg_by_all,
  list_transform(range(0, k % 5), lambda j: {{'tax_id': CASE WHEN (k // 5 + j * (k % 3)) % 14 = 0 AND k % 2 = 0 THEN 9606 ELSE 100 + j END,
    'div': ({_list(DIVS)})[(k // 5 + j * (k % 3)) % 14 + 1], 'cvg_by_div': len * greatest(0, k * 31 % 101 - k % 7 * j) // 100,
    'cvg_by_tax': len * greatest(0, k * 31 % 101 - k % 7 * j) // 100 * (100 - k % 4 * 10) // 100,
    'score': greatest(0, k * 13 % 400 - j * (k % 11) * 5)}}) AS taxa
 FROM (SELECT o_orderkey AS k, 300 + o_orderkey * 7919 % 20000 AS len FROM orders))"""


def records(s, d):
    """Report rows made from the keys of orders."""
    r = barrier(table(s, d, "orders").select(F.col("o_orderkey").cast("long").alias("k"), (300 + F.col("o_orderkey").cast("long") * 7919 % 20000).alias("len")))
    k, n = F.col("k"), F.col("len")
    div = lambda x: F.floor(x).cast("long")

    def taxon(j):
        at = ((div(k / 5) + j * (k % 3)) % 14).cast("int")
        part = div(n * F.greatest(F.lit(0), k * 31 % 101 - k % 7 * j) / 100)
        return F.struct(
            F.when((at == 0) & (k % 2 == 0), 9606).otherwise(100 + j).cast("long").alias("tax_id"), F.get(F.array(*map(F.lit, DIVS)), at).alias("div"),
            part.alias("cvg_by_div"), div(part * (100 - k % 4 * 10) / 100).alias("cvg_by_tax"),
            F.greatest(F.lit(0), k * 13 % 400 - j * (k % 11) * 5).cast("long").alias("score"))

    text = lambda *x: F.concat(*(F.lit(v) if isinstance(v, str) else v.cast("string") for v in x))
    tail = (
        F.when(k % 6 == 1, text("~11..", n + 10)).when(k % 6 == 2, text("~~1..", n))
        .when(k % 6 == 3, text("~101..", 100 + 2 * n, "~~", 1 + k % 2 * 20, "..", n)).otherwise("")
    )
    js = F.filter(F.array(*(F.lit(j).cast("long") for j in range(4))), lambda j: j < k % 5)
    return barrier(r.select(
        "k", F.concat(F.lit("q"), k.cast("string"), tail).alias("seq_id"), "len", div(n * (k * 3 % 13) / 40).alias("xp"),
        div(n * (k * 5 % 11) / 40).alias("lc"), F.lit(0).alias("co"), F.lit(0).alias("n"),
        F.least(n, div(n * (k * 31 % 101) / 100) + k % 500).alias("cvg_by_all"), F.transform(js, taxon).alias("taxa")))


def _kingdom(x: str) -> str:
    return f"CASE WHEN {x} IN {tuple(cl.vertebrates())} THEN 'vrbt' WHEN {x} LIKE 'anml:%' THEN 'ivrt' ELSE {x}[1:4] END"


def _prok(x: str) -> str:
    return f"({x} LIKE 'prok:%' OR {x} LIKE 'arch:%')"


def _virus(x: str) -> str:
    return f"({x} LIKE 'virs:%' OR {x} LIKE 'synt%')"


def _euk(x: str) -> str:
    return f"(NOT {_prok(x)} AND NOT {_virus(x)})"


def _classes(name, ours, theirs, outlier, fraction=0.2) -> str:
    """The rules for one setting, as SQL over rec."""
    meta, p0 = ours == ["unkn:metagenomes"], ours[0]
    fits = lambda kind: f"virus IN ('virs:viruses', 'virs:{kind} viruses')"
    kind_of = lambda f: f(f"'{p0}'")
    return f"""SELECT '{name}' AS setting, seq_id, CASE
  WHEN low OR xp > t.cvg_by_div THEN CASE WHEN rep THEN 'repeat' WHEN low THEN 'low-coverage' ELSE 'transposon' END
  WHEN human THEN 'contaminant(human)' WHEN found IS NOT NULL THEN 'primary-div'
  WHEN virus IS NOT NULL AND t.score > least THEN CASE WHEN ({kind_of(_prok)} AND {fits('prokaryotic')})
    OR ({kind_of(_euk)} AND {fits('eukaryotic')} AND contains(seq_id, '~')) THEN 'primary-div(virus)' ELSE 'contaminant(virus)' END
  WHEN contains(seq_id, '~~') AND same AND len < 10000 AND t.score > least THEN 'same-kingdom-chimeric'
  WHEN foreign_ AND (t.score > 50 OR (t.score > least AND t.cvg_by_div > 0.8 * len AND NOT same)) THEN 'contaminant(div)'
  WHEN {str(meta).lower()} THEN 'inconclusive(metagenome)'
  WHEN one AND NOT same AND t.score > 100 AND strong THEN 'contaminant(cross-kingdom)'
  WHEN len(divs) = 1 AND NOT list_contains({_list(ours)}, t.div) AND t.score > 100 AND strong AND (NOT rep OR t.div = 'anml:primates')
    THEN 'contaminant(cross-div)' WHEN rep THEN 'repeat' ELSE 'inconclusive' END AS result,
 CASE WHEN low OR xp > t.cvg_by_div THEN coalesce(t.div, 'none') WHEN human THEN t.div WHEN found IS NOT NULL THEN found
  WHEN virus IS NOT NULL AND t.score > least THEN virus ELSE t.div END AS result_div
FROM (SELECT *, list_contains(kdms, {kind_of(_kingdom)}) AS same, len(kdms) = 1 AS one,
  list_filter(divs, lambda x: list_contains({_list(ours)}, x) OR ({str(meta).lower()} AND ({_prok('x')} OR {_virus('x')}))
    OR ({str(outlier).lower()} AND list_contains(kdms, {kind_of(_kingdom)})))[1] AS found,
  list_filter(divs, lambda x: x LIKE 'virs:%')[1] AS virus,
  (list_contains({_list(theirs)}, t.div) AND len(kdms) = 1) OR len(list_filter(divs, lambda x: NOT list_contains({_list(theirs)}, x))) = 0 AS foreign_,
  coalesce(t.div = 'anml:primates' AND '{p0}' <> 'anml:primates' AND len(list_filter(taxa[1:2], lambda x: x.tax_id = 9606)) > 0
    AND frac > 0.7 AND strong AND NOT contains(seq_id, '~~')
    AND len(list_filter(near, lambda x: x.score > t.score * 0.8 AND x.div <> t.div)) = 0, false) AS human
 FROM (SELECT *, list_transform(near, lambda x: x.div) AS divs, list_distinct(list_transform(near, lambda x: {_kingdom('x.div')})) AS kdms,
   t.cvg_by_tax > 200 AND t.score * t.score > 15 * t.cvg_by_tax AND frac > 0.5 AS strong
  FROM (SELECT *, t IS NULL OR t.cvg_by_div < {fraction} * len AS low, lc + co + xp > least(CAST(cvg_by_all AS DOUBLE), 0.66 * len) AS rep,
    ([30, 25, 40])[1 + CAST({_euk('t.div')} AS INTEGER) + CAST({kind_of(_euk)} AS INTEGER)] AS least,
    t.cvg_by_div / greatest(greatest(len - lc - co - xp, cvg_by_all), 1) AS frac,
    list_filter(taxa, lambda x: x.score * x.cvg_by_div > t.score * t.cvg_by_div
      * CASE WHEN list_contains({_list(ours)}, x.div) OR {_virus('x.div')} THEN 0.5::DOUBLE ELSE 0.8::DOUBLE END) AS near
   FROM (SELECT *, taxa[1] AS t FROM rec))))"""


def _labels(s, d):
    out = None
    for name, ours, theirs, outlier in SETTINGS:
        c = cl.classify(records(s, d), ours, theirs, 0.2, outlier=outlier).select(F.lit(name).alias("setting"), "seq_id", "result", "result_div")
        out = c if out is None else out.unionAll(c)
    return out


def _runs(s, d):
    """Runs made from the keys of customers: what was asserted, and what was inferred."""
    k = F.col("c_custkey").cast("long")
    every = DIVS + ["prok:proteobacteria", "prok:actinobacteria", "prok:high GC Gram+", "unkn:metagenomes", "prok:a-proteobacteria", "fung:ascomycetes"]
    names = ["Bos taurus", "bacterium X1", "Foo bacterium", "genus_undefined", "endosymbiont of Y", "Candidate phylum Z"]
    at = lambda values, x: F.get(F.array(*map(F.lit, values)), (x % len(values)).cast("int"))
    found = F.filter(F.array(*(at(every, k * (3 + j) + j) for j in range(3))), lambda x: F.lit(True))
    return table(s, d, "customer").select(
        k.alias("k"), F.when(k % 13 != 0, at(names, k)).alias("species"), F.when(k % 17 != 0, at(every, F.floor(k / 3).cast("long"))).alias("asserted_div"),
        F.slice(found, 1, (k % 4).cast("int")).alias("inferred"))


EVERY = DIVS + ["prok:proteobacteria", "prok:actinobacteria", "prok:high GC Gram+", "unkn:metagenomes", "prok:a-proteobacteria", "fung:ascomycetes"]
NAMES = ["Bos taurus", "bacterium X1", "Foo bacterium", "genus_undefined", "endosymbiont of Y", "Candidate phylum Z"]
KNOWN = cl.WELL_KNOWN
ADJUST = f"""WITH r AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 13 <> 0 THEN ({_list(NAMES)})[c_custkey % 6 + 1] END AS species,
  CASE WHEN c_custkey % 17 <> 0 THEN ({_list(EVERY)})[(c_custkey // 3) % 20 + 1] END AS d,
  list_transform(range(0, least(3, c_custkey % 4)), lambda j: ({_list(EVERY)})[(c_custkey * (3 + j) + j) % 20 + 1]) AS inf FROM customer),
c AS (SELECT *, CASE WHEN d = 'virs:viruses' THEN 1 WHEN d IN ('virs:eukaryotic viruses', 'virs:prokaryotic viruses') THEN 2
  WHEN d = 'unkn:metagenomes' THEN 3 WHEN d IS NULL OR list_contains(inf, d) THEN 4
  WHEN len(inf) = 0 OR ((coalesce(regexp_matches('^' || species, '\\^bacterium| bacterium| phylum| genomosp\\.|symbiont'), false)
      OR coalesce(species = 'genus_undefined' AND {_prok('d')}, false))
    AND (d = 'prok:proteobacteria' AND len(list_filter(inf, lambda p: contains(p, 'proteobacteria'))) > 0
      OR d = 'prok:actinobacteria' AND list_contains(inf, 'prok:high GC Gram+')
      OR d = 'prok:bacteria' AND len(list_filter(inf, lambda p: contains(p, 'prok:'))) > 0
      OR contains(d, 'prok:') AND list_contains(inf, 'prok:bacteria')))
    OR (({_kingdom('d')}) = ({_kingdom('inf[1]')}) AND NOT list_contains({_list(KNOWN)}, d)) THEN 5 ELSE 6 END AS c FROM r)
SELECT k, array_to_string(CASE c WHEN 1 THEN {_list(cl.VIRUSES)} WHEN 2 THEN list_append(inf, 'virs:viruses') WHEN 3 THEN ['unkn:metagenomes']
  WHEN 4 THEN inf WHEN 5 THEN list_prepend(d, inf) ELSE [d] END, '|') AS "primary",
 array_to_string(CASE c WHEN 3 THEN {_list(cl.vertebrates())} WHEN 6 THEN inf ELSE [] END, '|') AS contaminants FROM c"""
WEIGH = f"""WITH {REC}, x AS (SELECT len, xp, lc + co AS rep, coalesce(list_max(list_transform(list_filter(taxa, lambda t: t.div = 'anml:mammals'),
  lambda t: t.cvg_by_div)), 0) AS pd, taxa[1].score AS top, unnest(taxa) AS t FROM rec),
g AS (SELECT t.div AS div, CAST(sum(t.cvg_by_div) AS BIGINT) AS cvg, CAST(sum(least(t.cvg_by_div, rep)) AS BIGINT) AS by_repeats,
  CAST(sum(least(t.cvg_by_div, xp)) AS BIGINT) AS by_transposons, CAST(sum(least(t.cvg_by_div, pd)) AS BIGINT) AS by_primary,
  CAST(sum(greatest(0, t.cvg_by_div - rep - xp)) AS BIGINT) AS own FROM x
  WHERE t.score > top * 0.8 AND (t.score > 150 OR t.cvg_by_tax > len * 0.8) GROUP BY 1)
SELECT * FROM g WHERE div = (SELECT div FROM g ORDER BY cvg DESC, div DESC LIMIT 1) OR CASE WHEN {_euk('div')}
  THEN greatest(by_repeats, by_transposons, by_primary) < cvg * 0.5 AND own > 25000
  ELSE greatest(by_repeats, by_transposons, by_primary) < cvg * 0.75 AND own > 10000 END"""
KINDS = f"""WITH p AS (SELECT a.d AS a, b.d AS b FROM (SELECT unnest({_list(DIVS)}) AS d) a CROSS JOIN (SELECT unnest({_list(DIVS)}) AS d) b)
SELECT a, b, {_kingdom('a')} AS kingdom, {_prok('a')} AS prok, {_virus('a')} AS virus, {_euk('a')} AS euk, ({_kingdom('a')}) = ({_kingdom('b')}) AS same_kingdom,
 a[1:5] = b[1:5] OR (a[1:4] IN ('prok', 'arch') AND b[1:4] IN ('prok', 'arch')) AS same_prefix,
 a NOT LIKE 'virs:%' AND b LIKE CASE WHEN a LIKE 'prok%' THEN 'virs:prokaryotic%' ELSE 'virs:eukaryotic%' END AS can_host FROM p"""


def _kinds(s, d):
    a, b = F.col("a"), F.col("b")
    one = lambda name: s.createDataFrame([(x,) for x in DIVS], f"{name} string")
    return one("a").crossJoin(one("b")).select(
        a, b, cl.kingdom(a).alias("kingdom"), cl.is_prok(a).alias("prok"), cl.is_virus(a).alias("virus"), cl.is_euk(a).alias("euk"),
        cl.same_kingdom(a, b).alias("same_kingdom"), cl.same_prefix(a, b).alias("same_prefix"), cl.can_host_virus(a, b).alias("can_host"))


POSITIONS = f"""WITH {REC}, p AS (SELECT seq_id, len, regexp_extract(seq_id, '^[^~]+') AS id,
  TRY_CAST(regexp_extract(seq_id, '^[^~]+~(\\d+)\\.\\.(\\d+)', 1) AS BIGINT) AS a, TRY_CAST(regexp_extract(seq_id, '^[^~]+~(\\d+)\\.\\.(\\d+)', 2) AS BIGINT) AS b,
  TRY_CAST(regexp_extract(seq_id, '~~(\\d+)\\.\\.(\\d+)$', 1) AS BIGINT) AS c, TRY_CAST(regexp_extract(seq_id, '~~(\\d+)\\.\\.(\\d+)$', 2) AS BIGINT) AS e FROM rec)
SELECT seq_id, id AS orig_id, CASE WHEN a IS NULL AND c IS NULL THEN 1 WHEN c IS NULL THEN a WHEN a IS NULL THEN c ELSE a + c - 1 END AS start_pos,
 CASE WHEN a IS NULL AND c IS NULL THEN len WHEN c IS NULL THEN b WHEN a IS NULL THEN e ELSE a + e - 1 END AS end_pos, a IS NULL AND c IS NULL AS whole,
 a IS NULL OR c IS NULL OR c = 1 AS joins_left, a IS NULL OR c IS NULL OR e = b - a + 1 AS joins_right FROM p"""


def register(query) -> None:
    query("classify_labels", f"WITH {REC} " + " UNION ALL ".join(_classes(*x) for x in SETTINGS))(_labels)
    groups = "CASE WHEN result IN {} THEN 'contaminant' WHEN result IN {} THEN 'primary' ELSE 'grey' END".format(*(tuple(cl.LABELS[k]) for k in ("contaminant", "primary")))
    query("label_groups", f"WITH {REC}, c AS (" + " UNION ALL ".join(_classes(*x) for x in SETTINGS) + f") SELECT setting, result, {groups} AS label, count(*) AS n FROM c GROUP BY ALL")(
        lambda s, d: _labels(s, d).groupBy("setting", "result", cl.label_group(F.col("result")).alias("label")).agg(F.count("*").alias("n")))
    query("select_divs", WEIGH)(lambda s, d: cl.select_divs(records(s, d), "anml:mammals"))
    query("adjust_divs", ADJUST)(lambda s, d: cl.adjust_divs(_runs(s, d)).select("k", *(F.array_join(c, "|").alias(c) for c in ("primary", "contaminants"))))
    query("division_kinds", KINDS)(_kinds)
    query("high_evidence", f"""WITH {REC}, f AS (SELECT seq_id, taxa[1] AS t, taxa[1].cvg_by_div / greatest(greatest(len - lc - co - xp, cvg_by_all), 1) AS frac FROM rec WHERE len(taxa) > 0)
SELECT seq_id, frac, t.cvg_by_tax > 200 AND t.score * t.score > 15 * t.cvg_by_tax AND frac > 0.5 AS strong FROM f""")(
        lambda s, d: records(s, d).filter("size(taxa) > 0").select("seq_id", cl.effective_fraction().alias("frac"), cl.high_evidence().alias("strong")))
    query("record_positions", POSITIONS)(lambda s, d: records(s, d).select("seq_id", scalars.record_position(F.col("seq_id"), F.col("len")).alias("p")).select("seq_id", "p.*"))
    query("scored_taxa", f"WITH {REC} SELECT seq_id, array_to_string(list_transform(list_filter(taxa, lambda t: t.score > 25), lambda t: t.div || ':' || t.score), '|') AS taxa FROM rec")(
        lambda s, d: records(s, d).select("seq_id", F.array_join(F.transform(cl.scored(F.col("taxa")), lambda t: F.concat_ws(":", t["div"], t["score"].cast("string"))), "|").alias("taxa")))
