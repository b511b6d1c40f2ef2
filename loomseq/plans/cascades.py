"""The query of the action cascade over made-up spans in which every action occurs, and its SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..adapters import barrier, table
from ..operators import cascade
from .classes import DIVS, _list

SETTINGS = [("plain", "anml:mammals", {}), ("rare", "prok:bacteria", {"demote_rare": True}), ("same", "anml:fishes", {"demote_same": True}), ("low", "anml:primates", {"low_mode": True})]
SPANS = f"""sp AS (SELECT l_orderkey AS seq_id, row_number() OVER w AS i, count(*) OVER (PARTITION BY l_orderkey) AS n,
  coalesce(sum(CAST(l_quantity AS BIGINT) * 900) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1 AS pos, CAST(l_quantity AS BIGINT) * 900 AS len,
  CAST(l_quantity AS BIGINT) * 890 AS ungap_len, CASE WHEN l_suppkey % 5 < 2 THEN 'primary' WHEN l_suppkey % 5 < 4 THEN 'contaminant' ELSE 'grey' END AS label,
  l_partkey % 6 = 0 AS low, l_partkey % 5 = 0 AS review, l_partkey % 4 = 0 AS integrant, ({_list(DIVS)})[(l_partkey + l_suppkey) % 14 + 1] AS div, l_partkey % 101 AS cov,
  CASE WHEN l_suppkey % 11 = 0 THEN 'Wolbachia sp.' ELSE 'x' END AS tax_name, CASE WHEN l_suppkey % 3 = 0 THEN CAST(l_quantity AS BIGINT) * 900 ELSE 0 END AS outside
 FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity)),
st AS (SELECT seq_id, CAST(sum(len) AS BIGINT) AS seq_len, CAST(sum(ungap_len) AS BIGINT) AS ungap, ({_list(DIVS)})[seq_id % 14 + 1] AS sdiv, seq_id * 7 % 101 AS scov, seq_id % 9 = 0 AS chimera,
  CAST(sum(CASE WHEN label = 'primary' THEN ungap_len ELSE 0 END) AS BIGINT) AS kept, bool_or(label = 'contaminant') AS anybad, sum(outside) AS out, max_by(low, i) AS last_low FROM sp GROUP BY seq_id)"""


def _frames(s, d):
    li = table(s, d, "lineitem")
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    q, sup, part = F.col("l_quantity").cast("long"), F.col("l_suppkey"), F.col("l_partkey")
    at = lambda x: F.get(F.array(*map(F.lit, DIVS)), (x % 14).cast("int"))
    sp = barrier(li.select(
        F.col("l_orderkey").alias("seq_id"), (F.coalesce(F.sum(q * 900).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + 1).alias("pos"),
        (q * 900).alias("len"), (q * 890).alias("ungap_len"), F.when(sup % 5 < 2, "primary").when(sup % 5 < 4, "contaminant").otherwise("grey").alias("label"),
        (part % 6 == 0).alias("low"), (part % 5 == 0).alias("review"), (part % 4 == 0).alias("integrant"), at(part + sup).alias("div"), (part % 101).alias("cov"),
        F.when(sup % 11 == 0, "Wolbachia sp.").otherwise("x").alias("tax_name"), F.when(sup % 3 == 0, q * 900).otherwise(0).alias("outside")))
    k = F.col("seq_id")
    st = sp.groupBy("seq_id").agg(F.sum("len").alias("seq_len"), F.sum("ungap_len").alias("ungap_len"))
    return sp, st.select("seq_id", "seq_len", "ungap_len", at(k).alias("div"), (k * 7 % 101).alias("cov"), (k % 9 == 0).alias("chimera"))


def _decided(s, d):
    sp, st = _frames(s, d)
    out = None
    for name, primary, options in SETTINGS:
        one = cascade.cascade(sp, st, primary, everything=True, **options).select(F.lit(name).alias("setting"), "*")
        out = one if out is None else out.unionAll(one)
    return out


def _sql(name: str, p: str, rare: bool = False, same: bool = False, low: bool = False) -> str:
    pa = lambda x: f"{x}[1:4] IN ('prok', 'arch')"
    akin, akin_pa = f"div[1:5] = '{p[:5]}'", f"(div[1:5] = '{p[:5]}' OR ({pa('div')} AND {p[:4] in ('prok', 'arch')}))"
    euk = p[:4] in ("anml", "fung", "plnt", "prst")
    return f"""SELECT '{name}' AS setting, seq_id, CASE WHEN kind = 'many' THEN pos ELSE 1 END AS pos, CASE WHEN kind = 'many' THEN len ELSE seq_len END AS len, split_part(x, '|', 1) AS action,
 split_part(x, '|', 2) AS rule, CASE WHEN kind = 'all' THEN sdiv ELSE div END AS div, CASE WHEN kind = 'all' THEN scov ELSE cov END AS cov
FROM (SELECT *, CASE kind WHEN 'one' THEN CASE
   WHEN label = 'primary' THEN CASE WHEN {euk} AND out > 0.8 * seq_len THEN 'ORGANELLE|S04' ELSE 'ACCEPT|S02' END
   WHEN cov <= 10 THEN 'ACCEPT|coverage too low to decide' WHEN label = 'grey' THEN 'MEH|S03'
   WHEN {rare} AND {pa('div')} THEN 'REVIEW_RARE|prok or arch of one kingdom' WHEN {same} AND {akin} THEN 'ACCEPT|same kingdom ignored'
   WHEN chimera THEN 'INFO|endosymbiotic chimera' WHEN review THEN 'REVIEW|low-coverage review' WHEN {akin} AND cov < 20 THEN 'REVIEW|S01' ELSE 'EXCLUDE|S01' END
  WHEN 'all' THEN CASE WHEN scov <= 10 THEN 'ACCEPT|M05' WHEN {rare} AND {pa('sdiv')} THEN 'REVIEW_RARE|prok or arch of one kingdom'
   WHEN last_low THEN 'REVIEW|low-coverage review' WHEN {akin_pa.replace('div', 'sdiv')} AND scov < 20 THEN 'REVIEW|same kingdom with coverage under 20 %' ELSE 'EXCLUDE|M01' END
  ELSE CASE WHEN label = 'primary' THEN 'KEEP|primary' WHEN cov <= 10 THEN 'KEEP|coverage too low to decide' WHEN {same} AND {akin} THEN 'KEEP|same kingdom ignored'
   WHEN label = 'grey' THEN '|' WHEN {euk} AND tax_name LIKE 'Wolb%' THEN 'INFO|Endosymbiont'
   WHEN integrant AND (div LIKE 'prok%' OR tax_name LIKE 'Wolb%') THEN 'INFO|Endosymbiont' WHEN integrant AND contains(div, 'virus') THEN 'KEEP|integrant virus'
   WHEN NOT integrant AND review THEN CASE WHEN {low} AND {akin} THEN 'KEEP|same kingdom low coverage contaminant' ELSE 'REVIEW|low-coverage review' END
   WHEN NOT integrant AND {akin_pa} AND len * cov < 1000000 THEN 'KEEP|same kingdom with effective length under 10000'
   WHEN NOT integrant AND {rare} AND {pa('div')} THEN 'REVIEW_RARE|prok or arch of one kingdom'
   WHEN NOT integrant AND {akin_pa} THEN CASE WHEN {low} AND {akin} THEN 'KEEP|same kingdom low coverage contaminant' ELSE 'REVIEW|same kingdom with effective length of 10000 or more' END
   WHEN pos = 1 OR pos + len - 1 = seq_len THEN 'TRIM|M02' ELSE 'FIX|M03' END END AS x
 FROM (SELECT *, CASE WHEN n = 1 THEN 'one' WHEN kept < 200 OR (anybad AND kept < 50000 AND kept / ungap * 100 < 30) THEN 'all' ELSE 'many' END AS kind FROM sp JOIN st USING (seq_id))
 WHERE kind <> 'all' OR i = 1) WHERE x <> '|'"""


def register(query) -> None:
    parts = [_sql(n, p, **{k.removeprefix("demote_").removesuffix("_mode"): v for k, v in o.items()}) for n, p, o in SETTINGS]
    query("action_cascade", f"WITH {SPANS} " + " UNION ALL ".join(parts))(_decided)
