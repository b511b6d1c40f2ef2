"""The query of the greedy choice over customers as assemblies, and SQL that makes it one assembly after another."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..adapters import table
from ..operators import selection
from .classes import _list

DIVS = [*list(selection.PROXIMITY)[:6], "prok:firmicutes", "virs:viruses", "prst:algae", "fung:fungi", "unkn:unknown"]
_PROX = " ".join(f"WHEN '{k}' THEN {v}" for k, v in selection.PROXIMITY.items())
_SMALL = lambda d: f"coalesce({d}[1:5] IN ({', '.join(repr(x + ':') for x in selection.SMALL)}), false)"
CHOICE = f"""WITH RECURSIVE a AS (SELECT c_custkey AS id, c_custkey // 3 + 1 AS tax_id, (c_custkey // 3 + 1) // 2 * 2 + 1 AS sp_tax_id, ({_list(DIVS)})[(c_custkey // 3 + 1) % {len(DIVS)} + 1] AS div,
  CASE c_custkey % 10 WHEN 0 THEN 'ok-acceptlist' WHEN 1 THEN 'ok-reference' WHEN 2 THEN 'not-prescreened' WHEN 3 THEN 'too-large' ELSE 'ok' END AS status,
  c_custkey * 7 % 5 AS weight, c_nationkey % 4 AS projects, 1000 + c_custkey % 37 AS len, c_custkey * 13 % 1000 AS n50 FROM customer),
dv AS (SELECT DISTINCT tax_id, div FROM a),
px AS (SELECT o_custkey // 3 + 1 AS t1, (o_custkey + o_orderkey % 50) // 3 + 1 AS t2, o_orderkey % 100 / 100.0 AS score FROM orders),
th AS (SELECT t1, t2, score, x.div AS d1, y.div AS d2, CASE WHEN {_SMALL('x.div')} AND {_SMALL('y.div')} THEN {selection.SMALL_PROXIMITY} ELSE {selection.OTHER_PROXIMITY} END AS other
  FROM px LEFT JOIN dv x ON x.tax_id = t1 LEFT JOIN dv y ON y.tax_id = t2 WHERE t1 <> t2),
ed AS (SELECT t1, t2 FROM th WHERE score > least(CASE d1 {_PROX} ELSE other END, CASE d2 {_PROX} ELSE other END)),
nb AS (SELECT a, list(DISTINCT b) AS near FROM (SELECT t1 AS a, t2 AS b FROM ed UNION ALL SELECT t2, t1 FROM ed) GROUP BY a),
ac AS (SELECT *, count(*) OVER (PARTITION BY div) AS of_div, count(*) OVER (PARTITION BY tax_id) AS of_tax FROM a),
o AS MATERIALIZED (SELECT ac.*, coalesce(near, []) AS near, row_number() OVER (ORDER BY of_div DESC, div DESC, weight DESC, projects DESC, of_tax DESC, n50 / len DESC, id) AS ord
  FROM ac LEFT JOIN nb ON nb.a = ac.tax_id),
walk AS (SELECT CAST(0 AS BIGINT) AS ord, CAST(MAP {{}} AS MAP(BIGINT, BIGINT)) AS seen, CAST(NULL AS BIGINT) AS id, CAST(NULL AS BIGINT) AS tax_id, '' AS status, CAST(NULL AS BIGINT) AS nbr_tax_id
  UNION ALL SELECT ord, CASE WHEN status LIKE 'ok%' AND NOT gone THEN map_concat(seen, MAP([tax_id], [tax_id]), MAP([sp_tax_id], [sp_tax_id]), map_from_entries(list_transform(near, lambda x: ROW(x, tax_id)))) ELSE seen END, id, tax_id,
   CASE WHEN v IS NULL AND status = 'not-prescreened' THEN 'needs-prescreen' WHEN gone THEN 'seen' ELSE status END, CASE WHEN gone THEN v END
  FROM (SELECT *, v IS NOT NULL AND (status = 'ok' OR status = 'ok-reference' AND v = tax_id) AS gone FROM (
   SELECT o.*, seen, coalesce(seen[o.tax_id], seen[o.sp_tax_id]) AS v FROM walk w JOIN o ON o.ord = w.ord + 1)))
SELECT id, tax_id, status, coalesce(nbr_tax_id, 0) AS nbr_tax_id, ord FROM walk WHERE ord > 0"""


def inputs(s, d):
    c, o = table(s, d, "customer"), table(s, d, "orders")
    k = F.col("c_custkey")
    tax = lambda x: F.floor(x / 3).cast("long") + 1
    status = F.when(k % 10 == 0, "ok-acceptlist").when(k % 10 == 1, "ok-reference").when(k % 10 == 2, "not-prescreened").when(k % 10 == 3, "too-large").otherwise("ok")
    a = c.select(k.alias("id"), tax(k).alias("tax_id"), (F.floor(tax(k) / 2) * 2 + 1).cast("long").alias("sp_tax_id"), F.get(F.array(*map(F.lit, DIVS)), (tax(k) % len(DIVS)).cast("int")).alias("div"),
                 status.alias("status"), (k * 7 % 5).alias("weight"), (F.col("c_nationkey") % 4).alias("projects"), (1000 + k % 37).alias("len"), (k * 13 % 1000).alias("n50"))
    p = o.select(tax(F.col("o_custkey")).alias("t1"), tax(F.col("o_custkey") + F.col("o_orderkey") % 50).alias("t2"), (F.col("o_orderkey") % 100 / 100.0).alias("score"))
    return a, p, a.select("tax_id", "div").distinct()


def register(query) -> None:
    query("select_subjects", CHOICE)(lambda s, d: selection.select_subjects(*inputs(s, d)).select("id", "tax_id", "status", F.coalesce("nbr_tax_id", F.lit(0)).alias("nbr_tax_id"), "ord"))
