"""The taxonomy report of queries made of documents' numbers, six matches for each document, and its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..adapters import barrier, table
from ..operators import report
from .chimeras import _merged, _minus, ctes
from .classes import _list

DIVS = ["anml:mammals", "anml:birds", "prok:firmicutes", "fung:fungi", "plnt:plants", "virs:viruses", "prst:algae", "synt:synthetic"]
TRACKS = {"xp": (29, 40, 120), "lc": (31, 10, 80), "n": (37, 0, 25), "xc": (41, 0, 200)}
CN = f"""cn AS (SELECT doc_id // 40 AS q_id, CAST(t + 10 * (x % 3) AS BIGINT) AS tax_id, ({_list(DIVS)})[t] AS div, 1 + doc_id % 40 * 250 + doc_id * 37 % 120 + k * 9 AS pos, 20 + (n_chars * 7 + k * 31) % 250 AS len, x FROM (
   SELECT *, doc_id * 11 + k AS x, CASE WHEN doc_id % 40 // (6 + doc_id // 40 % 9) % 2 = 0 THEN 1 + (doc_id + k) % 2 WHEN doc_id % 7 = 0 THEN 1 + (doc_id // 7 + k) % 8 ELSE 3 + doc_id // 40 % 3 END AS t
   FROM documents, (SELECT unnest(range(6)) AS k)) WHERE doc_id % 40 * 7 % 11 <> doc_id // 40 % 5),
sc AS (SELECT *, CAST(least(len * len, 50 * len) AS DOUBLE) AS score FROM cn),
wq AS (SELECT q_id, 1 AS pos, max(pos + len) + q_id * 13 % 900 AS len FROM cn GROUP BY q_id)"""


def sql() -> str:
    raw = ", ".join(f"{t}_ AS (SELECT q_id, pos + {b} AS pos, {n} AS len FROM cn WHERE pos % {m} = 0), {_merged(t + '_', 'q_id', t + '_m')}" for t, (m, b, n) in TRACKS.items())
    lap = "least(t.pos + t.len, i.pos + i.len) - greatest(t.pos, i.pos)"
    tracks = {"xp": "xp_2", "lc": "lc_1", "co": "co_m", "n": "n_m", "xc": "xc_m", "cvg_by_all": "al"}
    over = ", ".join(f"o_{t} AS (SELECT i.q_id, i.pos, i.len, CAST(sum({lap}) AS BIGINT) AS n FROM iv i JOIN {s} t ON t.q_id = i.q_id AND t.pos < i.pos + i.len AND i.pos < t.pos + t.len GROUP BY ALL)" for t, s in tracks.items())
    joined = " ".join(f"LEFT JOIN o_{t} ON o_{t}.q_id = i.q_id AND o_{t}.pos = i.pos AND o_{t}.len = i.len" for t in tracks)
    return f"""WITH RECURSIVE {CN}, {raw},
cl AS (SELECT q_id, div, unnest(range(pos + 10, pos + len, 20)) // 20 AS cell FROM cn WHERE div[1:5] NOT IN ('prok:', 'arch:', 'virs:')),
co_ AS (SELECT q_id, cell * 20 - 10 AS pos, 20 AS len FROM cl WHERE cell > 0 GROUP BY q_id, cell HAVING count(DISTINCT div) >= 5), {_merged('co_', 'q_id', 'co_m', 20)},
rq AS (SELECT q_id, pos, len FROM xp_m UNION ALL SELECT q_id, pos, len FROM lc_m UNION ALL SELECT q_id, pos, len FROM co_m UNION ALL SELECT q_id, pos, len FROM n_m),
{ctes()}, iv AS (SELECT q_id, pos, len FROM ch UNION ALL SELECT q_id, pos, len FROM bt WHERE len > 0),
{_minus('lc_m', 'co_m', 'lc_1')}, {_minus('xp_m', 'lc_1', 'xp_1')}, {_minus('xp_1', 'co_m', 'xp_2')}, {over},
ct AS (SELECT i.q_id, i.pos, i.len, tax_id, div, greatest(t.pos, i.pos) AS at_, {lap} AS n, score * ({lap}) / t.len AS part FROM iv i JOIN sc t ON t.q_id = i.q_id AND t.pos < i.pos + i.len AND i.pos < t.pos + t.len),
tx AS (SELECT q_id, pos, len, tax_id, div, CAST(sum(n) AS BIGINT) AS cvg_by_tax, sum(part) AS score FROM ct GROUP BY q_id, pos, len, tax_id, div),
cc AS (SELECT q_id || ' ' || pos || ' ' || len AS iv, div, at_ AS pos, n AS len FROM ct), {_merged('cc', 'iv, div', 'cm')}, cd AS (SELECT iv, div, CAST(sum(len) AS BIGINT) AS cvg_by_div FROM cm GROUP BY iv, div),
tr AS (SELECT *, row_number() OVER (PARTITION BY q_id, pos, len, div ORDER BY score * CASE WHEN div LIKE 'synt%' OR div LIKE '%virus%' THEN 1.5 ELSE 1.0 END DESC, tax_id) AS r FROM tx),
tp4 AS (SELECT tr.*, cvg_by_div, row_number() OVER (PARTITION BY q_id, pos, len ORDER BY score DESC, tax_id) AS k FROM tr JOIN cd ON cd.iv = q_id || ' ' || pos || ' ' || len AND cd.div = tr.div WHERE r <= 2),
ta AS (SELECT q_id, pos, len, string_agg(tax_id || ':' || div || ':' || cvg_by_div || ':' || cvg_by_tax || ':' || CAST(floor(sqrt(score) + 0.5) AS BIGINT), '|' ORDER BY k) AS taxa, min_by(tax_id, k) AS best FROM tp4 WHERE k <= 4 GROUP BY q_id, pos, len)
SELECT i.q_id || CASE WHEN i.pos = 1 AND i.len = wq.len THEN '' ELSE '~~' || i.pos || '..' || (i.pos + i.len - 1) END AS seq_id, i.len, {', '.join(f'coalesce(o_{t}.n, 0) AS {t}' for t in tracks)},
 coalesce('species ' || best, '') AS tax_name, coalesce(taxa, '') AS taxa
FROM iv i JOIN wq ON wq.q_id = i.q_id {joined} LEFT JOIN ta ON ta.q_id = i.q_id AND ta.pos = i.pos AND ta.len = i.len"""


def frames(s, d):
    doc, k = F.col("doc_id"), F.col("k")
    place, g = doc % 40, F.floor(doc / 40).cast("long")
    t = F.when(F.floor(place / (6 + g % 9)) % 2 == 0, 1 + (doc + k) % 2).when(doc % 7 == 0, 1 + (F.floor(doc / 7) + k) % 8).otherwise(3 + g % 3)
    e = table(s, d, "documents").filter(place * 7 % 11 != g % 5).select("doc_id", "n_chars", F.explode(F.array(*(F.lit(x).cast("long") for x in range(6)))).alias("k"))
    n = e.select(g.alias("q_id"), t.cast("long").alias("t"), (1 + place * 250 + doc * 37 % 120 + k * 9).alias("pos"), (20 + (F.col("n_chars") * 7 + k * 31) % 250).alias("len"), ((doc * 11 + k) % 3).alias("x"))
    n = barrier(n.select("q_id", "pos", "len", (F.col("t") + 10 * F.col("x")).alias("tax_id"), F.get(F.array(*map(F.lit, DIVS)), (F.col("t") - 1).cast("int")).alias("div"), F.least(F.col("len") * F.col("len"), 50 * F.col("len")).cast("double").alias("score")))
    whole = n.groupBy("q_id").agg(F.max(F.col("pos") + F.col("len")).alias("e")).select("q_id", F.lit(1).cast("long").alias("pos"), (F.col("e") + F.col("q_id") * 13 % 900).alias("len"))
    track = {name: n.filter(F.col("pos") % m == 0).select("q_id", (F.col("pos") + b).alias("pos"), F.lit(size).cast("long").alias("len")) for name, (m, b, size) in TRACKS.items()}
    names = n.select("tax_id").distinct().withColumn("species", F.concat(F.lit("species "), F.col("tax_id").cast("string")))
    return n, whole, n.filter("div like 'anml%'").select("q_id", "div"), track["xp"], track["lc"], track["n"], track["xc"], names


def register(query) -> None:
    one = lambda t: F.concat_ws(":", t["tax_id"].cast("string"), t["div"], t["cvg_by_div"].cast("string"), t["cvg_by_tax"].cast("string"), t["score"].cast("string"))
    query("interval_report", sql())(lambda s, d: report.report(*frames(s, d)).withColumn("taxa", F.array_join(F.transform("taxa", one), "|")))
