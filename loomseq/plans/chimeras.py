"""Division intervals of queries made of documents' numbers, forty matches each, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..adapters import barrier, table
from ..operators import chimeric
from .classes import _list

DIVS = ["anml:mammals", "anml:birds", "prok:firmicutes", "fung:fungi", "plnt:plants"]
CN = f"""cn AS (SELECT doc_id // 40 AS q_id, 1 + doc_id % 40 * 250 + doc_id * 37 % 120 AS pos, 30 + n_chars * 7 % 330 AS len,
  ({_list(DIVS)})[CASE WHEN doc_id % 40 // (6 + doc_id // 40 % 9) % 2 = 0 THEN 1 + doc_id % 2 ELSE 3 + doc_id // 40 % 3 + CASE WHEN doc_id * 7 % 5 = 0 THEN -1 ELSE 0 END END] AS div
  FROM documents WHERE doc_id % 40 * 7 % 11 <> doc_id // 40 % 5),
wq AS (SELECT q_id, 1 AS pos, max(pos + len) + q_id * 13 % 900 AS len FROM cn GROUP BY q_id),
rq AS (SELECT q_id, pos + 20 AS pos, 60 AS len FROM cn WHERE pos % 9 = 0)"""


def _merged(src, key, name, gap=0):
    from .queries import merged

    return merged(src, key, gap, name)


def _minus(a: str, b: str, out: str) -> str:
    """a less b, both merged, as SQL: ends of what is left, from gaps of b."""
    return f"""{out}_g AS (SELECT q_id, pos + len AS g, coalesce(lead(pos) OVER (PARTITION BY q_id ORDER BY pos), 1000000000) AS h FROM {b}
  UNION ALL SELECT q_id, -1000000000, min(pos) FROM {b} GROUP BY q_id UNION ALL SELECT DISTINCT q_id, -1000000000, 1000000000 FROM {a} WHERE q_id NOT IN (SELECT q_id FROM {b})),
{out} AS (SELECT {a}.q_id, greatest(pos, g) AS pos, least(pos + len, h) - greatest(pos, g) AS len FROM {a} JOIN {out}_g ON {a}.q_id = {out}_g.q_id AND pos < h AND g < pos + len)"""


def ctes() -> str:
    """From cn (matches), wq (whole queries) and rq (repeats) to ch, the chimeric intervals, and bt, what lies between."""
    return f"""{_merged('cn', 'q_id, div', 'tk')}, {_merged('cn', 'q_id', 'al')}, {_merged('rq', 'q_id', 'rp')},
sz AS (SELECT q_id, div, sum(len) AS n, div LIKE 'anml%' AS prim FROM tk GROUP BY q_id, div),
tp AS (SELECT *, first_value(div) OVER w AS top, first_value(prim) OVER w AS top_prim FROM sz WINDOW w AS (PARTITION BY q_id ORDER BY n DESC, div)),
us AS (SELECT tk.q_id, pos, len FROM tk JOIN tp ON tp.q_id = tk.q_id AND tp.div = tk.div WHERE tp.div = top OR top_prim AND prim), {_merged('us', 'q_id', 'pm')},
{_minus('al', 'pm', 'r1')}, {_minus('r1', 'rp', 'r2')},
ix AS MATERIALIZED (SELECT *, row_number() OVER w AS k, sum(len) OVER w AS after FROM r2 WINDOW w AS (PARTITION BY q_id ORDER BY pos)),
hd AS MATERIALIZED (SELECT j.q_id, j.k AS head, greatest(1, (SELECT count(*) FROM ix i WHERE i.q_id = j.q_id AND i.pos < j.pos + j.len - 2000)) AS tail FROM ix j),
lt AS (SELECT q_id, max(head) AS head, max_by(tail, head) AS tail FROM hd GROUP BY q_id),
hu AS (SELECT q_id, head, tail FROM hd UNION ALL SELECT lt.q_id, lt.head, ix.k FROM lt JOIN ix ON ix.q_id = lt.q_id AND ix.k > lt.tail),
hl AS (SELECT a.q_id, a.pos, b.pos + b.len - a.pos AS len, b.after - a.after + a.len AS covered, w.len AS q_len FROM hu JOIN ix a ON a.q_id = hu.q_id AND a.k = hu.tail JOIN ix b ON b.q_id = hu.q_id AND b.k = hu.head JOIN wq w ON w.q_id = hu.q_id),
ok AS (SELECT q_id, pos, len FROM hl WHERE 100.0 * covered / (1.0 + len) >= 50 AND (len >= 2000 OR len >= 500 AND (pos + len < 2000 OR pos + 2000 > q_len))), {_merged('ok', 'q_id', 'st')},
ld AS (SELECT st.q_id, st.pos, st.len FROM st JOIN tk ON tk.q_id = st.q_id AND tk.pos < st.pos + st.len AND st.pos < tk.pos + tk.len GROUP BY st.q_id, st.pos, st.len, tk.div
  HAVING sum(least(tk.pos + tk.len, st.pos + st.len) - greatest(tk.pos, st.pos)) * 100 > st.len * 50), ld1 AS (SELECT DISTINCT * FROM ld), {_merged('ld1', 'q_id', 'mg', 500)},
od AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY pos) AS k FROM mg),
jn AS (SELECT q_id, k, pos, len, pos AS from_ FROM od WHERE k = 1
  UNION ALL SELECT o.q_id, o.k, CASE WHEN j.len + o.len > (o.pos + o.len - j.pos) * 0.9 THEN j.pos ELSE o.pos END, CASE WHEN j.len + o.len > (o.pos + o.len - j.pos) * 0.9 THEN o.pos + o.len - j.pos ELSE o.len END, o.pos FROM jn j JOIN od o ON o.q_id = j.q_id AND o.k = j.k + 1),
jl AS (SELECT q_id, pos, max(len) AS len FROM jn GROUP BY q_id, pos),
ex AS (SELECT jl.q_id, CASE WHEN jl.pos = min(jl.pos) OVER v AND jl.pos - 1 < 500 THEN 1 ELSE jl.pos END AS a, CASE WHEN jl.pos = max(jl.pos) OVER v AND wq.len + 1 - jl.pos - jl.len < 500 THEN wq.len + 1 ELSE jl.pos + jl.len END AS b
  FROM jl JOIN wq ON wq.q_id = jl.q_id WINDOW v AS (PARTITION BY jl.q_id)),
ch AS (SELECT q_id, a AS pos, b - a AS len FROM ex), {_minus('wq', 'ch', 'bt')}"""


def frames(s, d):
    k, g = F.col("doc_id") % 40, F.floor(F.col("doc_id") / 40).cast("long")
    block = F.floor(k / (6 + g % 9)) % 2 == 0
    which = F.when(block, F.col("doc_id") % 2).otherwise(2 + g % 3 + F.when(F.col("doc_id") * 7 % 5 == 0, -1).otherwise(0))
    n = table(s, d, "documents").filter(k * 7 % 11 != g % 5).select(g.alias("q_id"), (1 + k * 250 + F.col("doc_id") * 37 % 120).alias("pos"), (30 + F.col("n_chars") * 7 % 330).alias("len"), F.get(F.array(*map(F.lit, DIVS)), which.cast("int")).alias("div"))
    n = barrier(n)
    whole = n.groupBy("q_id").agg(F.max(F.col("pos") + F.col("len")).alias("e")).select("q_id", F.lit(1).cast("long").alias("pos"), (F.col("e") + F.col("q_id") * 13 % 900).alias("len"))
    repeats = n.filter("pos % 9 = 0").select("q_id", (F.col("pos") + 20).alias("pos"), F.lit(60).cast("long").alias("len"))
    return n, repeats, whole, n.filter("div like 'anml%'").select("q_id", "div")


def register(query) -> None:
    query("div_intervals", f"WITH RECURSIVE {CN}, {ctes()} SELECT q_id, pos, len, true AS chimeric FROM ch UNION ALL SELECT q_id, pos, len, false FROM bt WHERE len > 0")(lambda s, d: chimeric.div_intervals(*frames(s, d)))
