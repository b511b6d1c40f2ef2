"""Spans of sequences made of documents' numbers, twenty-four rows each, with small primary islands taken in, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..adapters import barrier, table
from ..operators import islands

ROWS = """rw AS (SELECT doc_id // 24 AS seq_id, doc_id % 24 AS at_, 1 + doc_id % 24 * 100000 AS pos, doc_id % 24 * 100000 + 100000 AS end_,
  CASE WHEN (n_chars * 7 + doc_id) % 5 < 2 THEN 1000 + n_chars % 97 * 900 ELSE 100 + n_chars % 83 * 40 END AS len, (n_chars + doc_id * 3) % 101 AS pct,
  CASE WHEN (n_chars * 3 + doc_id // 24) % 10 < 3 THEN 'primary' WHEN (n_chars * 3 + doc_id // 24) % 10 < 8 THEN 'contaminant' ELSE 'grey' END AS label FROM documents)"""
_RIGHT = "CASE WHEN pl = 'contaminant' THEN CASE WHEN pp >= 75 THEN true WHEN np >= 75 THEN false ELSE true END ELSE CASE WHEN np >= 75 THEN false WHEN pp >= 75 THEN true ELSE false END END"
_LABEL = "CASE WHEN contam >= prim AND contam > 0 THEN 'contaminant' WHEN prim > contam THEN 'primary' ELSE 'grey' END"
SUMMED = f"""{ROWS}, ra AS (SELECT *, last_value(CASE WHEN label <> 'grey' THEN label END IGNORE NULLS) OVER b AS pl, last_value(CASE WHEN label <> 'grey' THEN pct END IGNORE NULLS) OVER b AS pp,
   first_value(CASE WHEN label <> 'grey' THEN label END IGNORE NULLS) OVER a AS nl, first_value(CASE WHEN label <> 'grey' THEN pct END IGNORE NULLS) OVER a AS np FROM rw
   WINDOW b AS (PARTITION BY seq_id ORDER BY at_ ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), a AS (PARTITION BY seq_id ORDER BY at_ ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
rb AS (SELECT *, CASE WHEN label <> 'grey' THEN label WHEN pl IS NULL AND nl IS NULL THEN 'grey' WHEN pl IS NULL THEN nl WHEN nl IS NULL OR pl = nl THEN pl WHEN {_RIGHT} THEN nl ELSE pl END AS own FROM ra),
rc AS (SELECT *, CASE WHEN lag(own) OVER w IS DISTINCT FROM own THEN 1 ELSE 0 END AS fresh FROM rb WINDOW w AS (PARTITION BY seq_id ORDER BY at_)),
rd AS (SELECT *, sum(fresh) OVER (PARTITION BY seq_id ORDER BY at_) AS span FROM rc),
sm AS (SELECT seq_id, min(pos) AS pos, max(end_) AS end_, sum(len) AS ungap, sum(CASE WHEN label = 'contaminant' THEN len * pct // 100 ELSE 0 END) AS contam, sum(CASE WHEN label = 'primary' THEN len * pct // 100 ELSE 0 END) AS prim,
   sum(CASE WHEN label = 'grey' THEN len * pct // 100 ELSE 0 END) AS grey FROM rd GROUP BY seq_id, span)"""
MERGED = f"""{SUMMED}, so AS (SELECT *, CASE {_LABEL} WHEN 'contaminant' THEN contam WHEN 'primary' THEN prim ELSE grey END AS res, prim >= {islands.BIG} AS large, max(CASE WHEN prim >= {islands.BIG} THEN pos END) OVER (PARTITION BY seq_id) AS last_big FROM sm),
sp AS (SELECT *, CASE WHEN large OR lag(pos) OVER w IS NULL OR lag(large) OVER w AND lag(pos) OVER w <> last_big THEN 1 ELSE 0 END AS opens FROM so WINDOW w AS (PARTITION BY seq_id ORDER BY pos)),
sq AS (SELECT *, sum(opens) OVER (PARTITION BY seq_id ORDER BY pos) AS g FROM sp), sr AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY seq_id, g ORDER BY pos) AS k FROM sq),
gr AS (SELECT seq_id, g, list(contam ORDER BY k) AS c, list(prim ORDER BY k) AS p, list(res ORDER BY k) AS r, count(*) AS n FROM sr GROUP BY seq_id, g),
lp AS (SELECT seq_id, g, c, p, r, [[CAST(1 AS BIGINT), n]] AS todo, CAST(NULL AS BIGINT) AS lo, CAST(NULL AS BIGINT) AS hi, CAST(NULL AS BIGINT) AS i, CAST(NULL AS BIGINT) AS j, CAST([] AS BIGINT[][]) AS found FROM gr
  UNION ALL SELECT seq_id, g, c, p, r,
   CASE WHEN lo IS NULL THEN list_slice(todo, 1, len(todo) - 1) WHEN hit THEN list_concat(todo, [[lo, i - 1], [j + 1, hi]]) ELSE todo END,
   CASE WHEN lo IS NULL THEN todo[-1][1] WHEN i < j AND NOT hit THEN lo END, CASE WHEN lo IS NULL THEN todo[-1][2] ELSE hi END,
   CASE WHEN lo IS NULL THEN todo[-1][1] WHEN r[i] >= r[j] THEN i + 1 ELSE i END, CASE WHEN lo IS NULL THEN todo[-1][2] WHEN r[i] >= r[j] THEN j ELSE j - 1 END,
   CASE WHEN lo IS NULL THEN found WHEN hit THEN list_concat(found, [[i, j]]) WHEN i < j THEN found ELSE list_concat(found, list_transform(range(lo, hi + 1), lambda k: [k, k])) END
  FROM (SELECT *, coalesce(i < j AND list_sum(p[i:j]) > 0 AND list_sum(p[i:j]) < {islands.BIG} AND floor(list_sum(c[i:j]) * CAST({islands.SHARE} AS DOUBLE)) > list_sum(p[i:j]), false) AS hit FROM lp WHERE lo IS NOT NULL OR len(todo) > 0)),
fd AS (SELECT seq_id, g, unnest(found) AS f FROM lp WHERE lo IS NULL AND len(todo) = 0),
mi AS (SELECT fd.seq_id, min(pos) AS pos, max(end_) AS end_, CAST(sum(ungap) AS BIGINT) AS ungap, CAST(sum(contam) AS BIGINT) AS contam, CAST(sum(prim) AS BIGINT) AS prim, CAST(sum(grey) AS BIGINT) AS grey FROM fd JOIN sr ON sr.seq_id = fd.seq_id AND sr.g = fd.g AND sr.k BETWEEN f[1] AND f[2] GROUP BY fd.seq_id, fd.g, f),
mg AS MATERIALIZED (SELECT *, {_LABEL} AS label FROM mi)"""
_COLS = "seq_id, pos, end_ AS \"end\", ungap AS ungap_len, contam AS contam_len, prim AS primary_len, grey AS grey_len"


def _state(**change: str) -> str:
    own = {"i": "a.i", "taken": "a.taken", "bad": "a.bad", "good": "a.good", "last": "a.last", "stop": "a.stop", "len": "a.len", "lab": "a.lab"} | change
    return "{" + ", ".join(f"'{k}': {v}" for k, v in own.items()) + "}"


def _trim(items: str) -> str:
    zero, none = "CAST(0 AS BIGINT)", "CAST(NULL AS BIGINT)"
    enough = "a.i > 0 AND (a.last IS NULL OR a.last >= 200) AND a.good * 100 >= (a.bad + x.len) * 30"
    bad = f"CASE WHEN {enough} THEN {_state(stop='true')} ELSE {_state(i='a.i + 1', bad='a.bad + x.len', last=none, taken='a.i')} END"
    good = f"CASE WHEN x.len >= 50000 THEN {_state(stop='true')} ELSE {_state(i='a.i + 1', good='a.good + x.len', last='x.len')} END"
    first = f"{{'i': {zero}, 'taken': {zero}, 'bad': {zero}, 'good': {zero}, 'last': {none}, 'stop': false, 'len': {zero}, 'lab': ''}}"
    out = f"list_reduce(list_prepend({first}, {items}), lambda a, x: CASE WHEN a.stop THEN a WHEN x.lab = 'contaminant' THEN {bad} WHEN x.lab = 'primary' THEN {good} ELSE {_state(i='a.i + 1')} END).taken"
    return f"CASE WHEN {out} > 0 THEN {out} + 1 ELSE 0 END"


ENDS = f"""{MERGED}, it AS (SELECT seq_id, count(*) AS n, list({{'i': CAST(0 AS BIGINT), 'taken': CAST(0 AS BIGINT), 'bad': CAST(0 AS BIGINT), 'good': CAST(0 AS BIGINT), 'last': CAST(NULL AS BIGINT), 'stop': false, 'len': ungap, 'lab': label}} ORDER BY pos) AS xs FROM mg GROUP BY seq_id),
fb AS (SELECT seq_id, n, {_trim('xs')} AS f, {_trim('list_reverse(xs)')} AS b FROM it),
mk AS (SELECT mg.*, n, f, b, row_number() OVER (PARTITION BY mg.seq_id ORDER BY pos) - 1 AS i FROM mg JOIN fb ON fb.seq_id = mg.seq_id),
mp AS (SELECT *, CASE WHEN f + b > n OR i < f THEN -1 WHEN i >= n - b THEN -2 ELSE i END AS part FROM mk),
oe AS (SELECT seq_id, min(pos) AS pos, max(end_) AS end_, CAST(sum(ungap) AS BIGINT) AS ungap, CAST(sum(contam) AS BIGINT) AS contam, CAST(sum(prim) AS BIGINT) AS prim, CAST(sum(grey) AS BIGINT) AS grey, CASE WHEN part < 0 THEN 'contaminant' ELSE any_value(label) END AS label FROM mp GROUP BY seq_id, part)"""


def rows(s, d):
    doc, n = F.col("doc_id"), F.col("n_chars")
    at, kind = doc % 24, (n * 3 + F.floor(doc / 24)) % 10
    size = F.when((n * 7 + doc) % 5 < 2, 1000 + n % 97 * 900).otherwise(100 + n % 83 * 40)
    label = F.when(kind < 3, "primary").when(kind < 8, "contaminant").otherwise("grey")
    return barrier(table(s, d, "documents").select(F.floor(doc / 24).cast("long").alias("seq_id"), at.alias("at"), (1 + at * 100_000).alias("pos"), (at * 100_000 + 100_000).alias("end"), size.alias("len"), ((n + doc * 3) % 101).alias("pct"), label.alias("label")))


def register(query) -> None:
    query("merged_islands", f"WITH RECURSIVE {MERGED} SELECT {_COLS}, label FROM mg")(lambda s, d: islands.merge_islands(islands.summed(rows(s, d))))
    query("end_islands", f"WITH RECURSIVE {ENDS} SELECT {_COLS}, label FROM oe")(lambda s, d: islands.discard_end_islands(islands.merge_islands(islands.summed(rows(s, d)))))
