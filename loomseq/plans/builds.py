"""One index build over documents as raw sequences, and its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..adapters import taxa as taxa_of
from ..operators import index_build
from .store import BITS, DRAWN, DSQ, mixed

_STOP = "length(seq) % 3 = 0 AND seq[-3:] IN ('TAA', 'TAG', 'TGA')"


def sql() -> str:
    from .chimeras import _minus
    from .queries import merged

    return f"""WITH {DSQ},
raw AS (SELECT oid AS doc, oid // 100 AS source, CASE WHEN oid % 3 = 0 THEN 'cds_' ELSE 'seq_' END || oid AS seq_id, CASE WHEN oid % 3 = 0 THEN 'ATG' || seq ELSE seq END AS seq, tax_id,
  CASE WHEN oid % 6 < 4 THEN 'g' || (oid // 4) ELSE '' END AS gene, CASE WHEN oid % 31 = 1 THEN 'UNVERIFIED: ' WHEN oid % 37 = 2 THEN 'x alternate locus' ELSE '' END AS note FROM dsq),
ga AS (SELECT *, sum(CASE WHEN lg IS DISTINCT FROM gene THEN 1 ELSE 0 END) OVER (PARTITION BY source ORDER BY doc) AS g FROM (SELECT *, lag(gene) OVER (PARTITION BY source ORDER BY doc) AS lg FROM raw)),
cd AS (SELECT * FROM ga WHERE gene = '' UNION ALL SELECT * FROM ga WHERE gene <> '' QUALIFY row_number() OVER (PARTITION BY source, g ORDER BY length(seq) DESC, doc) = 1),
sco AS (SELECT * FROM cd WHERE note = '' AND doc % 13 <> 5 AND doc % 41 <> 3),
num AS MATERIALIZED (SELECT row_number() OVER (ORDER BY tax_id, length(seq) DESC, seq_id) AS oid, doc, seq_id, seq, tax_id,
  CASE WHEN seq_id LIKE 'cds_%' AND (seq LIKE 'ATG%' OR {_STOP}) THEN 18 WHEN tax_id % 3 = 0 THEN 11 ELSE 22 END AS stride FROM sco),
rm AS (SELECT oid AS q_id, 1 + doc % 50 AS pos, 30 + doc % 90 AS len FROM num WHERE doc % 7 = 1 UNION ALL SELECT oid, 200 + doc % 90, 77 FROM num WHERE doc % 5 = 1
  UNION ALL SELECT oid, min(i), count(*) FROM (SELECT oid, i, i - row_number() OVER (PARTITION BY oid ORDER BY i) AS g FROM (
   SELECT oid, seq, unnest(range(1, length(seq) + 1)) AS i FROM num WHERE seq LIKE '%NNNNNNNNNN%') WHERE seq[i] = 'N') GROUP BY oid, g HAVING count(*) >= 10),
{merged('rm', 'q_id', name='mk')}, wh AS (SELECT oid AS q_id, 1 AS pos, length(seq) AS len FROM num WHERE length(seq) > 0), {_minus('wh', 'mk', 'fr')},
{DRAWN.replace('FROM dsq', 'FROM num')}, {BITS},
w0 AS (SELECT l.oid, l.tax_id, l.seq AS s, n.stride, unnest(range(CAST(ceil((f.pos - 1) / n.stride) AS BIGINT) * n.stride, f.pos + f.len - 56, n.stride)) AS p FROM fr f JOIN lettered l ON l.oid = f.q_id JOIN num n ON n.oid = f.q_id WHERE f.len >= 56),
w1 AS (SELECT oid, tax_id, p + 1 AS pos, regexp_replace(translate(substring(s, p + 1, 56), 'AC', '01'), '(..).', '\\1', 'g') AS w FROM w0), w2 AS (SELECT *, translate(reverse(w), '01', '10') AS r FROM w1),
w3 AS (SELECT DISTINCT least(w, r) AS word, tax_id, oid, CASE WHEN r < w THEN -(pos + 55) ELSE pos END AS pos FROM w2)
SELECT word, tax_id, oid, pos FROM w3 QUALIFY row_number() OVER (PARTITION BY word, tax_id ORDER BY oid, pos) <= 2"""


def frames(s, d):
    """Raw rows, and the other tables of a build, which do without texts."""
    o = F.col("oid")
    seq_id = F.concat(F.when(o % 3 == 0, "cds_").otherwise("seq_"), o.cast("string"))
    note = F.when(o % 31 == 1, "UNVERIFIED: ").when(o % 37 == 2, "x alternate locus").otherwise("")
    gene = F.when(o % 6 < 4, F.concat(F.lit(" [gene=g"), F.floor(o / 4).cast("string"), F.lit("]"))).otherwise("")
    seq = F.when(o % 3 == 0, F.concat(F.lit("ATG"), "seq")).otherwise(F.col("seq"))
    texts = mixed(s, d).select(F.floor(o / 100).cast("long").alias("source"), o.alias("place"), seq_id.alias("seq_id"), F.concat(seq_id, F.lit(" "), note, gene).alias("defline"), seq.alias("seq"))
    raw = taxa_of(s, d).select(o.alias("place"), seq_id.alias("seq_id"), "tax_id")
    ids = raw.filter("place % 13 <> 5").select("seq_id", "tax_id")
    taxa = raw.select("tax_id", F.when(F.col("tax_id") % 3 == 0, "prok:bacteria").otherwise("anml:birds").alias("div")).distinct()
    long = lambda c: c.cast("long")
    hard = raw.filter("place % 41 = 3").select("seq_id", long(F.lit(1)).alias("pos"), F.lit(None).cast("long").alias("len")).unionByName(raw.filter("place % 7 = 1").select("seq_id", long(1 + F.col("place") % 50).alias("pos"), long(30 + F.col("place") % 90).alias("len")))
    soft = raw.filter("place % 5 = 1").select("seq_id", long(200 + F.col("place") % 90).alias("pos"), long(F.lit(77)).alias("len"))
    return texts, ids, taxa, hard, soft


def register(query) -> None:
    query("index_build", sql())(lambda s, d: index_build.build(*frames(s, d), low_complexity=False)[0].select("word", "tax_id", "oid", "pos"))
