"""Queries of screens, windows and protein signatures, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..adapters import IV, QRY, bases, intervals, probes, table
from ..operators import screen, sketch, words

M = "% 18446744073709551616"
LETTERS = sketch.DIGITS
PROT = """p AS (SELECT CAST(item_id % 8 AS BIGINT) AS id, upper(regexp_replace(text, '[^A-Za-z]', '', 'g')) || '*' AS seq FROM benchmark),
g AS (SELECT DISTINCT id, translate(regexp_replace(seq, '[^CFYW*MLIVGPATSNEDHQRK]', 'K', 'g'), 'CFYW*MLIVGPATSNEDHQRK', '000001111222222333333') AS r FROM p),
w AS (SELECT DISTINCT id, CAST(list_sum(list_transform(range(0, 15), lambda j: (ascii(r[i + j]) - 48) * CAST(power(4, 14 - j) AS BIGINT))) AS UBIGINT) AS x
 FROM (SELECT id, r, unnest(range(1, length(r) - 13)) AS i FROM g))"""


def _hash(source: str, name: str, keys: str) -> str:
    """CTEs for the hash of column x of a source, as column x of name."""
    a = f"{name}1 AS (SELECT {keys}, CAST((CAST(x AS UHUGEINT) + 11400714819323198485) {M} AS UBIGINT) AS x FROM {source})"
    b = f"{name}2 AS (SELECT {keys}, CAST((CAST(xor(x, x >> 30) AS UHUGEINT) * 13787848793156543929) {M} AS UBIGINT) AS x FROM {name}1)"
    c = f"{name}3 AS (SELECT {keys}, CAST((CAST(xor(x, x >> 27) AS UHUGEINT) * 10723151780598845931) {M} AS UBIGINT) AS x FROM {name}2)"
    return f"{a}, {b}, {c}, {name} AS (SELECT {keys}, xor(x, x >> 31) AS x FROM {name}3)"


SIGNED = f"""WITH {PROT}, {_hash('w', 'h', 'id')}, s AS (SELECT id, i AS slot, xor(x, CAST(i AS UBIGINT) << 32) AS x FROM h, range(0, 1024) AS t(i)),
{_hash('s', 'y', 'id, slot')}, l AS (SELECT id, slot, min(x) AS x FROM y GROUP BY ALL),
sig AS (SELECT id, string_agg('{LETTERS}'[CAST(x % 64 AS INTEGER) + 1], '' ORDER BY slot) AS signature FROM l GROUP BY id)"""




def _entropy(name: str, window: int, bits: float) -> str:
    """CTEs for the entropy track of qry."""
    by = min(window // 3, 30)
    return f"""{name}a AS (SELECT oid, length(seq) AS n, unnest(range(0, greatest(length(seq), {window}))) AS i, seq FROM qry WHERE length(seq) > 0),
{name}b AS (SELECT oid, n, i, CASE seq[i % n + 1] WHEN 'A' THEN 0 WHEN 'C' THEN 1 WHEN 'G' THEN 2 WHEN 'T' THEN 3 ELSE i % 3 END AS d FROM {name}a),
{name}c AS (SELECT oid, n, i, d + 4 * coalesce(lag(d, 1) OVER w, 0) + 16 * coalesce(lag(d, 2) OVER w, 0) + 64 * coalesce(lag(d, 3) OVER w, 0)
  + 256 * coalesce(lag(d, 4) OVER w, 0) + 1024 * coalesce(lag(d, 5) OVER w, 0) AS h FROM {name}b WINDOW w AS (PARTITION BY oid ORDER BY i)),
{name}d AS (SELECT c.oid, c.n, c.i, unnest(range(c.i, c.i + {window})) AS j FROM {name}c c WHERE c.i + {window} <= greatest(c.n, {window})),
{name}e AS (SELECT d.oid, d.n, d.i, c.h, count(*) AS k FROM {name}d d JOIN {name}c c ON c.oid = d.oid AND c.i = d.j GROUP BY ALL),
{name}f AS (SELECT oid, n, i, sum(k * log2(k)) AS s FROM {name}e GROUP BY ALL HAVING s > (log2({window}) - {bits}) * {window} + 1e-9),
{name}g AS (SELECT oid, n, i + 1 AS pos, least({window}, n - i) AS len, max(i + 1 + least({window}, n - i)) OVER (PARTITION BY oid ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mx FROM {name}f),
{name}h AS (SELECT *, sum(CASE WHEN mx IS NULL OR pos > mx THEN 1 ELSE 0 END) OVER (PARTITION BY oid ORDER BY pos) AS g FROM {name}g),
{name}m AS (SELECT oid, n, min(pos) AS pos, max(pos + len) - min(pos) AS len FROM {name}h GROUP BY oid, n, g),
{name}l AS (SELECT oid, n, pos + CASE WHEN pos > 1 AND len > {by} THEN {by} ELSE 0 END AS pos, len - CASE WHEN pos > 1 AND len > {by} THEN {by} ELSE 0 END AS len FROM {name}m),
{name} AS (SELECT oid, pos, len - CASE WHEN pos + len - 1 < n AND len > {by} THEN {by} ELSE 0 END AS len FROM {name}l)"""


def _proteins(s, d, sets: int = 1):
    """Letters of passages as proteins; passage i belongs to so many neighbouring sets of eight."""
    t = table(s, d, "benchmark").select("item_id", F.upper(F.regexp_replace("text", "[^A-Za-z]", "")).alias("seq"))
    return t.select(F.explode(F.array(*(((F.col("item_id") + 7 * k) % 8).cast("long") for k in range(sets)))).alias("id"), "seq")


def _segments(s, d):
    return intervals(s, d).select("id", "div", F.col("pos").alias("q"), "len", "seq_id")


SEG = f"{IV}, seg AS (SELECT id, div, pos AS q, len, seq_id FROM iv)"
WINDOWS = f"""WITH {SEG}, a AS (SELECT *, row_number() OVER w AS n, q - lag(q, 3) OVER w <= 4000 AS hit FROM seg WINDOW w AS (PARTITION BY seq_id, div ORDER BY q, id)),
b AS (SELECT *, max(CASE WHEN hit THEN n END) OVER (PARTITION BY seq_id, div ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last FROM a),
c AS (SELECT *, sum(CASE WHEN hit AND (last IS NULL OR n - last > 4) THEN 1 ELSE 0 END) OVER (PARTITION BY seq_id, div ORDER BY n) AS island FROM b),
e AS (SELECT seq_id, div, min(n) - 3 AS lo, max(n) AS hi FROM c WHERE hit GROUP BY seq_id, div, island),
f AS (SELECT c.*, e.lo FROM c LEFT JOIN e ON c.seq_id = e.seq_id AND c.div = e.div AND n BETWEEN lo AND hi),
g AS (SELECT *, avg(len) OVER (PARTITION BY seq_id, div, lo) AS mean FROM f) SELECT id, len FROM g WHERE lo IS NULL OR len >= mean * 4"""
HOT = f"""WITH {SEG}, p AS (SELECT id, div, len, q - id % 977 AS dg, q + id % 977 AS an FROM seg),
c AS (SELECT id, div, len, floor((dg + a) / 500.0) AS x, floor((an + b) / 700.0) AS y FROM p, (VALUES (0, 0), (250, 0), (0, 350), (250, 350)) AS t(a, b)),
h AS (SELECT div, x, y FROM c GROUP BY ALL HAVING sum(len) >= 4000) SELECT DISTINCT id FROM c JOIN h USING (div, x, y)"""
TRACKS = f"""WITH {IV}, p AS (SELECT seq_id, div, unnest(range(pos, pos + len)) AS base FROM iv),
k AS (SELECT seq_id, base, bool_or(div = 'click') AS xp, bool_or(div = 'view') AS lc, bool_or(div = 'purchase') AS co, bool_or(div = 'signup') AS nn FROM p WHERE div IN ('click', 'view', 'purchase', 'signup') GROUP BY ALL)
SELECT seq_id, count(*) AS combined, count(CASE WHEN xp AND NOT lc AND NOT co THEN 1 END) AS xp, count(CASE WHEN lc AND NOT co THEN 1 END) AS lc, count(CASE WHEN co THEN 1 END) AS co FROM k GROUP BY 1"""
PIECES = f"""WITH {IV}, n AS (SELECT DISTINCT seq_id FROM iv), every AS (SELECT seq_id, unnest(range(1, 20001)) AS base FROM n),
m AS (SELECT DISTINCT seq_id, unnest(range(pos, pos + len)) AS base FROM iv),
f AS (SELECT seq_id, base FROM every ANTI JOIN m USING (seq_id, base)), g AS (SELECT *, base - row_number() OVER (PARTITION BY seq_id ORDER BY base) AS g FROM f)
SELECT seq_id, min(base) AS pos, count(*) AS len FROM g GROUP BY seq_id, g HAVING count(*) >= 56"""


def _tracks(s, d):
    i = intervals(s, d).select("seq_id", "div", "pos", "len")
    t = screen.tracks(*(i.filter(F.col("div") == x).select("seq_id", "pos", "len") for x in ("click", "view", "purchase", "signup")), ["seq_id"])
    out = None
    for name in ("combined", "xp", "lc", "co"):
        one = t[name].groupBy("seq_id").agg(F.sum("len").alias(name))
        out = one if out is None else out.join(one, "seq_id", "left")
    return out.fillna(0)


def _pieces(s, d):
    i = intervals(s, d).select("seq_id", "pos", "len")
    whole = i.select("seq_id").distinct().withColumn("len", F.lit(20_000))
    return screen.indexable(whole, i, ["seq_id"])


def _scope(s, d):
    k = F.col("doc_id")
    text = F.concat("source", F.when(k % 11 == 0, " alternate locus").when(k % 13 == 0, " UNVERIFIED: x").otherwise(""))
    seqs = table(s, d, "documents").select(k.alias("seq_id"), text.alias("defline"))
    ids = seqs.filter("seq_id % 4 <> 1").select("seq_id")
    masked = seqs.filter("seq_id % 7 = 2").select("seq_id", F.when(F.col("seq_id") % 2 == 0, 5).alias("len"))
    return screen.in_scope(seqs, ids, masked).select("seq_id")


def _hot(s, d):
    g = _segments(s, d).select(F.col("id").alias("ident"), "div", (F.col("q") - F.col("id") % 977).alias("diag"), (F.col("q") + F.col("id") % 977).alias("anti"), "len")
    return screen.hot_windows(g, "div", 500, 700).select(F.col("ident").alias("id"))


def _with_actions(s, d):
    seqs = table(s, d, "documents").select(F.col("doc_id").alias("seq_id"), bases(F.col("text")).alias("seq"))
    acts = seqs.filter("seq_id % 3 = 0").select("seq_id", F.length("seq").cast("long").alias("seq_len"), F.lit("TRIM").alias("action"))
    return screen.with_actions(seqs, acts).select("seq_id", F.coalesce("seq_len", F.lit(-1)).alias("seq_len"), F.coalesce("action", F.lit("")).alias("action"))


def register(query) -> None:
    query("minhash_signature", f"{SIGNED} SELECT id, md5(signature) AS digest, length(signature) AS n FROM sig")(
        lambda s, d: sketch.protein_signatures(_proteins(s, d)).select("id", F.md5("signature").alias("digest"), F.length("signature").cast("long").alias("n")))
    # all pairs of slots are too slow in SQL here; a test compares this one with brute force
    query("minhash_pairs")(lambda s, d: sketch.similar_pairs(sketch.protein_signatures(_proteins(s, d, 2)), 0.3))
    query("in_scope", "SELECT doc_id AS seq_id FROM documents WHERE doc_id % 4 <> 1 AND doc_id % 11 <> 0 AND doc_id % 13 <> 0 AND NOT (doc_id % 7 = 2 AND doc_id % 2 = 1)")(_scope)
    taxa = lambda s, d: table(s, d, "nation").select((F.col("n_nationkey") + 1).alias("tax_id"))
    rows = lambda s, d: table(s, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_suppkey") % 40).cast("int").alias("tax_id"))
    query("known_taxa", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_suppkey % 40 BETWEEN 1 AND 25")(lambda s, d: screen.known_taxa(rows(s, d), F.broadcast(taxa(s, d))).select("l_orderkey", "l_linenumber"))
    query("unknown_taxa", "SELECT CAST(l_suppkey % 40 AS INTEGER) AS tax_id, count(*) AS \"rows\" FROM lineitem WHERE l_suppkey % 40 NOT BETWEEN 1 AND 25 GROUP BY 1 ORDER BY 1 LIMIT 10")(lambda s, d: screen.unknown_taxa(rows(s, d), F.broadcast(taxa(s, d))))
    query("sequences_with_actions", "SELECT doc_id AS seq_id, CASE WHEN doc_id % 3 = 0 THEN coalesce(length(regexp_replace(text, '[^A-Za-z]', '', 'g')), 0) ELSE -1 END AS seq_len, CASE WHEN doc_id % 3 = 0 THEN 'TRIM' ELSE '' END AS action FROM documents")(_with_actions)
    query("repeat_track_union", TRACKS)(_tracks)
    query("indexable_pieces", PIECES)(_pieces)
    query("repeat_windows", WINDOWS)(lambda s, d: screen.drop_repeat_windows(_segments(s, d), ["seq_id", "div"], ["id"], 3, 4000).select("id", "len"))
    query("hot_windows", HOT)(_hot)
    query("augmented_seeds", f"WITH {SEG}, c AS (SELECT seq_id, count(*) AS n FROM seg GROUP BY 1), l AS (SELECT min(n) AS m FROM (SELECT n FROM c ORDER BY n DESC LIMIT 20)) SELECT id FROM seg WHERE len > 60 OR seq_id IN (SELECT seq_id FROM c, l WHERE n > m)")(
        lambda s, d: screen.augment(_segments(s, d).filter("len > 60"), _segments(s, d), "seq_id").select("id"))
    narrow, wide = (50, 5.42), (300, 7.45)
    query("entropy_narrow", f"WITH {QRY}, {_entropy('x', *narrow)} SELECT * FROM x")(lambda s, d: words.entropy_track(probes(s, d), *narrow))
    query("entropy_wide", f"WITH {QRY}, {_entropy('x', *wide)} SELECT * FROM x")(lambda s, d: words.entropy_track(probes(s, d), *wide))
    both = f"""WITH {QRY}, {_entropy('x', *narrow)}, {_entropy('y', *wide)}, hi AS (SELECT oid, 1 + oid % 50 AS pos, 20 AS len FROM qry),
a AS (SELECT *, max(pos + len) OVER (PARTITION BY oid ORDER BY pos, len ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mx FROM x WHERE len > 0),
b AS (SELECT *, sum(CASE WHEN mx IS NULL OR pos > mx + 56 THEN 1 ELSE 0 END) OVER (PARTITION BY oid ORDER BY pos, len) AS g FROM a),
c AS (SELECT oid, min(pos) AS pos, max(pos + len) - min(pos) AS len FROM b GROUP BY oid, g HAVING max(pos + len) - min(pos) > 56),
e AS (SELECT * FROM c UNION ALL SELECT * FROM y UNION ALL SELECT * FROM hi),
f AS (SELECT *, max(pos + len) OVER (PARTITION BY oid ORDER BY pos, len ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mx FROM e WHERE len > 0),
h AS (SELECT *, sum(CASE WHEN mx IS NULL OR pos > mx THEN 1 ELSE 0 END) OVER (PARTITION BY oid ORDER BY pos, len) AS g FROM f)
SELECT oid, min(pos) AS pos, max(pos + len) - min(pos) AS len FROM h GROUP BY oid, g"""
    high = lambda s, d: probes(s, d).select("oid", (1 + F.col("oid") % 50).cast("long").alias("pos"), F.lit(20).cast("long").alias("len"))
    query("low_complexity_report", both)(lambda s, d: words.reported_low_complexity(words.entropy_track(probes(s, d), *narrow), words.entropy_track(probes(s, d), *wide), high(s, d)))
    band = f"""WITH {SEG}, b AS (SELECT id, div, seq_id, q - id % 2000 AS d, q + id % 2000 AS a FROM seg)
SELECT id FROM b x WHERE EXISTS (SELECT 1 FROM b y WHERE x.div = y.div AND x.seq_id = y.seq_id AND x.id <> y.id AND abs(x.d - y.d) <= 60 AND abs(x.a - y.a) <= 300)"""
    query("banded_neighbours", band)(
        lambda s, d: screen.banded_neighbours(_segments(s, d).withColumn("s", F.col("id") % 2000).drop("len"), ["div", "seq_id"], ["id"], 60, 300).select("id"))
