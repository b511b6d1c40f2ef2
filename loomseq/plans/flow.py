"""Queries of the smaller dataflow operators, of scalar expressions, and of streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..adapters import IV, QRY, fresh, intervals, probes, table
from ..functions import scalars as x
from ..operators import dataflow as df_
from ..operators import hits
from ..streaming import events as ev

KEY, ORD = ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
W = "OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity)"
IDS = """i AS (SELECT o_orderkey AS k, CASE o_orderkey % 6 WHEN 0 THEN '>gi|12|ref|NC_' || o_orderkey || '.3|' WHEN 1 THEN '>lcl|c' || o_orderkey || ' text'
 WHEN 2 THEN 'gb|A' || o_orderkey || '.' || (1 + o_orderkey % 9) WHEN 3 THEN 'a~b' || o_orderkey || '~5..9' WHEN 4 THEN 'x~' || o_orderkey || '~~1..7'
 ELSE '>plain' || o_orderkey END AS line FROM orders)"""


def _ids(s, d):
    k = F.col("o_orderkey")
    t = k.cast("string")
    c = lambda *v: F.concat(*(F.lit(y) if isinstance(y, str) else y for y in v))
    line = (
        F.when(k % 6 == 0, c(">gi|12|ref|NC_", t, ".3|")).when(k % 6 == 1, c(">lcl|c", t, " text")).when(k % 6 == 2, c("gb|A", t, ".", (1 + k % 9).cast("string")))
        .when(k % 6 == 3, c("a~b", t, "~5..9")).when(k % 6 == 4, c("x~", t, "~~1..7")).otherwise(c(">plain", t)))
    return table(s, d, "orders").select(k.alias("k"), line.alias("line"))


def _stream(s, d):
    """events as a stream of its Parquet file."""
    e = table(s, d, "events")
    path = fresh(s, "stream")
    e.write.parquet(path)
    return s.readStream.schema(e.schema).parquet(path)


def _finished(writer, s):
    writer.option("checkpointLocation", fresh(s, "state")).trigger(availableNow=True).start().awaitTermination()


def _running(s, d):
    out = fresh(s, "totals")
    writer = ev.running_totals(_stream(s, d).select("user_id", F.coalesce("value", F.lit(0.0)).alias("value")))
    _finished(writer.writeStream.outputMode("update").foreachBatch(lambda b, n: b.withColumn("batch", F.lit(n)).write.mode("append").parquet(out)), s)
    last = s.read.parquet(out)
    best = F.max_by(F.struct("events", "value"), F.struct("batch", "events"))
    return last.groupBy("user_id").agg(best.alias("x")).select("user_id", "x.events", F.round("x.value", 4).alias("value"))


def _tee(s, d):
    a, b = fresh(s, "tee-a"), fresh(s, "tee-b")
    to = lambda path, f: (lambda batch: f(batch).write.mode("append").parquet(path))
    _finished(ev.tee(_stream(s, d), to(a, lambda x: x.select("event_id", "event_type")), to(b, lambda x: x.filter("value > 50").select("event_id"))), s)
    return s.read.parquet(a).join(s.read.parquet(b).withColumn("high", F.lit(True)), "event_id", "left").groupBy("event_type").agg(F.count("*").alias("n"), F.count("high").alias("high"))


def _deltas(rows):
    last = 0.0
    for r in rows:
        yield {"l_orderkey": r["l_orderkey"], "l_linenumber": r["l_linenumber"], "step": float(r["l_quantity"]) - last}
        last = float(r["l_quantity"])


def register(query) -> None:
    li = lambda s, d: table(s, d, "lineitem")
    orders = lambda s, d: table(s, d, "orders")
    query("foldl_default", "SELECT o_custkey, CAST(sum(o_orderkey % 97) AS BIGINT) AS total FROM orders GROUP BY 1")(
        lambda s, d: df_.fold_default(orders(s, d).withColumn("v", F.col("o_orderkey") % 97), ["o_custkey"], ["o_orderkey"], "v", lambda a, v: a + v, "total"))
    query("reverse", "SELECT o_orderkey FROM orders ORDER BY o_orderkey DESC")(lambda s, d: df_.reverse(orders(s, d), [F.desc("o_orderkey")]).select("o_orderkey"))
    by = "SELECT o_orderkey, o_orderpriority, row_number() OVER (ORDER BY o_orderpriority, o_orderkey) AS rank FROM orders"
    query("sort_by", by)(lambda s, d: df_.ordinal(df_.sort_by(orders(s, d), ["o_orderpriority"], ["o_orderkey"]), ["o_orderpriority", "o_orderkey"], "rank").select("o_orderkey", "o_orderpriority", (F.col("rank") + _base(s)).alias("rank")))
    query("unstable_sort", "SELECT o_orderpriority FROM orders ORDER BY 1")(lambda s, d: df_.sort_by(orders(s, d), ["o_orderpriority"], []).select("o_orderpriority"))
    query("lazy_sort", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 40")(lambda s, d: df_.lazy_sort(orders(s, d), ["o_totalprice", "o_orderkey"], 40).select("o_orderkey", "o_totalprice"))
    query("set_unique", "SELECT o_custkey, coalesce(max(CASE WHEN o_custkey % 3 > 0 THEN o_custkey * 7 END), -1) AS v FROM orders GROUP BY 1")(
        lambda s, d: df_.set_unique(orders(s, d).withColumn("x", F.when(F.col("o_custkey") % 3 > 0, F.col("o_custkey") * 7)), ["o_custkey"], "x", -1, "v"))
    query("adapt_stage", f"SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DOUBLE) - coalesce(lag(CAST(l_quantity AS DOUBLE)) {W}, 0) AS step FROM lineitem")(
        lambda s, d: df_.adapt(li(s, d).select(*KEY, *ORD), KEY, ORD, _deltas, "l_orderkey long, l_linenumber long, step double"))
    query("for_each_adjacent", f"SELECT l_orderkey, l_linenumber, lag(l_quantity) {W} AS before FROM lineitem")(lambda s, d: li(s, d).select(*KEY, "l_linenumber", df_.lagged(li(s, d), KEY, ORD, "l_quantity").alias("before")))
    runs = f"WITH f AS (SELECT *, CASE WHEN lag(l_returnflag) {W} = l_returnflag THEN 0 ELSE 1 END AS b FROM lineitem), g AS (SELECT *, sum(b) {W} AS g FROM f) SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey, g ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS nth FROM g"
    query("map_groups", runs)(lambda s, d: df_.map_groups(li(s, d), KEY, ORD, "l_returnflag", lambda w: F.row_number().over(w).cast("long"), "nth").select(*KEY, "l_linenumber", "nth"))
    near = runs.replace(f"CASE WHEN lag(l_returnflag) {W} = l_returnflag THEN 0 ELSE 1 END", f"CASE WHEN abs(l_quantity - lag(l_quantity) {W}) <= 10 THEN 0 ELSE 1 END")
    together = lambda s, d: F.abs(F.col("l_quantity") - df_.lagged(li(s, d), KEY, ORD, "l_quantity")) <= 10
    query("map_groups_if", near)(lambda s, d: df_.map_groups_if(li(s, d), KEY, ORD, together(s, d), lambda w: F.row_number().over(w).cast("long"), "nth").select(*KEY, "l_linenumber", "nth"))
    query("counter", "SELECT o_custkey, CAST(sum(n) AS BIGINT) AS n FROM (SELECT o_custkey, 1 AS n FROM orders UNION ALL SELECT o_custkey, -1 FROM orders WHERE o_orderstatus = 'F') GROUP BY 1 HAVING sum(n) > 0")(
        lambda s, d: df_.counter(orders(s, d), orders(s, d).filter("o_orderstatus = 'F'"), "o_custkey"))
    query("irange", "SELECT unnest(range(3, 5000, 7)) AS id")(lambda s, d: df_.irange(s, 3, 5000, 7))
    query("generate", "SELECT i AS n, i * i AS square FROM range(0, 100) AS t(i)")(lambda s, d: s.range(100).select(F.col("id").alias("n"), (F.col("id") * F.col("id")).alias("square")))
    # scalars
    query("flip_positions", f"WITH {IV} SELECT id, 1 - pos - len AS flipped, 1 - (1 - pos - len) - len AS again FROM iv")(
        lambda s, d: intervals(s, d).select("id", x.flip_pos(F.col("pos"), F.col("len")).alias("flipped"), x.flip_pos(x.flip_pos(F.col("pos"), F.col("len")), F.col("len")).alias("again")))
    pair = f"WITH {IV}, p AS (SELECT a.id, a.pos AS ap, a.len AS al, b.pos AS bp, b.len AS bl FROM iv a JOIN iv b ON b.id = a.id + 1)"
    query("interval_hull", pair + " SELECT id, least(ap, bp) AS pos, greatest(ap + al, bp + bl) - least(ap, bp) AS len, greatest(0, least(ap + al, bp + bl) - greatest(ap, bp)) AS overlap, greatest(ap, bp) - least(ap + al, bp + bl) AS distance FROM p")(
        lambda s, d: intervals(s, d).select("id", F.col("pos").alias("ap"), F.col("len").alias("al")).join(intervals(s, d).select((F.col("id") - 1).alias("id"), F.col("pos").alias("bp"), F.col("len").alias("bl")), "id").select("id", x.hull(*map(F.col, ("ap", "al", "bp", "bl"))).alias("h")).select("id", "h.*"))
    normal = "CASE k % 6 WHEN 0 THEN 'NC_' || k || '.3' WHEN 1 THEN 'c' || k WHEN 2 THEN 'A' || k || '.' || (1 + k % 9) WHEN 5 THEN 'plain' || k ELSE line END"
    query("normal_ids", f"WITH {IDS} SELECT k, {normal} AS id FROM i")(lambda s, d: _ids(s, d).select("k", x.normal_id(F.col("line")).alias("id")))
    query("escaped_tildes", f"WITH {IDS} SELECT k, CASE k % 6 WHEN 3 THEN 'a{{TILDE}}b' || k || '~5..9' WHEN 4 THEN 'x{{TILDE}}' || k || '~~1..7' ELSE line END AS escaped, line AS back FROM i")(
        lambda s, d: _ids(s, d).select("k", x.escape_tilde(F.col("line")).alias("escaped"), x.unescape_tilde(x.escape_tilde(F.col("line"))).alias("back")))
    query("parsed_ranges", "SELECT k, CAST(r[1] AS BIGINT) AS pos, CAST(r[2] - r[1] + 1 AS BIGINT) AS len FROM (SELECT o_orderkey AS k, unnest([[o_orderkey % 50 + 1, o_orderkey % 50 + 9], [100, 100 + o_orderkey % 7]]) AS r FROM orders)")(
        lambda s, d: orders(s, d).select(F.col("o_orderkey").alias("k"), F.format_string("%d..%d,100..%d", F.col("o_orderkey") % 50 + 1, F.col("o_orderkey") % 50 + 9, 100 + F.col("o_orderkey") % 7).alias("t")).select("k", F.explode(x.parse_ranges(F.col("t"))).alias("r")).select("k", "r.*"))
    query("gene_symbols", "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_brand ELSE '' END AS gene FROM part")(
        lambda s, d: table(s, d, "part").select("p_partkey", x.gene_symbol(F.concat("p_name", F.when(F.col("p_size") % 2 == 0, F.concat(F.lit(" [gene="), "p_brand", F.lit("] more"))).otherwise(""))).alias("gene")))
    framed = "c AS (SELECT oid, CASE oid % 3 WHEN 0 THEN 'ATG' || seq || 'TAA' WHEN 1 THEN seq ELSE 'ATG' || seq[1:3 * (length(seq) // 3)] || 'TGA' END AS seq FROM qry)"
    query("strides", f"WITH {QRY}, {framed} SELECT oid, length(seq) % 3 = 0 AND seq[1:3] = 'ATG' AND seq[-3:] IN ('TAA', 'TAG', 'TGA') AS coding, CASE WHEN length(seq) % 3 = 0 AND seq[1:3] = 'ATG' AND seq[-3:] IN ('TAA', 'TAG', 'TGA') THEN 18 WHEN length(seq) > 200 THEN 22 ELSE 11 END AS stride FROM c")(_strides)
    query("reduced_proteins", f"WITH {QRY} SELECT oid, translate(seq || 'MKXW*', 'ACGTMKXW*', '202213300') AS reduced FROM qry")(
        lambda s, d: probes(s, d).select("oid", x.reduced_protein(F.concat("seq", F.lit("MKXW*"))).alias("reduced")))
    query("previous_accessions", "SELECT o_orderkey AS k, 'GCA_' || o_orderkey || '.' || (o_orderkey % 9) AS previous FROM orders")(
        lambda s, d: orders(s, d).select(F.col("o_orderkey").alias("k"), x.previous_accession(F.concat(F.lit("GCA_"), F.col("o_orderkey").cast("string"), F.lit("."), (F.col("o_orderkey") % 9 + 1).cast("string"))).alias("previous")))
    query("dates", "SELECT o_orderkey AS k, strftime(o_orderdate, '%Y-%m-%d') AS run, strftime(o_orderdate, '%Y%m%d') AS build FROM orders")(
        lambda s, d: orders(s, d).select(F.col("o_orderkey").alias("k"), x.run_date(F.col("o_orderdate")).alias("run"), x.build_date(F.col("o_orderdate")).alias("build")))
    query("exact_sum", "SELECT l_returnflag, CAST(sum(CAST(l_extendedprice AS DECIMAL(38, 6))) AS VARCHAR) AS total FROM lineitem GROUP BY 1")(
        lambda s, d: li(s, d).groupBy("l_returnflag").agg(x.exact_sum(F.col("l_extendedprice")).cast("decimal(38,6)").cast("string").alias("total")))
    query("drop_own_taxon", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_suppkey % 10 <> 3")(
        lambda s, d: hits.drop_taxa(li(s, d).withColumn("tax_id", (F.col("l_suppkey") % 10).cast("int")), [3]).select("l_orderkey", "l_linenumber"))
    query("drop_seed_length", f"WITH {IV} SELECT id FROM iv WHERE len <> 56 AND len > 0")(lambda s, d: intervals(s, d).filter((F.col("len") != 56) & (F.col("len") > 0)).select("id"))
    # streams
    query("stream_running_totals", "SELECT user_id, count(*) AS events, round(sum(coalesce(value, 0)), 4) AS value FROM events GROUP BY 1")(_running)
    query("stream_tee", "SELECT event_type, count(*) AS n, count(CASE WHEN value > 50 THEN 1 END) AS high FROM events GROUP BY 1")(_tee)


def _base(s) -> int:
    """What turns an ordinal into a rank from 1."""
    first = df_.ordinal(s.range(1), ["id"], "rank").first()["rank"]
    return 1 - first


def _strides(s, d):
    seq = F.col("seq")
    coded = F.when(F.col("oid") % 3 == 0, F.concat(F.lit("ATG"), seq, F.lit("TAA"))).when(F.col("oid") % 3 == 1, seq).otherwise(F.concat(F.lit("ATG"), F.substring(seq, F.lit(1), (F.floor(F.length(seq) / 3) * 3).cast("int")), F.lit("TGA")))
    q = probes(s, d).select("oid", coded.alias("seq"))
    return q.select("oid", x.in_frame(F.col("seq")).alias("coding"), x.stride(x.in_frame(F.col("seq")), F.length("seq") > 200).cast("int").alias("stride"))
