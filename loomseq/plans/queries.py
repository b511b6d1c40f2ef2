"""One query for each operator over the driver's tables, and the SQL that gives the same rows."""

from __future__ import annotations

import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..adapters import IV, NODES, QRY, SBJ, among, bases_of, intervals, nodes, probes, sequences, settled, subjects, table, taxa, texts
from ..functions import scalars as x
from ..operators import actions as act
from ..operators import align, classify, dataflow as df_, extension, hits, intervals as iv, rounds, select, sketch, taxify, words
from ..sources import sinks
from ..streaming import events as ev

Q: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return keep


li = lambda s, d: table(s, d, "lineitem")
orders = lambda s, d: table(s, d, "orders")
cust = lambda s, d: table(s, d, "customer")
evs = lambda s, d: table(s, d, "events")
KEY, ORD = ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
E1 = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_quantity FROM lineitem"

# ---- dataflow -----------------------------------------------------------------------------------------------------------
query("where", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'O'")(lambda s, d: df_.where(orders(s, d), (F.col("o_totalprice") > 100000) & (F.col("o_orderstatus") == "O")).select("o_orderkey", "o_totalprice"))
query("transform", "SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS net FROM lineitem")(lambda s, d: df_.transform(li(s, d), net=F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4)).select("l_orderkey", "l_linenumber", "net"))
query("counts", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL")(lambda s, d: df_.counts(li(s, d), "l_returnflag", "l_linestatus"))
query("group_all", "SELECT o_custkey, array_to_string(list_sort(list(o_orderkey)), ',') AS items FROM orders GROUP BY o_custkey")(lambda s, d: df_.group_all(orders(s, d), ["o_custkey"], "o_orderkey").select("o_custkey", F.array_join(F.col("items").cast("array<string>"), ",").alias("items")))
query("group_adjacent", f"WITH e AS ({E1}), f AS (SELECT *, lag(l_returnflag) OVER w IS DISTINCT FROM l_returnflag AS b FROM e WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity)), g AS (SELECT *, sum(CAST(b AS BIGINT)) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS island FROM f) SELECT l_orderkey, CAST(island AS BIGINT) AS island, l_returnflag, count(*) AS n FROM g GROUP BY ALL")(lambda s, d: df_.group_adjacent(li(s, d), KEY, ORD, "l_returnflag").groupBy("l_orderkey", "island", "l_returnflag").agg(F.count("*").alias("n")))
query("group_adjacent_if", f"WITH e AS ({E1}), f AS (SELECT *, coalesce(abs(l_quantity - lag(l_quantity) OVER w) > 10, true) AS b FROM e WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity)), g AS (SELECT *, sum(CAST(b AS BIGINT)) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS island FROM f) SELECT l_orderkey, CAST(island AS BIGINT) AS island, count(*) AS n, sum(l_quantity) AS q FROM g GROUP BY ALL")(lambda s, d: df_.group_adjacent_if(li(s, d), KEY, ORD, F.abs(F.col("l_quantity") - df_.lagged(None, KEY, ORD, "l_quantity")) <= 10).groupBy("l_orderkey", "island").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("q")))
query("in_groups_of", "SELECT (row_number() OVER (ORDER BY o_orderkey) - 1) // 100 AS batch, o_orderkey FROM orders")(lambda s, d: df_.in_groups_of(orders(s, d), 100, ["o_orderkey"]).select("batch", "o_orderkey"))
query("sliding_window", "WITH w AS (SELECT l_orderkey, l_linenumber, list(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS q, count(*) OVER (PARTITION BY l_orderkey) AS n, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS r FROM lineitem) SELECT l_orderkey, l_linenumber, len(q) AS n, list_sum(q) AS q FROM w WHERE len(q) = 3 OR (n < 3 AND r = 1)")(lambda s, d: df_.sliding_window(li(s, d), KEY, ORD, "l_quantity", 3).select("l_orderkey", "l_linenumber", F.size("window").cast("long").alias("n"), F.aggregate("window", F.lit(0.0), lambda a, v: a + v).alias("q")))
PRE = "WITH p AS (SELECT l_orderkey, l_linenumber, sum(CAST(NOT l_quantity < 30 AS INTEGER)) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS bad FROM lineitem) SELECT l_orderkey, l_linenumber FROM p WHERE bad "
query("take_while", PRE + "= 0")(lambda s, d: df_.take_while(li(s, d), KEY, ORD, F.col("l_quantity") < 30).select("l_orderkey", "l_linenumber"))
query("drop_while", PRE + "> 0")(lambda s, d: df_.drop_while(li(s, d), KEY, ORD, F.col("l_quantity") < 30).select("l_orderkey", "l_linenumber"))
query("take_first", "SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 25")(lambda s, d: df_.take_first(orders(s, d), 25, ["o_orderkey"]).select("o_orderkey"))
query("take_last", "SELECT o_orderkey FROM orders ORDER BY o_orderkey DESC LIMIT 25")(lambda s, d: df_.take_last(orders(s, d), 25, [F.desc("o_orderkey")]).select("o_orderkey"))
query("drop_first", "SELECT o_orderkey FROM orders ORDER BY o_orderkey OFFSET 25")(lambda s, d: df_.drop_first(orders(s, d), 25, ["o_orderkey"]).select("o_orderkey"))
query("drop_last", "SELECT o_orderkey FROM orders ORDER BY o_orderkey DESC OFFSET 25")(lambda s, d: df_.drop_last(orders(s, d), 25, [F.desc("o_orderkey")]).select("o_orderkey"))
query("semi_sorted", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")(lambda s, d: df_.where_in(cust(s, d), orders(s, d).select(F.col("o_custkey").alias("c_custkey")), "c_custkey").select("c_custkey"))
query("anti_sorted", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")(lambda s, d: df_.where_not_in(cust(s, d), orders(s, d).select(F.col("o_custkey").alias("c_custkey")), "c_custkey").select("c_custkey"))
for name, way in (("max", "DESC"), ("min", "ASC")):
    query(f"where_{name}_by", f"SELECT l_orderkey, l_linenumber, l_quantity FROM (SELECT *, rank() OVER (PARTITION BY l_orderkey ORDER BY l_quantity {way}) AS r FROM lineitem) WHERE r = 1")(lambda s, d, way=way: df_.where_extreme_by(li(s, d), KEY, F.desc("l_quantity") if way == "DESC" else F.asc("l_quantity")).select("l_orderkey", "l_linenumber", "l_quantity"))
query("exists_where", "SELECT l_orderkey, bool_or(l_discount > 0.08) AS found FROM lineitem GROUP BY l_orderkey")(lambda s, d: df_.exists_where(li(s, d), KEY, F.col("l_discount") > 0.08))
query("top_n_by", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")(lambda s, d: df_.top_n_by(orders(s, d), 20, [F.desc("o_totalprice"), "o_orderkey"]).select("o_orderkey", "o_totalprice"))
query("unique_adjacent", "SELECT l_orderkey, l_linenumber FROM (SELECT *, lag(l_returnflag) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS p FROM lineitem) WHERE p IS DISTINCT FROM l_returnflag")(lambda s, d: df_.unique_adjacent(li(s, d), KEY, ORD, "l_returnflag").select("l_orderkey", "l_linenumber"))
query("unique_all", "SELECT l_partkey, l_orderkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey) = 1")(lambda s, d: df_.unique_all(li(s, d), ["l_partkey"], ["l_orderkey", "l_linenumber", "l_suppkey"]).select("l_partkey", "l_orderkey", "l_linenumber"))
query("concat", "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")(lambda s, d: df_.concat(table(s, d, "part").select("p_partkey", F.split("p_name", " ").alias("w")), "w", "word"))
query("append", "SELECT c_custkey AS id, c_acctbal AS bal FROM customer UNION ALL SELECT s_suppkey, s_acctbal FROM supplier")(lambda s, d: df_.append(cust(s, d).select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("bal")), table(s, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("bal"))))
query("zip_with", "WITH a AS (SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal, c_custkey) AS ord FROM customer), b AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_acctbal, s_suppkey) AS ord FROM supplier) SELECT a.ord, c_custkey, s_suppkey FROM a JOIN b ON a.ord = b.ord")(lambda s, d: df_.zip_with(cust(s, d).select("c_custkey", "c_acctbal"), table(s, d, "supplier").select("s_suppkey", "s_acctbal"), ["c_acctbal", "c_custkey"], ["s_acctbal", "s_suppkey"]).select("ord", "c_custkey", "s_suppkey"))
query("zip_adjacent", "SELECT l_orderkey, l_linenumber, diff FROM (SELECT *, l_quantity - lag(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS diff FROM lineitem) WHERE diff IS NOT NULL")(lambda s, d: df_.zip_adjacent(li(s, d), KEY, ORD, "l_quantity", lambda a, b: b - a, "diff").select("l_orderkey", "l_linenumber", "diff"))
query("cartesian", "SELECT r_name, n_name FROM region, nation")(lambda s, d: df_.cartesian(table(s, d, "region"), table(s, d, "nation")).select("r_name", "n_name"))
query("foldl", "SELECT l_orderkey, round(list_reduce(list_prepend(0.0, list(l_quantity ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity)), lambda a, v: a / 2 + v), 6) AS f FROM lineitem GROUP BY l_orderkey")(lambda s, d: df_.fold(li(s, d), KEY, ORD, "l_quantity", F.lit(0.0), lambda a, v: a / 2 + v, "f").withColumn("f", F.round("f", 6)))
query("foldl_1", "SELECT l_orderkey, round(list_reduce(list(l_quantity ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity), lambda a, v: a / 2 + v), 6) AS f FROM lineitem GROUP BY l_orderkey")(lambda s, d: df_.fold_first(li(s, d), KEY, ORD, "l_quantity", lambda a, v: a / 2 + v, "f").withColumn("f", F.round("f", 6)))
query("enumerated", "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS ord FROM orders")(lambda s, d: df_.ordinal(orders(s, d), ["o_totalprice", "o_orderkey"]).select("o_orderkey", "ord"))
query("gmean", "SELECT l_returnflag, round(exp(avg(ln(1 + l_quantity)) FILTER (l_quantity > 0)) - 1, 6) AS gmean FROM lineitem GROUP BY l_returnflag")(lambda s, d: df_.gmean_by(li(s, d), ["l_returnflag"], "l_quantity").withColumn("gmean", F.round("gmean", 6)))
query("sum_by", "SELECT o_orderpriority, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ALL")(lambda s, d: df_.sum_by(orders(s, d), ["o_orderpriority"], F.col("o_totalprice")).withColumn("total", F.round("total", 2)))
query("first_or_default", "SELECT o_custkey, coalesce(arg_min(o_totalprice, o_orderkey) FILTER (o_totalprice > 150000), -1.0) AS price FROM orders GROUP BY ALL")(lambda s, d: df_.first_or(orders(s, d), ["o_custkey"], "o_orderkey", "o_totalprice", F.col("o_totalprice") > 150000, -1.0, "price"))
query("last_or_default", "SELECT o_custkey, coalesce(arg_max(o_totalprice, o_orderkey) FILTER (o_totalprice > 150000), -1.0) AS price FROM orders GROUP BY ALL")(lambda s, d: df_.last_or(orders(s, d), ["o_custkey"], "o_orderkey", "o_totalprice", F.col("o_totalprice") > 150000, -1.0, "price"))
query("get_unique", "SELECT o_orderkey, o_custkey AS cust FROM orders")(lambda s, d: df_.get_unique(orders(s, d), ["o_orderkey"], F.col("o_custkey") >= 0, "o_custkey", "cust"))
query("at_or_default", "SELECT c_custkey, coalesce(n, 0) AS n FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON c_custkey = o_custkey")(lambda s, d: df_.at_or_default(cust(s, d).select("c_custkey"), df_.counts(orders(s, d).withColumnRenamed("o_custkey", "c_custkey"), "c_custkey"), "c_custkey", "n", 0))
query("analytic_functions", "SELECT o_custkey, o_orderkey, rank() OVER w AS rk, dense_rank() OVER w AS dr, ntile(4) OVER w AS nt, round(percent_rank() OVER w, 6) AS pr, round(cume_dist() OVER w, 6) AS cd, first_value(o_orderkey) OVER w AS fv, nth_value(o_orderkey, 2) OVER w AS nv, lead(o_orderkey) OVER w AS ld FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)")(
    lambda s, d: (lambda w: orders(s, d).select("o_custkey", "o_orderkey", F.rank().over(w).cast("long").alias("rk"), F.dense_rank().over(w).cast("long").alias("dr"), F.ntile(4).over(w).cast("long").alias("nt"), F.round(F.percent_rank().over(w), 6).alias("pr"), F.round(F.cume_dist().over(w), 6).alias("cd"), F.first_value("o_orderkey").over(w).alias("fv"), F.nth_value("o_orderkey", 2).over(w).alias("nv"), F.lead("o_orderkey").over(w).alias("ld")))(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")))

# ---- intervals ----------------------------------------------------------------------------------------------------------
def merged(src: str, key: str, gap: int = 0, name: str = "m") -> str:
    return f"{name}0 AS (SELECT {key}, pos, len, max(pos + len) OVER (PARTITION BY {key} ORDER BY pos, len ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mx, row_number() OVER (PARTITION BY {key} ORDER BY pos, len) AS rn FROM {src} WHERE len > 0), {name}1 AS (SELECT *, sum(CASE WHEN mx IS NULL OR pos > mx + {gap} THEN 1 ELSE 0 END) OVER (PARTITION BY {key} ORDER BY rn) AS g FROM {name}0), {name} AS (SELECT {key}, min(pos) AS pos, max(pos + len) - min(pos) AS len FROM {name}1 GROUP BY {key}, g)"


S = ["seq_id"]
CLICKS = "even AS (SELECT seq_id, pos, len FROM iv WHERE id % 2 = 0), odd AS (SELECT seq_id, pos, len FROM iv WHERE id % 2 = 1)"
AB = f"WITH {IV}, {CLICKS}, {merged('even', 'seq_id', name='a')}, {merged('odd', 'seq_id', name='b')}"
ISECT = "SELECT a.seq_id, greatest(a.pos, b.pos) AS pos, least(a.pos + a.len, b.pos + b.len) - greatest(a.pos, b.pos) AS len FROM a JOIN b ON a.seq_id = b.seq_id AND a.pos < b.pos + b.len AND b.pos < a.pos + a.len"


def two(s, d):
    i = intervals(s, d)
    return iv.merge(i.filter("id % 2 = 0"), S), iv.merge(i.filter("id % 2 = 1"), S)


def hull(m, extra=10):
    return m.groupBy("seq_id").agg((F.min("pos") - extra).alias("pos"), (F.max(F.col("pos") + F.col("len")) - F.min("pos") + 2 * extra).alias("len"))


query("iv_merge", f"WITH {IV}, {merged('iv', 'seq_id')} SELECT * FROM m")(lambda s, d: iv.merge(intervals(s, d), S))
query("iv_merge_gap", f"WITH {IV}, {merged('iv', 'seq_id', 15)} SELECT * FROM m")(lambda s, d: iv.merge(intervals(s, d), S, 15))
query("iv_invert", f"WITH {IV}, {merged('iv', 'seq_id')} SELECT seq_id, pos + len AS pos, coalesce(lead(pos) OVER (PARTITION BY seq_id ORDER BY pos), pos + len) - pos - len AS len FROM m UNION ALL SELECT seq_id, min(pos), 0 FROM m GROUP BY seq_id")(lambda s, d: iv.invert(iv.merge(intervals(s, d), S), S))
query("iv_invert_whole", f"WITH {IV}, {merged('iv', 'seq_id')}, w AS (SELECT seq_id, min(pos) - 10 AS a, max(pos + len) + 10 AS b FROM m GROUP BY 1), g AS (SELECT m.seq_id, pos + len AS pos, coalesce(lead(pos) OVER (PARTITION BY m.seq_id ORDER BY pos), b) AS e FROM m JOIN w ON m.seq_id = w.seq_id) SELECT seq_id, pos, e - pos AS len FROM g WHERE e > pos UNION ALL SELECT seq_id, a, 10 FROM w")(lambda s, d: (lambda m: iv.invert_whole(m, S, hull(m)))(iv.merge(intervals(s, d), S)))
query("iv_intersect", f"{AB} {ISECT}")(lambda s, d: iv.intersect(*two(s, d), S))
query("iv_intersect_len", f"{AB} SELECT seq_id, CAST(sum(len) AS BIGINT) AS len FROM ({ISECT}) GROUP BY seq_id")(lambda s, d: iv.intersect_len(*two(s, d), S))
query("iv_subtract", f"""{AB}, bi AS (SELECT a.seq_id, a.pos AS ap, a.pos + a.len AS ae, greatest(a.pos, b.pos) AS bp, least(a.pos + a.len, b.pos + b.len) AS be FROM a JOIN b ON a.seq_id = b.seq_id AND a.pos < b.pos + b.len AND b.pos < a.pos + a.len),
g AS (SELECT seq_id, be AS pos, coalesce(lead(bp) OVER (PARTITION BY seq_id, ap ORDER BY bp), ae) AS e FROM bi UNION ALL SELECT seq_id, ap, min(bp) FROM bi GROUP BY seq_id, ap UNION ALL SELECT seq_id, pos, pos + len FROM a WHERE NOT EXISTS (SELECT 1 FROM bi WHERE bi.seq_id = a.seq_id AND bi.ap = a.pos))
SELECT seq_id, pos, e - pos AS len FROM g WHERE e > pos""")(lambda s, d: iv.subtract(*two(s, d), S))
query("iv_overlap_join", f"WITH {IV} SELECT x.seq_id, x.id AS id, y.id AS b_id FROM iv x JOIN iv y ON x.seq_id = y.seq_id AND x.id % 7 = 0 AND y.id % 7 = 1 AND x.pos < y.pos + y.len AND y.pos < x.pos + x.len")(lambda s, d: (lambda i: iv.overlap_join(i.filter("id % 7 = 0"), i.filter("id % 7 = 1"), S).select("seq_id", "id", "b_id"))(intervals(s, d)))
query("iv_overlap_join_whole", f"WITH {IV}, {merged('iv', 'seq_id, div')} SELECT x.seq_id, x.id, m.div AS b_div, m.pos AS b_pos FROM iv x JOIN m ON x.seq_id = m.seq_id AND x.len > 0 AND x.pos < m.pos + m.len AND m.pos < x.pos + x.len")(lambda s, d: (lambda i: iv.overlap_join(i, iv.merge(i, ["seq_id", "div"]), S).select("seq_id", "id", "b_div", "b_pos"))(intervals(s, d)))
query("iv_exclude_third", f"WITH {IV} SELECT id, seq_id, pos, len FROM iv x WHERE id % 5 > 0 AND NOT EXISTS (SELECT 1 FROM iv y WHERE y.id % 5 = 0 AND x.seq_id = y.seq_id AND 3 * (least(x.pos + x.len, y.pos + y.len) - greatest(x.pos, y.pos)) > x.len)")(lambda s, d: (lambda i: iv.exclude_overlapping(i.filter("id % 5 > 0"), i.filter("id % 5 = 0"), S, "id").select("id", "seq_id", "pos", "len"))(intervals(s, d)))
query("iv_coverage_by_div", f"WITH {IV}, {merged('iv', 'seq_id, div')} SELECT seq_id, div, CAST(sum(len) AS BIGINT) AS covered FROM m GROUP BY ALL")(lambda s, d: iv.coverage(intervals(s, d), ["seq_id", "div"]))
query("iv_bins_multi_div", f"WITH {IV}, e AS (SELECT seq_id, div, unnest(range(pos // 20, (pos + len - 1) // 20 + 1)) AS bin FROM iv) SELECT seq_id, bin, count(DISTINCT div) AS labels FROM e GROUP BY ALL HAVING labels >= 3")(lambda s, d: iv.crowded_bins(intervals(s, d), S, "div", 20, 3))
query("iv_check", f"WITH {IV}, {merged('iv', 'seq_id')} SELECT * FROM m")(lambda s, d: iv.check(iv.merge(intervals(s, d), S), S))
query("iv_session", "WITH e AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p, event_id FROM events), f AS (SELECT *, sum(CASE WHEN p IS NULL OR ts >= p + INTERVAL 30 MINUTE THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g FROM e) SELECT user_id, epoch_us(min(ts)) AS start_us, count(*) AS events FROM f GROUP BY user_id, g")(lambda s, d: ev.sessions(evs(s, d)).select("user_id", us("start"), "events"))


def us(c, name="start_us"):
    zero = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")).cast("timestamp")
    return (F.unix_micros(F.col(c).cast("timestamp")) - F.unix_micros(zero)).alias(name)


query("windows_tumbling", "SELECT epoch_us(date_trunc('hour', ts)) AS start_us, event_type, count(*) AS events, round(sum(value), 4) AS value FROM events GROUP BY ALL")(lambda s, d: ev.windows(evs(s, d)).select(us("start"), "event_type", "events", F.round("value", 4).alias("value")))
query("windows_sliding", "WITH e AS (SELECT event_type, value, unnest([0, 1, 2, 3]) AS k, ts FROM events) SELECT (epoch_us(ts) // 900000000 - k) * 900000000 AS start_us, event_type, count(*) AS events, round(sum(value), 4) AS value FROM e GROUP BY ALL")(lambda s, d: ev.windows(evs(s, d), "1 hour", "15 minutes").select(us("start"), "event_type", "events", F.round("value", 4).alias("value")))
query("stream_first_seen", "SELECT DISTINCT user_id, event_type FROM events")(lambda s, d: ev.first_seen(evs(s, d).select("user_id", "event_type"), ["user_id", "event_type"]))
query("stream_static_join", "SELECT event_id, c_mktsegment FROM events LEFT JOIN customer ON user_id = c_custkey")(lambda s, d: ev.with_table(evs(s, d), cust(s, d).select(F.col("c_custkey").alias("user_id"), "c_mktsegment"), "user_id").select("event_id", "c_mktsegment"))

# ---- words --------------------------------------------------------------------------------------------------------------
def word_sql(src: str, t: int = 56, stride: int = 1, name: str = "w", extra: str = "") -> str:
    return f"{name}0 AS (SELECT oid{extra}, translate(seq, 'ACGT', '0101') AS bits, unnest(range(1, length(seq) - {t - 2}, {stride})) AS pos FROM {src} WHERE length(seq) >= {t}), {name}1 AS (SELECT oid{extra}, pos, regexp_replace(substring(bits, pos, {t}), '(..).', '\\1', 'g') AS w FROM {name}0), {name}2 AS (SELECT *, translate(reverse(w), '01', '10') AS r FROM {name}1), {name} AS (SELECT oid{extra}, CASE WHEN r < w THEN -(pos + {t - 1}) ELSE pos END AS pos, least(w, r) AS word, r < w AS flipped FROM {name}2)"


IDX = f"{SBJ}, {word_sql('sbj', stride=11, name='sw', extra=', tax_id')}, idx AS (SELECT DISTINCT word, tax_id, oid, pos FROM sw QUALIFY dense_rank() OVER (PARTITION BY word, tax_id ORDER BY oid, pos) <= 2)"
QW = f"{QRY}, {word_sql('qry', name='qw')}"
SEED = "q_oid, CASE WHEN s < 0 THEN 1 - q - 56 ELSE q END AS q_pos, s_oid, CASE WHEN s < 0 THEN 1 - s - 56 ELSE s END AS s_pos"
SEEDS = f"seeds AS (SELECT {SEED} FROM (SELECT qw.oid AS q_oid, qw.pos AS q, idx.oid AS s_oid, idx.pos AS s FROM qw JOIN idx ON qw.word = idx.word))"
index = lambda s, d: words.build_index(texts(s, d), read=bases_of)
seeds = lambda s, d: words.seeds_of(words.spaced_words(probes(s, d)), texts(s, d), bases_of)
query("spaced_words", f"WITH {QRY}, {word_sql('qry', 44)} SELECT oid, pos, word FROM w")(lambda s, d: words.spaced_words(probes(s, d), 44).select("oid", "pos", "word"))
query("canonical_words", f"WITH {QW} SELECT oid, pos, word, flipped FROM qw")(lambda s, d: words.spaced_words(probes(s, d)))
query("split_key", f"WITH {QW}, t AS (SELECT oid, pos, substring(word, 24, 15) || substring(word, 1, 23) AS t FROM qw) SELECT oid, pos, substring(t, 1, 8) AS key8, substring(t, 9, 30) AS key30 FROM t")(lambda s, d: words.split_key(words.spaced_words(probes(s, d))).select("oid", "pos", "key8", "key30"))
query("index_keep2", f"WITH {IDX} SELECT word, tax_id, oid, pos FROM idx")(lambda s, d: index(s, d).select("word", "tax_id", "oid", "pos"))
query("seed_join", f"WITH {IDX}, {QW}, {SEEDS} SELECT * FROM seeds")(seeds)
query("seed_join_tiered", f"""WITH {IDX}, {QW}, i2 AS (SELECT *, substring(word, 24, 15) || substring(word, 1, 23) AS t FROM idx), i3 AS (SELECT oid AS s_oid, pos AS s, word, substring(t, 9, 30) AS k30, substring(t, 1, 4) AS top, count(*) OVER (PARTITION BY substring(t, 9, 30)) AS n FROM i2),
q2 AS (SELECT oid AS q_oid, pos AS q, word, substring(substring(word, 24, 15) || substring(word, 1, 23), 9, 30) AS k30, substring(substring(word, 24, 15) || substring(word, 1, 23), 1, 4) AS top FROM qw)
SELECT {SEED}, 1 AS tier FROM q2 JOIN i3 ON q2.word = i3.word UNION ALL
SELECT {SEED}, CASE WHEN n <= 8 THEN 2 ELSE 3 END AS tier FROM q2 JOIN i3 ON q2.k30 = i3.k30 AND (n <= 8 OR q2.top = i3.top) WHERE q2.word NOT IN (SELECT word FROM idx)""")(lambda s, d: (lambda q: words.seed_join_tiered(q, settled(words.build_index(texts(s, d), asked=q, by="key30", read=bases_of))))(words.spaced_words(probes(s, d))))
query("occurrence_cap", f"WITH {IDX}, {QW}, {SEEDS}, h AS (SELECT q_oid, q_pos, count(*) AS n FROM seeds GROUP BY ALL), c AS (SELECT q_oid, floor(greatest(20.0, 4 * (exp(avg(ln(1 + n))) - 1))) AS cap FROM h GROUP BY ALL) SELECT seeds.* FROM seeds JOIN h ON seeds.q_oid = h.q_oid AND seeds.q_pos = h.q_pos JOIN c ON h.q_oid = c.q_oid WHERE n < cap")(lambda s, d: words.occurrence_cap(seeds(s, d)))
SEG = f"{SEEDS}, c0 AS (SELECT q_oid, s_oid, (q_pos < 0) <> (s_pos < 0) AS minus, q_pos AS q, s_pos AS s, s_pos - q_pos AS dg, lag(q_pos) OVER (PARTITION BY q_oid, s_oid, (q_pos < 0) <> (s_pos < 0), s_pos - q_pos ORDER BY q_pos) AS p FROM seeds), c1 AS (SELECT *, sum(CASE WHEN p IS NULL OR q > p + 156 THEN 1 ELSE 0 END) OVER (PARTITION BY q_oid, s_oid, minus, dg ORDER BY q) AS g FROM c0), seg AS (SELECT q_oid, s_oid, minus, min(q) AS q, min(s) AS s, max(q) + 56 - min(q) AS len FROM c1 GROUP BY q_oid, s_oid, minus, dg, g)"
query("seed_coalesce", f"WITH {IDX}, {QW}, {SEG} SELECT * FROM seg")(lambda s, d: words.coalesce(seeds(s, d)))
NEAR = f"""WITH {IDX}, {QW}, {SEG}, n AS (SELECT *, row_number() OVER (PARTITION BY q_oid, s_oid ORDER BY s, len, q) AS rn FROM seg)
SELECT q_oid, s_oid, minus, q, s, len FROM n a WHERE len > 56 OR EXISTS (SELECT 1 FROM n b WHERE b.q_oid = a.q_oid AND b.s_oid = a.s_oid AND b.rn <> a.rn
 AND abs(b.rn - a.rn) <= 15 AND abs((b.q - b.s) - (a.q - a.s)) <= 5000 AND abs((b.q + b.s) - (a.q + a.s)) <= 50000)"""
query("near_neighbours", NEAR)(lambda s, d: words.near_neighbours(words.coalesce(seeds(s, d))).select("q_oid", "s_oid", "minus", "q", "s", "len"))
HITS = "h AS (SELECT q_oid AS oid, abs(q_pos) AS pos, count(*) AS n FROM seeds GROUP BY ALL)"
query("hi_occ", f"WITH {IDX}, {QW}, {SEEDS}, {HITS}, t AS (SELECT oid, pos, sum(n) OVER (PARTITION BY oid ORDER BY pos RANGE BETWEEN 19 PRECEDING AND CURRENT ROW) AS s FROM h), k AS (SELECT oid, pos, 1 AS len FROM t WHERE s > 3), {merged('k', 'oid')} SELECT * FROM m")(lambda s, d: words.high_occurrence(seeds(s, d).groupBy(F.col("q_oid").alias("oid"), F.abs("q_pos").alias("pos")).agg(F.count("*").alias("n")), most=3))
query("low_complexity", f"WITH {QRY}, p AS (SELECT oid, seq, unnest(range(1, length(seq) - 53)) AS pos FROM qry WHERE length(seq) >= 55), x AS (SELECT oid, pos, substring(seq, pos + k, 6) AS w FROM (SELECT oid, seq, pos, unnest(range(0, 50)) AS k FROM p)), c AS (SELECT oid, pos, w, count(*) / 50.0 AS p FROM x GROUP BY ALL), e AS (SELECT oid, pos, sum(-p * log2(p)) AS h FROM c GROUP BY ALL), k AS (SELECT oid, pos, 55 AS len FROM e WHERE h < 5.2), {merged('k', 'oid')} SELECT * FROM m")(lambda s, d: words.low_complexity(probes(s, d), bits=5.2))
query("frequent_words", f"WITH {SBJ}, {word_sql('sbj', 44, 11)} SELECT word, least(count(*), 250) AS n FROM w GROUP BY word")(lambda s, d: words.word_counts(words.spaced_words(subjects(s, d).select("oid", "seq"), 44, 11)).withColumn("n", F.col("n").cast("long")))
query("count_baseline", f"WITH {SBJ}, {word_sql('sbj', 44, 11)}, c AS (SELECT word, count(*) AS n FROM w GROUP BY word) SELECT round(sum(n) FILTER (n BETWEEN 1 AND 10) / (count(*) FILTER (n BETWEEN 1 AND 10) + 1), 6) AS baseline FROM c")(lambda s, d: words.count_baseline(words.word_counts(words.spaced_words(subjects(s, d).select("oid", "seq"), 44, 11))).withColumn("baseline", F.round("baseline", 6)))


def _tracks(s, d):
    w = words.spaced_words(probes(s, d), 44)
    return words.repeat_tracks(w, words.word_counts(w), 2)


query("repeat_tracks")(_tracks)
NR = "translate(text, '.,!? \n', 'NNNNNN')"


def _ntext(s, d):
    return table(s, d, "benchmark").select(F.col("item_id").alias("oid"), F.translate("text", ".,!? \n", "NNNNNN").alias("seq"))


NSQL = f"t AS (SELECT item_id AS oid, {NR} AS seq FROM benchmark), c AS (SELECT oid, seq, unnest(range(1, length(seq) + 1)) AS p FROM t), f AS (SELECT oid, p, substring(seq, p, 1) = 'N' AS n FROM c), g AS (SELECT oid, p, p - row_number() OVER (PARTITION BY oid ORDER BY p) AS k FROM f WHERE n), r AS (SELECT oid, min(p) AS pos, count(*) AS len FROM g GROUP BY oid, k HAVING count(*) >= 2)"
query("n_runs", f"WITH {NSQL} SELECT * FROM r")(lambda s, d: words.n_runs(_ntext(s, d), 2))
query("split_runs", f"WITH {NSQL}, b AS (SELECT oid, pos + len AS pos, coalesce(lead(pos) OVER (PARTITION BY oid ORDER BY pos), length(seq) + 1) AS e, length(seq) AS n, seq FROM r JOIN t USING (oid) UNION ALL SELECT oid, 1, coalesce((SELECT min(pos) FROM r WHERE r.oid = t.oid), length(seq) + 1), length(seq), seq FROM t) SELECT oid, pos, e - pos AS len, substring(seq, pos, e - pos) AS piece FROM b WHERE e > pos AND (e - pos >= 100 OR pos = 1 OR e = n + 1)")(lambda s, d: words.split_on_runs(_ntext(s, d), 2))
M = "% 18446744073709551616"
query("hash64", f"WITH a AS (SELECT o_orderkey AS k, CAST((CAST(o_orderkey AS UHUGEINT) + 11400714819323198485) {M} AS UBIGINT) AS x FROM orders), b AS (SELECT k, CAST((CAST(xor(x, x >> 30) AS UHUGEINT) * 13787848793156543929) {M} AS UBIGINT) AS x FROM a), c AS (SELECT k, CAST((CAST(xor(x, x >> 27) AS UHUGEINT) * 10723151780598845931) {M} AS UBIGINT) AS x FROM b) SELECT k, CAST(xor(x, x >> 31) AS VARCHAR) AS h FROM c")(lambda s, d: orders(s, d).select(F.col("o_orderkey").alias("k"), F.conv(F.hex(x.hash64(F.col("o_orderkey"))), 16, 10).alias("h")))
COMP = f"translate(upper(%s), '{x.IUPAC}', '{x.IUPAC_COMPLEMENT}')"
query("reverse_complement", f"WITH {QRY} SELECT oid, reverse({COMP % 'seq'}) AS rc FROM qry")(lambda s, d: probes(s, d).select("oid", x.reverse_complement(F.col("seq")).alias("rc")))
query("as_pct", "SELECT l_orderkey, l_linenumber, CAST(floor(l_quantity / 50 * 100 + 0.5) AS BIGINT) AS pct FROM lineitem")(lambda s, d: li(s, d).select("l_orderkey", "l_linenumber", x.as_pct(F.col("l_quantity"), F.lit(50)).alias("pct")))
query("checksums", "SELECT item_id, md5(text) AS md5, sha1(text) AS sha1, sha256(text) AS sha256 FROM benchmark")(lambda s, d: table(s, d, "benchmark").select("item_id", x.checksums(F.col("text").cast("binary")).alias("c")).select("item_id", "c.md5", "c.sha1", "c.sha256"))
query("align")(lambda s, d: align.align(probes(s, d), texts(s, d), read=bases_of))
query("extension_rounds")(lambda s, d: extension.extension_rounds(*_found(s, d)))
query("best_chain")(lambda s, d: align.best_chain(words.coalesce(seeds(s, d)), ["q_oid"]))
query("drop_shadows")(lambda s, d: align.drop_shadows(words.coalesce(seeds(s, d))))
query("drop_stacks", f"WITH {IDX}, {QW}, {SEG} SELECT * FROM seg WINDOW w AS (PARTITION BY q_oid, s_oid, s, len) QUALIFY NOT ((count(*) OVER w >= 32 AND len <= 110) OR (count(*) OVER w >= 64 AND len <= 150))")(lambda s, d: align.drop_stacks(words.coalesce(seeds(s, d))))
query("drop_crud", f"WITH {IDX}, {QW}, {SEG}, g AS (SELECT q_oid FROM seg GROUP BY q_oid HAVING sum(greatest(len - 56, 0)) >= 50 OR sum(len) * 10 >= 100000) SELECT seg.* FROM seg WHERE q_oid IN (SELECT q_oid FROM g)")(lambda s, d: align.drop_crud(words.coalesce(seeds(s, d)), ["q_oid"]))
segs = lambda s, d: words.coalesce(seeds(s, d))


def _found(s, d):
    """Segments, queries, and the subjects that have a segment."""
    g = settled(segs(s, d))
    return g, probes(s, d), words.found_subjects(texts(s, d), g, bases_of)


def taxed(s, d):
    """Segments with their subject's tax_id; taxa of other subjects are gone before anything is dealt out."""
    g = settled(segs(s, d))
    return g.join(among(taxa(s, d).withColumnRenamed("oid", "s_oid"), g.select("s_oid"), "s_oid"), "s_oid")


NORM = "ns AS (SELECT q_oid, tax_id, count(*) AS n, CAST(sum(len) AS BIGINT) AS sum_len, CAST(sum(len * len) AS BIGINT) AS sum_squares, max(len) AS max_len, sum(len) / count(*) AS mean_len, sum(len * len) / count(*) AS mean_square FROM seg JOIN sbj ON s_oid = sbj.oid GROUP BY ALL)"
query("taxon_norms", f"WITH {IDX}, {QW}, {SEG}, {NORM} SELECT q_oid, tax_id, n, sum_len, sum_squares, max_len, round(mean_len, 4) AS mean_len, round(mean_square, 4) AS mean_square FROM ns")(lambda s, d: rounds.taxon_norms(taxed(s, d)).withColumns({c: F.round(c, 4) for c in ("mean_len", "mean_square")}))
CAND = "cx AS (SELECT q_oid, tax_id, tax_id % 4 AS div, unnest([0, 1, 2, 3, 4, 5]) AS k, unnest([n, sum_len, sum_squares, max_len, mean_len, mean_square]) AS v FROM ns), cr AS (SELECT *, row_number() OVER w AS r, first_value(div) OVER w AS d0 FROM cx WINDOW w AS (PARTITION BY q_oid, k ORDER BY v DESC, tax_id)), cd AS (SELECT *, min(CASE WHEN div <> d0 AND r > 2 THEN r END) OVER (PARTITION BY q_oid, k) AS o FROM cr), cand AS (SELECT DISTINCT q_oid, tax_id FROM cd WHERE r <= 2 OR r = o)"
query("candidate_taxa", f"WITH {IDX}, {QW}, {SEG}, {NORM}, {CAND} SELECT * FROM cand")(lambda s, d: (lambda n: rounds.candidate_taxa(n, n.select("tax_id", (F.col("tax_id") % 4).alias("div")).distinct()))(settled(rounds.taxon_norms(taxed(s, d)))))
NEAR = f"nx AS (SELECT seg.q_oid, seg.s_oid, s AS a, s + len AS e, least(100000, 2 * length(qry.seq)) AS n, length(sbj.seq) AS sl, lag(s + len) OVER w AS pe, lead(s) OVER w AS ns FROM seg JOIN qry ON q_oid = qry.oid JOIN sbj ON s_oid = sbj.oid WINDOW w AS (PARTITION BY q_oid, s_oid ORDER BY s, len, q)), ny AS (SELECT q_oid, s_oid, sl, CASE WHEN pe IS NULL OR a - pe >= 2 * n THEN a - n ELSE pe END AS x, a AS y FROM nx WHERE pe IS NULL OR a - pe >= 30 OR a - pe >= 2 * n UNION ALL SELECT q_oid, s_oid, sl, e, e + n FROM nx WHERE ns IS NULL OR ns - e >= 2 * n), nz AS (SELECT q_oid, s_oid, greatest(x - 50, 1) AS pos, least(y + 50, sl + 1) - greatest(x - 50, 1) AS len FROM ny), np AS (SELECT * FROM nz WHERE len > 0), {merged('np', 'q_oid, s_oid', 50, 'near')}"


def _sizes(s, d, segments):
    """Lengths of both sides of each pair; of the found subjects only lengths are kept."""
    q = probes(s, d)
    b = sequences(among(texts(s, d).select(F.col("oid").alias("s_oid"), "seq"), segments.select("s_oid"), "s_oid").withColumnRenamed("s_oid", "oid"), bases_of, "seq")
    pair = segments.select("q_oid", "s_oid").distinct()
    return pair.join(q.select(F.col("oid").alias("q_oid"), F.length("seq").alias("q_len")), "q_oid").join(b.select(F.col("oid").alias("s_oid"), F.length("seq").alias("s_len")), "s_oid")


query("neighbourhoods", f"WITH {IDX}, {QW}, {SEG}, {NEAR} SELECT q_oid, s_oid, pos, len FROM near")(lambda s, d: (lambda g: rounds.neighbourhoods(g, _sizes(s, d, g)))(settled(segs(s, d))))
query("second_round", f"""WITH {IDX}, {QW}, {SEG}, {NORM}, {CAND.replace('tax_id % 4 AS div', '0 AS div')}, {NEAR.replace('FROM seg JOIN qry', 'FROM seg JOIN cand USING (q_oid) JOIN qry').replace('JOIN sbj ON s_oid = sbj.oid WINDOW', 'JOIN sbj ON s_oid = sbj.oid AND sbj.tax_id = cand.tax_id WINDOW')},
pc AS (SELECT s_oid AS oid, q_oid, pos - 1 AS o, substring(seq, pos, len) AS seq FROM near JOIN sbj ON s_oid = sbj.oid), {word_sql('pc', 29, name='pw', extra=', q_oid, o')}, {word_sql('qry', 29, name='qs')}, qk AS (SELECT *, count(*) OVER (PARTITION BY oid, word) AS c FROM qs),
s2 AS (SELECT DISTINCT pw.q_oid, pw.oid AS s_oid, CASE WHEN pw.pos < 0 THEN 1 - qk.pos - 29 ELSE qk.pos END AS q, CASE WHEN pw.pos < 0 THEN 1 - pw.pos - 29 ELSE pw.pos END + o AS s FROM qk JOIN pw ON qk.oid = pw.q_oid AND qk.word = pw.word WHERE c <= 10),
l2 AS (SELECT *, q < 0 AS minus, lag(q) OVER (PARTITION BY q_oid, s_oid, q < 0, s - q ORDER BY q) AS p FROM s2), g2 AS (SELECT *, sum(CASE WHEN p IS NULL OR q > p + 34 THEN 1 ELSE 0 END) OVER (PARTITION BY q_oid, s_oid, minus, s - q ORDER BY q) AS g FROM l2)
SELECT q_oid, s_oid, minus, min(q) AS q, min(s) AS s, max(q) + 29 - min(q) AS len FROM g2 GROUP BY q_oid, s_oid, minus, s - q, g HAVING max(q) + 29 - min(q) >= 50""")(lambda s, d: rounds.second_round(taxed(s, d), probes(s, d), texts(s, d), read=bases_of))
query("gapped_extension")(lambda s, d: (lambda g, q, b: align.gapped(align.extend(g, q, b), q, b))(*_found(s, d)))
query("drop_self", f"WITH {IDX}, {QW}, {SEG} SELECT q_oid || '~1..9' AS q_id, s_oid AS s_id, s, len FROM seg WHERE q_oid <> s_oid")(lambda s, d: hits.drop_self(segs(s, d).select(F.concat("q_oid", F.lit("~1..9")).alias("q_id"), F.col("s_oid").alias("s_id"), "s", "len")))
query("drop_taxa", f"WITH {IDX}, {QW}, {SEG} SELECT q_oid, s_oid, tax_id, s, len FROM seg JOIN sbj ON s_oid = sbj.oid WHERE tax_id NOT IN (3, 5)")(lambda s, d: hits.drop_taxa(taxed(s, d), [3, 5]).select("q_oid", "s_oid", "tax_id", "s", "len"))
query("tag_extrachromosomal", "SELECT event_id AS id, user_id AS s_id, event_type AS div, user_id % 3 = 0 AND event_type = 'click' AS extra FROM events")(lambda s, d: (lambda i: hits.tag_extrachromosomal(i.select("id", F.col("seq_id").alias("s_id"), "div"), i.filter("seq_id % 3 = 0").select(F.col("seq_id").alias("s_id")), "click"))(intervals(s, d)))
query("batches", "SELECT doc_id, CAST((sum(n_chars) OVER (ORDER BY doc_id) - n_chars) // 100000 AS BIGINT) AS batch FROM documents")(lambda s, d: hits.batches(table(s, d, "documents").select("doc_id", "n_chars"), "doc_id", F.col("n_chars")).select("doc_id", "batch"))
query("repeat_source", "WITH t AS (SELECT doc_id AS seq_id, n_chars AS len FROM documents), r AS (SELECT *, sum(len) OVER (ORDER BY len, seq_id) AS up FROM t WHERE len >= 300 AND len < 20000) SELECT seq_id, len FROM r WHERE up * 5 + 5 * (SELECT coalesce(sum(len), 0) FROM t WHERE len < 300) >= (SELECT sum(len) FROM t) UNION ALL SELECT * FROM t WHERE len >= 20000")(lambda s, d: hits.repeat_source(table(s, d, "documents").select(F.col("doc_id").alias("seq_id"), F.col("n_chars").alias("len")), 300, 20_000))
query("n_counts", f"SELECT item_id AS oid, length({NR}) - length(replace({NR}, 'N', '')) AS n FROM benchmark")(lambda s, d: hits.n_counts(_ntext(s, d)))
query("best_subarray", "WITH p AS (SELECT user_id, event_id, sum(value - 50) OVER (PARTITION BY user_id ORDER BY event_id) AS s FROM events), m AS (SELECT user_id, s - least(0, coalesce(min(s) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS v FROM p) SELECT user_id, round(max(v), 4) AS best FROM m GROUP BY user_id")(lambda s, d: align.best_subarray(evs(s, d).withColumn("v", F.col("value") - 50), ["user_id"], ["event_id"], "v").withColumn("best", F.round("best", 4)))

# ---- taxonomy -----------------------------------------------------------------------------------------------------------
whole = lambda n: n.groupBy("q_id").agg(F.lit(1).cast("long").alias("pos"), (F.max(F.col("pos") + F.col("len")) - 1).alias("len"))
COL0 = "k0 AS (SELECT *, max(pos + len) OVER (PARTITION BY q_id, tax_id ORDER BY pos, len, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mx, row_number() OVER (PARTITION BY q_id, tax_id ORDER BY pos, len, id) AS rn FROM nodes), k1 AS (SELECT *, sum(CASE WHEN mx IS NULL OR pos - mx >= 10 THEN 1 ELSE 0 END) OVER (PARTITION BY q_id, tax_id ORDER BY rn) AS g FROM k0)"
query("collapse_nodes", f"WITH {NODES}, {COL0} SELECT q_id, tax_id, div, min(pos) AS pos, max(pos + len) - min(pos) AS len FROM k1 GROUP BY q_id, tax_id, div, g")(lambda s, d: taxify.collapse_nodes(nodes(s, d)).drop("score"))
query("collapse_scores")(lambda s, d: taxify.collapse_nodes(nodes(s, d)))
TAX = "tx AS (SELECT q_id, tax_id, div, CAST(sum(len) AS BIGINT) AS cvg_by_tax, CAST(sum(score) AS DOUBLE) AS score FROM nodes GROUP BY ALL)"
query("tax_scores", f"WITH {NODES}, {TAX} SELECT q_id, tax_id, div, cvg_by_tax, round(score, 4) AS score FROM tx")(lambda s, d: (lambda n: taxify.tax_scores(n, whole(n)).withColumn("score", F.round("score", 4)))(nodes(s, d)))
TOP = f"{TAX}, t2 AS (SELECT * FROM tx QUALIFY row_number() OVER (PARTITION BY q_id, div ORDER BY score DESC, tax_id) <= 2), t4 AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score DESC, tax_id) AS rank FROM t2 QUALIFY rank <= 4)"
query("top2_per_div_top4", f"WITH {NODES}, {TOP} SELECT q_id, tax_id, rank FROM t4")(lambda s, d: (lambda n: taxify.best_taxa(taxify.tax_scores(n, whole(n))).select("q_id", "tax_id", F.col("rank").cast("long").alias("rank")))(nodes(s, d)))
CV = f"{merged('iv', 'seq_id, div')}, cv AS (SELECT seq_id AS q_ord, div, sum(len) AS len FROM m GROUP BY ALL)"
query("running_div_stats", f"WITH {IV}, {CV}, g AS (SELECT q.q_ord, v.div, coalesce(cv.len, 0) AS len FROM (SELECT DISTINCT q_ord FROM cv) q CROSS JOIN (SELECT DISTINCT div FROM cv) v LEFT JOIN cv ON cv.q_ord = q.q_ord AND cv.div = v.div), r AS (SELECT q_ord, div, CAST(sum(len) OVER (PARTITION BY div ORDER BY q_ord) AS BIGINT) AS cvg_len FROM g) SELECT *, row_number() OVER (PARTITION BY q_ord ORDER BY cvg_len DESC, div) = 1 AS top FROM r")(lambda s, d: taxify.running_div_stats(iv.coverage(intervals(s, d), ["seq_id", "div"]).select(F.col("seq_id").alias("q_ord"), "div", F.col("covered").alias("len"))))


def _primary(s, d):
    i = intervals(s, d)
    cover = iv.merge(i, ["seq_id", "div"])
    top = iv.merge(i.filter("div = 'click'"), S)
    isect = iv.overlap_join(cover, top, S).groupBy("div").agg(F.sum(F.least(F.col("pos") + F.col("len"), F.col("b_pos") + F.col("b_len")) - F.greatest("pos", "b_pos")).alias("isect"))
    stats = cover.groupBy("div").agg(F.sum("len").alias("cvg_len"), F.sum("len").alias("cvg_nr")).join(isect, "div", "left").fillna(0)
    return taxify.primary_divs(stats)


query("primary_divs")(_primary)
query("ultraconserved", f"WITH {IV}, e AS (SELECT seq_id, div, unnest(range(pos // 20, (pos + len - 1) // 20 + 1)) AS bin FROM iv), k AS (SELECT seq_id, bin * 20 AS pos, 20 AS len FROM e GROUP BY seq_id, bin HAVING count(DISTINCT div) >= 4), {merged('k', 'seq_id', 20)} SELECT * FROM m")(lambda s, d: iv.merge(iv.crowded_bins(intervals(s, d), S, "div", 20, 4).select("seq_id", (F.col("bin") * 20).alias("pos"), F.lit(20).cast("long").alias("len")), S, 20))
query("chimeric_intervals", f"WITH {NODES}, {merged('nodes', 'q_id, div', name='n')}, c AS (SELECT *, sum(len) OVER (PARTITION BY q_id, div ORDER BY pos) AS cs FROM n), k AS (SELECT x.q_id, x.div, x.pos, y.pos + y.len - x.pos AS len FROM c x JOIN c y ON x.q_id = y.q_id AND x.div = y.div AND y.pos >= x.pos AND y.pos + y.len - x.pos <= 2000 AND (y.cs - x.cs + x.len) * 100 >= 50 * (y.pos + y.len - x.pos)), {merged('k', 'q_id, div')} SELECT q_id, div, pos, len FROM m")(lambda s, d: taxify.chimeric_intervals(nodes(s, d)))
DIVR = f"{merged('nodes', 'q_id, div', name='dv')}, dc AS (SELECT q_id, div, sum(len) AS cvg FROM dv GROUP BY ALL), {merged('nodes', 'q_id', name='al')}, ac AS (SELECT q_id, sum(len) AS cvg FROM al GROUP BY ALL), wh AS (SELECT q_id, max(pos + len) - 1 AS n FROM nodes GROUP BY ALL)"
query("div_report", f"WITH {NODES}, {TOP}, {DIVR} SELECT t4.q_id, wh.n AS seq_len, CAST(ac.cvg AS BIGINT) AS cvg_by_all, string_agg(tax_id || ':' || t4.div || ':' || CAST(dc.cvg AS BIGINT) || ':' || cvg_by_tax || ':' || CAST(floor(score + 0.5) AS BIGINT), '|' ORDER BY rank) AS taxa FROM t4 JOIN dc ON t4.q_id = dc.q_id AND t4.div = dc.div JOIN ac ON t4.q_id = ac.q_id JOIN wh ON wh.q_id = t4.q_id GROUP BY ALL")(lambda s, d: (lambda n: taxify.report(n, whole(n)).select("q_id", "seq_len", "cvg_by_all", F.array_join(F.transform("taxa", lambda t: F.concat_ws(":", t["tax_id"].cast("string"), t["div"], t["cvg_by_div"].cast("string"), t["cvg_by_tax"].cast("string"), t["score"].cast("string"))), "|").alias("taxa")))(nodes(s, d)))
query("run_info", f"WITH {NODES}, {DIVR}, t AS (SELECT count(*) AS c, CAST(sum(wh.n) AS BIGINT) AS l, round(CAST(sum(ac.cvg) AS DOUBLE) / sum(wh.n), 6) AS g FROM wh JOIN ac USING (q_id)) SELECT '{{\"sequences\":' || c || ',\"length\":' || l || ',\"coverage\":' || g || ',\"asserted_div\":\"click\",\"primary_divs\":[' || (SELECT string_agg('\"' || div || '\"', ',' ORDER BY div) FROM (SELECT DISTINCT div FROM nodes)) || ']}}' AS info FROM t")(lambda s, d: (lambda n: hits.run_info(taxify.report(n, whole(n)), "click", n.select("div")))(nodes(s, d)))
query("subject_regions", f"WITH {IV}, s AS (SELECT div AS s_id, pos, len FROM iv), {merged('s', 's_id', 1000)} SELECT s_id, pos, len FROM m")(lambda s, d: taxify.subject_regions(intervals(s, d).select(F.col("div").alias("s_id"), "pos", "len")))

# ---- classes and actions ------------------------------------------------------------------------------------------------
#: Divisions that stand for event types, so that every kingdom occurs.
DIV = {"click": "anml:primates", "view": "prok:firmicutes", "purchase": "fung:fungi", "signup": "virs:viruses"}
DIVSQL = "CASE div " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in DIV.items()) + " ELSE 'anml:mammals' END"


def _records(s, d):
    n = nodes(s, d).withColumn("div", F.coalesce(*(F.when(F.col("div") == k, v) for k, v in DIV.items()), F.lit("anml:mammals")))
    r = taxify.report(n, whole(n))
    return r.select(F.col("q_id").alias("seq_id"), F.col("seq_len").alias("len"), (F.col("q_id") % 50).alias("xp"), (F.col("q_id") % 30).alias("lc"), F.lit(0).alias("co"), F.lit(0).alias("n"), "cvg_by_all", "taxa")


query("classify_rows")(lambda s, d: classify.classify(_records(s, d), ["anml:mammals"], ["prok:firmicutes", "fung:fungi"], 0.001).select("seq_id", "result", "result_div"))
query("div_totals", f"WITH {NODES.replace('event_type AS div', 'event_type AS div')}, {TOP}, {DIVR} SELECT {DIVSQL.replace('div ', 't4.div ', 1)} AS div, count(*) AS \"rows\", CAST(sum(n) AS BIGINT) AS total_len, CAST(sum(CASE WHEN rank = 1 THEN n ELSE 0 END) AS BIGINT) AS first_len FROM t4 JOIN wh ON t4.q_id = wh.q_id GROUP BY ALL")(lambda s, d: classify.div_totals(_records(s, d)).select("div", "rows", "total_len", "first_len"))
LAB = "CASE l_returnflag WHEN 'A' THEN 'contaminant' WHEN 'R' THEN 'primary' ELSE 'grey' END"
ROWS = f"r AS (SELECT l_orderkey AS seq_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_returnflag) AS at, CAST(floor(l_quantity) AS BIGINT) AS len, {LAB} AS label, CAST(floor(l_discount * 1000 + 0.5) AS BIGINT) AS pct, r_name AS div FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"


def rows(s, d):
    label = F.when(F.col("l_returnflag") == "A", "contaminant").when(F.col("l_returnflag") == "R", "primary").otherwise("grey")
    n = table(s, d, "nation").join(F.broadcast(table(s, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    sup = table(s, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("r_name").alias("div"))
    return li(s, d).join(sup, F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("l_orderkey").alias("seq_id"), F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*ORD, "l_discount", "l_returnflag")).cast("long").alias("at"), F.col("l_quantity").cast("long").alias("len"), label.alias("label"), F.floor(F.col("l_discount") * 1000 + 0.5).cast("long").alias("pct"), "div")


query("spans", f"""WITH {ROWS}, a AS (SELECT *, last_value(CASE WHEN label <> 'grey' THEN label END IGNORE NULLS) OVER p AS pl, last_value(CASE WHEN label <> 'grey' THEN pct END IGNORE NULLS) OVER p AS pp, first_value(CASE WHEN label <> 'grey' THEN label END IGNORE NULLS) OVER n AS nl, first_value(CASE WHEN label <> 'grey' THEN pct END IGNORE NULLS) OVER n AS np FROM r
 WINDOW p AS (PARTITION BY seq_id ORDER BY at ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), n AS (PARTITION BY seq_id ORDER BY at ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
b AS (SELECT *, CASE WHEN label <> 'grey' THEN label WHEN pl IS NULL AND nl IS NULL THEN 'grey' WHEN pl IS NULL THEN nl WHEN nl IS NULL OR pl = nl THEN pl WHEN pl = 'contaminant' THEN CASE WHEN pp >= 75 THEN nl WHEN np >= 75 THEN pl ELSE nl END ELSE CASE WHEN np >= 75 THEN pl WHEN pp >= 75 THEN nl ELSE pl END END AS span_label FROM a),
c AS (SELECT *, lag(span_label) OVER (PARTITION BY seq_id ORDER BY at) IS DISTINCT FROM span_label AS nw FROM b), e AS (SELECT *, sum(CAST(nw AS INTEGER)) OVER (PARTITION BY seq_id ORDER BY at) AS span FROM c)
SELECT seq_id, CAST(span AS BIGINT) AS span, span_label, min(at) AS first_at, max(at) AS last_at, CAST(sum(len) AS BIGINT) AS len, count(*) AS "rows" FROM e GROUP BY seq_id, span, span_label""")(lambda s, d: act.spans(rows(s, d)))
STAT = "".join(f", CAST(sum(CASE WHEN label = '{k}' THEN CAST(floor(len * pct / 100) AS BIGINT) ELSE 0 END) AS BIGINT) AS {k}_len" for k in ("primary", "contaminant", "grey"))


def lead_sql(c):
    return f"(SELECT seq_id, {c} FROM (SELECT seq_id, {c}, sum(len) AS l FROM r GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY seq_id ORDER BY l DESC, {c}) = 1)"


query("seq_stats", f"WITH {ROWS}, b AS (SELECT seq_id{STAT}, CAST(sum(len) AS BIGINT) AS seq_len FROM r GROUP BY seq_id) SELECT b.*, l.label AS top_label, v.div AS top_div FROM b JOIN {lead_sql('label')} l ON b.seq_id = l.seq_id JOIN {lead_sql('div')} v ON b.seq_id = v.seq_id")(lambda s, d: act.seq_stats(rows(s, d)))
DST = "ds AS (SELECT div, count(*) AS \"rows\", CAST(sum(len) AS BIGINT) AS total_len, CAST(sum(CASE WHEN label = 'contaminant' THEN len ELSE 0 END) AS BIGINT) AS contaminant_len, count(*) FILTER (label = 'contaminant') AS contaminants, sum(CASE WHEN label = 'contaminant' THEN len ELSE 0 END) >= 70000 AS review FROM r GROUP BY div)"
query("div_stats", f"WITH {ROWS}, {DST} SELECT * FROM ds")(lambda s, d: act.div_stats(rows(s, d), 70000))
query("low_cov_promote", f"WITH {ROWS}, {DST} SELECT seq_id, at, CASE WHEN label = 'grey' AND pct >= 10 AND div IN (SELECT div FROM ds WHERE review) THEN 'contaminant' ELSE label END AS label FROM r")(lambda s, d: (lambda r: act.promote_low_coverage(r, act.div_stats(r, 70000)).select("seq_id", "at", "label"))(rows(s, d)))
ACTS = "ac AS (SELECT *, CASE WHEN label = 'contaminant' AND div IN ('ASIA', 'EUROPE') AND pct > 90 THEN 'EXCLUDE' WHEN label = 'contaminant' THEN 'REVIEW' WHEN label = 'grey' AND pct > 95 THEN 'TRIM' ELSE 'INFO' END AS action FROM r)"
acts = lambda s, d: rows(s, d).withColumn("action", F.when((F.col("label") == "contaminant") & F.col("div").isin("ASIA", "EUROPE") & (F.col("pct") > 90), "EXCLUDE").when(F.col("label") == "contaminant", "REVIEW").when((F.col("label") == "grey") & (F.col("pct") > 95), "TRIM").otherwise("INFO"))
query("review_needs_exclude", f"WITH {ROWS}, {ACTS} SELECT seq_id, at, CASE WHEN action = 'REVIEW' AND div NOT IN (SELECT div FROM ac WHERE action = 'EXCLUDE') THEN 'INFO' ELSE action END AS action FROM ac")(lambda s, d: act.review_needs_exclude(acts(s, d)).select("seq_id", "at", "action"))
query("production_limits", f"WITH {ROWS}, {ACTS}, t AS (SELECT count(DISTINCT substring(div, 1, 4)) FILTER (action = 'EXCLUDE') AS kingdoms, count(DISTINCT div) FILTER (action = 'EXCLUDE') AS divs, CAST(sum(CASE WHEN action IN ('FIX', 'TRIM') THEN len ELSE 0 END) AS BIGINT) AS cut_len, count(*) FILTER (action IN ('FIX', 'TRIM')) AS cuts, CAST(sum(CASE WHEN action IN ('EXCLUDE', 'REVIEW') THEN len ELSE 0 END) AS BIGINT) AS out_len, CAST(sum(len) AS BIGINT) AS total_len FROM ac) SELECT *, kingdoms > 1 OR divs > 4 OR cut_len > 50000 OR cuts > 2 OR out_len > 50000000 OR out_len * 5 > total_len AS over FROM t")(lambda s, d: act.production_limits(acts(s, d)))
query("integrants", f"WITH {ROWS} SELECT seq_id, at, len FROM r WHERE label = 'contaminant' AND EXISTS (SELECT 1 FROM r x WHERE x.seq_id = r.seq_id AND x.label = 'primary' AND x.at < r.at) AND EXISTS (SELECT 1 FROM r x WHERE x.seq_id = r.seq_id AND x.label = 'primary' AND x.at > r.at)")(lambda s, d: act.integrants(rows(s, d)).select("seq_id", "at", "len"))
query("summary_rollup", f"WITH {ROWS} SELECT coalesce(div, 'TOTAL') AS div, count(*) AS n, CAST(sum(len) AS BIGINT) AS len FROM r GROUP BY ROLLUP (div)")(lambda s, d: act.summary(rows(s, d), "div"))


CHROWS = "c AS (SELECT seq_id, label, CASE WHEN seq_id % 3 = 0 THEN 'anml:insects' ELSE div END AS div, CASE WHEN label = 'contaminant' AND seq_id % 5 < 4 THEN 'Wolbachia sp.' ELSE 'other' END AS tax_name FROM r WHERE label <> 'grey')"
HIN = "hs AS (SELECT seq_id, at * 100 AS pos, 100 - CASE WHEN len < 8 THEN 1 ELSE 0 END AS len, CASE WHEN pct > 40 THEN 'primary' WHEN label = 'contaminant' THEN 'contaminant' ELSE 'grey' END AS label, CASE WHEN pct > 40 THEN CASE WHEN seq_id % 2 = 0 THEN 'anml:insects' ELSE 'prok:firmicutes' END WHEN seq_id % 3 = 0 THEN 'virs:prokaryotic viruses' ELSE 'virs:eukaryotic viruses' END AS div, CASE WHEN at = 2 THEN 'Wolbachia' ELSE 'x' END AS tax_name FROM r)"
query("hosted_integrants", f"""WITH {ROWS}, {HIN}, o AS (SELECT *, lag(label) OVER w AS pl, lag(pos + len) OVER w AS pe, lead(label) OVER w AS nl, lead(pos) OVER w AS np, last_value(CASE WHEN label = 'primary' THEN pos END IGNORE NULLS) OVER (PARTITION BY seq_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lp, first_value(CASE WHEN label = 'primary' THEN pos END IGNORE NULLS) OVER (PARTITION BY seq_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS rp FROM hs WINDOW w AS (PARTITION BY seq_id ORDER BY pos)),
x AS (SELECT *, label = 'contaminant' AND ((pl = 'primary' AND pe < pos) OR (nl = 'primary' AND pos + len < np)) IS TRUE AS gap FROM o WHERE label <> 'primary' AND lp IS NOT NULL AND rp IS NOT NULL),
y AS (SELECT *, bool_or(gap) OVER (PARTITION BY seq_id, lp) AS gaps FROM x),
z AS (SELECT *, bool_and(label = 'grey' OR (tax_name = 'Wolbachia' AND seq_id % 2 = 0) OR (NOT gaps AND (div = 'virs:prokaryotic viruses') = (seq_id % 2 = 1))) OVER (PARTITION BY seq_id, lp) AS ok FROM y)
SELECT seq_id, pos, len FROM z WHERE ok""")(lambda s, d: act.hosted_integrants(rows(s, d).select("seq_id", (F.col("at") * 100).alias("pos"), (100 - (F.col("len") < 8).cast("int")).alias("len"), F.when(F.col("pct") > 40, "primary").when(F.col("label") == "contaminant", "contaminant").otherwise("grey").alias("label"), F.when(F.col("pct") > 40, F.when(F.col("seq_id") % 2 == 0, "anml:insects").otherwise("prok:firmicutes")).when(F.col("seq_id") % 3 == 0, "virs:prokaryotic viruses").otherwise("virs:eukaryotic viruses").alias("div"), F.when(F.col("at") == 2, "Wolbachia").otherwise("x").alias("tax_name"))).select("seq_id", "pos", "len"))
query("endosymbiont_chimeras", f"WITH {ROWS}, {CHROWS}, f AS (SELECT seq_id, label = 'contaminant' AND tax_name LIKE 'Wolb%' AS g, label = 'primary' AND div = 'anml:insects' AS h FROM c) SELECT seq_id FROM f GROUP BY seq_id HAVING bool_and(g OR h) AND bool_or(g) AND bool_or(h)")(lambda s, d: act.endosymbiont_chimeras(rows(s, d).filter("label <> 'grey'").select("seq_id", "label", F.when(F.col("seq_id") % 3 == 0, "anml:insects").otherwise(F.col("div")).alias("div"), F.when((F.col("label") == "contaminant") & (F.col("seq_id") % 5 < 4), "Wolbachia sp.").otherwise("other").alias("tax_name")), ["anml:insects", "anml:nematodes"]))


def placed(s, d):
    w = Window.partitionBy("seq_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    return act.spans(rows(s, d)).withColumn("pos", F.coalesce(F.sum("len").over(w), F.lit(0)) + 1).select("seq_id", "pos", "len", F.col("span_label").alias("label"))


query("trim_ends")(lambda s, d: act.trim_ends(placed(s, d), good_len=60, good_abs=15))


def _edits(s, d):
    p = probes(s, d).select(F.col("oid").cast("string").alias("seq_id"), "seq")
    k = F.col("seq_id").cast("long")
    row = lambda a, n, act_: p.select("seq_id", F.lit(a).cast("long").alias("pos"), F.lit(n).cast("long").alias("len"), act_.alias("action"))
    a = row(1, 7, F.when(k % 3 == 0, "TRIM").otherwise("INFO")).unionByName(row(20, 5, F.when(k % 2 == 0, "FIX").otherwise("REVIEW"))).unionByName(row(40, 10, F.when(k % 5 == 0, "ACTION_TRIM").otherwise("INFO")))
    return act.apply_actions(p, a, 30)


query("apply_actions", f"""WITH {QRY}, e AS (SELECT oid, seq, CASE WHEN oid % 2 = 0 THEN substring(seq, 1, 19) || repeat('N', 5) || substring(seq, 25) ELSE seq END AS f FROM qry),
p AS (SELECT oid, false AS piece, 1 AS a, length(seq) AS b, f FROM e WHERE oid % 5 > 0 UNION ALL SELECT oid, true, 1, 39, f FROM e WHERE oid % 5 = 0 UNION ALL SELECT oid, true, 50, length(seq), f FROM e WHERE oid % 5 = 0),
o AS (SELECT oid, piece, a, b, CASE WHEN oid % 3 = 0 AND a = 1 THEN substring(f, 8, b - 7) ELSE substring(f, a, b - a + 1) END AS seq FROM p)
SELECT CASE WHEN piece THEN oid || '~' || a || '..' || b ELSE CAST(oid AS VARCHAR) END AS id, seq FROM o WHERE CASE WHEN piece THEN length(seq) > 30 ELSE length(seq) >= 30 END""")(_edits)


def _decide(s, d):
    sp = act.spans(rows(s, d).filter("label <> 'grey'"))
    w = Window.partitionBy("seq_id").orderBy("span")
    sp = sp.withColumn("pos", F.coalesce(F.sum("len").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + 1)
    seqs = sp.groupBy("seq_id").agg(F.sum("len").alias("seq_len"))
    return act.decide(sp.select("seq_id", "pos", "len", F.col("span_label").alias("label"), F.lit(50).alias("pct"), (F.col("seq_id") % 2 == 0).alias("same_kingdom")), seqs, short=100, least=20)


query("decide_actions")(_decide)

# ---- sketches and selection ---------------------------------------------------------------------------------------------
sigs = lambda s, d: sketch.signatures(table(s, d, "benchmark").select(F.col("item_id").alias("id"), "text"))


def _greedy(s, d):
    c = cust(s, d).select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("grp"), F.col("c_acctbal").alias("preference"))
    # neighbours: two of a group whose ids sum to a multiple of seven
    m = c.select("grp").distinct().crossJoin(s.range(7).select(F.col("id").alias("a"), F.pmod(-F.col("id"), F.lit(7)).alias("b")))
    return select.greedy_of_classes(c.withColumn("class", F.pmod("id", F.lit(7))), m, "grp")


query("select_greedy")(_greedy)
query("group_median", "SELECT l_returnflag, count(*) AS n, count(DISTINCT l_partkey) AS n_unique, CAST(sum(l_partkey) AS BIGINT) AS total, median(l_partkey) AS median FROM lineitem GROUP BY ALL")(lambda s, d: select.group_summary(li(s, d), "l_returnflag", "l_partkey"))
query("load_dict", "SELECT o_custkey, min(o_orderpriority) AS o_orderpriority, count(DISTINCT o_orderpriority) > 1 AS conflict FROM orders GROUP BY ALL")(lambda s, d: select.load_dict(orders(s, d), "o_custkey", "o_orderpriority"))
query("longest_per_symbol", "WITH e AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_quantity, lag(l_returnflag) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) IS DISTINCT FROM l_returnflag AS b FROM lineitem), f AS (SELECT *, sum(CAST(b AS INTEGER)) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS g FROM e) SELECT l_orderkey, l_linenumber FROM f QUALIFY row_number() OVER (PARTITION BY l_orderkey, g ORDER BY l_quantity DESC, l_linenumber, l_partkey, l_suppkey, l_quantity) = 1")(lambda s, d: sketch.longest_per_symbol(li(s, d), KEY, ORD, "l_returnflag", "l_quantity").select("l_orderkey", "l_linenumber"))
query("sync_status", "WITH m AS (SELECT item_id AS path, length(text) AS size, md5(text) AS digest FROM benchmark WHERE item_id % 4 > 0), f AS (SELECT item_id AS path, length(text) + CASE WHEN item_id % 6 = 1 THEN 1 ELSE 0 END AS size, CASE WHEN item_id % 10 = 3 THEN 'x' ELSE md5(text) END AS digest FROM benchmark WHERE item_id % 5 > 0) SELECT coalesce(m.path, f.path) AS path, CASE WHEN f.size IS NULL THEN 'missing' WHEN m.size IS NULL THEN 'extra' WHEN m.size <> f.size THEN 'size' WHEN m.digest <> f.digest THEN 'checksum' ELSE 'up-to-date' END AS status FROM m FULL JOIN f ON m.path = f.path")(
    lambda s, d: (lambda b: select.sync_status(b.filter("path % 4 > 0").select("path", "size", "digest"), b.filter("path % 5 > 0").select("path", (F.col("size") + (F.col("path") % 6 == 1).cast("int")).alias("size"), F.when(F.col("path") % 10 == 3, "x").otherwise(F.col("digest")).alias("digest"))))(table(s, d, "benchmark").select(F.col("item_id").alias("path"), F.length("text").alias("size"), F.md5("text").alias("digest"))))


ASM = {"accept": "c_custkey % 19 = 3", "refuse": "c_custkey % 17 = 5", "curated_id": "CASE WHEN c_custkey % 3 = 0 THEN 'x' ELSE '' END", "category": "CASE c_mktsegment WHEN 'BUILDING' THEN 'reference genome' WHEN 'MACHINERY' THEN 'representative genome' ELSE 'na' END", "div": "CASE c_nationkey % 4 WHEN 0 THEN 'fung:fungi' WHEN 1 THEN 'virs:viruses' WHEN 2 THEN 'anml:birds' ELSE 'prok:firmicutes' END", "ftp_path": "CASE WHEN c_custkey % 23 = 0 THEN '' ELSE 'p' END", "len": "c_custkey * 20000000", "n50": "c_custkey % 30 * 1000", "screened": "c_custkey % 7 > 0"}
WEIGHT = "CASE WHEN refuse THEN -1 WHEN accept THEN 10 WHEN curated_id <> '' THEN CASE category WHEN 'reference genome' THEN 7 WHEN 'representative genome' THEN 6 ELSE 5 END WHEN div = 'fung:fungi' OR div = 'virs:viruses' AND c_custkey % 2 = 0 OR div = 'prok:firmicutes' AND c_custkey % 2 = 1 THEN CASE category WHEN 'reference genome' THEN 4 WHEN 'representative genome' THEN 3 ELSE 2 END WHEN category <> 'na' THEN 1 ELSE 0 END"
query("assembly_status", f"WITH a AS (SELECT c_custkey, {', '.join(f'{v} AS {k}' for k, v in ASM.items())} FROM customer), w AS (SELECT *, {WEIGHT} AS weight FROM a) SELECT c_custkey, weight, CASE WHEN ftp_path = '' THEN 'not-in-scope' WHEN accept THEN 'ok-acceptlist' WHEN refuse THEN 'denylist' WHEN category = 'reference genome' THEN 'ok-reference' WHEN weight < 2 THEN 'not-in-scope' WHEN len > 4300000000 THEN 'too-large' WHEN NOT (n50 = len OR n50 > 20000 OR (curated_id <> '' AND n50 > 10000) OR div LIKE 'virs%') THEN 'low-n50' WHEN NOT screened THEN 'not-prescreened' ELSE 'ok' END AS status FROM w")(lambda s, d: select.assembly_status(select.assembly_weight(cust(s, d).select("c_custkey", *(F.expr(v).alias(k) for k, v in ASM.items())).withColumn("excluded", F.expr("CASE WHEN c_custkey % 2 = 1 THEN array('derived from metagenome') ELSE cast(array() AS array<string>) END")))).select("c_custkey", "weight", "status"))
query("hit_rows", f"WITH {NSQL.replace('r AS (', 'nr AS (')}, {QRY} SELECT CAST(oid AS VARCHAR) AS q_id, CAST(pos AS INTEGER) AS q_pos, 0 AS tax_id, '_N_run' AS s_id, 1 AS s_pos, CAST(len AS INTEGER) AS len, 0 AS l2, 0 AS mismatches FROM nr UNION ALL SELECT CAST(oid AS VARCHAR), 1, 0, '_self', 1, length(seq), length(seq), length(seq) - length(replace(seq, 'N', '')) FROM t")(lambda s, d: (lambda t, z: sinks.hit_rows(s.createDataFrame([], sinks.HITS), t.select(F.col("oid").cast("string").alias("q_id"), "seq"), words.n_runs(t, 2).select(F.col("oid").cast("string").alias("q_id"), "pos", "len"), z, z))(_ntext(s, d), s.createDataFrame([], "q_id string, pos long, len long")))


# ---- flagship -----------------------------------------------------------------------------------------------------------
FLAG = f"WITH {IDX}, {QW}, {SEG}, pr AS (SELECT q_oid, s_oid, sum(len) AS len, count(*) AS segments FROM seg GROUP BY ALL), c AS (SELECT pr.*, least(1.0, len / length(seq)) AS share FROM pr JOIN qry ON q_oid = qry.oid) SELECT q_oid, s_oid, segments, CAST(len AS BIGINT) AS len, round(share, 4) AS share, CASE WHEN share >= 0.8 THEN 'contained' WHEN share >= 0.3 THEN 'partial' ELSE 'trace' END AS verdict, row_number() OVER (PARTITION BY q_oid ORDER BY len DESC, s_oid) AS rank FROM c QUALIFY rank <= 5"


@query("flagship", FLAG)
def flagship(s, d):
    """Which documents contain which benchmark passages, how much of each, and the verdict."""
    seg = words.coalesce(seeds(s, d)).groupBy("q_oid", "s_oid").agg(F.sum("len").alias("len"), F.count("*").alias("segments"))
    c = seg.join(probes(s, d).select(F.col("oid").alias("q_oid"), F.length("seq").alias("n")), "q_oid").withColumn("share", F.least(F.lit(1.0), F.col("len") / F.col("n")))
    verdict = F.when(F.col("share") >= 0.8, "contained").when(F.col("share") >= 0.3, "partial").otherwise("trace")
    w = Window.partitionBy("q_oid").orderBy(F.desc("len"), "s_oid")
    return c.select("q_oid", "s_oid", "segments", "len", F.round("share", 4).alias("share"), verdict.alias("verdict"), F.row_number().over(w).cast("long").alias("rank")).filter("rank <= 5")


for _name in ("spans", "low_cov_promote", "review_needs_exclude", "integrants", "seq_stats", "div_stats", "production_limits", "summary_rollup", "hosted_integrants"):
    SQL[_name] = re.sub(r"(?<![\w\"])at\b", '"at"', SQL[_name])  # a word of SQL

from . import builds, cascades, chimeras, classes, files, flow, hot, islands, reports, screens, selected, store, stretches  # noqa: E402

for _module in (builds, cascades, chimeras, classes, files, flow, hot, islands, reports, screens, selected, store, stretches):
    _module.register(query)

_rec = f"""rec AS (SELECT CAST(t4.q_id AS VARCHAR) AS seq_id, any_value(wh.n) AS len, t4.q_id % 50 AS xp, t4.q_id % 30 AS lc, 0 AS co, 0 AS n,
 CAST(any_value(ac.cvg) AS BIGINT) AS cvg_by_all, list({{'tax_id': tax_id, 'div': {DIVSQL.replace("div ", "t4.div ", 1)}, 'cvg_by_div': CAST(dc.cvg AS BIGINT),
 'cvg_by_tax': CAST(cvg_by_tax AS BIGINT), 'score': CAST(floor(score + 0.5) AS BIGINT)}} ORDER BY rank) AS taxa
 FROM t4 JOIN dc ON t4.q_id = dc.q_id AND t4.div = dc.div JOIN ac ON t4.q_id = ac.q_id JOIN wh ON wh.q_id = t4.q_id GROUP BY t4.q_id)"""
SQL["classify_rows"] = (
    f"WITH {NODES}, {TOP}, {DIVR}, {_rec}, c AS ({classes._classes('x', ['anml:mammals'], ['prok:firmicutes', 'fung:fungi'], False, 0.001)}) "
    "SELECT CAST(seq_id AS BIGINT) AS seq_id, result, result_div FROM c"
)
