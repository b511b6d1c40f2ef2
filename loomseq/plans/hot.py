"""Queries of the hot list over seeds made of events, as a stream and as a table, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..adapters import fresh, table
from ..streaming import hotlist
from .flow import _finished

#: Events as seeds: users are queries, minutes are places on them.
SEEDS = """seeds AS (SELECT user_id AS q_oid, ascii(event_type) % 2 AS s_oid, m * 8 AS q, m * 8 + CASE WHEN event_id % 3 = 0 THEN event_id % 7 * 2600 ELSE event_id % 11 * 1700 END AS s,
  CAST(20 + event_id % 5 * 3000 AS BIGINT) AS len FROM (SELECT *, CAST(floor((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / 60000000.0) AS BIGINT) AS m FROM events))"""
_NEAR = f"abs(p.d - x.d) <= {hotlist.DIAG} AND p.a + 2 * p.len + {hotlist.ANTI} >= x.a AND p.q <> x.q"
HOT = f"""WITH {SEEDS}, r0 AS (SELECT *, s - q AS d, s + q AS a, CAST(floor((s - q) / {hotlist.DIAG}) AS BIGINT) AS band, CAST(floor((s - q + {hotlist.DIAG // 2}) / {hotlist.DIAG}) AS BIGINT) AS up FROM seeds),
r1 AS (SELECT *, row_number() OVER w AS k, CASE WHEN lag(d) OVER w = d AND lag(q + len) OVER w + {hotlist.GAP} >= q THEN 0 ELSE 1 END AS start FROM r0 WINDOW w AS (PARTITION BY q_oid, s_oid, band ORDER BY q, s, len)),
r2 AS (SELECT *, sum(start) OVER (PARTITION BY q_oid, s_oid, band ORDER BY k) AS i FROM r1),
r3 AS MATERIALIZED (SELECT *, first_value(q) OVER v AS q0, first_value(a) OVER v AS a0, first_value(len) OVER v AS len0, row_number() OVER v AS j FROM r2 WINDOW v AS (PARTITION BY q_oid, s_oid, band, i ORDER BY k)),
sg AS (SELECT q_oid, s_oid, band, i, min(q0) AS q, min(a0) AS a, min(d) AS d, max_by(q + len, k) - min(q0) AS len, count(*) AS n, min(up) FILTER (j = 1) AS up, min(s) FILTER (j = 1) AS s, min(len0) AS len0 FROM r3 GROUP BY ALL),
g2 AS (SELECT x.*, coalesce({_NEAR}, false) AS met FROM sg x LEFT JOIN sg p ON p.q_oid = x.q_oid AND p.s_oid = x.s_oid AND p.band = x.band AND p.i = x.i - 1),
res AS (SELECT x.q_oid, x.s_oid, x.band, x.i, x.up, max(ROW(r.q, r.s, r.len, r.k)) AS t FROM g2 x JOIN r3 r ON NOT x.met AND x.up <> x.band AND r.q_oid = x.q_oid AND r.s_oid = x.s_oid AND r.band = x.up AND ROW(r.q, r.s, r.len) < ROW(x.q, x.s, x.len0) GROUP BY ALL),
fnd AS (SELECT x.q_oid, x.s_oid, x.band, x.i, z.band AS pband, z.i AS pi FROM res e JOIN g2 x ON x.q_oid = e.q_oid AND x.s_oid = e.s_oid AND x.band = e.band AND x.i = e.i
  JOIN r3 z ON z.q_oid = e.q_oid AND z.s_oid = e.s_oid AND z.band = e.up AND z.k = e.t[4]
  WHERE abs(z.d - x.d) <= {hotlist.DIAG} AND z.a0 + 2 * (z.q + z.len - z.q0) + {hotlist.ANTI} >= x.a AND z.q0 <> x.q),
mk AS (SELECT q_oid, s_oid, band, i FROM fnd UNION SELECT q_oid, s_oid, pband, pi FROM fnd),
ld AS (SELECT *, lead(met) OVER v AS next_met, lead(q) OVER v AS next_q FROM g2 WINDOW v AS (PARTITION BY q_oid, s_oid, band ORDER BY i))
SELECT q_oid, CAST(s_oid AS BIGINT) AS s_oid, q, q + d AS s, len FROM ld x WHERE n > 1 OR met OR coalesce(next_met, false) OR coalesce(q + {hotlist.ANTI // 2} >= next_q, false)
  OR EXISTS (SELECT 1 FROM mk WHERE mk.q_oid = x.q_oid AND mk.s_oid = x.s_oid AND mk.band = x.band AND mk.i = x.i)"""


def seeds(s, d):
    us = lambda c: F.unix_micros(c.cast("timestamp"))
    zero = F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00"))
    e = table(s, d, "events").withColumn("m", F.floor((us(F.col("ts")) - us(zero)) / F.lit(60_000_000)).cast("long"))
    at = F.col("m") * 8
    lag = F.when(F.col("event_id") % 3 == 0, F.col("event_id") % 7 * 2600).otherwise(F.col("event_id") % 11 * 1700)
    return e.select(F.col("user_id").alias("q_oid"), (F.ascii("event_type") % 2).cast("long").alias("s_oid"), at.alias("q"), (at + lag).alias("s"), (20 + F.col("event_id") % 5 * 3000).cast("long").alias("len"), F.col("ts").cast("timestamp").alias("ts"))


def in_order(s, rows, rows_each: int = 2_000_000) -> tuple[str, int]:
    """A folder of files in order of time, as a stream would leave them, four stretches of as many files each; and one more row that ends
    all queries. Also the number of files of a stretch: more rows make more files, not more batches, each of which touches most queries."""
    path = fresh(s, "seeds")
    cuts = [None, *rows.selectExpr(*(f"percentile_approx(ts, {k / 4}) as c{k}" for k in range(1, 4))).first(), None]
    inside = [F.coalesce((F.lit(True) if lo is None else F.col("ts") >= F.lit(lo)) & (F.lit(True) if hi is None else F.col("ts") < F.lit(hi)), F.lit(False)) for lo, hi in zip(cuts, cuts[1:], strict=False)]
    counts = rows.agg(*(F.count_if(x).alias(f"n{k}") for k, x in enumerate(inside))).first()
    files = max(1, -(-min(counts) // rows_each))  # so that no file of the smallest stretch is empty
    for x in inside:
        rows.filter(x).repartition(files).write.mode("append").parquet(path)
    end = rows.agg((F.max("ts") + F.expr("INTERVAL 10 YEARS")).alias("ts")).filter("ts is not null")
    nothing = F.lit(None).cast("long")
    end.select(nothing.alias("q_oid"), nothing.alias("s_oid"), nothing.alias("q"), nothing.alias("s"), nothing.alias("len"), "ts").write.mode("append").parquet(path)
    return path, files


def streamed(s, rows, most: int = hotlist.MOST, rows_each: int = 2_000_000):
    """hot_list over the rows as a stream, one stretch of in_order for each batch."""
    (path, files), out = in_order(s, rows, rows_each), fresh(s, "hot")
    stream = s.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(path)
    _finished(hotlist.hot_list(stream, most, idle="400 days").writeStream.outputMode("append").format("parquet").option("path", out), s)
    return s.read.schema(hotlist.SCHEMA).parquet(out)


def register(query) -> None:
    query("stream_hot_list", HOT)(lambda s, d: streamed(s, seeds(s, d)))
    query("hot_list", HOT)(lambda s, d: hotlist.hot_list_table(seeds(s, d)))
