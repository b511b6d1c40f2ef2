"""A hot list: seeds that arrive in order of the query are held against the few that came last on the same band of diagonals, so
that lone ones go without being gathered first.

Seeds are (q_oid, s_oid, q, s, len), forward on the query. A band is DIAG diagonals wide; of each band the list holds the latest
segment. A seed on the diagonal of that segment, at most GAP after its end, makes it longer. Otherwise it is a neighbour of the
segment when that is not too far back (ANTI antidiagonals); where it is not, and the seed lies in the upper half of its band, it is
held against the next band. Neighbours and segments of several seeds are keepers. The seed then takes the segment's
place; what leaves goes out if it is a keeper or lies at most half of ANTI back on the query, and at the end keepers alone go
out.

hot_list does so on a stream, with at most `most` bands for each query and subject: when there are more, the band that was
touched longest ago leaves, and what would have met its segment later finds nothing. hot_list_table is the same for tables, with
windows, and forgets nothing.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

DIAG, ANTI, GAP, MOST, LISTS = 5000, 50_000, 10, 4096, 2048
KEY = ["q_oid", "s_oid"]
SCHEMA = "q_oid long, s_oid long, q long, s long, len long"


class Bands(dict):
    """band -> [q, s, len, keeper], the one touched longest ago first."""

    def push(self, q: int, s: int, n: int, most: int, out: list) -> None:
        d, a = s - q, s + q
        band = d // DIAG
        prev = self.pop(band, None)
        seg = [q, s, n, 0]
        if prev is not None and prev[1] - prev[0] == d and prev[0] + prev[2] + GAP >= q:
            prev[2], prev[3] = q + n - prev[0], 1
            self[band] = prev
            return
        near = lambda x: x is not None and abs(x[1] - x[0] - d) <= DIAG and x[0] + x[1] + 2 * x[2] + ANTI >= a and x[0] != q
        if near(prev):
            prev[3] = seg[3] = 1
        else:
            other = self.get((d + DIAG // 2) // DIAG)
            if near(other):
                other[3] = seg[3] = 1
        if prev is not None and (prev[3] or prev[0] + ANTI // 2 >= q):
            out.append(prev[:3])
        self[band] = seg
        if len(self) > most:
            left = self.pop(next(iter(self)))
            if left[3] or left[0] + ANTI // 2 >= q:
                out.append(left[:3])

    def packed(self) -> bytes:
        return np.array([[k, *v] for k, v in self.items()], np.int64).tobytes()

    @classmethod
    def of(cls, raw: bytes) -> Bands:
        return cls((r[0], r[1:]) for r in np.frombuffer(raw, np.int64).reshape(-1, 5).tolist())


class Lists(dict):
    """(q_oid, s_oid) -> [time when it is closed, Bands]; q_oid may be None."""

    def packed(self) -> bytes:
        heads = np.array([(q is None, q or 0, s, until, len(bands)) for (q, s), (until, bands) in self.items()], np.int64)
        return len(self).to_bytes(8, "little") + heads.tobytes() + b"".join(bands.packed() for _, bands in self.values())

    @classmethod
    def of(cls, raw: bytes) -> Lists:
        n, out = int.from_bytes(raw[:8], "little"), cls()
        at = 8 + 40 * n
        for none, q, s, until, size in np.frombuffer(raw, np.int64, 5 * n, 8).reshape(-1, 5).tolist():
            out[None if none else q, s] = [until, Bands.of(raw[at : at + 40 * size])]
            at += 40 * size
        return out

    def of_key(self, q_oid: int | None, s_oid: int, until: int) -> Bands:
        """The bands of a query and subject, which stay open until then at least."""
        held = self.setdefault((q_oid, s_oid), [until, Bands()])
        held[0] = until
        return held[1]

    def close(self, now: int, out: list) -> None:
        """Those whose time lies before now go; of their segments keepers alone go out."""
        for key in [k for k, (until, _) in self.items() if until < now]:
            out += [(*key, *v[:3]) for v in self.pop(key)[1].values() if v[3]]


def hot_list(seeds: DataFrame, most: int = MOST, idle: str = "1 hour", late: str = "1 hour", lists: int = LISTS) -> DataFrame:
    """Segments (q_oid, s_oid, q, s, len) of a stream of seeds with their time of arrival (ts). State is at most `most` segments for each
    query and subject; it is closed once nothing has come for it for so long. Rows without s_oid or a place only carry the time on. Within a batch
    seeds are put in order; over batches they have to come in it. Queries and subjects are dealt out into so many lists: a call of
    Python and a row of state serve a list, as one for each query and subject costs more than its seeds do."""
    wait = pd.Timedelta(idle) // pd.Timedelta("1ms")

    def push(rows: pd.DataFrame, held: Lists, out: list) -> None:
        rows = rows.sort_values(["none", *KEY, "q", "s", "len"])
        key = rows[["none", *KEY]].to_numpy("int64")
        at = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1).tolist(), len(rows)]
        until = np.maximum.reduceat(rows["ms"].to_numpy(), at[:-1]) + wait
        q, s, n = (rows[c].tolist() for c in ("q", "s", "len"))
        for lo, hi, end in zip(at[:-1], at[1:], until.tolist(), strict=True):
            none, q_oid, s_oid = key[lo].tolist()
            q_oid, mine = None if none else q_oid, []
            bands = held.of_key(q_oid, s_oid, end)
            for i in range(lo, hi):
                bands.push(q[i], s[i], n[i], most, mine)
            out += [(q_oid, s_oid, *x) for x in mine]

    def step(_, parts, state: GroupState):
        out: list = []
        held = Lists.of(state.get[0]) if state.exists else Lists()
        if not state.hasTimedOut and len(rows := pd.concat([x[~x["bare"]] for x in parts])):
            push(rows, held, out)
        held.close(state.getCurrentWatermarkMs(), out)
        if held:
            state.update((held.packed(),))
            state.setTimeoutTimestamp(min(until for until, _ in held.values()))
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame({c: pd.array(x, "Int64") for c, x in zip([*KEY, "q", "s", "len"], zip(*out, strict=True), strict=True)})

    whole = [F.coalesce(c, F.lit(0)).alias(c) for c in (*KEY, "q", "s", "len")]  # no nulls, which would make floats of numbers
    bare = F.greatest(*(F.col(c).isNull() for c in ("s_oid", "q", "s", "len"))).alias("bare")
    timed = seeds.withWatermark("ts", late).select(F.pmod(F.xxhash64(*KEY), F.lit(lists)).alias("list"), F.col("q_oid").isNull().alias("none"), *whole, bare, F.coalesce(F.unix_millis("ts"), F.lit(0)).alias("ms"), "ts")
    return timed.groupBy("list").applyInPandasWithState(step, SCHEMA, "bands binary", "append", GroupStateTimeout.EventTimeTimeout)


def hot_list_table(seeds: DataFrame) -> DataFrame:
    """What hot_list gives where no band leaves for want of room."""
    d, a = F.col("s") - F.col("q"), F.col("s") + F.col("q")
    rows = seeds.select(*KEY, "q", "s", "len", d.alias("d"), a.alias("a"), F.floor(d / DIAG).alias("band"), F.floor((d + DIAG // 2) / DIAG).alias("up"))
    order = ["q", "s", "len"]
    w = Window.partitionBy(*KEY, "band").orderBy(*order)
    grows = (F.lag("d").over(w) == F.col("d")) & (F.lag(F.col("q") + F.col("len")).over(w) + GAP >= F.col("q"))
    rows = rows.withColumn("start", F.coalesce(~grows, F.lit(True)))
    rows = rows.withColumn("i", F.sum(F.col("start").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("first", F.last(F.when(F.col("start"), F.struct("q", "a")), True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    segments = rows.groupBy(*KEY, "band", "i").agg(F.min("first.q").alias("q"), F.min("first.a").alias("a"), F.max(F.struct(*order)).alias("end"), F.count("*").alias("n"), F.min("d").alias("d"), F.max(F.when(F.col("start"), F.struct("up"))).alias("up"), F.min(F.when(F.col("start"), F.struct(*order))).alias("at"))
    segments = segments.withColumn("len", F.col("end.q") + F.col("end.len") - F.col("q"))
    v = Window.partitionBy(*KEY, "band").orderBy("i")
    near = lambda d, a, q, n: (F.abs(d - F.col("d")) <= DIAG) & (a + 2 * n + ANTI >= F.col("a")) & (q != F.col("q"))
    met = F.coalesce(near(*(F.lag(c).over(v) for c in ("d", "a", "q", "len"))), F.lit(False))
    segments = segments.withColumn("met", met)
    segments = segments.withColumns({"next_met": F.coalesce(F.lead("met").over(v), F.lit(False)), "next_q": F.lead("q").over(v)})
    # who is in the band above when a segment starts: the last row before it there, with its segment as long as it was then
    here = rows.select(*KEY, "band", *order, F.struct("d", F.col("first.a").alias("a"), F.col("first.q").alias("q"), (F.col("q") + F.col("len") - F.col("first.q")).alias("len"), "i").alias("seen"), F.lit(None).cast("struct<band:long,i:long,d:long,a:long,q:long>").alias("asks"))
    asks = segments.filter(~F.col("met") & (F.col("up.up") != F.col("band"))).select(*KEY, F.col("up.up").alias("band"), "at.q", "at.s", F.col("at.len").alias("len"), F.lit(None).cast(here.schema["seen"].dataType).alias("seen"), F.struct("band", "i", "d", "a", F.col("at.q").alias("q")).alias("asks"))
    u = Window.partitionBy(*KEY, "band").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    found = here.unionByName(asks).withColumn("by", F.last("seen", True).over(u)).filter("asks is not null and by is not null")
    found = found.select(*KEY, F.col("band").alias("up"), "asks.*", "by").filter((F.abs(F.col("by.d") - F.col("d")) <= DIAG) & (F.col("by.a") + 2 * F.col("by.len") + ANTI >= F.col("a")) & (F.col("by.q") != F.col("q")))
    marks = found.select(*KEY, "band", "i").unionByName(found.select(*KEY, F.col("up").alias("band"), F.col("by.i").alias("i"))).distinct().withColumn("mark", F.lit(True))
    out = segments.join(marks, [*KEY, "band", "i"], "left")
    keeper = (F.col("n") > 1) | F.col("met") | F.col("next_met") | F.col("mark").isNotNull()
    recent = F.coalesce(F.col("q") + ANTI // 2 >= F.col("next_q"), F.lit(False))
    return out.filter(keeper | recent).select(*KEY, "q", (F.col("q") + F.col("d")).alias("s"), "len")
