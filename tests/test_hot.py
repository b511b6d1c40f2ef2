"""The hot list: stream, table and a plain list of seeds give the same; what a short list loses."""

import datetime

import numpy as np

from loomseq.plans import hot
from loomseq.streaming import hotlist as H

SCHEMA = "q_oid long, s_oid long, q long, s long, len long, ts timestamp"
ZERO = datetime.datetime(2024, 1, 1)


def made(n, seed, spread):
    rng = np.random.default_rng(seed)
    out = []
    for q_oid in (1, 2):
        q = np.sort(rng.integers(0, spread, n))
        d = rng.choice([0, 0, 0, 2499, 2500, 4999, 5001, -1, -2600, 40_000, 90_000, 200_000], n)
        out += [(q_oid, int(rng.integers(2)), int(a), int(a + b), int(rng.choice([20, 20, 3000])), ZERO + datetime.timedelta(seconds=int(a))) for a, b in zip(q, d, strict=True)]
    return out


def plain(rows, most=None):
    """The list kept by hand: order of touch in a list, segments in a dictionary."""
    out, lost = [], 0
    for key in sorted({r[:2] for r in rows}):
        held, touched = {}, []
        go = lambda x, q: out.append((*key, x["q"], x["s"], x["n"])) if x["keep"] or x["q"] + H.ANTI // 2 >= q else None  # noqa: E731, B023
        for q, s, n in sorted(r[2:5] for r in rows if r[:2] == key):
            d = s - q
            band, p = d // H.DIAG, held.get(d // H.DIAG)
            if p and p["s"] - p["q"] == d and p["q"] + p["n"] + H.GAP >= q:
                p["n"], p["keep"] = q + n - p["q"], True
            else:
                new = {"q": q, "s": s, "n": n, "keep": False}
                ok = lambda x: x and abs(x["s"] - x["q"] - d) <= H.DIAG and x["s"] + x["q"] + 2 * x["n"] + H.ANTI >= s + q and x["q"] != q  # noqa: E731, B023
                for x in (p, held.get((d + H.DIAG // 2) // H.DIAG)):
                    if ok(x):
                        x["keep"] = new["keep"] = True
                        break
                if p:
                    go(p, q)
                held[band] = new
            touched = [b for b in touched if b != band] + [band]
            if most and len(held) > most:
                lost += 1
                go(held.pop(touched.pop(0)), q)
        out += [(*key, x["q"], x["s"], x["n"]) for x in held.values() if x["keep"]]
    return sorted(out), lost


def found(df):
    return sorted(map(tuple, df.select("q_oid", "s_oid", "q", "s", "len").collect()))


def test_stream_is_table_where_nothing_leaves(spark):
    rows = made(120, 1, 400_000)
    df = spark.createDataFrame(rows, SCHEMA)
    want, _ = plain(rows)
    assert found(H.hot_list_table(df)) == want and found(hot.streamed(spark, df)) == want
    alone = len({r[:5] for r in rows}) - len(want)
    assert alone > 10 and any(w[4] not in (20, 3000) for w in want)


def test_what_a_short_list_loses(spark):
    rows = made(150, 2, 900_000)
    df = spark.createDataFrame(rows, SCHEMA)
    whole, _ = plain(rows)
    want, left = plain(rows, 2)
    got = found(hot.streamed(spark, df, 2))
    assert got == want and left > 20
    assert set(whole) - set(got)  # keepers whose neighbour had left, and longer segments that came in pieces
    covered = lambda x, ys: any(y[:2] == x[:2] and y[3] - y[2] == x[3] - x[2] and y[2] <= x[2] and x[2] + x[4] <= y[2] + y[4] for y in ys)
    assert sum(covered(x, got) for x in whole) >= len(whole) / 2


def test_no_seeds(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert H.hot_list_table(df).count() == 0


def test_lists_survive_packing():
    b, out = H.Bands(), []
    for q, s in ((0, 0), (5, 9000), (7, -9000), (9, 9)):
        b.push(q, s, 20, 3, out)
    assert list(H.Bands.of(b.packed()).items()) == list(b.items()) and list(b) == [1, -2, 0]


def test_more_rows_make_more_files_not_more_batches(spark):
    rows = made(160, 3, 400_000)
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    path, files = hot.in_order(spark, df, 10)
    assert files > 1 and len(spark.read.parquet(path).inputFiles()) == 4 * files + 1
    assert found(hot.streamed(spark, df, rows_each=10)) == plain(rows)[0]


def test_queries_share_rows_of_state(spark):
    big = 2**60 + 1
    rows = [(big + 2 * k + r[0], *r[1:]) for k in range(12) for r in made(30, 10 + k, 400_000)]
    alone = [(None if r[0] == big + 1 else r[0], *r[1:]) for r in rows]
    path, files = hot.in_order(spark, spark.createDataFrame(alone, SCHEMA))
    stream, out = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files).parquet(path), hot.fresh(spark, "hot")
    writer = H.hot_list(stream, idle="400 days", lists=4).writeStream.option("checkpointLocation", hot.fresh(spark, "state")).option("path", out)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    got = sorted((big + 1 if r[0] is None else r[0], *r[1:]) for r in map(tuple, spark.read.parquet(out).select("q_oid", "s_oid", "q", "s", "len").collect()))
    assert got == plain(rows)[0] and len({r[:2] for r in rows}) > 40
    assert 0 < max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]) <= 4


def test_each_query_of_a_list_has_its_own_end():
    held, out = H.Lists(), []
    for key, until in (((1, 0), 50), ((None, 0), 90), ((0, 0), 90)):
        for q in (0, 5):
            held.of_key(*key, until).push(q, q, 20, 9, out)
    held = H.Lists.of(held.packed())
    assert list(held) == [(1, 0), (None, 0), (0, 0)] and H.Lists.of(H.Lists().packed()) == {}
    held.close(50, out)
    assert len(held) == 3 and not out
    held.close(51, out)
    assert list(held) == [(None, 0), (0, 0)] and out == [(1, 0, 0, 0, 25)]
