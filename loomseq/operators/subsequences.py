"""All maximal scoring stretches of ordered scores, for keys of any length.

A stretch is maximal when every shorter one inside it scores less and no longer one has that property. One pass finds them with a list of
candidates: a new one looks for the last candidate that begins at a lower running sum, and if that one also ends lower, both and all
between become one. The list of one chunk can be summed up for its neighbours: only candidates that begin lower than all before
them can be joined by what comes earlier, and only those that begin lower than all after them by what comes later. So rows are
range-partitioned by key and position, every partition makes its own list, summaries of neighbouring partitions are merged FAN at
a time until one is left, and what became one across partitions replaces its pieces. At most one final stretch crosses a border.

Scores are whole numbers; positions are unique within a key.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..adapters import settled

FAN = 64


class Candidates:
    """[first, last, sum before, sum after, first part, last part] in order, each with the last one before it that begins lower."""

    def __init__(self):
        self.items: list[list] = []
        self.lower: list[int] = []

    def push(self, item: list) -> None:
        j = len(self.items) - 1
        while True:
            while j >= 0 and self.items[j][2] >= item[2]:
                j = self.lower[j]
            if j < 0 or self.items[j][3] >= item[3]:
                self.items.append(item)
                self.lower.append(j)
                return
            other = self.items[j]
            item = [other[0], item[1], other[2], item[3], other[4], item[5]]
            below = self.lower[j]
            del self.items[j:], self.lower[j:]
            j = below

    def open_ends(self) -> list[list]:
        """Those that may still grow at either side."""
        use, least = set(), None
        for k, x in enumerate(self.items):
            if least is None or x[2] <= least:
                use.add(k)
                least = x[2]
        j = len(self.items) - 1
        while j >= 0:
            use.add(j)
            j = self.lower[j]
        return [self.items[k] for k in sorted(use)]


def _runs(pos: np.ndarray, score: np.ndarray, total: int):
    """Runs of positive scores as candidates."""
    after = total + np.cumsum(score)
    good = np.concatenate([[False], score > 0, [False]])
    edge = np.flatnonzero(good[1:] != good[:-1])
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        yield int(pos[a]), int(pos[b - 1]), int(after[a] - score[a]), int(after[b - 1])


LIST = "key {0}, part int, kind string, first long, last long, before long, after long, part_1 int, part_2 int, n int, total long"
NAMES = [x.split()[0] for x in LIST.split(", ")]


def _rows(key, part, kind, items, total):
    # n: the place in the list
    return pd.DataFrame([(key, part, kind, *x, k, total) for k, x in enumerate(items)], columns=NAMES).astype({"first": "Int64", "last": "Int64"})


def _part_lists(parts):
    """For each key of a partition its candidates, and a summary (kind end) that also holds where no score is positive."""
    from pyspark import TaskContext

    part, key, now, total = TaskContext.get().partitionId(), None, None, 0

    def done():
        if now.items:
            yield _rows(key, part, "item", now.items, total)
        ends = now.open_ends() or [[None, None, 0, 0, part, part]]
        yield _rows(key, part, "end", ends, total)

    for pdf in parts:
        k = pdf["key"].to_numpy()
        edge = [0, *(np.flatnonzero(k[1:] != k[:-1]) + 1).tolist(), len(k)]
        pos, score = pdf["pos"].to_numpy(), pdf["score"].to_numpy()
        for a, b in zip(edge, edge[1:], strict=False):
            if a == b:
                continue
            if now is None or k[a] != key:
                if now is not None:
                    yield from done()
                key, now, total = k[a], Candidates(), 0
            for first, last, before, after in _runs(pos[a:b], score[a:b], total):
                now.push([first, last, before, after, part, part])
            total += int(score[a:b].sum())
    if now is not None:
        yield from done()


def _merged(pdf: pd.DataFrame) -> pd.DataFrame:
    """Neighbouring summaries of one key: their own summary, and what crosses borders (kind over)."""
    pdf, now, total, at = pdf.sort_values(["part", "n"]), Candidates(), 0, None
    step = 0
    for part, first, last, before, after, p1, p2, whole in zip(*(pdf[c].tolist() for c in ("part", "first", "last", "before", "after", "part_1", "part_2", "total")), strict=True):
        if part != at:
            total, step, at = total + step, whole, part
        if not pd.isna(first):
            now.push([int(first), int(last), before + total, after + total, p1, p2])
    key, part = pdf["key"].iloc[0], int(pdf["part"].min())
    ends = now.open_ends() or [[None, None, 0, 0, part, part]]
    return pd.concat([_rows(key, part, "end", ends, total + step), _rows(key, part, "over", [x for x in now.items if x[4] != x[5]], 0)])


def maximal_stretches(df: DataFrame, key: str, pos: str, score: str, fan: int = FAN, parts: int | None = None) -> DataFrame:
    """(key, first, last, score): the first and last position of each maximal stretch, and what it scores. Null scores count as 0."""
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = LIST.format(df.schema[key].dataType.simpleString())
    rows = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(pos).cast("long").alias("pos"), F.coalesce(F.col(score).cast("long"), F.lit(0)).alias("score"))
    lists = settled(rows.repartitionByRange(parts, "key", "pos").sortWithinPartitions("key", "pos").mapInPandas(_part_lists, schema))
    items, ends = lists.filter("kind = 'item'"), lists.filter("kind = 'end'")
    several = ends.groupBy("key").agg(F.count_distinct("part").alias("parts")).filter("parts > 1").select("key")
    ends, over, width = ends.join(several, "key", "left_semi"), None, 1
    while width < parts:
        width *= fan
        both = settled(ends.groupBy("key", F.floor(F.col("part") / width).alias("group")).applyInPandas(_merged, schema))
        ends, more = both.filter("kind = 'end'"), both.filter("kind = 'over'")
        over = more if over is None else over.unionAll(more)
    out = F.col("after") - F.col("before")
    if over is None:
        return items.select(F.col("key").alias(key), "first", "last", out.alias("score"))
    # of what crosses a border, the longest is what is left there
    border = over.select("key", "first", "last", out.alias("score"), F.explode(F.sequence("part_1", F.col("part_2") - 1)).alias("border"))
    border = settled(border.groupBy("key", "border").agg(F.max_by(F.struct("first", "last", "score"), F.col("last") - F.col("first")).alias("x")).select("key", "border", "x.*"))
    left = border.select("key", (F.col("border") + 1).alias("part"), F.col("last").alias("until"))
    right = border.select("key", F.col("border").alias("part"), F.col("first").alias("since"))
    own = items.join(left, ["key", "part"], "left").join(right, ["key", "part"], "left")
    own = own.filter("(until is null or last > until) and (since is null or first < since)")
    return own.select("key", "first", "last", out.alias("score")).unionAll(border.select("key", "first", "last", "score").distinct()).withColumnRenamed("key", key)
