"""Helpers shared by the training-data operators.

Tables that cut lineage are Parquet folders under ``spark.checkpoint.dir``; a private folder is used only where that
setting is absent (tests). Worker-side caches live in ``cache()`` so that they survive from task to task.
"""

from __future__ import annotations

import atexit
import gc
import os
import shutil
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_written: dict[str, list[str]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        top = getattr(sys, "_loomseq_work", None)
        if top is None:
            top = sys._loomseq_work = tempfile.mkdtemp(prefix="loomseq-")
            atexit.register(shutil.rmtree, top, True)
        top = f"file://{top}"
    return f"{top}/loomseq-{spark.sparkContext.applicationId}"


def written(df: DataFrame, name: str, tag: str = "") -> DataFrame:
    """df, written to the shared folder and read back."""
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    _written.setdefault(tag, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, tag: str) -> None:
    """Deletes the tables written under a tag; call it only when nothing reads them any more."""
    for path in _written.pop(tag, []):
        discard(spark, path)


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a folder that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def free(spark: SparkSession) -> None:
    """Lets Spark delete shuffle files of finished steps now; it does so when the driver's objects are collected."""
    gc.collect()
    spark._jvm.System.gc()


def cache(name: str, make: Callable):
    """A value made once in each Python worker process."""
    store = sys.__dict__.setdefault("_loomseq_cache", {})
    if name not in store:
        store[name] = make()
    return store[name]


class Memo(dict):
    """word -> value; make() gives what is missing. Emptied when it reaches its bound, so memory stays bounded."""

    def __init__(self, make: Callable, bound: int = 400_000):
        self.make, self.bound = make, bound

    def __missing__(self, key):
        if len(self) >= self.bound:
            self.clear()
        value = self.make(key)
        if len(key) <= 64:
            self[key] = value
        return value


def rows_of(batches: Iterator[pa.RecordBatch], bytes_at_once: int = 8 << 20, text: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about so many bytes of text each; a single longer text is a slice of its own."""
    for b in batches:
        if not b.num_rows:
            continue
        size = np.asarray(pa.compute.fill_null(pa.compute.binary_length(b.column(b.schema.get_field_index(text))), 0)).astype(np.int64)
        cut = np.cumsum(size) // bytes_at_once
        at = [0, *(np.flatnonzero(np.diff(cut)) + 1).tolist(), b.num_rows]
        for lo, hi in zip(at, at[1:], strict=False):
            if hi > lo:
                yield b.slice(lo, hi - lo)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of equal keys of a partition that is sorted by them; one run is held at a time."""
    held: list[pa.RecordBatch] = []
    now: tuple | None = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(b.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(b.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        at = [0, *np.flatnonzero(change).tolist(), b.num_rows]
        for lo, hi in zip(at, at[1:], strict=False):
            key = tuple(c[lo].item() if hasattr(c[lo], "item") else c[lo] for c in cols)
            if now is not None and key != now:
                yield now, pa.Table.from_batches(held)
                held = []
            now = key
            held.append(b.slice(lo, hi - lo))
    if held:
        yield now, pa.Table.from_batches(held)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lower_ascii(col):
    return F.translate(F.coalesce(col, F.lit("")), UPPER, LOWER)


def components(edges: DataFrame, tag: str) -> DataFrame:
    """Connected components of (a long, b long): (node, root), root the least node. Alternating large- and small-star
    rounds until each component is a star; their number is logarithmic in a component's diameter. Nothing is collected to the
    driver."""
    def both(e):
        return e.select("a", "b").unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def star(e, large):
        n = both(e) if large else e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = n.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        j = n.join(low, F.col("a") == F.col("k"))
        if large:
            out = j.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = j.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(low.select(F.col("k").alias("a"), F.col("m").alias("b")))
        return out.filter("a <> b").distinct()

    e = edges.filter("a <> b").select("a", "b").distinct()
    k = 0
    while True:
        e = written(star(star(e, True), False), f"star{k}", tag)
        k += 1
        # done when every node has one root and no root has another: then a further round changes nothing
        sides = e.select(F.col("a").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(e.select("b", F.lit(0), F.lit(1)))
        seen = sides.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if seen.filter("up > 1 or (up > 0 and down > 0)").isEmpty():
            break
    return e.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
