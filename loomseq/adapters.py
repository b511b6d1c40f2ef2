"""The driver's tables in the shapes that the domain operators take, and the same views as SQL."""

from __future__ import annotations

import atexit
import shutil
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LETTERS, BASES = "abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTAC"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def barrier(df: DataFrame) -> DataFrame:
    """The same rows; derived columns are computed here once, not again inside later expressions."""
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def work_folder(spark: SparkSession) -> str:
    """A folder that all executors share, from spark.checkpoint.dir. Only a local master may do without that setting, as in tests."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        top = getattr(sys, "_loomseq_base", None)
        if top is None:
            top = sys._loomseq_base = tempfile.mkdtemp(prefix="loomseq-")
            atexit.register(shutil.rmtree, top, True)
        top = f"file://{top}"
    return f"{top}/loomseq-{spark.sparkContext.applicationId}"


def fresh(spark: SparkSession, name: str) -> str:
    """A new path in the work folder."""
    return f"{work_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def settled(df: DataFrame) -> DataFrame:
    """The same rows, computed now and kept in the checkpoint folder that executors share; what reads them several times does not
    compute them again."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(work_folder(df.sparkSession))
    return df.checkpoint()


def dealt(df: DataFrame, *by: str) -> DataFrame:
    """Rows dealt out by columns to spark.sql.shuffle.partitions tasks, however few bytes they have: for steps whose work is in
    Python, where rows of few bytes would otherwise end up in one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def among(df: DataFrame, keys: DataFrame, by: str, few: int = 500_000) -> DataFrame:
    """Rows of df whose column ``by`` is among the keys (a frame of that column). Up to so many different keys are sent to every task, so that
    df is not dealt out; more are joined by a shuffle."""
    keys = settled(keys.select(by).distinct())
    return df.join(keys.hint("broadcast" if keys.count() <= few else "merge"), by, "left_semi")


def bases(col):
    return F.translate(F.lower(F.regexp_replace(col, "[^A-Za-z]", "")), LETTERS, BASES)


_UPPER = LETTERS.upper().encode() + LETTERS.encode()
_TO, _GONE = bytes.maketrans(_UPPER, 2 * BASES.encode()), bytes(c for c in range(256) if c not in _UPPER)


def bases_of(text: bytes) -> bytes:
    """Bases of a text's bytes, as bases() makes them."""
    return text.translate(_TO, _GONE)


def portions(batches: Iterable[pa.RecordBatch], column: str, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Slices of batches that hold at most so many bytes of a column of texts, or one row."""
    for b in batches:
        n = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False)
        end, lo = np.cumsum(n, dtype=np.int64), 0
        while lo < len(n):
            hi = max(lo + 1, int(np.searchsorted(end, end[lo] - n[lo] + most, "right")))
            yield b.slice(lo, hi - lo)
            lo = hi


def sequences(texts: DataFrame, read: Callable[[bytes], bytes] = bases_of, column: str = "text") -> DataFrame:
    """(oid, seq, ...) of (oid, text, ...): what read makes of texts, by one pass over a text's bytes."""
    names = [c for c in texts.columns if c not in ("oid", column)]

    def run(batches):
        for b in portions(batches, column):
            seq = [None if x is None else read(x) for x in b.column(column).cast(pa.binary()).to_pylist()]
            yield pa.record_batch([b.column("oid"), pa.array(seq, pa.binary()).cast(pa.string()), *map(b.column, names)], names=["oid", "seq", *names])

    kind = lambda c: f"{c} {texts.schema[c].dataType.simpleString()}"
    return texts.mapInArrow(run, ", ".join([kind("oid"), "seq string", *map(kind, names)]))


def texts(spark, sf_dir) -> DataFrame:
    """(oid, seq, tax_id) of the subjects, with their whole texts; bases_of makes the sequence of one."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("oid"), F.col("text").alias("seq"), (F.regexp_extract("source", "([0-9]+)", 1).cast("int") + 1).alias("tax_id"))


def subjects(spark, sf_dir) -> DataFrame:
    return sequences(texts(spark, sf_dir), bases_of, "seq")


def taxa(spark, sf_dir) -> DataFrame:
    """(oid, tax_id) of the subjects, without reading their texts."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("oid"), (F.regexp_extract("source", "([0-9]+)", 1).cast("int") + 1).alias("tax_id"))


def probes(spark, sf_dir) -> DataFrame:
    return sequences(table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("oid"), "text"))


def intervals(spark, sf_dir) -> DataFrame:
    us = lambda c: F.unix_micros(c.cast("timestamp"))
    zero = F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00"))
    pos = (F.floor((us(F.col("ts")) - us(zero)) / F.lit(60_000_000)) + 1).cast("long")
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("user_id").alias("seq_id"), F.col("event_type").alias("div"), pos.alias("pos"), (1 + F.floor("value")).cast("long").alias("len"))


def nodes(spark, sf_dir) -> DataFrame:
    iv = intervals(spark, sf_dir)
    code = F.pmod(F.ascii("div"), F.lit(13)) * 10 + F.pmod("id", F.lit(3))
    return iv.select(F.col("seq_id").alias("q_id"), "id", "pos", "len", "div", code.cast("int").alias("tax_id"), F.least(F.col("len") * F.col("len"), 50 * F.col("len")).alias("score"))


IV = """iv AS (SELECT event_id AS id, user_id AS seq_id, event_type AS div,
 CAST(floor((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / 60000000.0) + 1 AS BIGINT) AS pos,
 CAST(1 + floor(value) AS BIGINT) AS len FROM events)"""
NODES = IV + """, nodes AS (SELECT seq_id AS q_id, id, pos, len, div, CAST(ascii(div) % 13 * 10 + id % 3 AS INTEGER) AS tax_id,
 least(len * len, 50 * len) AS score FROM iv)"""


def _bases(col: str) -> str:
    return f"translate(lower(regexp_replace({col}, '[^A-Za-z]', '', 'g')), '{LETTERS}', '{BASES}')"


SBJ = f"sbj AS (SELECT doc_id AS oid, {_bases('text')} AS seq, CAST(regexp_extract(source, '([0-9]+)', 1) AS INTEGER) + 1 AS tax_id FROM documents)"
QRY = f"qry AS (SELECT item_id AS oid, {_bases('text')} AS seq FROM benchmark)"
