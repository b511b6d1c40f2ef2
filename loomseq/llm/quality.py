"""Quality classifier: naive Bayes features with a linear support vector machine.

Indicators of word and character n-grams, hashed to a fixed number of columns, are scaled by the log ratio of their smoothed
class counts. A linear hinge-loss model is fitted on them by dual coordinate descent, and a logistic curve on the margins
turns them into scores. Only texts and labels of training rows are used; lang, source and doc_id are never inputs.

The model is fitted on whole texts of at most ``max_rows`` labelled training rows (the only bounded sample here: rows with
the smallest hash of doc_id). Executors turn them into columns, and the driver gets those: at most 2 ** BITS numbers a row,
whatever the length of its text. Scoring reads every row and whole text.

Defined results: null or empty text is scored as a text without features; rows are scored independently, so repeated rows,
ties and extra columns change nothing; with no or only one class of labels every score is the share of label 1 (0.5
without labels); an empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import Memo, cache, rows_of, written

BITS = 18
MAX_ROWS, MAX_COLUMNS = 6000, 50_000_000
THRESHOLD = 0.3


def held_out(doc_id, mod: int, rest: int):
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(mod)) == rest


class Features:
    """Distinct hashed n-grams of a text: words, word pairs, and runs of one to three bytes."""

    def __init__(self, bits: int = BITS):
        self.size, self.shift = 1 << bits, np.uint64(64 - bits)
        self.seen = np.zeros(self.size, np.int64)
        self.words = Memo(lambda w: xxhash.xxh3_64_intdigest(w))

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int64)
        mult = np.uint64(0x9E3779B97F4A7C15)
        b = np.frombuffer(text.encode(), np.uint8).astype(np.uint64)
        grams = [b + np.uint64(1)]
        if len(b) > 1:
            two = (b[:-1] << np.uint64(8) | b[1:]) + np.uint64(1 << 16)
            grams.append(two)
        if len(b) > 2:
            grams.append((b[:-2] << np.uint64(16) | b[1:-1] << np.uint64(8) | b[2:]) + np.uint64(1 << 24))
        found = text.split()
        w = np.fromiter(map(self.words.__getitem__, found), np.uint64, len(found))
        with np.errstate(over="ignore"):
            grams.append(w)
            if len(w) > 1:
                grams.append(w[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + w[1:])
            at = ((np.concatenate(grams) * mult) >> self.shift).astype(np.int64)
        at = np.concatenate([at, self._repeats(w)])
        order = np.arange(len(at))
        self.seen[at] = order  # the last of equal columns stays
        return at[self.seen[at] == order]


    def _repeats(self, w: np.ndarray) -> np.ndarray:
        """Columns of n-grams whose words repeat: for each period, one for a phrase said twice and one for thrice in a
        row, and for the share of such words in steps of an eighth."""
        found = []
        for p in range(1, 7):
            if len(w) < 2 * p:
                break
            same = np.cumsum(np.concatenate([[0], w[p:] == w[:-p]]))
            for k in (1, 2):
                if len(same) > k * p and (same[k * p :] - same[: -k * p] == k * p).any():
                    found.append(8 * p + k)
            found += [100 + 16 * p + s for s in range(1, 1 + int(8 * same[-1] / len(w)))]
        mult = 0x9E3779B97F4A7C15
        return np.array([((x + (3 << 40)) * mult % (1 << 64)) >> int(self.shift) for x in found], np.int64)


def fit(texts: list[str], labels: np.ndarray, bits: int = BITS, **options) -> dict:
    """The model of these texts."""
    feats = Features(bits)
    return fit_columns([feats(t) for t in texts], labels, bits, **options)


def fit_columns(rows: list[np.ndarray], labels: np.ndarray, bits: int = BITS, alpha: float = 1.0, cost: float = 1.0, rounds: int = 20, seed: int = 7) -> dict:
    """Weights by column, bias, and the slope and offset of the logistic curve, from the columns of each text."""
    y = np.asarray(labels, np.int64)
    share = float(y.mean()) if len(y) else 0.5
    if len(y) == 0 or y.min() == y.max():
        return {"weights": np.zeros(1 << bits, np.float32), "bias": 0.0, "slope": 0.0, "offset": float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))), "bits": bits}
    counts = np.full((2, 1 << bits), alpha)
    for x, k in zip(rows, y, strict=True):
        counts[k, x] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    kept_out = np.arange(len(y)) % 5 == 0  # the curve is fitted on margins of rows that the weights have not seen
    if min(np.bincount(y[kept_out], minlength=2)) >= 5 and min(np.bincount(y[~kept_out], minlength=2)) >= 5:
        part = np.full((2, 1 << bits), alpha)
        for i in np.flatnonzero(~kept_out):
            part[y[i], rows[i]] += 1
        r = np.log(part[1] / part[1].sum()) - np.log(part[0] / part[0].sum())
        w, b = _descend([rows[i] for i in np.flatnonzero(~kept_out)], y[~kept_out], r, cost, rounds, seed)
        margins = np.array([_margin(rows[i], w, b) for i in np.flatnonzero(kept_out)])
        slope, offset = _curve(margins, y[kept_out])
    else:
        slope, offset = 2.0, 0.0
    w, b = _descend(rows, y, ratio, cost, rounds, seed)
    return {"weights": w.astype(np.float32), "bias": b, "slope": slope, "offset": offset, "bits": bits}


def _margin(x: np.ndarray, w: np.ndarray, b: float) -> float:
    return float(w[x].sum() / np.sqrt(max(1, len(x))) + b)


def _descend(rows, y, ratio, cost, rounds, seed):
    """Dual coordinate descent for the hinge loss; each row is scaled by its number of features. The returned weights
    already hold the ratio."""
    rng = np.random.default_rng(seed)
    scale = np.array([1 / np.sqrt(max(1, len(x))) for x in rows])
    norm = np.array([float(ratio[x] @ ratio[x]) * k * k + 1 for x, k in zip(rows, scale, strict=True)])
    sign = np.where(y == 1, 1.0, -1.0)
    weight = len(y) / (2.0 * np.bincount(y, minlength=2))
    upper = cost * np.where(y == 1, weight[1], weight[0])
    w, b, dual = np.zeros(len(ratio)), 0.0, np.zeros(len(y))
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(y)):
            z = ratio[rows[i]] * scale[i]
            g = sign[i] * (w[rows[i]] @ z + b) - 1
            new = min(max(dual[i] - g / norm[i], 0.0), upper[i])
            if d := (new - dual[i]) * sign[i]:
                w[rows[i]] += d * z
                b += d
                dual[i] = new
                moved = max(moved, abs(d))
        if moved < 1e-3:
            break
    return w * ratio, b


def _curve(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic curve by Newton steps, with the targets of a smoothed class count."""
    n1, n0 = int((y == 1).sum()), int((y == 0).sum())
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, c = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + c, -30, 30)))
        g = np.array([((p - target) * margins).sum() + 1e-3 * a, (p - target).sum()])
        v = p * (1 - p)
        h = np.array([[(v * margins**2).sum() + 1e-3, (v * margins).sum()], [(v * margins).sum(), v.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, c = a - np.clip(step[0], -2, 2), c - np.clip(step[1], -2, 2)
        if abs(step).max() < 1e-6:
            break
    return float(max(a, 1e-3)), float(c)


def train(docs: DataFrame, labels: DataFrame, mod: int = 5, rest: int = 0, max_rows: int = MAX_ROWS, bits: int = BITS, max_columns: int = MAX_COLUMNS) -> dict:
    """The model of a bounded sample of labelled rows: at most max_rows ids, by a hash, and max_columns n-grams of theirs in all. An id
    that repeats is learnt once, with its greatest text."""
    known = labels.filter("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    train_rows = known.filter(~held_out(F.col("doc_id"), mod, rest)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    ids = {r.doc_id: int(r.quality > 0) for r in train_rows.collect()}
    if not ids:
        return fit([], np.zeros(0), bits)
    picked = docs.join(F.broadcast(docs.sparkSession.createDataFrame([(int(k),) for k in ids], "doc_id long")), "doc_id", "left_semi")

    def columns(batches):
        feats = cache(f"features:{bits}", lambda: Features(bits))
        for b in rows_of(batches):
            found = [np.sort(feats(t)).astype(np.int32).tobytes() for t in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(found, pa.binary())], names=["doc_id", "columns"])

    # one row for each id, and no more columns in all than max_columns: both in the order of a hash of the id
    one = picked.groupBy("doc_id").agg(F.max("text").alias("text"))
    found = written(one.mapInArrow(columns, "doc_id long, columns binary"), "columns")
    order = Window.orderBy(F.xxhash64("doc_id"), "doc_id")  # at most max_rows rows
    sizes = found.select("doc_id", F.sum(F.octet_length("columns") / 4).over(order).alias("total")).filter(F.col("total") <= max_columns)
    got = sorted((r.doc_id, bytes(r["columns"])) for r in found.join(F.broadcast(sizes.select("doc_id")), "doc_id", "left_semi").toLocalIterator())
    return fit_columns([np.frombuffer(x, np.int32) for _, x in got], np.array([ids[i] for i, _ in got]), bits)


def _scored(docs: DataFrame, model: dict) -> DataFrame:
    """(row: all columns of docs, score)"""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    name = f"quality:{zlib.crc32(model['weights'].tobytes())}:{model['bias']}"
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text")

    def run(batches):
        m = sent.value
        feats = cache(f"features:{m['bits']}", lambda: Features(m["bits"]))
        w = cache(name, lambda: m["weights"])
        for b in rows_of(batches):
            out = [_margin(feats(t), w, m["bias"]) for t in b.column(1).to_pylist()]
            p = 1 / (1 + np.exp(-np.clip(m["slope"] * np.array(out) + m["offset"], -30, 30)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p, pa.float64())], names=["row", "score"])

    return rows.mapInArrow(run, StructType([StructField("row", rows.schema["row"].dataType), StructField("score", DoubleType())]))


def score(docs: DataFrame, model: dict, mod: int = 5, rest: int = 0) -> DataFrame:
    """All columns of docs with held_out, score and predicted (names that docs already has are replaced)."""
    own = [F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in ("held_out", "score", "predicted")]
    return _scored(docs, model).select(*own, held_out(F.col("row")["doc_id"], mod, rest).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: dict) -> DataFrame:
    """The rows of docs that the model predicts as 1; columns of any names stay as they are."""
    return _scored(docs, model).filter(F.col("score") >= THRESHOLD).select("row.*")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(docs, labels)
    return score(docs.select("doc_id", "text"), model).select("doc_id", "held_out", "score", "predicted")
