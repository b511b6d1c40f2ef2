"""Ungapped extension in rounds, over slices of the sequences.

A segment first loses TRIM bases at both ends, for it may reach too far. Then for each penalty of PENALTIES it is extended
downstream and upstream by at most CAP bases. A match scores the length of the run of matches so far, a mismatch the penalty; it ends when the
score falls DROP below its best, and the last place with the best score is its end. Strict penalties come first, so that
neighbours on one diagonal do not grow over each other: a segment stops where the next one in order of the subject begins, when
that is on its diagonal and lies consistently behind it.

Only CAP * len(PENALTIES) bases beside each end can ever matter. They are cut out of pieces of the sequences, so no whole sequence
travels to a segment, and the passes run over batches of slices as matrices. Segments that can stop one another, neighbours in order on
one diagonal, stay together.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..adapters import dealt, settled

# Fixed values of the rounds.
PENALTIES, DROP, CAP, TRIM = (9, 4, 2), 20, 2000, 8
PIECE = 8192
SEGMENT = "q_oid long, s_oid long, minus boolean, q long, s long, len long"
COLUMNS = [x.split()[0] for x in SEGMENT.split(", ")]


def slices(asks: DataFrame, seqs: DataFrame, piece: int = PIECE) -> DataFrame:
    """(ask, texts): for each ask (ask, which, oid, pos, len) the bases from pos on, by which; ranges lie inside the sequence. seqs: (oid, seq),
    of single-byte letters."""
    raw = seqs.select("oid", F.col("seq").cast("binary").alias("seq"), F.explode(F.sequence(F.lit(0), F.floor((F.length("seq") - 1) / piece).cast("int"))).alias("part")).filter(F.length("seq") > 0)
    pieces = raw.select("oid", "part", F.substring("seq", F.col("part") * piece + 1, F.lit(piece)).alias("text"))
    first, last = F.floor((F.col("pos") - 1) / piece), F.floor((F.col("pos") + F.col("len") - 2) / piece)
    a = asks.filter("len > 0").select("*", F.explode(F.sequence(first.cast("int"), last.cast("int"))).alias("part"))
    begin = F.greatest(F.col("pos") - F.col("part") * piece, F.lit(1))
    end = F.least(F.col("pos") + F.col("len") - F.col("part") * piece, F.lit(piece + 1))
    cut = a.join(pieces, ["oid", "part"]).select("ask", "which", "part", F.substring("text", begin.cast("int"), (end - begin).cast("int")).cast("string").alias("text"))
    whole = cut.groupBy("ask").agg(F.array_sort(F.collect_list(F.struct("which", "part", "text"))).alias("x"))
    kinds = F.array_distinct(F.transform("x", lambda y: y["which"]))
    text = lambda k: F.array_join(F.transform(F.filter("x", lambda y: y["which"] == k), lambda y: y["text"]), "")
    return whole.select("ask", F.map_from_entries(F.transform(kinds, lambda k: F.struct(k, text(k)))).alias("texts"))


def scan(same: np.ndarray, room: np.ndarray, penalty: int) -> np.ndarray:
    """How far each row goes: same is (rows, width), flags of equal bases downstream; room: how many of them count."""
    rows, width = same.shape
    if not rows or not width:
        return np.zeros(rows, np.int64)
    at = np.arange(width)
    broken = np.maximum.accumulate(np.where(same, -1, at), 1)
    run = np.where(broken < 0, at + 1, at - broken + 1)  # a mismatch is a run of one, so the match behind it counts two
    value = np.cumsum(np.where(same, run, -penalty), 1)
    best = np.maximum.accumulate(np.maximum(value, 0), 1)
    fallen = value + DROP < best
    stop = np.where(fallen.any(1), fallen.argmax(1), width)
    value = np.where((at <= stop[:, None]) & (at < room[:, None]), value, -1)
    most = value.max(1)
    last = width - 1 - (value == most[:, None])[:, ::-1].argmax(1)
    return np.where(most >= 0, last + 1, 0)


def _flags(a: list[str], b: list[str], width: int, back: bool) -> tuple[np.ndarray, np.ndarray]:
    """Equal bases of each pair of slices, outwards from the segment, and how many there are. N equals nothing."""
    out, size = np.zeros((len(a), width), bool), np.zeros(len(a), np.int64)
    for k, (x, y) in enumerate(zip(a, b, strict=True)):
        n = min(len(x), len(y))
        size[k] = n
        if n:
            u, v = np.frombuffer(x.encode(), np.uint8), np.frombuffer(y.encode(), np.uint8)
            u, v = (u[-n:][::-1], v[-n:][::-1]) if back else (u[:n], v[:n])
            out[k, :n] = (u == v) & (u != ord("N"))
    return out, size


def extend_batch(q: np.ndarray, n: np.ndarray, run: np.ndarray, right: tuple, left: tuple) -> tuple[np.ndarray, np.ndarray]:
    """(start, length) after all rounds of trimmed segments in order; run: equal for neighbours on one diagonal; right, left: flags and
    sizes beside the ends."""
    start, end = q.copy(), q + n
    follows = np.append(run[1:] == run[:-1], False)
    after = np.minimum(np.arange(len(q)) + 1, len(q) - 1)
    used = [np.zeros(len(q), np.int64), np.zeros(len(q), np.int64)]
    for penalty in PENALTIES:
        for side, (same, size) in enumerate((right, left)):
            tidy = follows & (start < start[after]) & (end < end[after])
            gap = np.maximum(start[after] - end, 0)
            room = np.minimum(CAP, size - used[side])
            if side == 0:
                room = np.where(tidy, np.minimum(room, gap), room)
            else:
                room[1:] = np.where(tidy[:-1], np.minimum(room[1:], gap[:-1]), room[1:])
            room = np.maximum(room, 0)
            width = int(room.max(initial=0))
            at = used[side][:, None] + np.arange(width)
            window = np.take_along_axis(same, np.minimum(at, same.shape[1] - 1), 1) if width else same[:, :0]
            more = scan(window, room, penalty)
            used[side] += more
            if side == 0:
                end = end + more
            else:
                start = start - more
    return start, end - start


def _place(name: str, back: bool) -> tuple[Column, Column]:
    """pos and len, on the strand of the segment, of the slice beside its end or start; negative places count from the other end."""
    reach = CAP * len(PENALTIES)
    at, n, size, first = F.col(name), F.col("len"), F.col(f"{name}_len"), F.when(F.col(name) < 0, -F.col(f"{name}_len")).otherwise(1)
    if back:
        begin = F.greatest(first, at - reach)
        return begin, at - begin
    begin = at + n
    return begin, F.greatest(F.least(F.lit(reach), first + size - begin), F.lit(0))


def extension_rounds(segments: DataFrame, query: DataFrame, subject: DataFrame, rows: int = 2000) -> DataFrame:
    """Segments (q_oid, s_oid, minus, q, s, len), extended. Places on the query's minus strand are negative: -n is the complement of base n. query,
    subject: (oid, seq). Repeated segments count once; sequences that are not there leave the segment out; after trimming nothing is
    left of a segment of no more than 2 * TRIM bases, so that one is not trimmed."""
    w = Window.partitionBy("q_oid", "s_oid", "minus").orderBy("s", "q", "len")
    d = segments.select("q_oid", "s_oid", F.coalesce("minus", F.lit(False)).alias("minus"), "q", "s", "len").distinct()
    d = d.withColumn("_n", F.coalesce(F.lag(F.col("s") - F.col("q")).over(w) != F.col("s") - F.col("q"), F.lit(True)).cast("int"))
    d = d.withColumns({"run": F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0)), "r": F.row_number().over(w)}).drop("_n")
    trim = F.when(F.col("len") > 2 * TRIM, TRIM).otherwise(0)
    d = d.withColumns({"q": F.col("q") + trim, "s": F.col("s") + trim, "len": F.col("len") - 2 * trim})
    for name, seqs in (("q", query), ("s", subject)):
        d = d.join(seqs.select(F.col("oid").alias(f"{name}_oid"), F.length("seq").cast("long").alias(f"{name}_len")), f"{name}_oid")
    d = settled(d.withColumn("ask", F.monotonically_increasing_id()))
    texts = []
    for name, seqs in (("q", query), ("s", subject)):
        part = []
        for which, back in (("r", False), ("l", True)):
            pos, n = _place(name, back)
            turned = F.when(pos < 0, -pos - n + 1).otherwise(pos)  # on the strand that is stored
            part.append(F.struct(F.lit(which).alias("which"), turned.cast("long").alias("pos"), n.cast("long").alias("len")))
        asks = d.select("ask", F.col(f"{name}_oid").alias("oid"), F.explode(F.array(*part)).alias("p")).select("ask", "oid", "p.*")
        texts.append(slices(asks, seqs).select("ask", *(F.coalesce(F.try_element_at("texts", F.lit(k)), F.lit("")).alias(f"{name}_{k}") for k in ("r", "l"))))
    for t in texts:
        d = d.join(t, "ask", "left")
    turn = lambda c: F.when(F.col("minus"), F.translate(F.reverse(c), "ACGT", "TGCA")).otherwise(F.col(c))
    d = d.withColumns({"q_r": turn("q_r"), "q_l": turn("q_l")}).select("q_oid", "s_oid", "minus", "run", "r", "q", "s", "len", *(F.coalesce(c, F.lit("")).alias(c) for c in ("q_r", "q_l", "s_r", "s_l")))

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        key = pdf[["q_oid", "s_oid", "minus", "run"]]
        run = np.cumsum((key != key.shift()).any(axis=1).to_numpy())
        longest = lambda *cs: max((int(pdf[c].str.len().max()) for c in cs), default=0) or 1
        right = _flags(pdf["q_r"].tolist(), pdf["s_r"].tolist(), longest("q_r", "s_r"), False)
        left = _flags(pdf["q_l"].tolist(), pdf["s_l"].tolist(), longest("q_l", "s_l"), True)
        q = pdf["q"].to_numpy(np.int64)
        start, n = extend_batch(q, pdf["len"].to_numpy(np.int64), run, right, left)
        return pdf.assign(q=start, s=pdf["s"].to_numpy(np.int64) + start - q, len=n)[COLUMNS]

    def each(parts):
        held = None
        for pdf in parts:
            for lo in range(0, len(pdf), rows):
                some = pdf.iloc[lo : lo + rows]
                held = some if held is None else pd.concat([held, some], ignore_index=True)
                key = held[["q_oid", "s_oid", "minus", "run"]]
                same = (key == key.iloc[-1]).all(axis=1).to_numpy()
                cut = len(same) - int(same[::-1].argmin()) if not same.all() else 0  # the last run may go on
                if cut:
                    yield work(held.iloc[:cut])
                    held = held.iloc[cut:].reset_index(drop=True)
        if held is not None and len(held):
            yield work(held)

    by = ["q_oid", "s_oid", "minus", "run"]
    return dealt(d, *by).sortWithinPartitions(*by, "r").mapInPandas(each, SEGMENT)
