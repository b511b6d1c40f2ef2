"""Alignment steps that are sequential by nature, as grouped pandas functions: best chain, ungapped and gapped extension,
shadow drop, maximal sub-arrays; and the order of stages."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..adapters import dealt, settled
from . import intervals, rounds, screen, words
from . import extension as ungapped

SEGMENT = "q_oid long, s_oid long, minus boolean, q long, s long, len long"
COLUMNS = ["q_oid", "s_oid", "minus", "q", "s", "len"]
TURN = np.arange(256, dtype=np.uint8)
TURN[list(b"ACGT")] = list(b"TGCA")


def chain_rows(q: np.ndarray, s: np.ndarray, n: np.ndarray, sid: np.ndarray, look_back: int = 1000, reach: int = 500_000) -> np.ndarray:
    """Rows of the best chain, by dynamic programming over rows sorted by q. A step along one subject scores the new length
    times up to two for closeness of diagonals; a jump from the best row so far costs 500."""
    m = len(q)
    score, prev, top = np.zeros(m), np.full(m, -1), 0
    end_q, end_s, diag, anti = q + n, s + n, q - s, q + s
    for b in range(1, m):
        fresh = max(0, min(n[b], end_q[b] - end_q[top]))
        value, back = score[top] - 500 + fresh - (0 if q[b] >= q[top] and end_q[b] >= end_q[top] else 1e9), top
        lo = max(0, b - look_back + 1)
        a = np.arange(lo, b)
        gap = (anti[b] + 2 * n[b] - anti[a]) / 2
        ok = (end_q[a] + reach >= q[b]) & (sid[a] == sid[b]) & (q[a] < q[b]) & (s[a] < s[b]) & (end_q[a] < end_q[b]) & (end_s[a] < end_s[b]) & (gap < 1_000_000)
        if ok.any():
            a, gap = a[ok], gap[ok]
            gain = score[a] + np.minimum(n[b], np.minimum(end_q[b] - end_q[a], end_s[b] - end_s[a])) * (1 + np.maximum(0, 1 - np.abs(diag[b] - diag[a]) / (gap + 1000)))
            k = len(gain) - 1 - int(gain[::-1].argmax())
            if gain[k] > value:
                value, back = gain[k], int(a[k])
        score[b], prev[b] = value, back
        if value > score[top]:
            top = b
    out = []
    while top >= 0:
        out.append(top)
        top = prev[top]
    return np.array(out[::-1], int)


def best_chain(segments: DataFrame, by: list[str]) -> DataFrame:
    """The rows of the best chain of each group (query and taxon, say)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["q", "s_oid", "s", "len"], kind="stable").reset_index(drop=True)
        return pdf.iloc[chain_rows(*(pdf[c].to_numpy() for c in ("q", "s", "len", "s_oid")))]

    return dealt(segments, *by).groupBy(*by).applyInPandas(run, segments.schema)


def extension(same: np.ndarray, drop: int = 20, penalty: int = 4) -> int:
    """How far an ungapped extension goes over flags of equal bases: a match adds the run's growth, a mismatch costs; it ends
    when the score falls drop below its best."""
    value = np.cumsum(np.where(same, 1, -penalty))
    if not len(value):
        return 0
    best = np.maximum.accumulate(np.maximum(value, 0))
    stop = np.flatnonzero(best - value > drop)
    value = value[: stop[0]] if len(stop) else value
    return int(value.argmax()) + 1 if len(value) and value.max() > 0 else 0


def _pairs(segments: DataFrame, query: DataFrame, subject: DataFrame, work, schema: str) -> DataFrame:
    """work(query bytes, subject bytes, rows) -> rows for each (query, subject, strand); rows are (q, s, len) from 0 by subject
    place. Both sequences travel once for each pair, the query turned where the strand is minus."""
    g = segments.groupBy("q_oid", "s_oid", F.coalesce("minus", F.lit(False)).alias("minus")).agg(F.array_sort(F.collect_set(F.struct("s", "q", "len"))).alias("segs"))
    j = g.join(query.select(F.col("oid").alias("q_oid"), F.col("seq").alias("q_seq")), "q_oid").join(subject.select(F.col("oid").alias("s_oid"), F.col("seq").alias("s_seq")), "s_oid")

    def run(parts):
        for pdf in parts:
            out = []
            for r in pdf.itertuples(index=False):
                a, b = (np.frombuffer(x.encode(), np.uint8) for x in (r.q_seq, r.s_seq))
                a, shift = (TURN[a[::-1]], len(a)) if r.minus else (a, -1)  # minus: place -n is base n of the other strand
                found = work(a, b, [(x["q"] + shift if r.minus else x["q"] - 1, x["s"] - 1, x["len"]) for x in r.segs])
                out += [(r.q_oid, r.s_oid, r.minus, q - shift if r.minus else q + 1, s + 1, *rest) for q, s, *rest in found]
            yield pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])

    return dealt(j.select("q_oid", "s_oid", "minus", "segs", "q_seq", "s_seq"), "q_oid", "s_oid").mapInPandas(run, schema)


def grow(a: np.ndarray, b: np.ndarray, q: int, s: int, n: int, cap: int = 2000) -> tuple[int, int, int]:
    """A segment extended to both sides as long as the bases agree."""
    left, right = min(q, s, cap), min(len(a) - q - n, len(b) - s - n, cap)
    lo = extension(a[q - left : q][::-1] == b[s - left : s][::-1]) if left > 0 else 0
    hi = extension(a[q + n : q + n + right] == b[s + n : s + n + right]) if right > 0 else 0
    return q - lo, s - lo, n + lo + hi


def extend(segments: DataFrame, query: DataFrame, subject: DataFrame, cap: int = 2000) -> DataFrame:
    """Segments of both strands, extended without gaps."""
    return _pairs(segments, query, subject, lambda a, b, rows: sorted({grow(a, b, *r, cap) for r in rows}), SEGMENT)


def best_shift(a: np.ndarray, b: np.ndarray, size: int = 24) -> tuple[int, int]:
    """(shift, equal bases): by how much a must be shifted (or b, if negative) so that the next size bases of both agree best; a
    shift costs its amount, and of equally good ones the least shift of a is taken."""
    spare = min(len(a), len(b)) - size
    tries = [(k, int((a[k : k + size] == b[:size]).sum())) for k in range(spare)] + [(-k, int((a[:size] == b[k : k + size]).sum())) for k in range(spare)]
    return max(tries, key=lambda x: x[1] - abs(x[0]))


def downstream(a: np.ndarray, b: np.ndarray, q: int, s: int, most: int, least: int = 10, room: int = 32, size: int = 24) -> list[tuple[int, int, int]]:
    """Segments that go on after the places q and s, each found at the best shift behind the one before, up to ``most`` bases away
    on b and as long as they have at least ``least`` bases."""
    out, stop = [], s + most
    while s + least < stop and q + room <= len(a) and s + room <= len(b):
        shift, _ = best_shift(a[q : q + room], b[s : s + room], size)
        seg = grow(a, b, q + max(shift, 0) + size // 2, s + max(-shift, 0) + size // 2, 1)
        if seg[2] < least:
            break
        out.append(seg)
        q, s = seg[0] + seg[2], seg[1] + seg[2]
    return out


def join_diagonals(rows: list[tuple[int, int, int]], gap: int = 5) -> list[tuple[int, int, int]]:
    """Segments of one diagonal that overlap or are up to gap apart, as one."""
    out: list[list[int]] = []
    for d, q, n in sorted((s - q, q, n) for q, s, n in rows):
        if out and out[-1][0] == d and q <= out[-1][1] + out[-1][2] + gap:
            out[-1][2] = max(out[-1][2], q + n - out[-1][1])
        else:
            out.append([d, q, n])
    return [(q, q + d, n) for d, q, n in out]


def gapped(segments: DataFrame, query: DataFrame, subject: DataFrame, reach: int = 10_000, gap: int = 5) -> DataFrame:
    """With continuations behind gaps: before the first and after the last segment of a pair up to reach, and between
    neighbours, from both, as far as they are apart (up to reach where their order differs)."""

    def work(a, b, rows):
        back = lambda q, s, n, most: [(len(a) - x - m, len(b) - y - m, m) for x, y, m in downstream(a[::-1], b[::-1], len(a) - q, len(b) - s, most)]
        found = back(*rows[0], reach) + downstream(a, b, rows[-1][0] + rows[-1][2], rows[-1][1] + rows[-1][2], reach)
        for (q, s, n), y in zip(rows, rows[1:], strict=False):
            near = 10 + max(0, min(y[0] - q - n, y[1] - s - n)) if q < y[0] and s < y[1] else reach
            found += downstream(a, b, q + n, s + n, near) + back(*y, near)
        return join_diagonals(rows + found, gap)

    return _pairs(segments, query, subject, work, SEGMENT)


def measure(segments: DataFrame, query: DataFrame, subject: DataFrame) -> DataFrame:
    """Segments with their numbers of mismatches and the sum of squared match runs."""

    def work(a, b, rows):
        for q, s, n in rows:
            same = a[q : q + n] == b[s : s + n]
            edge = np.flatnonzero(np.diff(np.concatenate([[0], same.astype(int), [0]])))
            runs = edge[1::2] - edge[::2]
            yield q, s, n, int((~same).sum()), int((runs * runs).sum())

    return _pairs(segments, query, subject, work, SEGMENT + ", mismatches long, run_squares long")


def drop_shadows(segments: DataFrame) -> DataFrame:
    """Without segments that lie strictly inside the one kept before and are shorter than half of it."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["q", "len", "s_oid", "s"], kind="stable")
        keep, last = [], None
        for k, (q, n) in enumerate(zip(pdf.q, pdf.len, strict=True)):
            if last and q > last[0] and q + n < last[0] + last[1] and 2 * n < last[1]:
                continue
            last = (q, n)
            keep.append(k)
        return pdf.iloc[keep]

    return dealt(segments, "q_oid").groupBy("q_oid").applyInPandas(run, segments.schema)


def drop_stacks(segments: DataFrame) -> DataFrame:
    """Without identical subject places hit 32 times (length up to 110) or 64 times (up to 150)."""
    n = F.count("*").over(Window.partitionBy("q_oid", "s_oid", "s", "len"))
    return segments.withColumn("_n", n).filter(~(((F.col("_n") >= 32) & (F.col("len") <= 110)) | ((F.col("_n") >= 64) & (F.col("len") <= 150)))).drop("_n")


def drop_crud(segments: DataFrame, by: list[str], chunk: int | Column = 100_000) -> DataFrame:
    """Without groups of short extensions: less than 50 beyond seed length in all, and less than a tenth of the chunk."""
    g = segments.groupBy(*by).agg(F.sum(F.greatest(F.col("len") - 56, F.lit(0))).alias("_e"), F.sum("len").alias("_l")).filter((F.col("_e") >= 50) | (F.col("_l") * 10 >= chunk))
    return segments.join(g.select(*by), by, "left_semi")


def segment_scores(segments: DataFrame, min_identity: int = 40) -> DataFrame:
    """With l2 = round(sqrt(run_squares)); segments below the least identity go."""
    keep = F.col("mismatches") <= F.col("len") * (1 - min_identity / 100)
    return segments.filter(keep).withColumn("l2", F.floor(F.sqrt("run_squares") + 0.5).cast("long"))


def query_words(query: DataFrame, index: DataFrame, repeats: DataFrame | None = None) -> DataFrame:
    """Words of queries without those inside low-complexity and high-occurrence intervals, and inside repeats where sequences to
    count them in are given."""
    w = words.spaced_words(query)
    w = w.withColumn("at", F.when(F.col("pos") < 0, -F.col("pos") - 55).otherwise(F.col("pos")))
    low = intervals.merge(words.entropy_track(query), ["oid"], 56).filter(F.col("len") > 56)
    tracks = [low, words.high_occurrence_mask(w, index)]
    if repeats is not None:
        tracks.append(words.transposon_mask(query, repeats))
    return words.masked(w, tracks).drop("at")


def accompanied(segments: DataFrame) -> DataFrame:
    """Segments of several seeds, and those with a neighbour on the same subject."""
    seg = settled(segments)
    return seg.filter(F.col("len") > 56).unionByName(screen.banded_neighbours(seg, ["q_oid", "s_oid"], COLUMNS).select(*seg.columns)).distinct()


def align(query: DataFrame, subject: DataFrame, stride: int = 11, short: int = 300, repeats: DataFrame | None = None, read: Callable[[bytes], bytes] | None = None) -> DataFrame:
    """Seeds outside masks, occurrence cap, coalescing, neighbours, shadows, extension, chain; a second round of finer seeds around what was
    found; extension with and without gaps, chain, and scores. read makes the sequence of a subject's bytes, where seq is not one yet."""
    index = settled(words.build_index(subject, stride=stride, asked=words.spaced_words(query), read=read))
    seeds = words.occurrence_cap(words.seed_join(query_words(query, index, repeats), index))
    seg = settled(drop_stacks(drop_shadows(accompanied(words.coalesce(seeds)))))
    subject = words.found_subjects(subject, seg, read)  # later steps stay on these
    taxon = subject.select(F.col("oid").alias("s_oid"), "tax_id")
    by = ["q_oid", "tax_id"]
    first = settled(best_chain(ungapped.extension_rounds(seg, query, subject).join(taxon, "s_oid").select(*COLUMNS, "tax_id"), by).filter("len > 56"))
    more = rounds.second_round(first, query.filter(F.length("seq") >= short), subject)
    more = best_chain(more, ["q_oid", "s_oid"]).select(*COLUMNS)
    seg = gapped(ungapped.extension_rounds(first.select(*COLUMNS).unionByName(more), query, subject), query, subject)
    seg = settled(best_chain(seg.join(taxon, "s_oid").select(*COLUMNS, "tax_id"), by))
    seg = seg.join(query.select(F.col("oid").alias("q_oid"), F.length("seq").alias("q_len")), "q_oid")
    seg = drop_crud(seg, [*by, "q_len"], F.col("q_len")).select(*COLUMNS)
    return segment_scores(measure(seg, query, subject))


def best_subarray(df: DataFrame, key: list[str], order: list[str], value: str) -> DataFrame:
    """Per key the greatest sum of neighbouring values, by prefix sums and their running minimum."""
    w = Window.partitionBy(*key).orderBy(*order)
    d = df.withColumn("_s", F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    d = d.withColumn("_m", F.least(F.lit(0), F.coalesce(F.min("_s").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    return d.groupBy(*key).agg(F.max(F.col("_s") - F.col("_m")).alias("best"))


def maximal_subarrays(values: list[float]) -> list[tuple[int, int]]:
    """All maximal scoring stretches [from, to), each found in one pass over candidates with their left and right sums."""
    found: list[list[float]] = []  # from, to, sum before, sum after
    total = 0.0
    for i, v in enumerate(values):
        before, total = total, total + v
        if v <= 0:
            continue
        now = [i, i + 1, before, total]
        while True:
            k = next((k for k in range(len(found) - 1, -1, -1) if found[k][2] < now[2]), None)
            if k is None or found[k][3] >= now[3]:
                found.append(now)
                break
            now = [found[k][0], now[1], found[k][2], now[3]]
            del found[k:]
    return [(int(a), int(b)) for a, b, *_ in found]
