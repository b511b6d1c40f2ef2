"""Packing of token sequences as a cutting-stock problem solved by column generation.

A document that is longer than a sequence fills whole sequences first; its rest (shorter than a sequence) is an item. The
items' length histogram, at most ``width - 1`` numbers, is all that the linear program sees. Lengths are taken in classes of
UNIT tokens, rounded up, so that it has ``width / UNIT`` rows. Its columns are patterns of classes that fit a sequence; an
unbounded knapsack over the dual prices finds the next column, a revised simplex step takes it in, and it ends when no column
can lower the number of sequences by more than a proven share. Pattern counts are rounded down; what this leaves is at most a
sequence for each pattern, which rounding up and then best fit, both over true lengths, put into patterns as well. Every place of
a pattern takes documents in the order of their length and rank, so a pattern falls into runs of equal lengths.

What true lengths leave free in a sequence is filled by cutting: the items outside all patterns are laid end to end over these
gaps in the order of length and rank, and patterns are given up until they suffice; what then remains goes into whole sequences,
and the last, short rest is cut into powers of two. So no sequence holds padding.

Ranks are an offset for (length, part of the table) plus a running count within that part, so no group of equal lengths
ever meets in one task.

Defined results: null text counts as empty; every row, also a repeated one, is a document of its own and ends with one id
0; an empty document has that id alone; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cache, rows_of, written
from .pretokens import WORD
from .token_counts import vocabulary_path

WIDTH, UNIT = 1024, 8
BROADCAST_ROWS = 50_000


def encoder(path: str):
    """The byte-level encoder of a rank file, with the one special token that its vocabulary leaves free."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("packing", pat_str=WORD, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": len(ranks)})


# ---- the linear program -------------------------------------------------------------------------------------------------
def price(dual: np.ndarray, units: np.ndarray, size: int) -> tuple[float, dict[int, int]]:
    """The most valuable pattern of classes (index: times) of at most size units, by unbounded knapsack."""
    value, last = np.zeros(size + 1), np.full(size + 1, -1)
    for t in range(1, size + 1):
        n = np.searchsorted(units, t, side="right")
        value[t] = value[t - 1]
        if n:
            got = value[t - units[:n]] + dual[:n]
            k = int(got.argmax())
            if got[k] > value[t]:
                value[t], last[t] = got[k], k
    best, t = float(value[size]), size
    what: dict[int, int] = {}
    while t > 0:
        if last[t] < 0:
            t -= 1
            continue
        k = int(last[t])
        what[k] = what.get(k, 0) + 1
        t -= int(units[k])
    return best, what


def column_generation(supply: np.ndarray, units: np.ndarray, size: int, gap: float = 1e-4) -> tuple[list[tuple[dict[int, int], float]], float]:
    """([(pattern of classes, times)], lower bound): the fewest patterns that hold the supply of all classes, up to the gap. The
    bound (value of the duals over that of the dearest pattern) holds at any step."""
    m = len(units)
    basis = [{i: int(size // units[i])} for i in range(m)]
    scale = supply.sum()
    x = supply / scale * (1 + 1e-7 * np.random.default_rng(1).random(m))  # against ties in the ratio test
    need = x.copy()
    inverse = np.diag([1 / p[i] for i, p in enumerate(basis)])
    x, lower = inverse @ need, 0.0
    while True:
        dual = inverse.sum(0)
        total = float(x.sum())
        value, what = price(np.maximum(dual, 0), units, size)
        lower = max(lower, float(np.maximum(dual, 0) @ need) / max(value, 1e-12))
        if value <= 1 + 1e-9 or total - lower <= gap * total:
            break
        column = np.zeros(m)
        for k, n in what.items():
            column[k] = n
        d = inverse @ column
        ratio = np.where(d > 1e-9, x / np.where(d > 1e-9, d, 1), np.inf)
        r = int(ratio.argmin())
        step = ratio[r]
        x = np.maximum(x - step * d, 0)
        x[r] = step
        row = inverse[r] / d[r]
        inverse -= np.outer(d, row)
        inverse[r] = row
        basis[r] = what
    return [(p, float(n * scale)) for p, n in zip(basis, x, strict=True)], lower * scale


def _best_fit(left: dict[int, int], width: int) -> list[list[int]]:
    """Patterns of what is left, longest first, each length into the fullest sequences that still take it."""
    bins: list[list[int]] = []
    room = np.zeros(0, np.int64)
    for k in sorted(left, reverse=True):
        n = left[k]
        while n:
            fits = np.flatnonzero(room >= k)
            if len(fits):
                b = int(fits[room[fits].argmin()])
            else:
                bins.append([])
                room = np.append(room, width)
                b = len(bins) - 1
            a = min(n, int(room[b]) // k)
            bins[b] += [k] * a
            room[b] -= a * k
            n -= a
    return bins


def patterns(counts: dict[int, int], width: int = WIDTH, unit: int = UNIT) -> tuple[list[tuple[list[int], int]], float]:
    """([(lengths, times)], lower bound of the program): times are whole and together use no more items than there are."""
    left = {k: int(n) for k, n in sorted(counts.items()) if 0 < k < width and n > 0}
    if not left:
        return [], 0.0
    unit = max(1, min(unit, width // 8))
    size = width // unit
    of = lambda k: min(size, -(-k // unit))
    units = np.array(sorted({of(k) for k in left}))
    at = {int(u): i for i, u in enumerate(units)}
    supply = np.zeros(len(units))
    queue: list[list[list[int]]] = [[] for _ in units]  # of each class: [length, items left], longest last
    for k, n in left.items():
        supply[at[of(k)]] += n
        queue[at[of(k)]].append([k, n])
    found, lower = column_generation(supply, units, size)
    rest = supply.astype(np.int64)
    chosen = []
    for what, times in found:
        n = int(min(times + 1e-6, *(rest[c] // a for c, a in what.items())))
        for c, a in what.items():
            rest[c] -= a * n
        chosen.append([what, n, times - n])
    for row in sorted(chosen, key=lambda r: -r[2]):  # rounding up where the items suffice
        if row[2] > 1e-6 and all(rest[c] >= a for c, a in row[0].items()):
            row[1] += 1
            for c, a in row[0].items():
                rest[c] -= a
    out: list[tuple[list[int], int]] = []
    for what, times, _ in chosen:
        slots = [c for c, a in what.items() for _ in range(a)]
        takes: list[list[list[int]]] = []  # of each slot: [length, items], in order
        for c in slots:
            need, mine = times, []
            while need:
                k, n = queue[c][-1]
                a = min(n, need)
                mine.append([k, a])
                need -= a
                queue[c][-1][1] -= a
                if n == a:
                    queue[c].pop()
            takes.append(mine)
        while times:
            n = min(t[0][1] for t in takes)
            out.append(([t[0][0] for t in takes], n))
            times -= n
            for t in takes:
                t[0][1] -= n
                if not t[0][1]:
                    t.pop(0)
    out += [(b, 1) for b in _best_fit({k: n for q in queue for k, n in q}, width)]
    return out, lower


class Plan:
    """Where the item of a length and rank goes."""

    def __init__(self, counts: dict[int, int], width: int = WIDTH):
        self.width = width
        found, self.lower = patterns(counts, width)
        found.sort(key=lambda p: (sum(p[0]) - width, p[1]))  # fullest last
        gaps = sum((width - sum(p)) * n for p, n in found)
        cut = 0  # tokens of items outside all patterns
        begin = 0
        while cut < gaps:  # patterns with the largest gaps are given up, until what is in them fills the other gaps
            what, n = found[begin]
            full, free = sum(what), width - sum(what)
            give = min(n, -(-(gaps - cut) // width))
            cut, gaps = cut + full * give, gaps - free * give
            if give == n:
                begin += 1
            else:
                found[begin] = (what, n - give)
        runs: dict[int, list] = {k: [] for k in counts}  # length: [(first rank, first sequence, offset)]
        used = dict.fromkeys(counts, 0)
        sequence, gap, table = 0, 0, [(0, 1, 0, width)]
        for what, times in found[begin:]:
            at = 0
            for k in what:
                runs[k].append((used[k], sequence, at))
                used[k] += times
                at += k
            if at < width:
                table.append((gap, width - at, sequence, at))
                gap += (width - at) * times
            sequence += times
        self.runs = {k: np.array(v, np.int64).reshape(-1, 3) for k, v in runs.items()}
        self.gaps, self.gap = np.array(table[1:], np.int64).reshape(-1, 4), gap
        self.used, self.base, self.first, at = used, {}, sequence, 0
        for k in sorted(counts):
            self.base[k] = at
            at += k * (counts[k] - used[k])
        self.cut = at  # tokens of cut items
        at -= gap
        self.whole = at // width
        ends, rest = [], at % width
        for bit in range(width.bit_length(), -1, -1):
            if rest >> bit & 1:
                ends.append((ends[-1] if ends else self.whole * width) + (1 << bit))
        self.tail = np.array([self.whole * width, *ends], np.int64)

    def pieces(self, k: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(start in the item, length, sequence, offset)"""
        if rank < self.used[k]:
            runs = self.runs[k]
            first, sequence, at = runs[np.searchsorted(runs[:, 0], rank, side="right") - 1].tolist()
            return [(0, k, sequence + rank - first, at)]
        x = self.base[k] + (rank - self.used[k]) * k
        end, start, out = x + k, 0, []
        while x < end:
            if x < self.gap:
                first, size, sequence, at = self.gaps[np.searchsorted(self.gaps[:, 0], x, side="right") - 1].tolist()
                n, within = divmod(x - first, size)
                q, offset, free = sequence + n, at + within, size - within
            elif x - self.gap < self.whole * self.width:
                n, within = divmod(x - self.gap, self.width)
                q, offset, free = self.first + n, within, self.width - within
            else:
                i = int(np.searchsorted(self.tail, x - self.gap, side="right")) - 1
                q, offset, free = self.first + self.whole + i, x - self.gap - int(self.tail[i]), int(self.tail[i + 1]) - (x - self.gap)
            n = min(end - x, free)
            out.append((start, n, q, offset))
            start, x = start + n, x + n
        return out


# ---- the operator -------------------------------------------------------------------------------------------------------
def encoded(docs: DataFrame, path: str | None = None, width: int = WIDTH, tag: str = "") -> DataFrame:
    """(doc_id, ids, n, item, part, rank, whole): the ids with the closing 0, and running counts within the part."""
    path = path or vocabulary_path()

    def run(batches):
        enc = cache(f"packing:{path}", lambda: encoder(path))
        part = TaskContext.get().partitionId()
        seen, filled = np.zeros(width, np.int64), 0
        for b in rows_of(batches, 4 << 20):
            ids, n, item, rank, whole = [], [], [], [], []
            for t in b.column(1).to_pylist():
                x = enc.encode(t, allowed_special="all") if t else []
                x.append(0)
                ids.append(np.array(x, "<u4").astype("<u2" if enc.n_vocab <= 1 << 16 else "<u4").tobytes())
                n.append(len(x))
                item.append(len(x) % width)
                rank.append(int(seen[item[-1]]))
                seen[item[-1]] += 1
                whole.append(filled)
                filled += len(x) // width
            yield pa.record_batch([b.column(0), pa.array(ids, pa.binary()), *(pa.array(v, pa.int64()) for v in (n, item, [part] * len(n), rank, whole))], names=["doc_id", "ids", "n", "item", "part", "rank", "whole"])

    return written(docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids binary, n long, item long, part long, rank long, whole long"), "ids", tag)


def pack(docs: DataFrame, path: str | None = None, width: int = WIDTH, with_ids: bool = True, tag: str = "") -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]) of every piece."""
    spark = docs.sparkSession
    rows = encoded(docs, path, width, tag)
    held = written(rows.filter("item > 0").groupBy("item", "part").agg(F.count("*").alias("rows")), "lengths", tag)
    counts = {int(r["item"]): int(r["rows"]) for r in held.groupBy("item").agg(F.sum("rows").alias("rows")).collect()}
    plan = spark.sparkContext.broadcast(Plan(counts, width))
    before = Window.partitionBy("item").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    at = held.select("item", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).cast("long").alias("before"))
    if held.count() <= BROADCAST_ROWS:
        at = F.broadcast(at)
    rows = rows.join(at, ["item", "part"], "left")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    kinds = [pa.int64()] * 7 + [pa.binary()] * with_ids

    def cut(batches):
        p = plan.value
        for b in batches:
            col = {f: b.column(i).to_pylist() for i, f in enumerate(b.schema.names)}
            out: list[list] = [[] for _ in kinds]
            for doc, ids, n, item, part, rank, whole, ahead in zip(*(col[k] for k in ("doc_id", "ids", "n", "item", "part", "rank", "whole", "before")), strict=True):
                raw = ids if len(ids) == 4 * n else np.frombuffer(ids, "<u2").astype("<u4").tobytes()
                full = n - item
                # odd sequence ids: part and running count; even ones: of the plan
                got = [(s, width, ((part << 31) + whole + s // width) << 1 | 1, 0) for s in range(0, full, width)]
                if item:
                    got += [(full + s, k, q << 1, o) for s, k, q, o in p.pieces(item, (ahead or 0) + rank)]
                for s, k, q, o in got:
                    piece = raw[4 * s : 4 * (s + k)]
                    for c, v in zip(out, (doc, s, k, zlib.crc32(piece), n, q, o, piece), strict=False):
                        c.append(v)
            yield pa.record_batch([pa.array(v, k) for v, k in zip(out, kinds, strict=True)], names=[*names, "ids"][: len(kinds)])

    return rows.select("doc_id", "ids", "n", "item", "part", "rank", "whole", "before").mapInArrow(cut, ", ".join(f"{x} long" for x in names) + ", ids binary" * with_ids)
