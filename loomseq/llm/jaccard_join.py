"""Similarity join on word n-grams with Bayesian pruning.

A text is the set of its runs of five words (lower-cased A to Z, split at white space; a shorter text is one run). Texts
that share a band of MinHash values are candidates. A candidate pair's MinHash values are compared a few at a time; a pair
is dropped once the posterior probability that its Jaccard similarity reaches the threshold falls below a tolerance (uniform
prior), and what is left is verified exactly on the sets.

Rows with equal text are one class from the start and are never compared. Candidates are grouped by connected components
of shared bands. A component is dealt into chunks of a bounded number of texts and shingles, and pairs are compared chunk
against chunk, each such block in one task; a block returns one row for each of its texts (its links there, and the least
text it hangs together with), not its pairs. So no group meets in one task as a whole and no pair of a group is ever a row.

Defined results: null counts as empty; a text without words has no links and is a class with its equals; links are counted
between different texts; the class of a row is named by the least doc_id in it (a null doc_id is the greatest); repeated rows
are copies; extra columns are ignored; an empty table gives an empty result. Texts are told apart by a 64-bit hash. Bands miss
a pair of similarity 0.8 with probability 3e-6.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, Memo, cache, components, groups, rows_of, written

WORDS, THRESHOLD, TOLERANCE = 5, 0.8, 1e-7
BANDS, ROWS = 24, 4
HASHES, STEP = BANDS * ROWS, 16
CHUNK_TEXTS, CHUNK_SHINGLES = 512, 400_000
TABLE = bytes.maketrans(UPPER.encode(), LOWER.encode())
_rng = np.random.default_rng(20)
MULT = _rng.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLUS = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)
KEY_SCHEMA = "k long, doc_id long"


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None, memo) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of words."""
    found = text.encode().translate(TABLE).split() if text else []
    if not found:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(memo.__getitem__, found), np.uint64, len(found))
    n = max(1, len(w) - WORDS + 1)
    h = np.zeros(n, np.uint64)
    for k in range(min(WORDS, len(w))):
        h = h * np.uint64(0x9E3779B97F4A7C15) + w[k : k + n]
    return np.unique(mix(h))


def signature(x: np.ndarray) -> np.ndarray:
    out = np.empty(HASHES, np.uint32)
    for at in range(0, HASHES, 8):
        best = np.full(8, 0xFFFFFFFF, np.uint32)
        for lo in range(0, len(x), 4096):
            best = np.minimum(best, ((x[None, lo : lo + 4096] * MULT[at : at + 8, None] + PLUS[at : at + 8, None]) >> np.uint64(32)).astype(np.uint32).min(1))
        out[at : at + 8] = best
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band, of one signature or of many."""
    s = sig.reshape(*sig.shape[:-1], BANDS, ROWS).astype(np.uint64)
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93), s.shape[:-1])
    for k in range(ROWS):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + s[..., k])
    return h


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """After k compared values, the least number of equal ones with which the posterior still reaches the tolerance."""
    out = {}
    for k in range(STEP, HASHES + 1, STEP):
        for m in range(k + 1):
            # posterior is Beta(m + 1, k - m + 1); its upper tail is a binomial sum
            if sum(comb(k + 1, i) * threshold**i * (1 - threshold) ** (k + 1 - i) for i in range(m + 1)) >= tolerance:
                out[k] = m
                break
    return out


def _memo():
    return cache("shingle words", lambda: Memo(lambda w: xxhash.xxh3_64_intdigest(w)))


def keyed(docs: DataFrame, *more) -> DataFrame:
    return docs.select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("k"), "doc_id", *(more or ("text",)))


def signatures(docs: DataFrame, tag: str) -> DataFrame:
    """(k, doc_id, n, bands) of every row; k stands for the text."""

    def run(batches):
        memo = _memo()
        for b in rows_of(batches):
            n, bands, seen = [], [], {}
            for k, t in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                if k not in seen:
                    x = shingles(t, memo)
                    seen[k] = (len(x), band_keys(signature(x)).view(np.int64) if len(x) else [])
                n.append(seen[k][0])
                bands.append(seen[k][1])
            yield pa.record_batch([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(bands, pa.list_(pa.int64()))], names=["k", "doc_id", "n", "bands"])

    return written(keyed(docs).mapInArrow(run, KEY_SCHEMA + ", n long, bands array<long>"), "signatures", tag)


def block_links(ks: list[int], side: np.ndarray, sets: list[np.ndarray], crossed: bool, need: dict[int, int], threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """(links of each text, index of the least text that it hangs together with) in a block. crossed: only pairs of different
    sides count."""
    m = len(ks)
    size = np.array([len(x) for x in sets])
    sig = np.stack([signature(x) for x in sets])
    keys = band_keys(sig)
    share = np.zeros((m, m), bool)
    for b in range(BANDS):
        share |= keys[:, b][:, None] == keys[:, b][None, :]
    share &= np.triu(np.ones((m, m), bool), 1)
    if crossed:
        share &= side[:, None] != side[None, :]
    share &= np.minimum(size[:, None], size[None, :]) >= threshold * np.maximum(size[:, None], size[None, :]) - 1e-9
    a, b = np.nonzero(share)
    same = np.zeros(len(a), np.int64)
    for k in range(STEP, HASHES + 1, STEP):  # incremental comparison
        same += (sig[a, k - STEP : k] == sig[b, k - STEP : k]).sum(1)
        keep = same >= need[k]
        a, b, same = a[keep], b[keep], same[keep]
    if not len(a):
        return np.zeros(m, np.int64), np.arange(m)
    if len(a) <= 4 * m:
        both = np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(a, b, strict=True)])
    else:
        both = _overlaps(sets, m)[a, b]
    ok = both * 1000 >= round(threshold * 1000) * (size[a] + size[b] - both)
    a, b = a[ok], b[ok]
    links = np.bincount(a, minlength=m) + np.bincount(b, minlength=m)
    root = np.arange(m)  # least label by repeated minimum over links and pointer jumps
    while len(a):
        new = root.copy()
        np.minimum.at(new, a, root[b])
        np.minimum.at(new, b, root[a])
        new = new[new]
        if (new == root).all():
            break
        root = new
    return links, root


def _overlaps(sets: list[np.ndarray], m: int) -> np.ndarray:
    """Sizes of all intersections of a dense block: shingles that all texts or only one has are counted apart."""
    own = np.repeat(np.arange(m), [len(x) for x in sets])
    _, at, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum((df > 1) & (df < m)) - 1
    use = (df[at] > 1) & (df[at] < m)
    own, at = own[use], number[at[use]]
    order = np.argsort(at, kind="stable")
    own, at = own[order], at[order]
    out = np.full((m, m), float((df == m).sum()))
    width = 4096
    total = int(at[-1]) + 1 if len(at) else 0
    cut = np.searchsorted(at, np.arange(0, total + width, width))
    for lo, hi, first in zip(cut, cut[1:], range(0, total, width), strict=False):
        rows, r = np.unique(own[lo:hi], return_inverse=True)
        x = np.zeros((len(rows), min(width, total - first)), np.float32)
        x[r, at[lo:hi] - first] = 1
        out[np.ix_(rows, rows)] += x @ x.T
    return np.rint(out).astype(np.int64)


def near_classes(docs: DataFrame, threshold: float = THRESHOLD, tag: str = "") -> DataFrame:
    """(k, doc_id, class_id, class_k, n_links, n_copies, class_size) of every row; class_k and class_id name the row that
    stands for the class."""
    spark = docs.sparkSession
    need = least_matches(threshold)
    rows = signatures(docs, tag)
    texts = written(rows.groupBy("k").agg(F.max("n").alias("n"), F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "texts", tag)
    bands = rows.select(F.explode("bands").alias("b"), "k")
    several = bands.groupBy("b").agg(F.min("k").alias("m"), F.max("k").alias("x")).filter("m < x").select("b", "m")
    stars = written(bands.join(several, "b").filter("k <> m").select(F.col("k").alias("a"), F.col("m").alias("b")).distinct(), "stars", tag)
    near = components(stars, tag)
    near = near.unionAll(near.select(F.col("root").alias("node"), "root").distinct())
    member = texts.join(near, F.col("k") == F.col("node")).select("k", "rep", "n", F.col("root").alias("group"))
    chunks = member.groupBy("group").agg(F.ceil(F.greatest(F.count("*") / CHUNK_TEXTS, F.sum("n") / CHUNK_SHINGLES)).cast("int").alias("chunks"))
    member = written(member.join(chunks, "group").select("k", "rep", "group", "chunks", F.pmod(F.xxhash64("k"), F.col("chunks")).cast("int").alias("chunk")), "member", tag)

    def sets(batches):
        memo = _memo()
        for b in rows_of(batches):
            x = [shingles(t, memo).tobytes() for t in b.column(4).to_pylist()]
            yield pa.record_batch([*b.columns[:4], pa.array(x, pa.binary())], names=["k", "group", "chunks", "chunk", "shingles"])

    # the same join at every size: texts are dealt out by key, and a small member table isn't broadcast instead
    found = keyed(docs).alias("d").join(member.alias("m").hint("merge"), (F.col("d.k") == F.col("m.k")) & F.col("d.doc_id").eqNullSafe(F.col("m.rep"))).select("m.k", "group", "chunks", "chunk", F.coalesce("text", F.lit("")).alias("text"))
    found = found.mapInArrow(sets, "k long, group long, chunks int, chunk int, shingles binary")
    dealt = found.select("k", "group", "chunk", "shingles", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    dealt = dealt.select("k", "group", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "shingles")

    def compare(batches):
        out: list[tuple] = []
        for (_, i, j), t in groups(batches, ["group", "i", "j"]):
            seen: dict = {}
            for k, c, s in zip(*(t.column(x).to_pylist() for x in ("k", "chunk", "shingles")), strict=True):
                seen.setdefault(k, (c, s))
            ks = sorted(seen)
            if len(ks) > 1:
                links, root = block_links(ks, np.array([seen[k][0] for k in ks]), [np.frombuffer(seen[k][1], np.uint64) for k in ks], i != j, need, threshold)
                out += [(k, ks[r], int(n)) for k, r, n in zip(ks, root, links, strict=True) if n]
            if len(out) > 20_000:
                yield _batch(out)
                out = []
        yield _batch(out)

    def _batch(out):
        return pa.record_batch([pa.array([x[c] for x in out], pa.int64()) for c in range(3)], names=["k", "root", "links"])

    dealt = dealt.repartition("group", "i", "j").sortWithinPartitions("group", "i", "j")
    links = written(dealt.mapInArrow(compare, "k long, root long, links long"), "links", tag)
    joined = components(links.select(F.col("k").alias("a"), F.col("root").alias("b")), tag)
    count = links.groupBy("k").agg(F.sum("links").alias("n_links"))
    named = texts.join(joined, F.col("k") == F.col("node"), "left").join(count, "k", "left").select("k", "rep", "copies", F.coalesce("root", "k").alias("root"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    named = written(named, "named", tag)
    least = named.groupBy("root").agg(F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "k")).alias("least"), F.sum("copies").alias("class_size"))
    info = named.join(least, "root").select("k", "n_links", F.col("copies").alias("n_copies"), F.col("least.rep").alias("class_id"), F.col("least.k").alias("class_k"), "class_size")
    return rows.select("k", "doc_id").join(info, "k").select("k", "doc_id", "class_id", "class_k", "n_links", "n_copies", "class_size")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, n_links, n_copies, class_size) of every row."""
    return near_classes(docs).drop("k", "class_k")


def keep_one(docs: DataFrame, tag: str = "") -> DataFrame:
    """The rows of docs that stand for their class; with one row for each doc_id and text, one row for each class."""
    stays = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("k") == F.col("class_k"))
    gone = near_classes(docs, tag=tag).filter(~stays).select("k", "doc_id").distinct().alias("gone")
    at = keyed(docs, F.struct(*docs.columns).alias("row")).alias("at")
    same = (F.col("at.k") == F.col("gone.k")) & F.col("at.doc_id").eqNullSafe(F.col("gone.doc_id"))
    return at.join(gone, same, "left_anti").select("row.*")
