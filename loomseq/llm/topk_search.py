"""Exact top-k search by inner product with M-trees.

Vectors are quantised to integers, floor(256 x). With one more coordinate, sqrt(M - |x|^2) for candidates (M the greatest
squared norm of all) and 0 for queries, the largest inner product is the smallest Euclidean distance, so a metric tree finds
it: |q - x|^2 = |q|^2 + M - 2 q.x.

Candidates are dealt out by a hash; each shard becomes an M-tree of paged nodes: a page holds at most PAGE entries, an entry
its routing vector, covering radius and distance to the routing vector of its page. A query goes best-first through the
pages in the order of the least possible distance. By the triangle inequality |d(q, parent) - d(parent, entry)| - radius
bounds an entry's distance from below without computing it; entries and pages beyond the k-th best are left out. Bounds carry
a slack for rounding; scores are exact integers, and ties go to the smaller id.

Trees are built once and stored by shard. Queries are dealt out in blocks; every block meets every shard, one shard in
memory at a time, and the k best of each shard are merged.

Defined results: vectors that are null, empty, or hold null or non-finite components take no part; vectors of each length are
searched on their own, as there is no product across lengths; where squared norms reach 2^53, products are not whole in floating point, so
vectors of that length are compared in Python's integers, all of them, and a score that a long can't hold is null (its rank is right); where
a query's id repeats, the least of its vectors that take part is the query; repeated rows are candidates of their own except that rows with
the query's own id are never its results; with fewer than k candidates all are returned; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import heapq
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import groups, written

PAGE, SHARD_ROWS, BLOCK_QUERIES = 192, 8192, 1024
SLACK = 1e-3
NINES = str.maketrans("0123456789", "9876543210")


def taking_part(vectors: DataFrame) -> DataFrame:
    """(vec_id, x array<double>, dim) of the vectors that take part."""
    x = F.col("embedding")
    fit = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < F.lit(float("inf"))))
    ok = vectors.filter(F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0)).filter(fit)
    return ok.select(F.col("vec_id").cast("long").alias("vec_id"), x.cast("array<double>").alias("x"), F.size(x).alias("dim"))


def whole(x: np.ndarray, exact: bool) -> np.ndarray:
    """floor(256 x) as whole 64-bit floats, or as Python's integers."""
    if not exact:
        return np.floor(x * 256)
    return np.array([int(v) * 256 if abs(v) > 2.0**60 else int(np.floor(v * 256)) for v in x.ravel().tolist()], object).reshape(x.shape)


def _sortable(score: int) -> str:
    """A text that sorts as the number does, whatever its length."""
    digits = str(abs(score))
    if score >= 0:
        return f"1{len(digits):04d}{digits}"
    return f"0{9999 - len(digits):04d}{digits.translate(NINES)}"


class Scan:
    """Every product of a shard in Python's integers, where floating point can't hold them."""

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        self.ids, self.rows = ids.tolist(), points

    def search(self, query: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
        score = (self.rows * query).sum(1).tolist()
        return sorted(((s, i) for s, i in zip(score, self.ids, strict=True) if i != own), key=lambda x: (-x[0], x[1]))[:k]


class Tree:
    """pages: (routing vectors, radii, distances to the page's own routing vector, children or row numbers)"""

    def __init__(self, ids: np.ndarray, points: np.ndarray, norms: np.ndarray, top: float, page: int = PAGE):
        lift = np.sqrt(np.maximum(top - norms, 0.0))
        self.ids, self.rows, self.top = ids, points, top
        self.points = np.concatenate([self.rows, lift[:, None]], 1)
        self.pages: list[tuple] = []
        self.page = page
        self.root = self._build(np.arange(len(ids)), None)

    def _build(self, rows: np.ndarray, centre) -> int:
        x = self.points[rows]
        far = lambda c, y: np.zeros(len(y)) if c is None else np.sqrt(((y - c) ** 2).sum(1))
        if len(rows) <= self.page:
            self.pages.append((True, x, np.zeros(len(rows)), far(centre, x), rows))
            return len(self.pages) - 1
        at, radius, child = [], [], []
        for mine in self._parts(rows, min(self.page, -(-len(rows) // self.page))):
            y = self.points[mine]
            middle = y[((y - y.mean(0)) ** 2).sum(1).argmin()]  # the routing vector: the one nearest to the mean
            at.append(middle)
            radius.append(np.sqrt(((y - middle) ** 2).sum(1).max()))
            child.append(self._build(mine, middle))
        at = np.array(at)
        self.pages.append((False, at, np.array(radius), far(centre, at), np.array(child)))
        return len(self.pages) - 1

    def _parts(self, rows: np.ndarray, parts: int) -> list[np.ndarray]:
        """So many parts of about equal size, each by halving along the line between two far points; so pages are well filled."""
        if parts <= 1:
            return [rows]
        x = self.points[rows]
        a = x[((x - x[0]) ** 2).sum(1).argmax()]
        b = x[((x - a) ** 2).sum(1).argmax()]
        order = np.argsort(x @ (b - a), kind="stable")
        left = parts // 2
        cut = len(rows) * left // parts
        return self._parts(rows[order[:cut]], left) + self._parts(rows[order[cut:]], parts - left)

    def search(self, query: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
        """The k best (score, vec_id), best first."""
        q = np.append(query, 0.0)
        whole = float((query * query).sum()) + self.top  # |q|^2 + M
        best: list[tuple[int, int]] = []  # heap of (score, -vec_id), the worst first
        limit = np.inf
        queue: list[tuple[float, int, float]] = [(0.0, self.root, -1.0)]
        while queue:
            low, number, to_centre = heapq.heappop(queue)
            if low > limit:
                break
            leaf, at, radius, to_parent, below = self.pages[number]
            if to_centre >= 0:
                use = np.flatnonzero(np.abs(to_centre - to_parent) - radius <= limit)
                if len(use) == 0:
                    continue
            else:
                use = np.arange(len(at))
            if leaf:
                rows = below[use]
                score = self.rows[rows] @ query  # whole numbers below 2^53, so exact
                if len(best) == k:
                    near = np.flatnonzero(score >= best[0][0])
                else:
                    near = np.lexsort((self.ids[rows], -score))
                for i in near.tolist():
                    item = (int(score[i]), -int(self.ids[rows[i]]))
                    if -item[1] == own:
                        continue
                    if len(best) < k:
                        heapq.heappush(best, item)
                    elif item > best[0]:
                        heapq.heapreplace(best, item)
                if len(best) == k:
                    limit = np.sqrt(max(whole - 2 * best[0][0], 0.0)) + SLACK
                continue
            d = np.sqrt(((at[use] - q) ** 2).sum(1))
            lower = np.maximum(d - radius[use], 0)
            for i in np.flatnonzero(lower <= limit):
                heapq.heappush(queue, (float(lower[i]), int(below[use[i]]), float(d[i])))
        return sorted(((s, -i) for s, i in best), key=lambda x: (-x[0], x[1]))


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, tag: str = "") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each query row. Both tables: vec_id, embedding."""
    return _search(taking_part(vectors), taking_part(queries), k, tag)


def _search(base: DataFrame, asked: DataFrame, k: int, tag: str) -> DataFrame:
    spark = base.sparkSession
    squares = F.aggregate("x", F.lit(0.0), lambda a, v: a + F.floor(v * 256).cast("double") * F.floor(v * 256).cast("double"))
    large = F.exists("x", lambda v: F.abs(v) > 2.0**30)  # floor would not fit a long, and its square is beyond the bound anyway
    norm = F.when(large, float("inf")).otherwise(squares)
    stats = base.groupBy("dim").agg(F.count("*").alias("rows"), F.max(norm).alias("top")).orderBy("dim").collect()
    wanted = {r.dim: (r.n, r.top) for r in asked.groupBy("dim").agg(F.count("*").alias("n"), F.max(norm).alias("top")).collect()}
    schema = "query_id long, rank int, vec_id long, score long"
    first, lengths, tops = 0, [], {}
    for r in stats:
        if r.dim in wanted:
            shards, blocks = -(-r.rows // SHARD_ROWS), -(-wanted[r.dim][0] // BLOCK_QUERIES)
            lengths.append((r.dim, first, shards, blocks))
            tops[r.dim] = float(r.top) if max(r.top, wanted[r.dim][1]) < 1 << 53 else None
            first += shards
    if not lengths:
        return spark.createDataFrame([], schema)
    plan = spark.createDataFrame(lengths, "dim int, first int, shards int, blocks int")  # one row for each length of vectors

    def build(batches):
        for (s, dim), t in groups(batches, ["shard", "dim"]):
            top, ids = tops[dim], t.column("vec_id").to_numpy()
            x = whole(t.column("x").combine_chunks().flatten().to_numpy().reshape(-1, dim), top is None)
            tree = Scan(ids, x) if top is None else Tree(ids, x, (x * x).sum(1), top)
            yield pa.record_batch([pa.array([s], pa.int32()), pa.array([dim], pa.int32()), pa.array([pickle.dumps(tree, 5)], pa.binary())], names=["shard", "dim", "tree"])

    dealt = base.join(F.broadcast(plan), "dim").select((F.col("first") + F.pmod(F.xxhash64("vec_id", "x"), F.col("shards"))).cast("int").alias("shard"), "dim", "vec_id", "x")
    trees = written(dealt.repartition(first, "shard").sortWithinPartitions("shard").mapInArrow(build, "shard int, dim int, tree binary"), "trees", tag)
    block = asked.join(F.broadcast(plan), "dim").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    meet = block.select("dim", "block", "vec_id", "x", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("shards") - 1)).alias("shard"), F.lit(None).cast("binary").alias("tree"))
    here = trees.join(F.broadcast(plan), "dim").select("dim", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(None).cast("long").alias("vec_id"), F.lit(None).cast("array<double>").alias("x"), "shard", "tree")

    def ask(batches):
        for (_, _, dim), t in groups(batches, ["shard", "block", "dim"]):
            trees = [x for x in t.column("tree").to_pylist() if x is not None]
            mine = t.filter(pa.compute.is_valid(t.column("vec_id")))
            if not trees or not mine.num_rows:
                continue
            tree, out = pickle.loads(trees[0]), []
            q = whole(mine.column("x").combine_chunks().flatten().to_numpy().reshape(-1, dim), tops[dim] is None)
            for own, x in zip(mine.column("vec_id").to_pylist(), q, strict=True):
                out += [(own, i, s) for s, i in tree.search(x, own, k)]
            kept = [o[2] if abs(o[2]) < 1 << 63 else None for o in out]
            yield pa.record_batch([*(pa.array(v, pa.int64()) for v in ([o[0] for o in out], [o[1] for o in out], kept)), pa.array([_sortable(o[2]) for o in out], pa.string())], names=["query_id", "vec_id", "score", "order"])

    met = meet.unionByName(here).repartition(sum(s * b for _, _, s, b in lengths), "shard", "block").sortWithinPartitions("shard", "block")
    found = met.mapInArrow(ask, "query_id long, vec_id long, score long, order string")
    best = Window.partitionBy("query_id").orderBy(F.desc("order"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_five(vectors: DataFrame) -> DataFrame:
    fit = taking_part(vectors)
    asked = fit.filter("vec_id % 50 = 0").groupBy("vec_id").agg(F.min("x").alias("x")).withColumn("dim", F.size("x"))
    return _search(fit, asked, 5, "topk")


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS q FROM embeddings),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""
