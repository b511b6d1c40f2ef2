"""Codes of vectors: each vector is cut into equal parts, and a part becomes the number of the nearest entry of its codebook.

Components are whole numbers, floor(SCALE * x). Codebooks start as the parts of the vectors with the smallest ids and are refined by rounds
of Lloyd's algorithm: every part goes to its nearest entry, ties to the lower number, and each entry becomes the mean of its
parts, floored.

A round looks at few distances, after Elkan: for each part its upper bound on the distance to its own entry, and one lower bound
for each entry, are kept from round to round, moved by what the entry moved. An entry is left out only where a bound is strictly
on the safe side: the upper bound is below the entry's lower bound, or below half the distance between the two entries. Bounds are
rounded outwards, and what they do not settle is decided by whole squared distances, so codes are exact.

Vectors lie in blocks of rows that are written with their bounds once in a round; the sums of a round are columns of the
same rows. Only the codebooks (ENTRIES times the length of a vector) meet in the driver.

Defined results: vectors that are null or hold null or non-finite components are left out; vectors of another length have
codebooks of their own; a length that PARTS does not divide has no equal parts, so its rows have no code; an empty vector has the
code of zeros; of equal ids the lesser vector comes first, null ids last; with fewer vectors than entries there are fewer
entries; an error that a long can't hold is null, and so is a sum with it; repeated rows are rows of their own; columns that are not named
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import release, written

PARTS, ENTRIES, ROUNDS, SCALE, ROWS = 8, 16, 6, 4096, 4096
#: Digits of the sums that one column holds, so that sums of sums fit a long.
LIMB = 30
STATE = "dim int, keys array<long>, labels array<string>, x binary, code binary, upper binary, lower binary, sums array<long>"


def kept(vectors: DataFrame, label: str | None = None) -> DataFrame:
    """(key, label, dim, x) of the vectors that take part."""
    x = F.col("embedding")
    fit = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < F.lit(float("inf"))))
    return vectors.filter(x.isNotNull() & fit).select(F.col("vec_id").cast("long").alias("key"), (F.col(label) if label else F.lit(None)).cast("string").alias("label"), F.size(x).alias("dim"), x.cast("array<double>").alias("x"))


def whole(x: np.ndarray) -> np.ndarray:
    """floor(SCALE * x), as 64-bit integers where squared distances fit, as Python's integers elsewhere."""
    with np.errstate(over="ignore"):
        y = np.floor(x * SCALE)
    if x.size and not (np.abs(y).max() < 2.0**26):
        return np.array([int(v) * SCALE if abs(v) > 2.0**60 else int(np.floor(v * SCALE)) for v in x.ravel().tolist()], object).reshape(x.shape)
    return y.astype(np.int64)


def _up(x):
    return np.nextafter(x.astype(np.float32), np.float32(np.inf))


def _down(x):
    return np.maximum(np.nextafter(x.astype(np.float32), np.float32(-np.inf)), np.float32(0))


def _root(square: np.ndarray) -> np.ndarray:
    return np.sqrt(square.astype(np.float64))


def _assign_exactly(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, squared distances) with every distance computed."""
    best, code = None, np.zeros(len(x), np.int64)
    for j in range(len(entries)):
        d = ((x - entries[j]) ** 2).sum(1)
        if best is None:
            best = d
        else:
            less = (d < best).astype(bool)
            best, code = np.where(less, d, best), np.where(less, j, code)
    return code, best


def assign(x: np.ndarray, entries: np.ndarray, code: np.ndarray, upper: np.ndarray, lower: np.ndarray, moved: np.ndarray | None, looked: list | None = None) -> None:
    """One round for one part of (n, width) vectors; code, upper (n) and lower (n, entries) are brought up to date in place. moved: how far each
    entry went since the last round, None in the first. looked: gets the number of distances computed."""
    k = len(entries)
    if moved is not None:
        upper[:] = _up(upper + moved[code])
        lower[:] = _down(lower.astype(np.float64) - moved)
    between = _root(((entries[:, None] - entries[None]) ** 2).sum(2)) / 2 * (1 - 1e-12)
    np.fill_diagonal(between, np.inf)
    half = between.astype(np.float64)
    rows = np.flatnonzero(upper >= half.min(1)[code])
    if len(rows) == 0:
        return
    y, own = x[rows], code[rows].astype(np.int64)
    best = ((y - entries[own]) ** 2).sum(1)
    high = _up(_root(best))
    open_ = (high[:, None] >= lower[rows]) & (high[:, None] >= half[own])
    open_[np.arange(len(rows)), own] = False
    found, bounds = own.copy(), lower[rows]
    bounds[np.arange(len(rows)), own] = _down(_root(best))
    n = len(rows)
    for j in range(k):
        at = np.flatnonzero(open_[:, j])
        if len(at) == 0:
            continue
        d = ((y[at] - entries[j]) ** 2).sum(1)
        n += len(at)
        bounds[at, j] = _down(_root(d))
        nearer = (d < best[at]) | ((d == best[at]) & (j < found[at]))
        at = at[nearer]
        best[at], found[at] = d[nearer], j
    code[rows], upper[rows], lower[rows] = found, _up(_root(best)), bounds
    if looked is not None:
        looked.append(n)


def _sums(x: np.ndarray, code: np.ndarray, entries: int, limbs: int) -> np.ndarray:
    """For each entry the number of its rows and the sums of their components, in limbs from the low one: (entries, 1 + width * limbs)."""
    out = np.zeros((entries, 1 + x.shape[1] * limbs), np.int64)
    for j in range(entries):
        mine = x[code == j]
        out[j, 0] = len(mine)
        s = mine.sum(0)
        for k in range(limbs):
            out[j, 1 + k * x.shape[1] : 1 + (k + 1) * x.shape[1]] = (s & ((1 << LIMB) - 1) if k < limbs - 1 else s) if len(mine) else 0
            s = s >> LIMB
    return out


class Books:
    """The codebooks of one length of vectors: entries[part] is (entries, width)."""

    def __init__(self, entries: list[np.ndarray], limbs: int, before: list[np.ndarray] | None = None):
        self.entries, self.limbs, self.moved = entries, limbs, None
        if before is not None and self.entries[0].dtype != object:
            self.moved = [_root(((a - b) ** 2).sum(1)) * (1 + 1e-12) for a, b in zip(entries, before, strict=True)]

    def refined(self, sums: np.ndarray) -> Books:
        """sums: (parts, entries, 1 + width * limbs)"""
        out = []
        for e, s in zip(self.entries, sums, strict=True):
            width, rows = e.shape[1], []
            for old, r in zip(e.tolist(), s.tolist(), strict=True):
                rows.append([sum(r[1 + k * width + i] << LIMB * k for k in range(self.limbs)) // r[0] for i in range(width)] if r[0] else old)
            out.append(np.array(rows, e.dtype).reshape(e.shape))
        return Books(out, self.limbs, self.entries)

    def digest(self) -> str:
        return sha256(",".join(str(v) for e in self.entries for v in e.ravel().tolist()).encode()).hexdigest()


def _start(base: DataFrame) -> dict[int, Books]:
    """The first codebooks, by length. Sums of so many limbs hold any number of rows of the greatest component."""
    cut = base.filter(f"dim % {PARTS} = 0")
    first = cut.withColumn("r", F.row_number().over(Window.partitionBy("dim").orderBy(F.col("key").asc_nulls_last(), "x"))).filter(F.col("r") <= ENTRIES)
    most = {r.dim: r.most for r in cut.groupBy("dim").agg(F.max(F.when(F.size("x") > 0, F.array_max(F.transform("x", lambda v: F.abs(v))))).alias("most")).collect()}
    rows: dict[int, list] = {}
    for r in first.select("dim", "r", "x").orderBy("dim", "r").collect():
        rows.setdefault(r.dim, []).append(r.x)
    out = {}
    for dim, xs in rows.items():
        y = whole(np.array(xs, np.float64).reshape(len(xs), dim))
        bits = int(most[dim] or 0).bit_length() + 13
        if bits > 26 or 2 * (bits + 1) + dim.bit_length() > 62:  # squared distances may pass a long: all of them in Python's integers
            y = y.astype(object)
        out[dim] = Books([y[:, p * dim // PARTS : (p + 1) * dim // PARTS] for p in range(PARTS)], -(-(bits + 42) // LIMB))
    return out


def _blocks(base: DataFrame):
    """Rows of one length gathered into blocks; nothing is shuffled for it."""
    def gather(batches):
        held: dict[int, list] = {}
        for b in batches:
            dims = b.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                mine = b.filter(pa.array(dims == dim))
                x = pa.compute.list_flatten(mine.column("x")).to_numpy().reshape(mine.num_rows, dim)
                held.setdefault(dim, []).append((mine.column("key"), mine.column("label"), x))
                if sum(len(h[0]) for h in held[dim]) * max(1, dim) >= ROWS * 64:
                    yield _block(dim, held.pop(dim))
        for dim, mine in held.items():
            yield _block(dim, mine)

    return base.mapInArrow(gather, STATE)


def _block(dim: int, held: list) -> pa.RecordBatch:
    """Vectors are kept as 32-bit numbers where these are the same."""
    keys, labels = (sum((h[k].to_pylist() for h in held), []) for k in (0, 1))
    x = np.concatenate([h[2] for h in held])
    with np.errstate(over="ignore"):
        narrow = x.astype(np.float32)
    return _row([dim, keys, labels, (narrow if (narrow == x).all() else x).tobytes(), None, None, None, None])


def _vectors(raw: bytes, n: int, dim: int) -> np.ndarray:
    return whole(np.frombuffer(raw, np.float32 if len(raw) == 4 * n * dim else np.float64).reshape(n, dim).astype(np.float64))


def _row(values: list) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.list_(pa.int64()), pa.list_(pa.string()), *[pa.binary()] * 4, pa.list_(pa.int64())]
    names = ["dim", "keys", "labels", "x", "code", "upper", "lower", "sums"]
    return pa.record_batch([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names)


def _round(state: DataFrame, books: dict[int, Books]) -> DataFrame:
    def step(batches):
        for b in batches:
            for i in range(b.num_rows):
                dim, keys, labels, raw, code, upper, lower, _ = (b.column(c)[i].as_py() for c in b.schema.names)
                book = books.get(dim)
                if book is None:
                    yield _row([dim, keys, labels, raw, None, None, None, None])
                    continue
                n, k = len(keys), len(book.entries[0])
                x = _vectors(raw, n, dim)
                exact = book.entries[0].dtype == object
                code = np.zeros((PARTS, n), np.uint8) if code is None else np.frombuffer(code, np.uint8).reshape(PARTS, n).copy()
                upper = np.full((PARTS, n), np.inf, np.float32) if upper is None else np.frombuffer(upper, np.float32).reshape(PARTS, n).copy()
                lower = np.zeros((PARTS, n, k), np.float32) if lower is None else np.frombuffer(lower, np.float32).reshape(PARTS, n, k).copy()
                sums = []
                for p, entries in enumerate(book.entries):
                    y = x[:, p * dim // PARTS : (p + 1) * dim // PARTS]
                    if exact:
                        code[p] = _assign_exactly(y.astype(object), entries)[0]
                    else:
                        assign(y, entries, code[p], upper[p], lower[p], book.moved and book.moved[p])
                    sums.append(_sums(y, code[p], k, book.limbs))
                bounds = [None, None] if exact else [upper.tobytes(), lower.tobytes()]
                yield _row([dim, keys, labels, raw, code.tobytes(), *bounds, np.array(sums).ravel().tolist()])

    return state.mapInArrow(step, STATE)


def _refine(state: DataFrame, books: dict[int, Books]) -> dict[int, Books]:
    """Sums of the blocks' sums, place by place; a codebook's numbers are all that comes to the driver."""
    def add(batches):
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for dim, s in zip(b.column("dim").to_pylist(), b.column("sums"), strict=True):
                if s.is_valid:
                    v = s.values.to_numpy()
                    held[dim] = held[dim] + v if dim in held else v.copy()
        for dim, v in held.items():
            yield pa.record_batch([pa.array([dim] * len(v), pa.int32()), pa.array(range(len(v)), pa.int32()), pa.array(v, pa.int64())], names=["dim", "place", "v"])

    total = state.select("dim", "sums").mapInArrow(add, "dim int, place int, v long").groupBy("dim", "place").agg(F.sum("v").alias("v")).collect()
    sums = {dim: np.zeros(PARTS * len(b.entries[0]) * (1 + b.entries[0].shape[1] * b.limbs), np.int64) for dim, b in books.items()}
    for r in total:
        sums[r.dim][r.place] = r.v
    return {dim: b.refined(sums[dim].reshape(PARTS, len(b.entries[0]), -1)) for dim, b in books.items()}


def encode(vectors: DataFrame, label: str | None = None, rounds: int = ROUNDS, tag: str = "codes") -> tuple[DataFrame, dict[int, Books]]:
    """((key, label, dim, code, error) of each vector that takes part, the final codebooks by length); code: the entries' numbers in order of
    the parts, two hex digits each; error: squared distances, summed over parts."""
    spark = vectors.sparkSession
    base = kept(vectors, label)
    books = _start(base)
    state = written(_blocks(base), "blocks", f"{tag}0")
    for k in range(1, rounds + 2):
        state = written(_round(state, books), f"round{k}", f"{tag}{k % 2 + 1}")
        release(spark, f"{tag}{(k + 1) % 2 + 1}" if k > 1 else f"{tag}0")  # the round before has been read
        if k <= rounds:
            books = _refine(state, books)

    def out(batches):
        for b in batches:
            for i in range(b.num_rows):
                dim, keys, labels, raw, code = (b.column(c)[i].as_py() for c in ("dim", "keys", "labels", "x", "code"))
                n, book = len(keys), books.get(dim)
                if book is None:
                    codes = errors = [None] * n
                else:
                    x, code = _vectors(raw, n, dim), np.frombuffer(code, np.uint8).reshape(PARTS, n)
                    error = sum(((x[:, p * dim // PARTS : (p + 1) * dim // PARTS].astype(e.dtype) - e[code[p]]) ** 2).sum(1) for p, e in enumerate(book.entries))
                    codes, errors = [c.tobytes().hex() for c in np.ascontiguousarray(code.T)], [e if e < 1 << 63 else None for e in error.tolist()]
                yield pa.record_batch([pa.array(v, t) for v, t in ((keys, pa.int64()), (labels, pa.string()), ([dim] * n, pa.int32()), (codes, pa.string()), (errors, pa.int64()))], names=["key", "label", "dim", "code", "error"])

    return state.select("dim", "keys", "labels", "x", "code").mapInArrow(out, "key long, label string, dim int, code string, error long"), books


def vector_codes(vectors: DataFrame, tag: str = "codes") -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256)"""
    spark = vectors.sparkSession
    for k in range(4):
        release(spark, f"{tag}{k}")
    coded, books = encode(vectors, "label", tag=tag)
    coded = written(coded, "coded", f"{tag}3")
    sums = coded.groupBy("label").agg(F.try_sum(F.when(F.col("error").isNotNull(), F.col("error").cast("decimal(38,0)"))).alias("total"), F.count(F.when(F.col("error").isNull(), 1)).alias("open"))
    sums = sums.select(F.col("label").alias("of"), F.when(F.col("open") == 0, F.col("total")).try_cast("long").alias("label_error"))
    digests = F.lit(None).cast("string")
    for dim, book in books.items():
        digests = F.when(F.col("dim") == dim, book.digest()).otherwise(digests)
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of")), "left").select(F.col("key").alias("vec_id"), "code", "error", "label_error", digests.alias("codebooks_sha256"))


def oracle(rounds: int = ROUNDS) -> str:
    """SQL of the same rounds, every distance computed."""
    ctes = [f"""k AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
            f"x AS MATERIALIZED (SELECT vec_id, p, q[p * len(q) // {PARTS} + 1 : (p + 1) * len(q) // {PARTS}] AS v FROM k, (SELECT unnest(range({PARTS})) AS p))",
            f"b0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, v AS c FROM x QUALIFY e < {ENTRIES})"]
    for r in range(rounds + 1):
        ctes.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, p, v, min(ROW(d, e)) AS best FROM (SELECT vec_id, x.p, v, e,
  list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM x JOIN b{r} b ON b.p = x.p) GROUP BY vec_id, p, v)""")
        if r < rounds:
            ctes.append(f"""b{r + 1} AS MATERIALIZED (SELECT p, e, coalesce(list(n ORDER BY i) FILTER (n IS NOT NULL), any_value(c)) AS c FROM (
  SELECT b.p, b.e, any_value(b.c) AS c, s.i, sum(s.y) AS t, count(s.y) AS m, CAST(sum(s.y) // count(s.y) AS BIGINT) - CASE WHEN sum(s.y) % count(s.y) < 0 THEN 1 ELSE 0 END AS n
  FROM b{r} b LEFT JOIN (SELECT p, best[2] AS e, unnest(v) AS y, generate_subscripts(v, 1) AS i FROM a{r}) s ON s.p = b.p AND s.e = b.e GROUP BY b.p, b.e, s.i) GROUP BY p, e)""")
    return "WITH " + ",\n".join(ctes) + f""",
books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds}),
coded AS (SELECT vec_id, string_agg(printf('%02x', best[2]), '' ORDER BY p) AS code, CAST(sum(best[1]) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded JOIN k USING (vec_id) CROSS JOIN books
"""
