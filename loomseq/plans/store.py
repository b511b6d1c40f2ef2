"""Queries of the packed store and of words over any letters; documents are sequences in which y and z stand for N and R."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..adapters import LETTERS, sequences, texts
from ..operators import anywords
from ..sources import packed

MIXED = "ACGTACGTACGTACGTACGTACGTNR"
DSQ = f"dsq AS (SELECT doc_id AS oid, translate(lower(regexp_replace(text, '[^A-Za-z]', '', 'g')), '{LETTERS}', '{MIXED}') AS seq, CAST(regexp_extract(source, '([0-9]+)', 1) AS INTEGER) + 1 AS tax_id FROM documents)"


_SMALL = (LETTERS + LETTERS.upper()).encode()
_TO, _GONE = bytes.maketrans(_SMALL, 2 * MIXED.encode()), bytes(c for c in range(256) if c not in _SMALL)


def mixed_of(text: bytes) -> bytes:
    return text.translate(_TO, _GONE)


def mixed(s, d):
    return sequences(texts(s, d), mixed_of, "seq")


def hash_sql(x: str) -> str:
    """scalars.hash64 of an unsigned 64-bit expression."""
    wide = lambda e, k: f"CAST((CAST({e} AS UHUGEINT) * {k}) % 18446744073709551616 AS UBIGINT)"
    x = f"CAST((CAST({x} AS UHUGEINT) + 11400714819323198485) % 18446744073709551616 AS UBIGINT)"
    x = wide(f"xor({x}, {x} >> 30)", 13787848793156543929)
    x = wide(f"xor({x}, {x} >> 27)", 10723151780598845931)
    return f"xor({x}, {x} >> 31)"


SALT = f"xor({hash_sql('CAST(length(seq) AS UBIGINT)')}, {hash_sql('CAST(CAST(' + chr(39) + '0x' + chr(39) + ' || md5(seq)[1:15] AS BIGINT) AS UBIGINT)')})"
DRAWN = f"salted AS (SELECT *, {SALT} AS salt FROM dsq)"
RANGES = "asks AS (SELECT oid * 4 + k AS ask, oid, CASE k WHEN 0 THEN 1 WHEN 1 THEN 1 + oid * 7 % n ELSE 1 + oid * 131 % n END AS pos, CASE k WHEN 0 THEN n WHEN 1 THEN least(100 + oid % 900, n - oid * 7 % n) ELSE 1 END AS len FROM (SELECT oid, length(seq) AS n FROM dsq WHERE length(seq) > 0), (SELECT unnest([0, 1, 2]) AS k))"
FETCH = f"WITH {DSQ}, {RANGES} SELECT ask, length(t) AS n, md5(t) AS digest FROM (SELECT ask, substring(seq, pos, len) AS t FROM asks JOIN dsq USING (oid))"
_PLACE = hash_sql("xor(CAST(i - 1 AS UBIGINT), salt)")
CODES = f"WITH {DSQ}, {DRAWN}, l AS (SELECT oid, salt, unnest(string_split(seq, '')) AS c, generate_subscripts(string_split(seq, ''), 1) AS i FROM salted WHERE length(seq) > 0) SELECT oid, CAST({_PLACE} & 3 AS INTEGER) AS code, count(*) AS n FROM l WHERE c IN ('N', 'R') GROUP BY 1, 2"
BITS = f"lettered AS (SELECT oid, tax_id, array_to_string(list_transform(string_split(seq, ''), lambda c, i: CASE WHEN c IN ('A', 'G') THEN 'A' WHEN c IN ('C', 'T') THEN 'C' WHEN {_PLACE} & 1 = 1 THEN 'C' ELSE 'A' END), '') AS seq FROM salted WHERE length(seq) > 0)"


def _fetch(s, d):
    seqs = mixed(s, d)
    n, oid = F.length("seq").cast("long"), F.col("oid")
    ask = lambda k, pos, size: F.struct((oid * 4 + k).alias("ask"), pos.cast("long").alias("pos"), size.cast("long").alias("len"))
    some = F.array(ask(0, F.lit(1), n), ask(1, 1 + oid * 7 % n, F.least(100 + oid % 900, n - oid * 7 % n)), ask(2, 1 + oid * 131 % n, F.lit(1)))
    asks = seqs.filter("length(seq) > 0").select("oid", F.explode(some).alias("x")).select("oid", "x.*")
    return packed.fetch(packed.pack(seqs.select("oid", "seq")), asks).select("ask", F.length("text").cast("long").alias("n"), F.md5("text").alias("digest"))


def _codes(s, d):
    """What the store holds where letters are drawn, read by their byte."""
    odd = packed.pack(mixed(s, d).select("oid", "seq")).select("oid", "packed", F.explode("odd").alias("r"))
    at = odd.select("oid", "packed", F.explode(F.sequence(F.col("r.at"), F.col("r.at") + F.col("r.len") - 1)).alias("at"))
    byte = F.conv(F.hex(F.substring("packed", F.floor(F.col("at") / 4).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    code = F.expr("shiftright(byte, 6 - 2 * (at % 4))").bitwiseAND(3)
    return at.withColumn("byte", byte).withColumn("code", code).groupBy("oid", "code").agg(F.count("*").alias("n"))


def register(query) -> None:
    from .queries import word_sql

    query("packed_fetch", FETCH)(_fetch)
    query("two_bit_codes", CODES)(_codes)
    query("words_of_any_letters", f"WITH {DSQ}, {DRAWN}, {BITS}, {word_sql('lettered', stride=11)} SELECT oid, pos, word, flipped FROM w")(
        lambda s, d: anywords.spaced_words(mixed(s, d), stride=11))
