"""Exact duplicates by progressive refinement.

Rows are grouped by the byte length of the normalised text, then by a hash of its first bytes, and only groups that still
hold several rows are compared by the hash of the full content. Texts are equal when identical after lower-casing A to Z.
Groups travel as narrow rows (ids and hashes), are summed before they are shuffled, and the texts themselves never move.

Defined results: null counts as the empty text, and all empty texts are one group; of a group the row with the largest
doc_id stays (a null doc_id is the smallest); of repeated rows with that doc_id exactly one stays; extra columns are
untouched, whatever their names; an empty table gives an empty result. ``exact_dedup`` names a row by two hashes of its hashable
columns, so it doesn't matter in which order the source is read again; rows equal in all of them are one row said twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, written

PREFIX = 64
UID = "_loom_uid"


def _keys(text) -> list:
    return [F.octet_length(text).alias("n"), F.xxhash64(F.substring(text, 1, PREFIX)).alias("p")]


def _several(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Those rows that are not alone with their keys."""
    return rows.join(rows.groupBy(*keys).agg(F.count("*").alias("rows")).filter("rows > 1").select(*keys), keys, "left_semi")


def exact_groups(docs: DataFrame, tag: str = "") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, sha) of every row. As the digest of every row is wanted, one reading gives it with the
    keys, and what that reading returns is written once."""
    text = lower_ascii(F.col("text"))
    narrow = written(docs.select(F.monotonically_increasing_id().alias(UID), "doc_id", *_keys(text), F.unhex(F.sha2(text, 256)).alias("sha")), "narrow", tag)
    left = _several(narrow, ["n", "p"])
    groups = left.groupBy("sha").agg(F.count("*").alias("group_size"), F.max(F.struct("doc_id", UID)).alias("best")).filter("group_size > 1")
    several = left.join(groups, "sha").select(UID, "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best." + UID).alias("keep_uid"))
    out = narrow.join(several, UID, "left")
    alone = F.col("group_size").isNull()
    kept = alone | (F.col("keep_uid") == F.col(UID))
    return out.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), kept.alias("kept"), "sha")


def _fingerprint(docs: DataFrame):
    """Two hashes of a row; which columns are null is hashed as well."""
    cols = [F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]
    nulls = [c.isNull() for c in cols]
    return F.struct(F.xxhash64(*cols, *nulls).alias("a"), F.xxhash64(F.lit(1), *cols, *nulls).alias("b"))


def exact_dedup(docs: DataFrame, tag: str = "") -> DataFrame:
    """The rows of docs that stay, with all their columns: refined by length, then by prefix; only what is left is hashed whole."""
    uid, text = _fingerprint(docs), lower_ascii(F.col("text"))
    narrow = written(docs.select(uid.alias("uid"), *_keys(text)), "narrow", tag)
    left = written(_several(_several(narrow, ["n"]), ["n", "p"]).select("uid").distinct(), "left", tag)
    full = docs.select(uid.alias("uid"), "doc_id", text.alias("t")).join(left, "uid", "left_semi").select("uid", "doc_id", F.unhex(F.sha2("t", 256)).alias("sha"))
    full = written(full.groupBy("uid", "doc_id", "sha").agg(F.count("*").alias("rows")), "full", tag)
    groups = full.groupBy("sha").agg(F.sum("rows").alias("size"), F.max(F.struct("doc_id", "uid")).alias("best")).filter("size > 1")
    decided = full.join(groups, "sha").select("uid", (F.col("uid") != F.col("best.uid")).alias("gone"), (F.col("rows") > 1).alias("repeated"))
    decided = written(decided.filter("gone or repeated"), "decided", tag)
    # the same join at every size: small tables are not broadcast instead
    rows = docs.select(F.struct(*docs.columns).alias("row"), uid.alias("uid")).join(decided.hint("merge"), "uid", "left").filter("gone is null or not gone")
    kept = rows.filter("repeated is null or not repeated").select("row").unionAll(rows.filter("repeated").dropDuplicates(["uid"]).select("row"))
    return kept.select("row.*")


def exact_digest(docs: DataFrame) -> DataFrame:
    return exact_groups(docs).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


ORACLE = """
WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""
