"""Scalar functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: IUPAC codes and their complements.
IUPAC, IUPAC_COMPLEMENT = "-ACMGRSVTWYHKDBNU", "-TGKCYSBAWRDMHVNA"
LOW32 = 0xFFFFFFFF


def _mul64(x: Column, k: int) -> Column:
    """x * k mod 2^64 on longs, without overflow: the low half of x in 16-bit steps."""
    k0, k1, k2, k3 = ((k >> s) & 0xFFFF for s in (0, 16, 32, 48))
    part = lambda s: F.shiftrightunsigned(x, s).bitwiseAND(0xFFFF)
    a0, a1, a2, a3 = (part(s) for s in (0, 16, 32, 48))
    t0 = a0 * k0
    t1 = a1 * k0 + a0 * k1
    t2 = a2 * k0 + a1 * k1 + a0 * k2
    t3 = a3 * k0 + a2 * k1 + a1 * k2 + a0 * k3
    low = t0 + F.shiftleft(t1.bitwiseAND(0xFFFF), 16)
    high = t2 + F.shiftrightunsigned(t1, 16) + F.shiftrightunsigned(low, 32) + F.shiftleft(t3.bitwiseAND(0xFFFF), 16)
    return F.shiftleft(high.bitwiseAND(LOW32), 32).bitwiseOR(low.bitwiseAND(LOW32))


def _add64(x: Column, k: int) -> Column:
    low = x.bitwiseAND(LOW32) + (k & LOW32)
    high = F.shiftrightunsigned(x, 32) + (k >> 32) + F.shiftrightunsigned(low, 32)
    return F.shiftleft(high.bitwiseAND(LOW32), 32).bitwiseOR(low.bitwiseAND(LOW32))


def hash64(x: Column) -> Column:
    """The splitmix finaliser after one golden-ratio step, on longs."""
    x = _add64(x, 0x9E3779B97F4A7C15)
    x = _mul64(x.bitwiseXOR(F.shiftrightunsigned(x, 30)), 0xBF58476D1CE4E5B9)
    x = _mul64(x.bitwiseXOR(F.shiftrightunsigned(x, 27)), 0x94D049BB133111EB)
    return x.bitwiseXOR(F.shiftrightunsigned(x, 31))


def complement(seq: Column) -> Column:
    return F.translate(F.upper(seq), IUPAC, IUPAC_COMPLEMENT)


def reverse_complement(seq: Column) -> Column:
    return F.reverse(complement(seq))


def flip_pos(pos: Column, length: Column) -> Column:
    return 1 - pos - length


def as_pct(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.floor(part / whole * 100 + 0.5)).otherwise(0).cast("long")


def readable(x: Column, unit: str = "bp") -> Column:
    a = F.abs(x)
    return F.when(a >= 1e9, F.concat(F.format_string("%.2f", x / 1e9), F.lit(f" G{unit}"))).when(a >= 1e6, F.concat(F.format_string("%.2f", x / 1e6), F.lit(f" M{unit}"))).when(a >= 1e3, F.concat(F.format_string("%.2f", x / 1e3), F.lit(f" K{unit}"))).otherwise(F.concat(x.cast("string"), F.lit(f" {unit}")))


def parse_ranges(text: Column) -> Column:
    """"a..b,c..d" -> array of (pos, len)."""
    def one(r):
        a, b = F.split(r, r"\.\.")[0].cast("long"), F.split(r, r"\.\.")[1].cast("long")
        return F.struct(a.alias("pos"), (b - a + 1).alias("len"))

    return F.transform(F.split(text, ","), one)


def gene_symbol(description: Column) -> Column:
    return F.regexp_extract(description, r"\[gene=([^\]]*)\]", 1)


def normal_id(defline: Column) -> Column:
    """First word without ">", a leading gi number, a database prefix, and what follows the next bar."""
    x = F.regexp_extract(F.regexp_replace(defline, r"^>\s*", ""), r"^(\S+)", 1)
    x = F.regexp_replace(x, r"^gi\|\d+\|(?=.)", "")
    return F.regexp_replace(F.regexp_replace(x, r"^(?:lcl|ref|gb|emb|dbj|pir|prf|sp|pdb|pat|bbs|gnl\|[^|]*|gim|tpg|tpe|tpd|tr)\|(?=.)", ""), r"\|.*$", "")


def escape_tilde(seq_id: Column) -> Column:
    """Tildes become {TILDE}, but for those of trailing ranges ~a..b or ~~a..b."""
    tail = F.regexp_extract(seq_id, r"((?:~{1,2}\d+\.\.\d+)*)$", 1)
    head = seq_id.substr(F.lit(1), F.length(seq_id) - F.length(tail))
    return F.concat(F.replace(head, F.lit("~"), F.lit("{TILDE}")), tail)


def unescape_tilde(seq_id: Column) -> Column:
    return F.replace(seq_id, F.lit("{TILDE}"), F.lit("~"))


def id_range(seq_id: Column) -> Column:
    """(id, from, to) from an id with a trailing ~a..b or ~~a..b; from and to are null without one. Two ranges add up."""
    outer = F.regexp_extract(seq_id, r"(?<!~)~(\d+)\.\.\d+", 1).try_cast("long")
    a = F.regexp_extract(seq_id, r"~(\d+)\.\.\d+$", 1).try_cast("long")
    b = F.regexp_extract(seq_id, r"~\d+\.\.(\d+)$", 1).try_cast("long")
    inner = seq_id.rlike(r"(?<!~)~\d+\.\.\d+~~\d+\.\.\d+$")
    shift = F.when(inner, outer - 1).otherwise(0)
    return F.struct(F.regexp_replace(seq_id, r"(~{1,2}\d+\.\.\d+)+$", "").alias("id"), (a + shift).alias("from"), (b + shift).alias("to"))


def record_position(seq_id: Column, length: Column) -> Column:
    """(orig_id, start_pos, end_pos, whole, joins_left, joins_right) of a report row: where a part lies in its sequence, and whether a part of
    a part touches the ends of what it is cut from."""
    at = lambda pattern, k: F.regexp_extract(seq_id, pattern, k).try_cast("long")
    outer, inner = r"^[^~]+~(\d+)\.\.(\d+)", r"~~(\d+)\.\.(\d+)$"
    a, b, c, e = at(outer, 1), at(outer, 2), at(inner, 1), at(inner, 2)
    whole, shift = a.isNull() & c.isNull(), F.coalesce(a, F.lit(1)) - 1
    return F.struct(
        F.regexp_extract(seq_id, "^[^~]+", 0).alias("orig_id"), F.when(whole, 1).otherwise(F.coalesce(c + shift, a)).alias("start_pos"),
        F.when(whole, length).otherwise(F.coalesce(e + shift, b)).alias("end_pos"), whole.alias("whole"),
        (a.isNull() | c.isNull() | (c == 1)).alias("joins_left"), (a.isNull() | c.isNull() | (e == b - a + 1)).alias("joins_right"))


def previous_accession(acc: Column) -> Column:
    v = F.split(acc, r"\.")
    return F.concat(v[0], F.lit("."), (v[1].cast("int") - 1).cast("string"))


def reduced_protein(seq: Column) -> Column:
    """Four groups of residues as digits; unknown ones are in group 3."""
    # fixed values: the residues of each group
    groups = {"0": "CFYW*", "1": "MLIV", "2": "GPATSN", "3": "EDHQRK"}
    plain = F.regexp_replace(F.upper(seq), f"[^{''.join(groups.values())}]", "K")
    return F.translate(plain, "".join(groups.values()), "".join(k * len(v) for k, v in groups.items()))


def stride(in_frame: Column, long: Column) -> Column:
    return F.when(in_frame, 18).when(long, 22).otherwise(11)


def in_frame(seq: Column) -> Column:
    stop = F.substring(seq, -3, 3).isin("TAA", "TAG", "TGA")
    return (F.length(seq) % 3 == 0) & seq.startswith("ATG") & stop


def checksums(data: Column) -> Column:
    return F.struct(F.md5(data).alias("md5"), F.sha1(data).alias("sha1"), F.sha2(data, 256).alias("sha256"), F.sha2(data, 512).alias("sha512"))


def effective_fraction(by_div: Column, by_all: Column) -> Column:
    return by_div / F.greatest(by_all, F.lit(1))


def hull(a_pos: Column, a_len: Column, b_pos: Column, b_len: Column) -> Column:
    """(pos, len, overlap, distance) of two intervals: what holds both, what both hold, and the free letters between them (less than
    0 where they overlap)."""
    first, last = F.least(a_pos, b_pos), F.greatest(a_pos + a_len, b_pos + b_len)
    between = F.greatest(a_pos, b_pos) - F.least(a_pos + a_len, b_pos + b_len)
    return F.struct(first.alias("pos"), (last - first).alias("len"), F.greatest(F.lit(0), -between).alias("overlap"), between.alias("distance"))


def exact_sum(value: Column, places: int = 6) -> Column:
    """A sum in decimals, which no order of the rows changes; in place of compensated sums of doubles."""
    return F.sum(value.cast(f"decimal(38,{places})"))


def run_date(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def build_date(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd")
