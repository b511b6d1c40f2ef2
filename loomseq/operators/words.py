"""Orientation-invariant spaced words: extraction, index, seed joins, coalescing, occurrence caps, tracks of words.

A word is a string of 0 and 1: {C, T} is 1, {A, G} is 0; of the template's bases every third is left out; the reverse
complement is the reversed negation, and the canonical word is the lesser of the two. Words whose kept
bases hold other letters than ACGT are not made. Positions count from 1; a word whose reverse was the lesser has the negative position of its last base.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..adapters import among, barrier, portions, sequences, settled
from ..functions import letters
from . import intervals

#: So many different words are sent to every task; more are joined by a shuffle.
FEW = 500_000
#: So many words of a batch are made at a time.
WORDS = 1 << 18
#: The bit of a letter; 2: none.
BITS = np.full(256, 2, np.uint8)
BITS[list(b"AGCT")] = [0, 0, 1, 1]


def coded_words(seqs: DataFrame, template: int = 56, stride: int = 1, *also: str, read: Callable[[bytes], bytes] | None = None, only: tuple[np.ndarray, Callable] | None = None) -> DataFrame:
    """(oid, pos, code, flipped, also ...) of sequences (oid, seq, also ...); code is the word as a number. The words of a batch of
    sequences come out of one array of bits, WORDS at a time. read makes the sequence of a text's bytes, where seq is not one yet. only: sorted
    numbers, and what makes one of a code; other words do not leave the pass over the texts."""
    kept = [i for i in range(template) if i % 3 < 2]
    names = ["oid", "pos", "code", "flipped", *also]

    def run(batches):
        asked = only and _asked(only[0])
        for b in portions(batches, "seq"):
            raw, start = _read(b.column("seq"), read)
            many = np.maximum(0, (np.diff(start) - template) // stride + 1)
            upto = np.cumsum(many)
            for lo in range(0, int(upto[-1]) if len(upto) else 0, WORDS):
                k = np.arange(lo, min(lo + WORDS, int(upto[-1])))
                row = np.searchsorted(upto, k, "right")
                place = (k - (upto[row] - many[row])) * stride
                at = start[row] + place
                some = BITS[raw[at[0] : at[-1] + template]]  # what these words stand in
                at -= at[0]
                if some.max() > 1:
                    bad = some > 1
                    good = ~np.logical_or.reduce([bad[at + i] for i in kept])
                    row, place, at = row[good], place[good], at[good]
                code, flipped = letters.codes(some & 1, at, template)
                if only:
                    use = asked(only[1](code))
                    row, place, code, flipped = row[use], place[use], code[use], flipped[use]
                if len(row):
                    pos = np.where(flipped, -(place + template), place + 1)
                    yield pa.record_batch([b.column("oid").take(pa.array(row)), pa.array(pos), pa.array(code), pa.array(flipped), *(b.column(c).take(pa.array(row)) for c in also)], names=names)

    kind = lambda c: f"{c} {seqs.schema[c].dataType.simpleString()}"
    return seqs.select("oid", "seq", *also).mapInArrow(run, ", ".join([kind("oid"), "pos long, code long, flipped boolean", *map(kind, also)]))


def _read(seq: pa.Array, read: Callable[[bytes], bytes] | None) -> tuple[np.ndarray, np.ndarray]:
    """The letters of texts one after another, and where each text begins, with the end. Places count letters, not bytes."""
    if read is None:
        seq = seq.cast(pa.string()).fill_null("")
        data = seq.buffers()[2]
        raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
        start = np.frombuffer(seq.buffers()[1], np.int32)[seq.offset : seq.offset + len(seq) + 1].astype(np.int64)
        if not (raw[start[0] : start[-1]] > 127).any():
            return raw, start
    make = read or (lambda x: x.decode().encode("ascii", "replace"))
    texts = [b"" if x is None else make(x) for x in seq.cast(pa.binary()).to_pylist()]
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)], dtype=np.int64)


def _asked(numbers: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """Places, in an array, of what is among sorted numbers. Most of the others are told by 22 bits of a product."""
    mark = lambda x: (x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(42)
    seen = np.zeros(1 << 22, bool)
    seen[mark(numbers)] = True

    def places(x):
        at = np.flatnonzero(seen[mark(x)])
        i = np.searchsorted(numbers, x[at])
        return at[(i < len(numbers)) & (numbers[np.minimum(i, len(numbers) - 1)] == x[at])] if len(numbers) else at

    return places


def spelled(coded: DataFrame, template: int = 56) -> DataFrame:
    """With the word of each code, as a string of 0 and 1."""
    return coded.withColumn("word", F.lpad(F.bin("code"), template - template // 3, "0"))


def spaced_words(seqs: DataFrame, template: int = 56, stride: int = 1, *also: str) -> DataFrame:
    """(oid, pos, word, flipped, also ...) of sequences (oid, seq, also ...)."""
    return spelled(coded_words(seqs, template, stride, *also), template).select("oid", "pos", "word", "flipped", *also)


def split_key(words: DataFrame) -> DataFrame:
    """38-bit words with their low 15 bits moved to the top; key30: the low 30 bits then, key8: the rest."""
    turned = F.concat(F.substring("word", 24, 15), F.substring("word", 1, 23))
    return words.withColumn("_t", turned).withColumns({"key8": F.substring("_t", 1, 8), "key30": F.substring("_t", 9, 30)}).drop("_t")


def keep_two(words: DataFrame, taxon: str = "tax_id", word: str = "word", common: bool = False) -> DataFrame:
    """At most two postings of a word for each taxon, the first by (oid, pos), after removal of repeats; one shuffle and one sort
    serve both. common: few words with many postings; each task sorts its own once more, and only its first two are dealt out."""
    w = Window.partitionBy(word, taxon).orderBy("oid", "pos")
    d = words.select(word, taxon, "oid", "pos")
    if common:  # a bound on a rank alone holds within a task, too
        d = d.withColumn("_r", F.dense_rank().over(w)).filter("_r <= 2").drop("_r")
    d = d.withColumns({"_r": F.dense_rank().over(w), "_same": F.lag("oid").over(w).eqNullSafe(F.col("oid")) & F.lag("pos").over(w).eqNullSafe(F.col("pos")) & (F.row_number().over(w) > 1)})
    return d.filter((F.col("_r") <= 2) & ~F.col("_same")).drop("_r", "_same")


def build_index(seqs: DataFrame, template: int = 56, stride: int = 11, asked: DataFrame | None = None, by: str = "word", read: Callable[[bytes], bytes] | None = None) -> DataFrame:
    """Postings (word, key30, key8, tax_id, oid, pos) of subjects (oid, seq, tax_id). Where words are asked for, only those that have the
    asked ones' word (or key30); as a word's postings depend on that word alone, the others are gone before anything is sorted: up to FEW
    asked ones in the pass that makes words, more by a shuffle. Of the former a task deals out two postings for each taxon, however common the
    word is. Words are numbers until their postings are chosen. read: as in coded_words."""
    number = (lambda code: code) if by == "word" else lambda code: (code & 0x7F) << 23 | code >> 15  # key30 as a number
    only = keys = None
    if asked is not None:
        keys = settled(split_key(asked).select(F.conv(by, 2, 10).cast("long").alias("_k")).distinct())
        if keys.count() <= FEW:
            only = np.sort(keys.toArrow()["_k"].to_numpy()), number
    coded = coded_words(seqs, template, stride, "tax_id", read=read, only=only).select("oid", "pos", "code", "tax_id")
    if keys is not None and only is None:
        turned = F.shiftleft(F.col("code").bitwiseAND(0x7F), 23).bitwiseOR(F.shiftright("code", 15))
        coded = among(coded.withColumn("_k", F.col("code") if by == "word" else turned), keys, "_k", FEW).drop("_k")
    return split_key(spelled(keep_two(coded, word="code", common=only is not None), template).select("word", "tax_id", "oid", "pos"))


def seeds_of(query: DataFrame, subjects: DataFrame, read: Callable[[bytes], bytes] | None = None) -> DataFrame:
    """Seeds of queries' words (oid, pos, word) in subjects; read: as in coded_words."""
    return seed_join(query, build_index(subjects, asked=query, read=read))


def found_subjects(subjects: DataFrame, segments: DataFrame, read: Callable[[bytes], bytes] | None = None) -> DataFrame:
    """The subjects (oid, ...) that have a segment (s_oid), kept; the others' sequences are not dealt out, nor made of their texts (read, as
    in coded_words). Segments had better be settled."""
    found = among(subjects.withColumnRenamed("oid", "s_oid"), segments.select("s_oid"), "s_oid", FEW).withColumnRenamed("s_oid", "oid")
    return settled(sequences(found, read, "seq") if read else found)


def seed_join(query: DataFrame, index: DataFrame) -> DataFrame:
    """(q_oid, q_pos, s_oid, s_pos): equal words; both positions turned so that the subject's is forward."""
    q = query.select(F.col("oid").alias("q_oid"), F.col("pos").alias("q"), "word")
    s = index.select(F.col("oid").alias("s_oid"), F.col("pos").alias("s"), "word")
    return _forward(q.join(s, "word"))


def _forward(j: DataFrame, template: int = 56) -> DataFrame:
    turn = F.col("s") < 0
    flip = lambda c: 1 - F.col(c) - template
    return j.select("q_oid", F.when(turn, flip("q")).otherwise(F.col("q")).alias("q_pos"), "s_oid", F.when(turn, flip("s")).otherwise(F.col("s")).alias("s_pos"))


def seed_join_tiered(query: DataFrame, index: DataFrame, few: int = 8) -> DataFrame:
    """Equal words; for query words without any, the whole key30 bucket where it holds at most few postings; else postings that
    share the top half of key8 in it. Column tier says which. The index is read several times, so it had better be settled."""
    q = split_key(query).select(F.col("oid").alias("q_oid"), F.col("pos").alias("q"), "word", "key30", F.substring("key8", 1, 4).alias("top"))
    s = index.select(F.col("oid").alias("s_oid"), F.col("pos").alias("s"), "word", "key30", F.substring("key8", 1, 4).alias("top"))
    exact = _forward(q.join(s.select("s_oid", "s", "word"), "word")).withColumn("tier", F.lit(1))
    rest = q.join(index.select("word").distinct(), "word", "left_anti")
    size = s.groupBy("key30").agg(F.count("*").alias("n"))
    rest = rest.join(size, "key30")
    small = _forward(rest.filter(F.col("n") <= few).join(s.select("s_oid", "s", "key30"), "key30")).withColumn("tier", F.lit(2))
    large = _forward(rest.filter(F.col("n") > few).join(s.select("s_oid", "s", "key30", "top"), ["key30", "top"])).withColumn("tier", F.lit(3))
    return exact.unionByName(small).unionByName(large)


def occurrence_cap(seeds: DataFrame) -> DataFrame:
    """Seeds of query words with fewer hits than trunc(max(20, 4 * geometric mean of the query's hits))."""
    hits = seeds.groupBy("q_oid", "q_pos").agg(F.count("*").alias("hits"))
    cap = hits.groupBy("q_oid").agg(F.floor(F.greatest(F.lit(20.0), 4 * (F.exp(F.avg(F.log1p("hits"))) - 1))).alias("cap"))
    keep = hits.join(cap, "q_oid").filter(F.col("hits") < F.col("cap")).select("q_oid", "q_pos")
    return seeds.join(keep, ["q_oid", "q_pos"], "left_semi")


def coalesce(seeds: DataFrame, template: int = 56, gap: int = 100) -> DataFrame:
    """Segments (q_oid, s_oid, minus, q, s, len): seeds of one diagonal whose gap on the query is small. Length runs from the
    first start to the last end."""
    minus = (F.col("q_pos") < 0) != (F.col("s_pos") < 0)
    d = seeds.select("q_oid", "s_oid", minus.alias("minus"), F.col("q_pos").alias("q"), F.col("s_pos").alias("s"), (F.col("s_pos") - F.col("q_pos")).alias("diag"))
    key = ["q_oid", "s_oid", "minus", "diag"]
    w = Window.partitionBy(*key).orderBy("q")
    d = d.withColumn("_p", F.lag("q").over(w)).withColumn("_g", F.sum((F.col("_p").isNull() | (F.col("q") > F.col("_p") + template + gap)).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return d.groupBy(*key, "_g").agg(F.min("q").alias("q"), F.min("s").alias("s"), (F.max("q") + template - F.min("q")).alias("len")).drop("_g", "diag")


def near_neighbours(segments: DataFrame, diag: int = 5000, anti: int = 50_000, look_back: int = 15) -> DataFrame:
    """Segments with a neighbour on the same subject in a band of diagonals and antidiagonals, or longer than one seed."""
    w = Window.partitionBy("q_oid", "s_oid").orderBy("s", "len", "q")
    me = F.struct((F.col("q") - F.col("s")).alias("d"), (F.col("q") + F.col("s")).alias("a"))
    d = segments.withColumn("_me", me)
    close = lambda x: (F.abs(x["d"] - F.col("_me.d")) <= diag) & (F.abs(x["a"] - F.col("_me.a")) <= anti)
    d = d.withColumn("_b", F.collect_list("_me").over(w.rowsBetween(-look_back, -1))).withColumn("_f", F.collect_list("_me").over(w.rowsBetween(1, look_back)))
    return d.filter((F.col("len") > 56) | F.exists("_b", close) | F.exists("_f", close)).drop("_me", "_b", "_f")


def high_occurrence(hits: DataFrame, window: int = 20, most: int = 10_000) -> DataFrame:
    """(oid, pos, len): merged places where the counts (oid, pos, n) of the last window positions add up to more than most."""
    w = Window.partitionBy("oid").orderBy("pos").rangeBetween(-(window - 1), 0)
    hot = hits.withColumn("_s", F.sum("n").over(w)).filter(F.col("_s") > most)
    return intervals.merge(hot.select("oid", "pos", F.lit(1).cast("long").alias("len")), ["oid"])


def word_counts(words: DataFrame, most: int = 250) -> DataFrame:
    return words.groupBy("word").agg(F.least(F.count("*"), F.lit(most)).alias("n"))


def count_baseline(counts: DataFrame) -> DataFrame:
    """Mean of the counts from 1 to 10, with one more in the divisor."""
    few = F.col("n").between(1, 10)
    return counts.agg((F.sum(F.when(few, F.col("n"))) / (F.count_if(few) + 1)).alias("baseline"))


def repeat_tracks(words: DataFrame, counts: DataFrame, least: int, template: int = 44) -> DataFrame:
    """(oid, pos, len) of runs of frequent words: joined when within 3, dropped up to 54, widened by 5, joined within 100, dropped
    up to 100."""
    at = F.when(F.col("pos") < 0, -F.col("pos") - template + 1).otherwise(F.col("pos"))
    hot = words.join(counts.filter(F.col("n") >= least).select("word"), "word", "left_semi").select("oid", at.alias("pos"), F.lit(template).cast("long").alias("len")).distinct()
    runs = intervals.merge(hot, ["oid"], 3).filter("len > 54")
    wide = runs.select("oid", F.greatest(F.col("pos") - 5, F.lit(1)).alias("pos"), (F.col("pos") + F.col("len") + 5 - F.greatest(F.col("pos") - 5, F.lit(1))).alias("len"))
    return intervals.merge(wide, ["oid"], 100).filter("len > 100")


def _low_windows(seqs: DataFrame, window: int, bits: float) -> DataFrame:
    """(oid, pos) where so many hexamers begin whose entropy stays below bits. Each window is one row here; words of a window are
    counted with array functions."""
    n = F.length("seq") - 5
    s = barrier(seqs.select("oid", F.when(n >= window, F.transform(F.sequence(F.lit(1), n), lambda i: F.col("seq").substr(i.cast("int"), F.lit(6)))).alias("six")).filter("six is not null"))
    at = s.select("oid", "six", F.explode(F.sequence(F.lit(1), F.size("six") - (window - 1))).alias("pos"))
    words = at.select("oid", F.col("pos").cast("long").alias("pos"), F.explode(F.slice("six", F.col("pos"), F.lit(window))).alias("w"))
    h = words.groupBy("oid", "pos", "w").agg((F.count("*") / window).alias("p")).groupBy("oid", "pos").agg(F.sum(-F.col("p") * F.log2("p")).alias("h"))
    return h.filter(F.col("h") < bits).select("oid", "pos")


def low_complexity(seqs: DataFrame, window: int = 50, bits: float = 4.5) -> DataFrame:
    """(oid, pos, len): windows of so many hexamers whose entropy stays below bits, merged."""
    low = _low_windows(seqs, window, bits).select("oid", "pos", F.lit(window + 5).cast("long").alias("len"))
    return intervals.merge(low, ["oid"])


def low_complexity_mask(seqs: DataFrame, window: int = 50, bits: float = 4.5, template: int = 56, erode: int = 16) -> DataFrame:
    """(oid, pos, len) of at least one word more than a template: last bases of the hexamers of such windows, eroded where they do
    not reach an end of the sequence, and joined within a template's length. Only whole hexamers count."""
    runs = intervals.merge(_low_windows(seqs, window, bits).select("oid", (F.col("pos") + 5).alias("pos"), F.lit(window).cast("long").alias("len")), ["oid"])
    runs = runs.join(seqs.select("oid", F.length("seq").alias("_n")), "oid")
    left = F.when((F.col("pos") > 1) & (F.col("len") > erode), erode).otherwise(0)
    runs = runs.select("oid", (F.col("pos") + left).alias("pos"), (F.col("len") - left).alias("len"), "_n")
    right = F.when((F.col("pos") + F.col("len") - 1 < F.col("_n")) & (F.col("len") > erode), erode).otherwise(0)
    return intervals.merge(runs.select("oid", "pos", (F.col("len") - right).alias("len")), ["oid"], template).filter(F.col("len") > template)


def high_occurrence_mask(words: DataFrame, index: DataFrame, window: int = 20, most: int = 10_000, template: int = 56) -> DataFrame:
    """(oid, pos, len) before places where the postings of the last window words (oid, at, word) add up to more than most."""
    hits = words.join(index.groupBy("word").agg(F.count("*").alias("n")), "word").select("oid", F.col("at").alias("pos"), "n")
    w = Window.partitionBy("oid").orderBy("pos").rangeBetween(-(window - 1), 0)
    hot = hits.withColumn("_s", F.sum("n").over(w)).filter(F.col("_s") > most)
    pos = F.greatest(F.col("pos") - window - 1, F.lit(1))
    return intervals.merge(hot.select("oid", pos.alias("pos"), F.lit(template + window).cast("long").alias("len")), ["oid"])


def masked(words: DataFrame, tracks: list[DataFrame], template: int = 56, bin_: int = intervals.BIN) -> DataFrame:
    """Words (oid, at, ...) that lie in no interval (oid, pos, len) of any track; intervals of different tracks do not add up. Both
    sides meet in bins of a word's first base."""
    starts = None
    for t in tracks:  # the first bases of words that are inside
        x = t.filter(F.col("len") >= template).select("oid", F.col("pos").alias("_a"), (F.col("pos") + F.col("len") - template).alias("_b"))
        starts = x if starts is None else starts.unionByName(x)
    starts = starts.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("_a") / bin_), F.floor(F.col("_b") / bin_))))
    w = words.withColumn("_bin", F.floor(F.col("at") / bin_)).alias("w")
    inside = (F.col("w.oid") == F.col("t.oid")) & (F.col("w._bin") == F.col("t._bin")) & F.col("at").between(F.col("_a"), F.col("_b"))
    return w.join(starts.alias("t"), inside, "left_anti").drop("_bin")


def repeat_basis(seqs: DataFrame, least: int = 1000, long: int = 100_000) -> DataFrame:
    """Sequences whose words are counted for repeats: long ones, and of the others those that are not among the shortest, which
    together have less than a fifth of all bases. Sequences of one length stay together if one of them does."""
    d = seqs.withColumn("_n", F.length("seq").cast("long"))
    size = d.groupBy("_n").agg(F.sum("_n").alias("_s")).filter(F.col("_n") < long)
    total = d.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_t"))
    before = F.coalesce(F.sum("_s").over(Window.orderBy("_n").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    kept = size.withColumn("_c", before + F.col("_s")).crossJoin(total).filter((F.col("_n") >= least) & (F.col("_c") * 5 >= F.col("_t"))).select("_n")
    return d.filter(F.col("_n") >= long).unionByName(d.join(kept, "_n", "left_semi")).drop("_n")


def transposon_mask(seqs: DataFrame, basis: DataFrame) -> DataFrame:
    """Runs of words that are frequent in the basis: min(50, 30 times the baseline) times."""
    counts = word_counts(spaced_words(repeat_basis(basis), 44))
    baseline = count_baseline(counts).first()[0] or 0.0
    return repeat_tracks(spaced_words(seqs, 44), counts, min(50, int(30 * baseline)))


def n_runs(seqs: DataFrame, least: int = 10) -> DataFrame:
    """(oid, pos, len) of runs of N."""
    parts = F.regexp_extract_all("seq", F.lit("(N+|[^N]+)"), 1)
    p = barrier(seqs.select("oid", parts.alias("parts"))).select("oid", F.posexplode("parts").alias("i", "part"))
    w = Window.partitionBy("oid").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    p = p.select("oid", "part", (F.coalesce(F.sum(F.length("part")).over(w), F.lit(0)) + 1).alias("pos"), F.length("part").cast("long").alias("len"))
    return p.filter(F.col("part").startswith("N") & (F.col("len") >= least)).select("oid", "pos", "len")


def split_on_runs(seqs: DataFrame, least: int = 10, min_piece: int = 100) -> DataFrame:
    """(oid, pos, len, piece): what lies between runs of N; pieces below min_piece go unless they touch an end."""
    whole = seqs.select("oid", F.lit(1).cast("long").alias("pos"), F.length("seq").cast("long").alias("len"))
    gaps = intervals.invert_whole(n_runs(seqs, least), ["oid"], whole)
    j = gaps.join(seqs.select("oid", "seq"), "oid")
    ends = (F.col("pos") == 1) | (F.col("pos") + F.col("len") - 1 == F.length("seq"))
    return j.filter((F.col("len") >= min_piece) | ends).select("oid", "pos", "len", F.col("seq").substr(F.col("pos").cast("int"), F.col("len").cast("int")).alias("piece"))


def entropy_track(seqs: DataFrame, window: int = 50, bits: float = 4.5, erode: int | None = None, chunk: int = 100_000) -> DataFrame:
    """(oid, pos, len) where the hexamers that end in a window of letters have an entropy below bits: windows merged, then eroded by a third
    of the window, 30 at most, where they don't reach an end of the sequence. A sequence shorter than the window is repeated up to it.
    Other letters than ACGT count by their place. One pass over each piece of a sequence; counts are kept as the window moves."""
    import numpy as np
    import pandas as pd

    table = np.zeros(256, np.int64)
    table[[ord(c) for c in "CGT"]] = 1, 2, 3
    known = np.isin(np.arange(256), [ord(c) for c in "ACGT"])

    def run(parts):
        weight = [0.0] + [c * float(np.log2(c)) for c in range(1, window + 1)]
        most = (float(np.log2(window)) - bits) * window + 1e-9  # entropy is log2(window) - sum / window
        for pdf in parts:
            for oid, start, text, first in zip(pdf["oid"].tolist(), pdf["start"].tolist(), pdf["piece"].tolist(), pdf["first"].tolist(), strict=True):
                b = np.frombuffer(text.encode(), np.uint8)
                n = len(b)
                b = np.resize(b, max(n, window)) if first else b
                place = np.arange(len(b)) + start
                letter = np.where(known[b], table[b], place % 3)
                code = np.zeros(len(b), np.int64)
                for k in range(6):
                    code[k:] |= letter[: len(b) - k] << 2 * k
                skip = 0 if first else 5  # letters before the piece, only for the first hexamers
                codes, counts, total, low = code[skip:].tolist(), [0] * 4096, 0.0, []
                for i, c in enumerate(codes):
                    if i >= window:
                        old = codes[i - window]
                        total -= weight[counts[old]] - weight[counts[old] - 1]
                        counts[old] -= 1
                    total += weight[counts[c] + 1] - weight[counts[c]]
                    counts[c] += 1
                    if i >= window - 1 and total > most:
                        low.append(i - window + 1)
                if low:
                    at = np.array(low)
                    cut = np.flatnonzero(np.diff(at, prepend=at[0] - 2 * window) > window)
                    lo, hi = at[cut], np.append(at[cut[1:] - 1], at[-1]) + window
                    yield pd.DataFrame({"oid": oid, "pos": lo + start + skip + 1, "len": np.minimum(hi, n - skip) - lo})

    at = F.explode(F.sequence(F.lit(0), F.greatest(F.length("seq") - window, F.lit(0)), F.lit(chunk)))
    pieces = seqs.filter("length(seq) > 0").select("oid", "seq", at.alias("at"))
    begin = F.greatest(F.col("at") - 5, F.lit(0))
    pieces = pieces.select("oid", begin.cast("long").alias("start"), F.col("seq").substr(begin + 1, F.col("at") - begin + chunk + window - 1).alias("piece"), (F.col("at") == 0).alias("first"))
    runs = intervals.merge(pieces.mapInPandas(run, "oid long, pos long, len long"), ["oid"]).join(seqs.select("oid", F.length("seq").alias("_n")), "oid")
    by = min(window // 3, 30) if erode is None else erode
    left = F.when((F.col("pos") > 1) & (F.col("len") > by), by).otherwise(0)
    runs = runs.select("oid", (F.col("pos") + left).alias("pos"), (F.col("len") - left).alias("len"), "_n")
    right = F.when((F.col("pos") + F.col("len") - 1 < F.col("_n")) & (F.col("len") > by), by).otherwise(0)
    return runs.select("oid", "pos", (F.col("len") - right).alias("len"))


def reported_low_complexity(narrow: DataFrame, wide: DataFrame, high: DataFrame, template: int = 56) -> DataFrame:
    """What a report shows as low complexity: narrow runs joined within a template's length and longer than it, wide runs, and places of
    words that occur too often."""
    runs = intervals.merge(narrow, ["oid"], template).filter(F.col("len") > template)
    return intervals.merge(runs.unionByName(wide).unionByName(high), ["oid"])
