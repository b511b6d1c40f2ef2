"""Byte-level BPE encoding and decoding through a minimal acyclic transducer.

Frequent words of the corpus are compiled into a minimal deterministic acyclic automaton with shared prefixes and
suffixes. Arcs carry the number of words that sort before them, so the sum over a path is the word's rank, and the rank
leads to the word's ids. The automaton is one file that Spark puts on every machine; its workers map it into memory and read
it in place. The distinct words of a batch walk it together; those that it lacks are merged exactly by the tokenizer's merge
ranks, also together, and one by one with a heap where they are long.

The lexicon only decides which words take the short way; ids never depend on it. Its words are counted over the whole corpus.

Defined results: null or empty text has no ids; rows are encoded independently, so repeated rows, ties and extra columns
change nothing; texts of any length are encoded whole; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import struct
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cache, rows_of, work_dir, written
from .pretokens import words
from .token_counts import vocabulary_path

NO_PAIR = 1 << 62
LONG_WORD = 64


def byte_letters() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: letter -> byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """The exact encoder of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, letters = spec["model"], byte_letters()
        as_bytes = lambda s: bytes(letters[c] for c in s)
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        ids = {as_bytes(k): v for k, v in model["vocab"].items() if k not in self.special}
        self.single = [ids[bytes([b])] for b in range(256)]
        self.ranks = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = map(as_bytes, pair if isinstance(pair, list) else pair.split(" "))
            self.ranks[ids[a] << 20 | ids[b]] = rank << 20 | ids[a + b]
        pairs = sorted(self.ranks.items())
        self.pair_key = np.array([k for k, _ in pairs], np.int64)
        self.pair_value = np.array([v for _, v in pairs], np.int64)
        self.byte_id = np.array(self.single, np.int64)
        size = max([*ids.values(), *self.special.values()]) + 1
        self.token = [b""] * size
        for k, v in ids.items():
            self.token[v] = k
        for k, v in self.special.items():
            self.token[v] = k.encode()

    def word(self, word: bytes) -> list[int]:
        """Merges the pair of least rank, the leftmost first. A pair's value is rank << 20 | merged id."""
        out = [self.single[b] for b in word]
        if len(out) > LONG_WORD:
            return self._long(out)
        get, last = self.ranks.get, NO_PAIR
        value = [get(a << 20 | b, last) for a, b in zip(out, out[1:], strict=False)]
        while value and (best := min(value)) != last:
            i = value.index(best)
            x = out[i] = best & 0xFFFFF
            del out[i + 1], value[i]
            if i < len(value):
                value[i] = get(x << 20 | out[i + 1], last)
            if i:
                value[i - 1] = get(out[i - 1] << 20 | x, last)
        return out

    def _values(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 20 | b
        i = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where(self.pair_key[i] == key, self.pair_value[i], NO_PAIR)

    def together(self, flat: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each word) of many words, whose bytes are flat: in every round each word makes its next merge,
        the pair of least rank, the leftmost first."""
        count = size.copy()
        word = np.repeat(np.arange(len(size)), size)
        x = self.byte_id[flat]
        done: list[tuple[np.ndarray, np.ndarray]] = []
        value = np.full(len(x), NO_PAIR)
        same = np.flatnonzero(word[1:] == word[:-1])
        value[same] = self._values(x[same], x[same + 1])
        while len(x):
            first = np.flatnonzero(np.diff(word, prepend=-1))
            least = np.minimum.reduceat(value, first)
            own = np.repeat(least, np.diff(np.append(first, len(x))))
            live = own != NO_PAIR
            if not live.all():  # words without a further pair are finished
                done.append((word[~live], x[~live]))
                word, x, value, own = word[live], x[live], value[live], own[live]
                if not len(x):
                    break
            at = np.flatnonzero(value == own)
            at = at[np.diff(word[at], prepend=-1) != 0]
            x[at] = value[at] & 0xFFFFF
            keep = np.ones(len(x), bool)
            keep[at + 1] = False
            count[word[at]] -= 1
            at = at - np.arange(len(at))  # where the merged ones stand once their right parts are gone
            word, x, value = word[keep], x[keep], value[keep]
            right = (at + 1 < len(x)) & (word[np.minimum(at + 1, len(x) - 1)] == word[at])
            value[at] = NO_PAIR
            value[at[right]] = self._values(x[at[right]], x[at[right] + 1])
            left = at[(at > 0) & (word[at - 1] == word[at])]
            value[left - 1] = self._values(x[left - 1], x[left])
        if not done:
            return np.zeros(0, np.int64), count
        word, x = (np.concatenate([d[k] for d in done]) for k in range(2))
        return x[np.argsort(word, kind="stable")], count

    def _long(self, ids: list[int]) -> list[int]:
        """The same merges in the same order, in n log n steps."""
        n, ranks = len(ids), self.ranks
        right, left = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(v, i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False)) if (v := ranks.get(a << 20 | b)) is not None]
        heapq.heapify(heap)
        while heap:
            v, i, a, b = heapq.heappop(heap)
            j = right[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], right[i] = v & 0xFFFFF, -1, right[j]
            if right[i] >= 0:
                left[right[i]] = i
            for x in (left[i], i):
                if x >= 0 and right[x] >= 0 and (v := ranks.get(ids[x] << 20 | ids[right[x]])) is not None:
                    heapq.heappush(heap, (v, x, ids[x], ids[right[x]]))
        return [x for x in ids if x >= 0]


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """Words and ids as one block: header, arcs by state and byte, rank table, ids, final states."""
    known_words = sorted(w for w in entries if w)
    # states under construction: [final, {byte: child}]; finished ones are shared by their signature
    known: dict[tuple, int] = {}
    states: list[tuple] = []
    path: list[list] = [[False, {}]]

    def close(node) -> int:
        key = (node[0], tuple(node[1].items()))
        if key not in known:
            known[key] = len(states)
            states.append(key)
        return known[key]

    last = b""
    for w in known_words:
        k = 0
        while k < min(len(w), len(last)) and w[k] == last[k]:
            k += 1
        while len(path) - 1 > k:
            node = path.pop()
            path[-1][1][last[len(path) - 1]] = close(node)
        for _ in w[k:]:
            path.append([False, {}])
        path[-1][0] = True
        last = w
    while len(path) > 1:
        node = path.pop()
        path[-1][1][last[len(path) - 1]] = close(node)
    root = close(path[0])
    below = [0] * len(states)
    keys, target, before, final = [], [], [], bytearray()
    for s, (end, arcs) in enumerate(states):  # children come before their parents; arcs are in the order of their bytes
        final.append(end)
        n = int(end)
        for byte, to in arcs:
            keys.append(s << 8 | byte)
            target.append(to)
            before.append(n)
            n += below[to]
        below[s] = n
    ids = [entries[w] for w in known_words]
    at = np.cumsum([0, *map(len, ids)])
    blocks = [np.array(x, "<u4").tobytes() for x in (keys, target, before, at, [x for i in ids for x in i])] + [bytes(final)]
    return struct.pack("<7I", root, *map(len, blocks)) + b"".join(blocks)


class Lexicon:
    """A compiled lexicon, read in place from a block: bytes, or a memory map of the file that Spark has put on this machine."""

    def __init__(self, block):
        root, *sizes = struct.unpack_from("<7I", block)
        at, part = 28, []
        for n, kind in zip(sizes, ("<u4", "<u4", "<u4", "<u4", "<u4", "u1"), strict=True):
            part.append(np.frombuffer(block, kind, n // np.dtype(kind).itemsize, at))
            at += n
        self.root = root
        self.keys, self.target, self.before, self.at, self.ids, self.final = part

    def ranks(self, flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The rank of each word, or -1; words are slices of the bytes flat. All words walk the automaton together."""
        rank = np.zeros(len(start), np.int64)
        state = np.full(len(start), self.root, np.int64)
        live = np.flatnonzero(size > 0)
        out = np.full(len(start), -1, np.int64)
        k = 0
        while len(live):
            key = state[live] << 8 | flat[start[live] + k]
            i = np.minimum(np.searchsorted(self.keys, key.astype(np.uint32)), max(0, len(self.keys) - 1))
            hit = self.keys[i] == key if len(self.keys) else np.zeros(len(live), bool)
            live, i = live[hit], i[hit]
            rank[live] += self.before[i]
            state[live] = self.target[i]
            k += 1
            over = size[live] == k
            done = live[over]
            done = done[self.final[state[done]] > 0]
            out[done] = rank[done]
            live = live[~over]
        return out


def gathered(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The slices [start, start + size) of flat, one after another."""
    before = np.cumsum(size) - size
    return flat[np.repeat(start - before, size) + np.arange(int(size.sum()))]


class Codec:
    def __init__(self, path: str, block=None):
        self.merges = Merges(path)
        self.lexicon = Lexicon(block) if block is not None else None
        special = sorted(self.merges.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        token = self.merges.token
        self.token_bytes = np.frombuffer(b"".join(token), np.uint8)
        self.token_size = np.array([len(x) for x in token])
        self.token_start = np.cumsum(self.token_size) - self.token_size

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, number of ids of each text). Each distinct word of the batch is looked up once."""
        index: dict = {}
        found, sizes = [], []
        number = index.setdefault
        for t in texts:
            n = 0
            parts = self.special.split(t) if t and self.special and any(x in t for x in self.merges.special) else (t,)
            for k, p in enumerate(parts):
                if k % 2:
                    here = [self.merges.special[p]]
                else:
                    here = words(p) if p else ()
                found += [number(w, len(index)) for w in here]
                n += len(here)
            sizes.append(n)
        flat, start, size = self._words(list(index))
        at = np.array(found, np.int64)
        per_word = size[at]
        ends = np.concatenate([[0], np.cumsum(per_word)])
        cut = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64))])
        return gathered(flat, start[at], per_word), np.diff(ends[cut])

    def _words(self, distinct: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, start, size) of distinct words; a special token is its id."""
        raw = [w.encode() if isinstance(w, str) else b"" for w in distinct]
        given = np.array([-1 if isinstance(w, str) else w for w in distinct], np.int64)
        n = len(raw)
        size = np.fromiter(map(len, raw), np.int64, n)
        flat = np.frombuffer(b"".join(raw), np.uint8)
        start = np.cumsum(size) - size
        rank = self.lexicon.ranks(flat, start, size) if self.lexicon else np.full(n, -1)
        special, seen = np.flatnonzero(given >= 0), np.flatnonzero(rank >= 0)
        short = np.flatnonzero((rank < 0) & (given < 0) & (size <= LONG_WORD))
        long = np.flatnonzero((rank < 0) & (given < 0) & (size > LONG_WORD))
        merged, merged_size = self.merges.together(gathered(flat, start[short], size[short]), size[short])
        slow = [self.merges.word(raw[i]) for i in long.tolist()]
        blocks, counts = [given[special].astype(np.uint32)], [np.ones(len(special), np.int64)]
        if self.lexicon:
            lo = self.lexicon.at[rank[seen]].astype(np.int64)
            counts.append(self.lexicon.at[rank[seen] + 1].astype(np.int64) - lo)
            blocks.append(gathered(self.lexicon.ids, lo, counts[-1]))
        blocks += [merged.astype(np.uint32), *(np.array(x, np.uint32) for x in slow)]
        counts += [merged_size, np.array([len(x) for x in slow], np.int64)]
        order = np.concatenate([special, *([seen] if self.lexicon else []), short, long])
        counts = np.concatenate(counts)
        out_start, out_size = np.empty(n, np.int64), np.empty(n, np.int64)
        out_start[order], out_size[order] = np.cumsum(counts) - counts, counts
        return np.concatenate(blocks), out_start, out_size

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        """The text of each run of ids."""
        size = self.token_size[ids]
        raw = gathered(self.token_bytes, self.token_start[ids], size).tobytes()
        ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(sizes)])].tolist()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:], strict=False)]


def frequent_words(docs: DataFrame, max_words: int = 50_000, min_count: int = 8, held: int = 400_000) -> list[str]:
    """Up to max_words words that occur min_count times or more in all documents, most frequent first; a bounded list for
    the driver. A task sends its counts on, all of them, whenever it holds more than so many words."""

    def count(batches):
        seen: Counter = Counter()

        def flush():
            keep = [(w, n) for w, n in seen.items() if len(w) <= LONG_WORD]
            seen.clear()
            return pa.record_batch([pa.array([w for w, _ in keep], pa.string()), pa.array([n for _, n in keep], pa.int64())], names=["word", "n"])

        for b in rows_of(batches):
            for t in b.column(0).to_pylist():
                if t:
                    seen.update(words(t))
            if len(seen) > held:
                yield flush()
        yield flush()

    sums = docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)
    sums = written(sums, "words")
    # the least count that leaves at most max_words, from a histogram of eighths of powers of two: no part sends its own longest list
    step = F.floor(F.log2("n") * 8).cast("int")
    total, least = 0, None
    for r in sorted(sums.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect(), key=lambda r: -r["step"]):
        total += r["words"]
        if total > max_words:
            break
        least = r["step"]
    if least is None:
        return []
    return [r.word for r in sums.filter(step >= least).orderBy(F.desc("n"), "word").select("word").collect()]


def build_lexicon(docs: DataFrame, path: str, max_words: int = 50_000, min_count: int = 8) -> bytes:
    merges = Merges(path)
    found = [w.encode() for w in frequent_words(docs, max_words, min_count)]
    return compile_lexicon({w: merges.word(w) for w in found})


def _shipped(spark: SparkSession, block: bytes) -> str:
    """The name under which every machine has the block as a file; executors that start later get it as well."""
    name = f"lexicon-{hashlib.sha256(block).hexdigest()[:24]}"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{work_dir(spark)}/{name}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
    out.write(bytearray(block))
    out.close()
    spark.sparkContext.addFile(path.toString())
    return name


def mapped(name: str) -> mmap.mmap:
    with open(SparkFiles.get(name), "rb") as f:
        return mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)


def bpe_encode(docs: DataFrame, path: str | None = None, lexicon: bytes | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids binary, decoded string) of every row; ids little-endian unsigned 32-bit."""
    return _coded(docs, path, lexicon, lambda ids, texts: (ids, texts), [("ids", pa.binary(), "binary"), ("decoded", pa.string(), "string")])


def bpe_digests(docs: DataFrame, path: str | None = None, lexicon: bytes | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): the digests of bpe_encode, made where it runs."""
    sha = lambda x: hashlib.sha256(x).hexdigest()
    return _coded(docs, path, lexicon, lambda ids, texts: (list(map(sha, ids)), [sha(t.encode()) for t in texts]), [("ids_sha256", pa.string(), "string"), ("decoded_sha256", pa.string(), "string")])


def _coded(docs, path, lexicon, digest, columns) -> DataFrame:
    path = path or vocabulary_path("byte_bpe_50k.json")
    block = build_lexicon(docs, path) if lexicon is None else lexicon
    file = _shipped(docs.sparkSession, block)

    def encode(batches):
        codec = cache(f"bpe:{path}:{file}", lambda: Codec(path, mapped(file)))
        for b in rows_of(batches, 4 << 20):
            ids, sizes = codec.encode(b.column(1).to_pylist())
            raw, at = ids.astype("<u4").tobytes(), (4 * np.concatenate([[0], np.cumsum(sizes)])).tolist()
            out = digest([raw[x:y] for x, y in zip(at, at[1:], strict=False)], codec.decode(ids, sizes))
            yield pa.record_batch([b.column(0), pa.array(sizes, pa.int64()), *(pa.array(x, kind) for x, (_, kind, _) in zip(out, columns, strict=True))], names=["doc_id", "n_tokens", *(c[0] for c in columns)])

    return docs.select("doc_id", "text").mapInArrow(encode, "doc_id long, n_tokens long, " + ", ".join(f"{n} {s}" for n, _, s in columns))
