"""Token counts by a linear longest-match automaton.

The vocabulary is a trie over bytes. Every node has a failure link and the number of pieces that are popped when it is
followed, so the greedy longest-match-first number of pieces of a word comes from one walk over its bytes, without
backtracking and without building the pieces. A word is a match of the public pre-tokenisation pattern; the vocabulary
holds every single byte, so no word is unknown.

Defined results: null or empty text has 0 words and 0 tokens; rows are counted independently, so repeated rows, ties and
extra columns change nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import base64

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Memo, cache, rows_of
from .pretokens import WORD, words  # noqa: F401

def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def read_vocabulary(path: str) -> list[bytes]:
    with open(path, "rb") as f:
        return [base64.b64decode(line.split()[0]) for line in f if line.strip()]


class LongestMatch:
    """goto: (node << 8 | byte) -> node; fail and popped by node. Node 0 is the root."""

    def __init__(self, vocabulary: list[bytes]):
        goto: dict[int, int] = {}
        ends, parent, letter = [False], [0], [0]
        for piece in vocabulary:
            u = 0
            for c in piece:
                v = goto.get(u << 8 | c)
                if v is None:
                    v = goto[u << 8 | c] = len(ends)
                    ends.append(False)
                    parent.append(u)
                    letter.append(c)
                u = v
            ends[u] = bool(u)
        if any((c not in goto) or not ends[goto[c]] for c in range(256)):
            raise ValueError("the vocabulary must hold all single bytes")
        fail, popped = [0] * len(ends), [0] * len(ends)
        depth = [0] * len(ends)
        for v in range(1, len(ends)):  # a child is always made after its parent
            depth[v] = depth[parent[v]] + 1
        for v in sorted(range(1, len(ends)), key=depth.__getitem__):
            if ends[v]:
                fail[v], popped[v] = 0, 1
                continue
            z, n, c = fail[parent[v]], popped[parent[v]], letter[v]
            while (to := goto.get(z << 8 | c)) is None:
                n += popped[z]
                z = fail[z]
            fail[v], popped[v] = to, n
        self.goto, self.fail, self.popped = goto, fail, popped

    def count(self, word: bytes) -> int:
        goto, fail, popped = self.goto, self.fail, self.popped
        u = n = 0
        for c in word:
            while (v := goto.get(u << 8 | c)) is None:
                n += popped[u]
                u = fail[u]
            u = v
        while u:
            n += popped[u]
            u = fail[u]
        return n


def _counter(path: str) -> Memo:
    automaton = LongestMatch(read_vocabulary(path))
    return Memo(lambda w: automaton.count(w.encode()))


def count_text(text: str | None, memo) -> tuple[int, int]:
    found = words(text) if text else ()
    return len(found), sum(map(memo.__getitem__, found))


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_words, n_tokens) of every row."""
    path = path or vocabulary_path()

    def count(batches):
        memo = cache(f"longest:{path}", lambda: _counter(path))
        for b in rows_of(batches):
            got = [count_text(t, memo) for t in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array([x[0] for x in got], pa.int64()), pa.array([x[1] for x in got], pa.int64())], names=["doc_id", "n_words", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(count, "doc_id long, n_words long, n_tokens long")
