"""Letters of sequences as small numbers, in numpy: two bits for ACGT, one bit for the pairs CT and AG, and drawn ones for all others.

The draw depends on the place and on the sequence (its length and a digest of it), so that runs of other letters in two sequences do not
look alike, and one sequence always looks the same.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

TWO = np.full(256, 255, np.uint8)
TWO[[ord(c) for c in "ACGTacgt"]] = [0, 1, 2, 3] * 2
ONE = np.full(256, 255, np.uint8)
ONE[[ord(c) for c in "ACGTacgt"]] = [0, 1, 0, 1] * 2


def marks(seq: Column) -> Column:
    """Two longs of a sequence, its length and 60 bits of its digest, from which salt() draws."""
    return F.array(F.length(seq).cast("long"), F.conv(F.substring(F.md5(seq.cast("binary")), 1, 15), 16, 10).cast("long"))


def hashed(x: np.ndarray) -> np.ndarray:
    """scalars.hash64 over an array of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def salt(marks: list[int]) -> np.int64:
    a, b = hashed(np.array(marks, np.int64))
    return np.uint64(a ^ b).view(np.int64)


def coded(text: bytes, first: int, salt: np.int64, table: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, flags of drawn ones) of letters whose first one has the place first, from 0."""
    code = table[np.frombuffer(text, np.uint8)]
    other = code == 255
    if other.any():
        at = (np.flatnonzero(other) + first).astype(np.int64) ^ salt
        code[other] = (hashed(at.view(np.uint64)) & np.uint64((1 << bits) - 1)).astype(np.uint8)
    return code, other


#: Reversed negations of so many bits.
BACK = {n: np.array([int(f"{(1 << n) - 1 - v:0{n}b}"[::-1], 2) for v in range(1 << n)], np.int64) for n in (1, 2, 8)}


def codes(bits: np.ndarray, at: np.ndarray, template: int) -> tuple[np.ndarray, np.ndarray]:
    """(words as numbers, whether the reverse was the lesser) of the templates that begin at the places ``at`` of an array of bits, from 0. Of
    a template's bits every third is left out; at most 63 are kept. Bits are read by pairs and by four pairs at once."""
    left = template - template // 3
    two = bits[:-1] << 1 | bits[1:]
    eight = two[:-9] << 6 | two[3:-6] << 4 | two[6:-3] << 2 | two[9:] if left >= 8 else two
    code, back, done, i = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64), 0, 0
    while left:
        n, step, source = (8, 12, eight) if left >= 8 else (2, 3, two) if left >= 2 else (1, 1, bits)
        x = source[at + i]
        code = code << n | x
        back |= BACK[n][x] << done
        done, left, i = done + n, left - n, i + step
    return np.minimum(code, back), back < code
