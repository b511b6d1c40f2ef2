"""The public pre-tokenisation pattern on numpy arrays, and encoding of whole word lists.

``bounds`` cuts a text where the pattern of the byte-level vocabularies does: contractions, runs of letters, of digits and of
other characters, each with the one space before it, and runs of white space. Classes of characters come from one table that is
filled from the Unicode properties themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import regex

from .common import cache

#: The public pre-tokenisation pattern (fixed value).
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE, LETTER, DIGIT, OTHER = 0, 1, 2, 3
PIECE = 1 << 20
_cut = regex.compile(r"(?<=\S)(?= \S)")


def classes() -> np.ndarray:
    """The class of every code point."""

    def make():
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        out = np.full(0x110000, OTHER, np.uint8)
        for kind, pattern in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+"), (SPACE, r"\s+")):
            for m in regex.finditer(pattern, every):
                a, b = ord(every[m.start()]), ord(every[m.end() - 1])
                out[a : b + 1] = kind
        out[0xD800:0xE000] = OTHER
        return out

    return cache("pretoken classes", make)


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """Parts of a long text, cut only where a word surely ends."""
    at = 0
    while len(text) - at > size and (m := _cut.search(text, at + size)):
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


def bounds(text: str) -> np.ndarray:
    """Starts of the pattern's matches, closed by the length of the text; the matches leave nothing out."""
    n = len(text)
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    kind = classes()[c]
    first = np.empty(n, bool)  # of a run of one class
    first[0] = True
    np.not_equal(kind[1:], kind[:-1], out=first[1:])
    start = np.flatnonzero(first)
    # the last white space before other characters: a space goes with what follows, anything else stands alone
    at = start[1:][kind[start[1:] - 1] == SPACE]
    space = c[at - 1] == 32
    if space.any():
        first[at[space]] = False
    first[at - 1] = True
    # contractions: an apostrophe at the start of a match, with letters behind it
    quote = np.flatnonzero((c == 39) & first)
    quote = quote[quote + 1 < n]
    if len(quote):
        one = c[quote + 1]
        short = np.isin(one, (115, 116, 109, 100))  # s t m d
        two = np.where(quote + 2 < n, c[np.minimum(quote + 2, n - 1)], 0)
        long = ((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)  # re ve ll
        for q, size in ((quote[short], 2), (quote[long & ~short], 3)):
            first[q + 1] = False
            end = q + size
            end = end[end < n]
            first[end] |= kind[end] == LETTER
    return np.append(np.flatnonzero(first), n)


def words(text: str) -> list[str]:
    """The pattern's matches in a text."""
    out: list[str] = []
    for part in pieces(text) if len(text) > PIECE else (text,):
        at = bounds(part).tolist()
        out += [part[a:b] for a, b in zip(at, at[1:], strict=False)]
    return out
