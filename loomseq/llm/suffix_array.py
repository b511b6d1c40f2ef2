"""Suffix arrays by induced sorting, on numpy arrays.

Suffixes are classified as smaller (S) or larger (L) than the next one; leftmost smaller (LMS) substrings are sorted by
inducing, named, and sorted recursively where names repeat; the whole array is induced from them in two linear scans. While
the alphabet is small a scan goes bucket by bucket, all suffixes of a bucket at once; a bucket that feeds itself takes one
round for each character of its longest run. Deeper levels, with large alphabets, scan entry by entry.
"""

from __future__ import annotations

import numpy as np

SMALL = 1024


def _types(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next; the last one (the sentinel) is."""
    n = len(s)
    out = np.zeros(n, bool)
    out[-1] = True
    less = s[:-1] < s[1:]
    same = s[:-1] == s[1:]
    # within a run of equal characters the type is that of its end
    last = np.where(same, -1, np.arange(n - 1))
    nxt = np.minimum.accumulate(np.where(last < 0, n, last)[::-1])[::-1]
    out[:-1] = np.where(nxt < n - 1, less[np.minimum(nxt, n - 2)], False) if n > 1 else out[:-1]
    return out


def _place(s, lms, ends, n):
    """LMS suffixes, in the given order, at the ends of their buckets."""
    sa = np.full(n, -1, np.int64)
    c = s[lms]
    order = np.argsort(c, kind="stable")
    c = c[order]
    back = np.arange(len(c)) - np.searchsorted(c, c, side="right")  # -1 for the last of a bucket
    sa[ends[c] + back] = lms[order]
    return sa


def _scatter(sa, s, at, fill, step):
    """Puts the suffixes at into their buckets, keeping their order; fill moves by step. Returns them by bucket."""
    c = s[at]
    order = np.argsort(c, kind="stable")
    c = c[order]
    n = len(c)
    rank = np.arange(n) - np.searchsorted(c, c, side="left")
    if step > 0:
        sa[fill[c] + rank] = at[order]
    else:
        sa[fill[c] - 1 - rank] = at[order]
    new = np.flatnonzero(np.diff(c, prepend=-1))
    counts = np.diff(np.append(new, n))
    fill[c[new]] += step * counts


def _induce_by_bucket(sa, s, stype, heads, ends, k):
    head, end = heads.copy(), ends.copy()
    for c in range(k):  # L suffixes, from small to large
        lo, hi = heads[c], ends[c]
        done = lo
        while done < head[c]:  # those of the bucket's own L part, which may grow meanwhile
            stop = head[c]
            j = sa[done:stop]
            done = stop
            j = j[j > 0] - 1
            j = j[~stype[j]]
            if len(j):
                _scatter(sa, s, j, head, 1)
        j = sa[head[c] : hi]
        j = j[j > 0] - 1
        j = j[~stype[j]]
        if len(j):
            _scatter(sa, s, j, head, 1)
    # the S part is induced anew
    for c in range(k):
        sa[head[c] : ends[c]] = -1
    for c in range(k - 1, -1, -1):
        done = ends[c]
        while done > end[c]:
            stop = end[c]
            j = sa[stop:done][::-1]
            done = stop
            j = j[j > 0] - 1
            j = j[stype[j]]
            if len(j):
                _scatter(sa, s, j, end, -1)
        j = sa[heads[c] : head[c]][::-1]
        j = j[j > 0] - 1
        j = j[stype[j]]
        if len(j):
            _scatter(sa, s, j, end, -1)


def _induce_by_entry(sa_array, s_array, stype, heads, ends):
    """One pass for each kind; a list's iterators see what the pass itself puts ahead of them."""
    bucket = np.full(len(s_array) + 1, -1, np.int64)  # of the suffix to the left; the last entry serves empty places
    bucket[1:-1] = np.where(stype[:-1], -1, s_array[:-1])
    sa, to, at = sa_array.tolist(), bucket.tolist(), heads.tolist()
    for i in sa:
        if (c := to[i]) >= 0:
            k = at[c]
            sa[k] = i - 1
            at[c] = k + 1
    bucket[1:-1] = np.where(stype[:-1], s_array[:-1], -1)
    to, at = bucket.tolist(), ends.tolist()
    for i in reversed(sa):
        if (c := to[i]) >= 0:
            k = at[c] = at[c] - 1
            sa[k] = i - 1
    sa_array[:] = sa


def _induce(sa, s, stype, heads, ends, k):
    if k <= SMALL:
        _induce_by_bucket(sa, s, stype, heads, ends, k)
        sa[0] = len(s) - 1  # the sentinel
    else:
        _induce_by_entry(sa, s, stype, heads, ends)
        sa[0] = len(s) - 1


def suffix_array(s: np.ndarray, k: int | None = None) -> np.ndarray:
    """Of integers from 1 on whose last one is the only 0."""
    s = np.asarray(s, np.int64)
    n = len(s)
    if n <= 2:
        return np.arange(n)[::-1].copy()
    k = int(s.max()) + 1 if k is None else k
    stype = _types(s)
    ends = np.cumsum(np.bincount(s, minlength=k))
    heads = np.concatenate([[0], ends[:-1]])
    lms = np.flatnonzero(stype[1:] & ~stype[:-1]) + 1
    if len(lms) <= 1:
        sa = _place(s, lms, ends, n)
        _induce(sa, s, stype, heads, ends, k)
        return sa
    sa = _place(s, lms, ends, n)
    _induce(sa, s, stype, heads, ends, k)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    ordered = sa[is_lms[sa]]
    # names: neighbours are compared character by character up to the end of the LMS substring
    number = np.empty(n, np.int64)
    number[lms] = np.arange(len(lms))
    size = np.append(np.diff(lms) + 1, 1)[number[ordered]]
    same = size[1:] == size[:-1]
    a, b, left = ordered[1:], ordered[:-1], size[1:]
    live, at = np.flatnonzero(same), 0
    equal = np.zeros(len(ordered), bool)
    while len(live):
        x, y = a[live] + at, b[live] + at
        live = live[(s[x] == s[y]) & (stype[x] == stype[y])]
        at += 1
        done = left[live] <= at
        equal[live[done] + 1] = True
        live = live[~done]
    name = np.cumsum(~equal)
    names = np.empty(len(lms), np.int64)
    names[number[ordered]] = name
    if name[-1] == len(lms):
        order = ordered
    else:
        # the last LMS is the sentinel: its name is the least and its own
        order = lms[suffix_array(names - 1, int(name[-1]))]
    sa = _place(s, order, ends, n)
    _induce(sa, s, stype, heads, ends, k)
    return sa


def common_prefixes(s: np.ndarray, sa: np.ndarray, most: int, apart: int = -1) -> np.ndarray:
    """Permuted common prefixes: for each position the length that it shares with the suffix before it in the array, counted
    up to most. Only irreducible positions are compared, eight characters (bytes) at a time; all others follow from the
    position to their left. Nothing follows across the character apart, so that a count cut at most in one part never shortens
    those of the next."""
    n = len(s)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    left = np.arange(n) - 1
    prior = before - 1
    reducible = (before > 0) & (left >= 0)
    reducible[reducible] = s[left[reducible]] == s[prior[reducible]]
    # the neighbour of i - 1 must be before[i] - 1 for the value to follow
    follows = reducible.copy()
    follows[reducible] = (before[left[reducible]] == prior[reducible]) & (s[left[reducible]] != apart)
    out = np.zeros(n, np.int64)
    check = np.flatnonzero(~follows & (before >= 0))
    padded = np.concatenate([s, np.full(most + 16, -1)])
    wide = np.zeros(len(padded), np.uint64)
    small = (padded & 0xFFF).astype(np.uint64)
    for k in range(5):
        wide[: len(padded) - k] |= small[k:] << np.uint64(12 * k)
    live, at = check, 0
    while len(live) and at < most:
        ok = wide[live + at] == wide[before[live] + at]
        ended = live[~ok]
        if len(ended):
            got = np.full(len(ended), at)
            for k in range(5):
                still = (padded[ended + got] == padded[before[ended] + got]) & (got == at + k)
                got[still] += 1
            out[ended] = got
        live = live[ok]
        at += 5
    out[live] = most
    # values that follow fall by one from position to position
    start = np.maximum.accumulate(np.where(~follows, np.arange(n), -1))
    out[follows] = np.maximum(out[start[follows]] - (np.flatnonzero(follows) - start[follows]), 0)
    return out
