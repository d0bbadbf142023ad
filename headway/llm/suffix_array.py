"""Suffix arrays of many short strings by induced sorting, vectorised with numpy.

The strings stand in one vector, each followed by a separator.  Separators count as distinct, smaller
than every byte and ordered by position, so no comparison runs past the end of a string.

* Suffixes are classified as S (smaller than the next) or L; leftmost S (LMS) positions start the LMS
  substrings.
* One round of induced sorting orders the LMS substrings; equal ones get equal names.  The string of
  names is sorted by naming pairs of names again and again (each round doubles what a name stands for,
  at most the LMS substrings of the longest string), until names are distinct.
* The sorted LMS suffixes induce all L and then all S suffixes in linear time.  Each bucket (first
  byte) is dealt out in whole blocks, in order, instead of suffix by suffix.
* Permuted common prefixes: only irreducible positions (those whose left neighbour differs from that
  of their predecessor in the array) are compared, eight bytes at a time; all others follow from the
  position before by subtracting one.
"""

from __future__ import annotations

import numpy as np


def join(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Codes (1 separates, bytes from 3 in order; 2 and 0 close the vector) and the start of every string."""
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    starts = np.cumsum(sizes + 1) - sizes - 1
    raw = np.frombuffer(b"\0".join(strings) + b"\0\0\0", np.uint8)
    present = np.zeros(256, bool)
    present[raw] = True
    ends = starts + sizes
    code = np.cumsum(present) + 2
    if code[-1] > 255:
        s = code[raw].astype(np.uint16)
    else:
        s = code[raw].astype(np.uint8)
    s[ends] = 1
    s[-2:] = 2, 0                  # the last separator too is followed by something larger
    return s, starts


def _types(s: np.ndarray) -> np.ndarray:
    """True for S suffixes."""
    n = len(s)
    up = np.empty(n, bool)
    up[:-1] = s[:-1] < s[1:]
    up[-1] = True
    differs = np.empty(n, bool)
    differs[:-1] = s[:-1] != s[1:]
    differs[-1] = True
    if differs.all():
        return up
    at = np.where(differs, np.arange(n), n)
    nxt = np.minimum.accumulate(at[::-1])[::-1]
    return up[nxt]


def _deal(block: np.ndarray, s: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Predecessors of a block of suffixes that are of the wanted type, stably grouped by first code."""
    j = block - 1
    j = j[j >= 0]
    j = j[keep[j]]
    c = s[j]
    order = np.argsort(c, kind="stable")
    return j[order], c[order], np.bincount(c, minlength=0)


def _induce(s: np.ndarray, small: np.ndarray, lms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Suffix array from LMS suffixes given in order (of their substrings or of the suffixes)."""
    n, k = len(s), len(sizes)
    ends = np.cumsum(sizes)
    heads = ends - sizes
    large = ~small
    sa = np.full(n, -1, np.int64)
    # LMS suffixes at the bucket ends
    c = s[lms]
    order = np.argsort(c, kind="stable")
    per = np.bincount(c, minlength=k)
    place = np.repeat(ends - per, per) + np.arange(len(lms)) - np.repeat(np.cumsum(per) - per, per)
    sa[place] = lms[order]
    first_lms = ends - per
    head = heads.copy()
    for b in range(k):                                        # L suffixes, left to right
        at = heads[b]
        while at < head[b]:
            block = sa[at: head[b]]
            at = int(head[b])
            j, c, count = _deal(block, s, large)
            if len(j):
                w = len(count)
                sa[np.repeat(head[:w] - (np.cumsum(count) - count), count) + np.arange(len(j))] = j
                head[:w] += count
        if per[b]:
            j, c, count = _deal(sa[first_lms[b]: ends[b]], s, large)
            if len(j):
                w = len(count)
                sa[np.repeat(head[:w] - (np.cumsum(count) - count), count) + np.arange(len(j))] = j
                head[:w] += count
    tail = ends.copy()
    for b in range(k - 1, -1, -1):                            # S suffixes, right to left
        at = ends[b]
        while tail[b] < at:
            block = sa[tail[b]: at][::-1]
            at = int(tail[b])
            j, c, count = _deal(block, s, small)
            if len(j):
                w = len(count)
                sa[np.repeat(tail[:w] - 1 + (np.cumsum(count) - count), count) - np.arange(len(j))] = j
                tail[:w] -= count
        if head[b] > heads[b]:
            j, c, count = _deal(sa[heads[b]: head[b]][::-1], s, small)
            if len(j):
                w = len(count)
                sa[np.repeat(tail[:w] - 1 + (np.cumsum(count) - count), count) - np.arange(len(j))] = j
                tail[:w] -= count
        if b == 0:
            sa[0] = n - 1
    return sa


def _equal_neighbours(s: np.ndarray, lms: np.ndarray, length: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether LMS substrings number a and b are equal (separators never are)."""
    same = (length[a] == length[b]) & (s[lms[a]] > 1)
    todo = np.flatnonzero(same)
    k = 0
    while len(todo):
        ok = s[lms[a[todo]] + k] == s[lms[b[todo]] + k]
        same[todo[~ok]] = False
        todo = todo[ok]
        k += 1
        todo = todo[length[a[todo]] > k]
    return same


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Order of all suffixes of a vector made by ``join``."""
    n = len(s)
    small = _types(s)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    sizes = np.bincount(s)
    sa = _induce(s, small, lms, sizes)
    number = np.full(n, -1, np.int64)
    number[lms] = np.arange(len(lms))
    order = number[sa]
    order = order[order >= 0]                                 # LMS numbers in the order of their substrings
    seps = s[lms[order]] == 1                                 # separators: distinct, by position
    order[seps] = np.sort(order[seps])
    length = np.append(np.diff(lms) + 1, 1)
    new = np.ones(len(order), bool)
    new[1:] = ~_equal_neighbours(s, lms, length, order[1:], order[:-1])
    names = np.empty(len(lms), np.int64)
    names[order] = np.cumsum(new) - 1
    step = 1
    while names.max(initial=0) < len(lms) - 1:                # rename pairs until all are distinct
        after = np.zeros(len(lms), np.int64)
        after[:-step] = names[step:] + 1
        key = names * (len(lms) + 1) + after
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        names[order] = np.cumsum(np.concatenate([[0], ranked[1:] != ranked[:-1]]))
        step *= 2
    sorted_lms = np.empty(len(lms), np.int64)
    sorted_lms[names] = lms
    return _induce(s, small, sorted_lms, sizes)


def common_prefixes(s: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """Length of the common prefix of every suffix with its predecessor in the array, in array order."""
    n = len(s)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    end = np.where(s <= 2, np.arange(n), n)
    room = np.minimum.accumulate(end[::-1])[::-1] - np.arange(n)
    left = np.empty(n, bool)                                  # reducible: same byte before both
    left[0] = False
    prev = before[1:]
    left[1:] = (prev > 0) & (s[:-1] == s[np.maximum(prev, 1) - 1]) & (s[:-1] > 2)
    left &= before >= 0
    irr = np.flatnonzero(~left & (before >= 0))
    wide = np.zeros(n + 8, np.uint64)
    wide[:n] = s
    words = np.zeros(n, np.uint64)
    for k in range(8):
        words |= (wide[k: k + n] & np.uint64(255)) << np.uint64(8 * k)
    length = np.zeros(len(irr), np.int64)
    limit = np.minimum(room[irr], room[before[irr]])
    todo = np.flatnonzero(limit > 0)
    while len(todo):
        a, at = irr[todo], length[todo]
        x = words[a + at] ^ words[before[a] + at]
        low = x & (~x + np.uint64(1))                         # lowest differing bit
        same = np.where(x == 0, 8, np.log2(np.where(low == 0, 1, low).astype(np.float64)).astype(np.int64) >> 3)
        length[todo] = np.minimum(at + same, limit[todo])
        todo = todo[(x == 0) & (length[todo] < limit[todo])]
    plcp = np.zeros(n, np.int64)
    plcp[irr] = length
    source = np.where(left, -1, np.arange(n))
    source = np.maximum.accumulate(source)
    gap = np.arange(n) - source
    plcp = np.where(left, plcp[np.maximum(source, 0)] - gap, plcp)
    return np.maximum(plcp[sa], 0)
