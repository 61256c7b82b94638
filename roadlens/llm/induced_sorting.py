"""Suffix arrays by induced sorting, and permuted common prefixes, on arrays.

The steps are those of induced sorting: every suffix is smaller (S) or larger
(L) than the next one; leftmost smaller suffixes (LMS) are sorted by a reduced
text of the names of their substrings; all others follow from them in two
passes over the buckets.  A pass handles a whole stretch of a bucket at once.
What a stretch adds to later buckets keeps the stretch's order, and what it
adds to its own bucket is the next stretch; so a bucket takes as many steps as
its longest run of one byte, and a step is a few array operations.
"""

from __future__ import annotations

import numpy as np


def _types(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next; the last one, the end mark, is."""
    n = len(t)
    smaller = np.empty(n, bool)
    smaller[-1] = True
    rises, equal = t[:-1] < t[1:], t[:-1] == t[1:]
    # An equal neighbour has the type of the first place to the right that differs.
    places = np.where(equal, n - 1, np.arange(n - 1))
    decided = np.minimum.accumulate(places[::-1])[::-1]
    smaller[:-1] = np.where(decided == n - 1, True, rises[np.minimum(decided, n - 2)])
    return smaller


def _place(sa: np.ndarray, at: np.ndarray, ends: np.ndarray, suffixes: np.ndarray, chars: np.ndarray, step: int) -> None:
    """Put suffixes, in their order, at the growing end of their buckets."""
    order = np.argsort(chars, kind="stable")
    chars, suffixes = chars[order], suffixes[order]
    counts = np.bincount(chars, minlength=len(ends))
    within = np.arange(len(chars)) - (np.cumsum(counts) - counts)[chars]
    sa[ends[chars] + step * within] = suffixes
    ends += step * counts


def _induce(t: np.ndarray, smaller: np.ndarray, lms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All suffixes in order, given LMS suffixes in order (of their substrings, or fully)."""
    tails = np.cumsum(sizes)
    heads = tails - sizes
    sa = np.empty(len(t), np.int32)

    # The LMS suffixes of a bucket stand at its tail while the L suffixes grow from its head.
    lms_counts = np.bincount(t[lms], minlength=len(sizes))
    lms_sorted = lms[np.argsort(t[lms], kind="stable")]
    lms_ends = np.cumsum(lms_counts)
    ends = heads.copy()
    larger = ~smaller
    for c in np.flatnonzero(sizes):
        done = heads[c]
        while True:
            if done < ends[c]:
                stretch, done = sa[done:ends[c]], ends[c]
                last = False
            else:
                stretch = lms_sorted[lms_ends[c] - lms_counts[c]:lms_ends[c]]
                last = True
            before = stretch[stretch > 0] - 1
            before = before[larger[before]]
            if len(before):
                _place(sa, before, ends, before, t[before], 1)
            if last:
                break
    firsts_of_s = ends                                   # now each bucket's L suffixes are complete

    ends = tails - 1
    sa[0] = len(t) - 1                                   # the end mark; the suffix before it is an L
    for c in np.flatnonzero(sizes)[:0:-1]:
        done = tails[c] - 1
        while True:
            if done > ends[c]:
                stretch, done = sa[ends[c] + 1:done + 1][::-1], ends[c]
                last = False
            else:
                stretch = sa[heads[c]:firsts_of_s[c]][::-1]
                last = True
            before = stretch[stretch > 0] - 1
            before = before[smaller[before]]
            if len(before):
                _place(sa, before, ends, before, t[before], -1)
            if last:
                break
    return sa


def suffix_array(text: np.ndarray, alphabet: int) -> np.ndarray:
    """The suffix array of small whole numbers (uint16) that end with a 0 found nowhere else."""
    n = len(text)
    if n <= 2:
        return np.arange(n, dtype=np.int32)[::-1].copy()
    smaller = _types(text)
    sizes = np.bincount(text, minlength=alphabet)
    lms = (np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1).astype(np.int32)
    sa = _induce(text, smaller, lms, sizes)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    by_substring = sa[is_lms[sa]]
    names = _names(text, lms, by_substring)
    if names[-1] + 1 < len(lms):
        rank = np.empty(n, np.int32)
        rank[by_substring] = names
        order = _sorted_names(rank[lms])
        return _induce(text, smaller, lms[order], sizes)
    return _induce(text, smaller, by_substring, sizes)


def _names(text: np.ndarray, lms: np.ndarray, by_substring: np.ndarray) -> np.ndarray:
    """Numbers for the LMS substrings in their order, equal ones alike."""
    length = np.zeros(len(text), np.int32)
    length[lms[:-1]] = np.diff(lms) + 1                  # up to and with the next LMS place
    length[lms[-1]] = 1
    a, b = by_substring[:-1], by_substring[1:]
    differ = length[a] != length[b]
    open_ = np.flatnonzero(~differ)
    step = 0
    while len(open_):
        same = text[a[open_] + step] == text[b[open_] + step]
        differ[open_[~same]] = True
        step += 1
        open_ = open_[same & (length[a[open_]] > step)]
    return np.r_[0, np.cumsum(differ)]


def _sorted_names(names: np.ndarray) -> np.ndarray:
    """The order of the reduced text's suffixes.

    Its alphabet is as large as itself, so that buckets would be tiny: ranks by
    the first 1, 2, 4, ... names sort it instead, as often as its repeats need."""
    n, rank, width = len(names), names.astype(np.int64), 1
    while True:
        after = np.zeros(n, np.int64)
        after[:n - width] = rank[width:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key)
        changes = np.r_[0, np.cumsum(key[order][1:] != key[order][:-1])]
        if changes[-1] == n - 1:
            return order
        rank[order] = changes
        width *= 2


def common_prefixes(text: bytes, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every place in text order: the suffix before it in the array (-1: none) and their common prefix.

    Where the two suffixes are preceded by the same byte, the common prefix is
    one less than at the place before; only the others are compared, eight
    bytes at a step."""
    n = len(text)
    raw = np.frombuffer(text + bytes(8), np.uint8)
    eight = np.ndarray(n + 1, "<u8", raw.data, strides=(1,))
    prior = np.full(n, -1, np.int64)
    inner = sa[sa < n].astype(np.int64)                  # without the end mark
    prior[inner[1:]] = inner[:-1]
    places = np.arange(n)
    compared = (prior < 1) | (places < 1) | (raw[places - 1] != raw[prior - 1])
    todo = np.flatnonzero(compared & (prior >= 0))
    length = np.zeros(n, np.int64)
    limit = n - np.maximum(todo, prior[todo])
    got = np.zeros(len(todo), np.int64)
    open_ = np.arange(len(todo))
    while len(open_):
        i, j = todo[open_] + got[open_], prior[todo[open_]] + got[open_]
        x = eight[i] ^ eight[j]
        same = np.where(x == 0, 8, np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)) // 8).astype(np.int64)
        got[open_] += same
        open_ = open_[(same == 8) & (got[open_] < limit[open_])]
    length[todo] = np.minimum(got, limit)
    source = np.maximum.accumulate(np.where(compared, places, 0))
    return prior, np.where(prior >= 0, np.maximum(length[source] - (places - source), 0), 0)
