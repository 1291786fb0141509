"""Suffix order of a byte string by the difference cover modulo 3, in numpy."""

from __future__ import annotations

import numpy as np

#: Longest string that one call sorts: three names must fit in a 64-bit key.
LONGEST = 1 << 21
_21, _22, _42, _43 = (np.uint64(k) for k in (21, 22, 42, 43))


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes of `text` (integers from 1), ascending.

    Triples at starts 1 and 2 modulo 3 are sorted and named; while names repeat, the names' own suffixes are
    sorted by recursion. The starts 0 modulo 3 are sorted by their first symbol and the rank behind it, and
    merged: each is placed among the sampled ones by symbols up to the next start that both sides have ranked.
    """
    n = len(text)
    if n < 4:
        return np.array(sorted(range(n), key=lambda k: text[k:].tolist()), np.int64)
    t = np.zeros(n + 3, np.uint64)
    t[:n] = text
    ones, twos = np.arange(1, n, 3), np.arange(2, n, 3)
    sample = np.concatenate([ones, twos])
    names, name = np.unique((t[sample] << _42) | (t[sample + 1] << _21) | t[sample + 2], return_inverse=True)
    if len(names) == len(sample):
        order = np.empty(len(sample), np.int64)
        order[name] = np.arange(len(sample))
    else:
        joined = np.concatenate([name[: len(ones)] + 2, [1], name[len(ones) :] + 2])  # 1 ends the first half
        found = suffix_order(joined)
        found = found[found != len(ones)]
        order = np.where(found > len(ones), found - 1, found)
    rank = np.zeros(n + 3, np.uint64)
    rank[sample[order]] = np.arange(1, len(sample) + 1)
    zeros = np.arange(0, n, 3)
    by_one = lambda at: (t[at] << _22) | rank[at + 1]
    by_two = lambda at: (t[at] << _43) | (t[at + 1] << _22) | rank[at + 2]
    zeros = zeros[np.argsort(by_one(zeros), kind="stable")]
    sampled = sample[order]
    is_one = sampled % 3 == 1
    one, two = sampled[is_one], sampled[~is_one]
    before_one = np.searchsorted(by_one(one), by_one(zeros))
    before_two = np.searchsorted(by_two(two), by_two(zeros))
    out = np.empty(n, np.int64)
    out[np.arange(len(zeros)) + before_one + before_two] = zeros
    taken = np.zeros(n, bool)
    taken[np.arange(len(zeros)) + before_one + before_two] = True
    out[~taken] = sampled
    return out


def repeated_starts(text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of `starts` (ascending, each followed by `length` bytes) begin a string that begins at another of them too."""
    mine = np.zeros(len(text), bool)
    mine[starts] = True
    order = suffix_order(text.astype(np.int64) + 1)
    order = order[mine[order]]
    a, b = order[:-1], order[1:]
    live = np.arange(len(a))
    for k in range(0, length, 8):  # compare neighbours a few bytes at a time, as long as they agree
        for j in range(k, min(k + 8, length)):
            live = live[text[a[live] + j] == text[b[live] + j]]
    hit = np.zeros(len(text), bool)
    hit[a[live]] = hit[b[live]] = True
    return hit[starts]
