"""Suffix ranks by a difference cover of period three, in NumPy."""

from __future__ import annotations

import numpy as np


def _dense(*columns: np.ndarray) -> np.ndarray:
    """Rank of each row of the columns among the distinct rows, in order, from 0."""
    rank = columns[0]
    for i, c in enumerate(columns):
        if i:
            value = rank.astype(np.int64)
            value *= int(c.max()) + 1 if len(c) else 1
            value += c
        else:
            value = c
        order = np.argsort(value)
        value = value[order]
        steps = np.zeros(len(value), np.int32)
        np.cumsum(value[1:] != value[:-1], out=steps[1:], dtype=np.int32)
        del value
        rank = np.empty(len(order), np.int32)
        rank[order] = steps
        del order, steps
    return rank


def _below(keys: np.ndarray, of: np.ndarray) -> np.ndarray:
    """How many of the keys are smaller than each of `of`."""
    return np.searchsorted(np.sort(keys), of).astype(np.int32)


def suffix_ranks(s: np.ndarray, depth: int) -> np.ndarray:
    """For each position, how many suffixes of s are smaller; suffixes equal in their first `depth` values may share a rank, others do not.

    s holds values from 1 on, fewer than 2**31. Positions not divisible by three are the sample: their triples are
    sorted and named, the names recursed on, the rest sorted by one value and the sample's rank behind it, and both
    merged by counting.
    """
    n = len(s)
    pad = 3 + -n % 3  # what is padded is smaller than all
    n3 = n + pad
    s = np.r_[s.astype(np.int32), np.zeros(pad + 3, np.int32)]
    if depth <= 3:
        dense = _dense(s[:n3], s[1 : n3 + 1], s[2 : n3 + 2])
        counts = np.bincount(dense)
        return ((np.cumsum(counts) - counts).astype(np.int32)[dense] - pad)[:n]
    cut = lambda a, i: a[i : n3 + i : 3]  # noqa: E731  a[i], a[i + 3] and so on
    names = _dense(*[np.r_[cut(s, 1 + j), cut(s, 2 + j)] for j in range(3)])
    names += 1
    ranked = suffix_ranks(names, -(-depth // 3) + 1)
    del names
    third = n3 // 3
    rank = np.zeros(n3 + 3, np.int32)
    rank[1:n3:3], rank[2:n3:3] = ranked[:third] + 1, ranked[third:] + 1
    del ranked
    m = int(rank.max()) + 1
    # zeros against ones: one value and the rank behind
    zero, one = (cut(s, i).astype(np.int64) * m + cut(rank, i + 1) for i in (0, 1))
    out = np.empty(n3, np.int32)
    out[0::3] = _below(zero, zero) + _below(one, zero)
    out[1::3] = cut(rank, 1) - 1 + _below(zero, one)
    del zero, one
    # zeros against twos: two values and the rank behind them
    both = _dense(*[np.r_[cut(a, j), cut(a, 2 + j)] for a, j in ((s, 0), (s, 1), (rank, 2))])
    out[0::3] += _below(both[third:], both[:third])
    out[2::3] = cut(rank, 2) - 1 + _below(both[:third], both[third:])
    return out[:n] - pad
