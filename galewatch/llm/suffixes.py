"""Suffix order by the difference cover of 3, on arrays."""

from __future__ import annotations

import numpy as np

MOST = 1 << 21  # symbols; three names then fit into a 64-bit key


def ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
    """Order of the keys, names from 1 (equal keys, equal names), and whether all differ."""
    order = np.argsort(keys)  # equal keys in any order: where there are some, their names are sorted on
    ordered = keys[order]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    names = np.empty(len(keys), np.uint64)
    names[order] = np.cumsum(new)
    return order, names, bool(new.all())


def packed(*parts: np.ndarray) -> np.ndarray:
    out = parts[0]
    for part in parts[1:]:
        out = (out << np.uint64(21)) | part
    return out


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order. Symbols from 1; fewer than MOST of them, and none as large."""
    n = len(symbols)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: symbols[i:].tolist()), np.int64)
    s = np.concatenate((symbols.astype(np.uint64), np.zeros(3, np.uint64)))
    # Sample: suffixes at 1 and 2 mod 3, and an empty one after them when n is 1 mod 3, so that names of 1 mod 3 end.
    ones = np.arange(1, n + (n % 3 == 1), 3)
    twos = np.arange(2, n, 3)
    sample = np.concatenate((ones, twos))
    order, names, unique = ranked(packed(s[sample], s[sample + 1], s[sample + 2]))
    if not unique:
        order = suffix_order(names)
    rank = np.zeros(n + 3, np.uint64)
    rank[sample[order]] = np.arange(1, len(sample) + 1, dtype=np.uint64)
    sampled = sample[order]
    sampled = sampled[sampled < n]
    zeros = np.arange(0, n, 3)
    zeros = zeros[np.argsort(packed(s[zeros], rank[zeros + 1]))]  # ranks differ
    # Merge: a suffix at 0 mod 3 meets those at 1 by (symbol, rank), those at 2 by (symbol, symbol, rank).
    first, second = sampled[sampled % 3 == 1], sampled[sampled % 3 == 2]
    before = np.searchsorted(packed(s[first], rank[first + 1]), packed(s[zeros], rank[zeros + 1]))
    before = before + np.searchsorted(
        packed(s[second], s[second + 1], rank[second + 2]), packed(s[zeros], s[zeros + 1], rank[zeros + 2])
    )
    out = np.empty(n, np.int64)
    at = np.arange(len(zeros)) + before
    free = np.ones(n, bool)
    free[at] = False
    out[at], out[free] = zeros, sampled
    return out
