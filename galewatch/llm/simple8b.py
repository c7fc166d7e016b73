"""Simple-8b: whole numbers packed into 64-bit words.

The four highest bits of a word select how many numbers it holds and how wide
they are; the first number is in the lowest bits. Selector 0 is an escape: the
next word is one number of up to 64 bits. The last word is filled up with
zeros, so a reader must know how many numbers there are.
"""

from __future__ import annotations

import numpy as np

COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)  # selectors 1 to 14
WIDTHS = tuple(60 // count for count in COUNTS)
WIDEST = 60


def bits(numbers: np.ndarray) -> np.ndarray:
    return np.searchsorted(np.uint64(1) << np.arange(64, dtype=np.uint64), numbers, side="right").astype(np.uint8)


def encode(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words, and the places of words that an escape makes plain numbers. Each word takes as many numbers as fit."""
    numbers = np.asarray(numbers, np.uint64)
    n = len(numbers)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    padded = np.concatenate((numbers, np.zeros(COUNTS[0], np.uint64)))
    wide = bits(padded)
    # chosen[i]: the selector of a word that begins at i; most[i]: the widest of the next ``count`` numbers.
    chosen, most, reach = np.zeros(n, np.uint8), wide.copy(), 1
    for selector in range(len(COUNTS), 0, -1):
        count, width = COUNTS[selector - 1], WIDTHS[selector - 1]
        while reach < count:
            step = min(reach, count - reach)
            most[: len(most) - step] = np.maximum(most[: len(most) - step], most[step:])
            reach += step
        chosen[most[:n] <= width] = selector
    held = np.array((1, *COUNTS), np.int64)[chosen]
    jump, at, starts = held.tolist(), 0, []
    while at < n:
        starts.append(at)
        at += jump[at]
    starts = np.array(starts)
    selectors = chosen[starts]
    escaped = selectors == 0
    place = np.arange(len(starts)) + np.cumsum(escaped) - escaped
    words = np.zeros(len(starts) + int(escaped.sum()), np.uint64)
    plain = place[escaped] + 1
    words[plain] = padded[starts[escaped]]
    for selector in np.unique(selectors[~escaped]).tolist():
        mine = selectors == selector
        steps = np.arange(COUNTS[selector - 1])
        values = padded[starts[mine][:, None] + steps] << (steps * WIDTHS[selector - 1]).astype(np.uint64)
        words[place[mine]] = np.bitwise_or.reduce(values, axis=1) | np.uint64(selector << WIDEST)
    return words, plain


def decode(words: np.ndarray, plain: np.ndarray, n: int) -> np.ndarray:
    """The first n numbers; all words of a selector at once."""
    words = np.asarray(words, np.uint64)
    selectors = (words >> np.uint64(WIDEST)).astype(np.int64)
    counts = np.array((0, *COUNTS, 0), np.int64)[selectors]
    counts[plain], selectors[plain] = 1, -1
    at = np.cumsum(counts) - counts
    out = np.zeros(n + COUNTS[0], np.uint64)
    out[at[plain]] = words[plain]
    for selector in np.unique(selectors[selectors > 0]).tolist():
        mine, width = selectors == selector, WIDTHS[selector - 1]
        steps = np.arange(COUNTS[selector - 1])
        values = (words[mine][:, None] >> (steps * width).astype(np.uint64)) & np.uint64((1 << width) - 1)
        out[at[mine][:, None] + steps] = values
    return out[:n]
