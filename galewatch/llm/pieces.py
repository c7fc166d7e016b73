"""Cuts texts as the public pattern of byte-level tokenizers does, a block of texts at a time.

The pattern's alternatives amount to runs of one character class with at most
one space before, white space that leaves its last character to what follows,
and contractions where a piece begins with an apostrophe. So where classes
change tells where pieces begin, and arrays give all cuts of a block at once.
Any other pattern is asked for each text.

Equal pieces of a block are found by arrays as well: a rolling hash over the
block gives each piece's hash, and members of a class are compared with its
first one, character by character. What is worked out for a piece is worked out
once for its class.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import regex

BLOCK = 1_000_000  # characters cut at once; a longer text is a block of its own
LETTER, NUMBER, OTHER, BLANK = range(4)

# The pattern that cuts() puts into arrays, and its contractions.
KNOWN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2 ** 64


@cache
def classes() -> np.ndarray:
    """Character class of each code point."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    table = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (BLANK, r"\s+")):
        for run in regex.finditer(pattern, every):
            shift = [0x800 if at >= 0xD800 else 0 for at in (run.start(), run.end() - 1)]
            table[run.start() + shift[0] : run.end() + shift[1]] = kind
    return table


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def cuts(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether a piece of the known pattern begins at a character. ``ends``: where the joined texts end."""
    n = len(codes)
    kind = classes()[codes]
    first = np.zeros(n + 1, bool)
    first[0] = True
    first[ends] = True
    begins = np.empty(n, bool)
    begins[0] = True
    blank = kind == BLANK
    begins[1:] = (kind[1:] != kind[:-1]) & (blank[1:] | (codes[:-1] != 32))
    # The last of white space before a piece belongs to the piece, or is one by itself.
    begins[:-1] |= blank[:-1] & ~blank[1:] & ~first[1:n]
    begins |= first[:n]
    quotes = np.flatnonzero((codes == 39) & begins)
    if len(quotes):
        contracted(codes, first, begins, quotes)
    return begins


def contracted(codes: np.ndarray, first: np.ndarray, begins: np.ndarray, quotes: np.ndarray) -> None:
    """A contraction after a piece's apostrophe is one piece with it; what follows is another."""
    n = len(codes)
    for letters in CONTRACTIONS:
        size = len(letters)
        at = quotes[quotes + size < n]
        same = np.ones(len(at), bool)
        for i, letter in enumerate(letters, 1):
            same &= (codes[at + i] == ord(letter)) & ~first[at + i]
        at = at[same]
        begins[at + 1] = False
        after = at + size + 1
        begins[after[after < n]] = True


def distinct(codes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal pieces: places of one piece of each class among ``at``, and the class of each piece.

    ``at``: where pieces begin, the first at 0; the last goes to the end.
    """
    ends = np.append(at[1:], len(codes))
    powers, inverses = rolling(len(codes))
    total = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * powers, out=total[1:])
    hashes = (total[ends] - total[at]) * inverses[at]
    _, chosen, which = np.unique(hashes, return_index=True, return_inverse=True)
    sizes = ends - at
    if (sizes != sizes[chosen][which]).any() or (codes != codes[spread(at[chosen][which], sizes)]).any():
        return distinct_by_text(codes, at, ends)
    return chosen, which


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each run, one run after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def distinct_by_text(codes: np.ndarray, at: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same where two pieces have one hash."""
    seen: dict[bytes, int] = {}
    chosen, which = [], np.empty(len(at), np.int64)
    for i, (a, b) in enumerate(zip(at.tolist(), ends.tolist(), strict=True)):
        number = seen.setdefault(codes[a:b].tobytes(), len(seen))
        if number == len(chosen):
            chosen.append(i)
        which[i] = number
    return np.array(chosen, np.int64), which


powers_kept: list[np.ndarray] = []


def rolling(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64; a worker keeps those of a usual block."""
    if powers_kept and len(powers_kept[0]) >= n:
        return powers_kept[0][:n], powers_kept[1][:n]
    made = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        factors = np.full(max(n, BLOCK), base, np.uint64)
        factors[0] = 1
        made.append(np.cumprod(factors))
    if n <= BLOCK:
        powers_kept[:] = made
    return made[0][:n], made[1][:n]


class Cutter:
    """Cuts blocks of texts into classes of equal pieces."""

    def __init__(self, pattern: str):
        self.pattern = None if pattern == KNOWN_PATTERN else regex.compile(pattern)

    def cut(self, texts: list[str]) -> tuple[list[str], list[int], list[int]]:
        """A piece of each class, the class of each piece, and how many pieces each text has."""
        if self.pattern is not None:
            seen: dict[str, int] = {}
            parts = [self.pattern.findall(text) for text in texts]
            which = [seen.setdefault(piece, len(seen)) for part in parts for piece in part]
            return list(seen), which, list(map(len, parts))
        joined = "".join(texts)
        if not joined:
            return [], [], [0] * len(texts)
        codes, ends = code_points(joined), np.cumsum([len(t) for t in texts])
        at = np.flatnonzero(cuts(codes, ends))
        counts = np.diff(np.searchsorted(at, np.concatenate(([0], ends))))
        chosen, which = distinct(codes, at)
        stops = np.append(at[1:], len(codes))[chosen]
        words = [joined[a:b] for a, b in zip(at[chosen].tolist(), stops.tolist(), strict=True)]
        return words, which.tolist(), counts.tolist()

    def encode(self, texts: list[str], known: dict[str, bytes], learn, most: int) -> Iterator[bytes]:
        """What ``known`` has for the pieces of each text, joined; ``learn(pieces)`` adds to it what it lacks.

        ``known`` is emptied where it holds more than ``most`` pieces.
        """
        for block in blocks(texts):
            words, which, counts = self.cut(texts[block])
            if len(known) > most:
                known.clear()
            found = list(map(known.get, words))
            if None in found:
                learn([word for word, have in zip(words, found, strict=True) if have is None])
                found = list(map(known.__getitem__, words))
            done = 0
            for count in counts:
                yield b"".join(map(found.__getitem__, which[done : done + count]))
                done += count


def blocks(texts: list[str], size: int = BLOCK) -> Iterator[slice]:
    """Consecutive texts of about ``size`` characters."""
    start = held = 0
    for i, text in enumerate(texts):
        if held and held + len(text) > size:
            yield slice(start, i)
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield slice(start, len(texts))
