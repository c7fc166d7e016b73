"""Passages that an earlier document holds, by suffix order.

A byte is removed if it lies in a 50-byte string that also starts in a document
with a smaller id. To sort the suffixes of the whole corpus is more than it
takes: a string of 50 bytes has its place by content, the 16 bytes with the
least hash in it, and equal strings have equal places. So

1. every text is cut into runs of windows with the same place (all texts, all
   windows). A window holds at least SIDE bytes left or right of its place, so
   runs repeat only if they agree in the SIDE bytes on one side: a run whose
   place, with one of its sides, no other text holds ends here;
   the other runs meet again by text: each task packs its runs for a bucket of
   places, then of texts, into one row, so that not each run, block or text of
   each task is a row;
2. the bytes of these runs go to the task of their place; copies of a run
   that meet on the way are settled there, so few travel;
3. each task sorts the suffixes of its runs by the difference cover (triples of
   sampled suffixes, recursion on their names, merge with the others) and
   compares neighbours on 50 bytes: equal strings are neighbours, and the least
   document of each group of equal strings is known;
4. what is covered goes back to the texts, as spans.

Copies of a whole text are one text, owned by the least id; the others are
removed whole. A place that too many runs share, as any frequent one does in a
large corpus, is parted: the windows of its runs go with the SIDE bytes that they
hold whole beside the place, and only where another text has those. A place that
a block is crowded with, or that has too many runs with the same side, is left:
its windows go each to the task of their own hash, so no group grows with the
corpus but that of one and the same string, and those are settled on the way.

Null and empty texts, and those under 50 bytes, lose nothing. Rows that repeat an
id and text get a row each; neither is smaller. A null id is no smaller document
and loses nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galewatch.llm.shared import landed, no_collector
from galewatch.llm.suffixes import MOST, suffix_order

LENGTH = 50  # bytes
PLACE = 16  # bytes by which a window is placed
REACH = LENGTH - PLACE + 1  # places in a window
SIDE = (LENGTH - PLACE + 1) // 2  # bytes that any window has on one side of its place


@dataclass(frozen=True)
class Limits:
    """What is worked on together. None of them changes the result."""

    block: int = 4_000_000  # bytes of text
    piece: int = 100_000  # bytes of text whose windows are placed at once, so that they stay in the CPU's cache
    crowd: int = 40  # texts of a block with the same place; beyond, the place is left
    most_runs: int = 5_000  # runs with the same place, over the corpus; beyond, it is parted
    most_sides: int = 20_000  # runs with the same place and side; beyond, the place is left
    most_loose: int = 400  # runs of a parted place that hold it twice; beyond, it is left
    held: int = 2_000_000  # runs that a task packs together
    task: int = 64_000_000  # bytes of text whose runs one task compares


def words_at(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place, as a number; zeros beyond the end."""
    padded = np.concatenate((data, np.zeros(16, np.uint8)))
    out = np.empty(len(data) + 8, np.uint64)
    for shift in range(8):
        whole = padded[shift : shift + (len(padded) - shift) // 8 * 8].view(np.uint64)
        out[shift::8] = whole[: len(out[shift::8])]
    return out


def place_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the PLACE bytes (8 to 16) from each place."""
    at = words_at(np.concatenate((data, np.zeros(8, np.uint8))))
    out = at[: len(data)] * np.uint64(0x9E3779B97F4A7C15)
    out ^= out >> np.uint64(29)
    out += at[PLACE - 8 : len(data) + PLACE - 8]
    for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        out *= np.uint64(factor)
        out ^= out >> np.uint64(31)
    return out


def runs(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Text number, first window, number of windows (REACH at most), place hash, and hashes of both sides of each run."""
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    if not len(data):
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),) + (np.empty(0, np.uint16),) * 2
    hashes = place_hashes(data)
    least, reach = hashes.copy(), 1
    while reach < REACH:
        step = min(reach, REACH - reach)
        np.minimum(least[: len(least) - step], least[step:], out=least[: len(least) - step])
        reach += step
    ends = np.cumsum(sizes)
    windows = np.maximum(sizes - LENGTH + 1, 0)
    owner = np.repeat(np.arange(len(texts)), windows)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    place = least[np.repeat(ends - sizes, windows) + at]
    new = np.ones(len(owner), bool)
    new[1:] = (place[1:] != place[:-1]) | (at[1:] == 0)
    begins = np.flatnonzero(new)
    since = np.arange(len(owner)) - np.repeat(begins, np.diff(np.append(begins, len(owner))))
    begins = np.flatnonzero(since % REACH == 0)  # periodic texts have long runs
    counts = np.diff(np.append(begins, len(owner)))
    starts = (ends - sizes)[owner[begins]] + at[begins]
    left, right = side_hashes(data, places_of(hashes, least, starts, counts, place[begins]))
    return owner[begins], at[begins], counts, place[begins], left, right


def runs_by_piece(texts: list[bytes], most: int) -> tuple[np.ndarray, ...]:
    """As runs(), for about ``most`` bytes of text at a time."""
    out, start, held = [], 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > most:
            out.append((start, runs(texts[start:i])))
            start, held = i, 0
        held += len(text)
    out.append((start, runs(texts[start:])))
    owner = np.concatenate([own[0] + start for start, own in out])
    return owner, *(np.concatenate(c) for c in zip(*(own[1:] for _, own in out), strict=True))


def places_of(
    hashes: np.ndarray, least: np.ndarray, starts: np.ndarray, counts: np.ndarray, place: np.ndarray
) -> np.ndarray:
    """Where the place of each run lies; -1 if its windows hold it more than once, as equal windows then may lie anywhere."""
    # What is least in some window is no less than what is least in any window with it.
    most = least.copy()
    most[max(len(most) - REACH + 1, 0) :] = 0
    reach = 1
    while reach < REACH:
        step = min(reach, REACH - reach)
        most[step:] = np.maximum(most[step:], most[:-step].copy()) if step < len(most) else most[step:]
        reach += step
    chosen = hashes == most
    before = np.concatenate(([0], np.cumsum(chosen)))
    places = np.flatnonzero(chosen)
    at, stop = before[starts], before[starts + counts + REACH - 1]
    found, times = np.full(len(starts), -1, np.int64), np.zeros(len(starts), np.int64)
    active = np.flatnonzero(at < stop)
    while len(active):
        here = places[at[active]]
        own = hashes[here] == place[active]
        found[active[own]] = here[own]
        times[active] += own
        at[active] += 1
        active = active[at[active] < stop[active]]
    return np.where(times == 1, found, -1)


def side_hashes(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, from 1, of the SIDE bytes before and after each place; 0 for no place."""
    padded = np.concatenate((np.zeros(SIDE, np.uint8), data, np.zeros(PLACE + SIDE, np.uint8)))
    out = []
    for shift in (0, SIDE + PLACE):
        total = np.zeros(len(places), np.uint64)
        for i in range(SIDE):
            total = (total + padded[np.maximum(places, 0) + shift + i]) * np.uint64(0x9E3779B97F4A7C15)
            total ^= total >> np.uint64(31)
        value = (total >> np.uint64(40)) % np.uint64(65535) + np.uint64(1)
        out.append(np.where(places < 0, 0, value).astype(np.uint16))
    return out[0], out[1]


def byte_blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows of about ``most`` bytes of text (column ``text``, binary); a longer text is a block of its own."""
    for batch in batches:
        sizes = np.array([len(t) for t in batch.column("text").to_pylist()], np.int64)
        start = held = 0
        for i, size in enumerate(sizes.tolist()):
            if held and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


# A task's runs for a bucket of places travel as one row. Kinds: runs; runs of crowded places; crowded places alone.
PLACED = "bucket int, kind int, n int, packed binary"
RUNS, CROWDED, TOLD = range(3)

NAMED = 6  # bytes of a place's hash that travel; places that agree in them are taken for one, which costs work only
WIRE = ("<u8", "<i8", "<u4", "u1", "<u2", "<u2")  # place, t1, at, count, left and right side


def packed(press: zstandard.ZstdCompressor, *columns: np.ndarray) -> tuple[int, bytes]:
    """Number and bytes of runs. Columns are WIRE's, or the first of them."""
    place = np.ascontiguousarray(columns[0], "<u8").view(np.uint8).reshape(-1, 8)[:, :NAMED]
    data = place.tobytes() + b"".join(c.astype(k).tobytes() for c, k in zip(columns[1:], WIRE[1:], strict=False))
    return len(place), press.compress(data)


def unpacked(expand: zstandard.ZstdDecompressor, n: int, data: bytes, columns: int = len(WIRE)) -> tuple[np.ndarray, ...]:
    data = expand.decompress(data)
    place = np.zeros((n, 8), np.uint8)
    place[:, :NAMED] = np.frombuffer(data, np.uint8, n * NAMED).reshape(n, NAMED)
    kinds = WIRE[1:columns]
    ends = np.cumsum([n * NAMED, *(n * np.dtype(kind).itemsize for kind in kinds)])
    return (place.view("<u8").ravel(), *(np.frombuffer(data[a:b], k) for a, b, k in zip(ends, ends[1:], kinds, strict=False)))


def by_bucket(bucket: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """Each bucket with its part of the columns."""
    order = np.argsort(bucket, kind="stable")
    bucket, columns = bucket[order], [c[order] for c in columns]
    ends = [*np.flatnonzero(np.diff(bucket)) + 1, len(bucket)]
    for a, b in zip([0, *ends], ends, strict=False):
        if a < b:
            yield int(bucket[a]), *(c[a:b] for c in columns)


def text_bucket(t1: np.ndarray, buckets: int) -> np.ndarray:
    return (t1.view(np.uint64) % np.uint64(buckets)).astype(np.int64)


def placed(batches: Iterator[pa.RecordBatch], limits: Limits, buckets: int) -> Iterator[pa.RecordBatch]:
    """All runs, by bucket of their place; a row for each bucket of many blocks. Copies within a block count once."""
    parts: list[tuple] = []
    told: list[np.ndarray] = []
    for block in byte_blocks(batches, limits.block):
        texts = dict(zip(block.column("t1").to_pylist(), block.column("text").to_pylist(), strict=True))
        owner, at, count, place, left, right = runs_by_piece(list(texts.values()), limits.piece)
        if not len(owner):
            continue
        place &= np.uint64((1 << 8 * NAMED) - 1)
        t1 = np.array(list(texts), np.int64)[owner]
        order = np.lexsort((t1, place))
        p, t = place[order], t1[order]
        first = np.concatenate(([True], p[1:] != p[:-1]))
        other = first | np.concatenate(([True], t[1:] != t[:-1]))
        many = (np.bincount(np.cumsum(first) - 1, weights=other) > limits.crowd)[np.cumsum(first) - 1]
        crowded = np.zeros(len(place), bool)
        crowded[order] = many
        told.append(p[first & many])
        parts.append((place, t1, at.astype(np.uint32), count.astype(np.uint8), left, right, crowded))
        if sum(len(columns[0]) for columns in parts) >= limits.held:
            yield placed_rows(parts, told, buckets)
            parts, told = [], []
    if parts:
        yield placed_rows(parts, told, buckets)


def placed_rows(parts: list[tuple], told: list[np.ndarray], buckets: int) -> pa.RecordBatch:
    *columns, crowded = (np.concatenate(c) for c in zip(*parts, strict=True))
    parts.clear()
    press, rows = zstandard.ZstdCompressor(level=1), []
    # A crowd is known to repeat: its runs go by text, where copies meet, and the others of the place are told.
    places = np.unique(np.concatenate(told))
    for number, *own in by_bucket((places % np.uint64(buckets)).astype(np.int64), places):
        rows.append((number, TOLD, *packed(press, *own)))
    for kind, some in ((CROWDED, crowded), (RUNS, ~crowded)):
        place, t1, *others = (c[some] for c in columns)
        bucket = text_bucket(t1, buckets) if kind == CROWDED else (place % np.uint64(buckets)).astype(np.int64)
        for number, *own in by_bucket(bucket, place, t1, *others):
            rows.append((number, kind, *packed(press, *own)))
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary())
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, ["bucket", "kind", "n", "packed"])


def side_groups(group: np.ndarray, t1: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether another text's run of the group has the side, and how many runs have. They come sorted by group and text."""
    key = (group.astype(np.uint64) << np.uint64(16)) | side
    order = np.argsort(key, kind="stable")
    k, t = key[order], t1[order]
    first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    sizes = np.diff(np.append(first, len(k)))
    met, many = np.empty(len(k), bool), np.empty(len(k), np.int64)
    met[order] = np.repeat(t[first] != t[first + sizes - 1], sizes)
    many[order] = np.repeat(sizes, sizes)
    return met, many


def sides_met(group: np.ndarray, t1: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Runs that agree in a side with another text's of their group. They come sorted by group and text."""
    met = (np.bincount(group, weights=left == 0) > 0)[group]  # a run without one place may meet any
    for side in (left, right):
        met |= side_groups(group, t1, side)[0]
    return met


# What is sent of a run, in steps that leave room for its count: all of it by its place; its windows, each by its own
# hash; the windows that hold the left side, the right side, or either, by place and side.
STEP = 40
WHOLE, WINDOWS, LEFT, RIGHT, BOTH = range(0, 5 * STEP, STEP)


def parted(group: np.ndarray, t1: np.ndarray, left: np.ndarray, right: np.ndarray, limits: Limits) -> np.ndarray:
    """What is sent of runs whose place too many share; -1: nothing. They come sorted by group and text."""
    group = np.unique(group, return_inverse=True)[1]
    loose = np.bincount(group, weights=left == 0)[group]
    (met_left, many_left), (met_right, many_right) = (side_groups(group, t1, side) for side in (left, right))
    met_left, met_right = met_left | (loose > 0), met_right | (loose > 0)
    out = np.where(met_left, np.where(met_right, BOTH, LEFT), np.where(met_right, RIGHT, -1))
    large = np.maximum(np.where(left == 0, 0, many_left), np.where(right == 0, 0, many_right)) > limits.most_sides
    # Equal windows go the same way, so a place is left as a whole.
    left_whole = (np.bincount(group, weights=large) > 0)[group] | (loose > limits.most_loose)
    return np.where(left_whole, WINDOWS, out)


BY_TEXT = "bucket int, n int, packed binary"  # place, t1, at, count
REPEATING = "t1 bigint, n int, packed binary"  # place, at, count


def shared(batches: Iterator[pa.RecordBatch], limits: Limits, buckets: int) -> Iterator[pa.RecordBatch]:
    """The runs that some other text may repeat, from whole buckets of places; a row for each bucket of texts.

    To their count is added what is sent of them.
    """
    parts, told, known = [], [], []
    expand, press = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
    for batch in batches:
        for kind, n, data in zip(*(batch.column(name).to_pylist() for name in ("kind", "n", "packed")), strict=True):
            if kind == TOLD:
                told += unpacked(expand, n, data, 1)
            else:
                (known if kind == CROWDED else parts).append(unpacked(expand, n, data))
    found = [(p, t, at, count + np.uint8(WINDOWS)) for p, t, at, count, _, _ in known]
    if parts:
        place, t1, at, count, left, right = (np.concatenate(c) for c in zip(*parts, strict=True))
        del parts
        order = np.lexsort((t1, place))
        p, t = place[order], t1[order]
        if len(order) > 1:  # copies of a text, from other blocks
            a = at[order]
            order = order[np.concatenate(([True], (p[1:] != p[:-1]) | (t[1:] != t[:-1]) | (a[1:] != a[:-1])))]
            p, t = place[order], t1[order]
        first = np.flatnonzero(np.concatenate(([True], p[1:] != p[:-1])))
        sizes = np.diff(np.append(first, len(p)))
        more = t[first] != t[first + sizes - 1]
        crowded = np.isin(p[first], np.concatenate(told)) if told else np.zeros(len(first), bool)
        many = more & (sizes > limits.most_runs)
        group = np.repeat(np.arange(len(first)), sizes)
        send = np.where(crowded[group], WINDOWS, -1)
        able = np.flatnonzero((more & ~many & ~crowded)[group])
        if len(able):
            own = order[able]
            send[able] = np.where(sides_met(group[able], t[able], left[own], right[own]), WHOLE, -1)
        able = np.flatnonzero((many & ~crowded)[group])
        if len(able):
            own = order[able]
            send[able] = parted(group[able], t[able], left[own], right[own], limits)
        own, send = order[send >= 0], send[send >= 0].astype(np.uint8)
        found.append((place[own], t1[own], at[own], count[own] + send))
    if not any(len(columns[0]) for columns in found):
        return
    place, t1, at, count = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.lexsort((at, t1))
    place, t1, at, count = place[order], t1[order], at[order], count[order]
    new = np.concatenate(([True], (t1[1:] != t1[:-1]) | (at[1:] != at[:-1])))  # copies of a text have the same runs
    place, t1, at, count = place[new], t1[new], at[new], count[new]
    rows = [(number, *packed(press, *own)) for number, *own in by_bucket(text_bucket(t1, buckets), place, t1, at, count)]
    kinds = (pa.int32(), pa.int32(), pa.binary())
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    yield pa.RecordBatch.from_arrays(columns, ["bucket", "n", "packed"])


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each text with all its runs, from whole buckets of texts."""
    parts, expand = [], zstandard.ZstdDecompressor()
    for batch in batches:
        for n, data in zip(*(batch.column(name).to_pylist() for name in ("n", "packed")), strict=True):
            parts.append(unpacked(expand, n, data, 4))
    if not parts:
        return
    place, t1, at, count = (np.concatenate(c) for c in zip(*parts, strict=True))
    del parts
    order = np.lexsort((count, at, t1))
    place, t1, at, count = place[order], t1[order], at[order], count[order]
    # Copies of a text may come from the task of a place and, crowded in a block, from that of the text.
    new = np.concatenate(([True], (t1[1:] != t1[:-1]) | (at[1:] != at[:-1]) | (count[1:] != count[:-1])))
    place, t1, at, count = place[new], t1[new], at[new], count[new]
    begins = np.flatnonzero(np.concatenate(([True], t1[1:] != t1[:-1])))
    ends = np.append(begins[1:], len(t1))
    for some in range(0, len(begins), 20_000):
        rows = []
        for a, b in zip(begins[some : some + 20_000].tolist(), ends[some : some + 20_000].tolist(), strict=True):
            data = place[a:b].tobytes() + at[a:b].astype("<u4").tobytes() + count[a:b].tobytes()
            rows.append((int(t1[a]), b - a, data))
        kinds = (pa.int64(), pa.int32(), pa.binary())
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, ["t1", "n", "packed"])


def runs_of(n: int, data: bytes) -> Iterator[tuple[int, int, int]]:
    """Place, first window and count, with what is sent added, of a text's runs."""
    place = np.frombuffer(data[: 8 * n], "<u8").view("<i8").tolist()
    at = np.frombuffer(data[8 * n : 12 * n], "<u4").tolist()
    return zip(place, at, data[12 * n :], strict=True)


def pressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts for their way through the exchange."""
    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        small = pa.array([press.compress(t) for t in batch.column("text").to_pylist()], pa.binary())
        yield batch.set_column(batch.schema.get_field_index("text"), "text", small)


def unpressed(texts: pa.Array) -> list[bytes]:
    expand = zstandard.ZstdDecompressor()
    return [expand.decompress(t) if t else b"" for t in texts.to_pylist()]


def side_routes(parts: list[bytes], places: list[int], sent: list[int]) -> Iterator[list[tuple[int, int, int]]]:
    """For each part, its windows as (route, first, stop): by place and by the side that the windows hold whole.

    The place is the first in a window that has it more than once, so equal windows have equal routes.
    """
    sizes = np.array([len(p) for p in parts], np.int64)
    data = np.frombuffer(b"".join(parts), np.uint8)
    name = np.array(places, np.int64).view(np.uint64)
    found = np.flatnonzero((place_hashes(data) & np.uint64((1 << 8 * NAMED) - 1)) == np.repeat(name, sizes))
    windows = sizes - LENGTH + 1
    owner = np.repeat(np.arange(len(parts)), windows)
    begins = np.cumsum(sizes) - sizes
    at = begins[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    held = np.searchsorted(found, at)
    left, right = side_hashes(data, found)
    in_left = found[held] - at >= SIDE
    side = np.where(in_left, left[held], right[held]).astype(np.uint64) << np.uint64(1) | in_left
    route = (name[owner] * np.uint64(0x9E3779B97F4A7C15) + side) * np.uint64(0xBF58476D1CE4E5B9)
    route = (route ^ route >> np.uint64(31)).view(np.int64)
    wanted = np.array(sent, np.int64)[owner]
    wanted = (wanted == BOTH) | (wanted == np.where(in_left, LEFT, RIGHT))
    new = np.concatenate(([True], (owner[1:] != owner[:-1]) | (route[1:] != route[:-1])))
    first = np.flatnonzero(new)
    out: list[list[tuple[int, int, int]]] = [[] for _ in parts]
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(owner)], strict=True):
        if wanted[a]:
            start = int(at[a] - begins[owner[a]])
            out[owner[a]].append((int(route[a]), start, start + b - a))
    yield from out


SENT = "route bigint, part binary, t1 bigint, owner bigint, at bigint, settled bigint"


def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the runs that may repeat, to the task of their place; of equal ones of a batch the least owner's.

    The others are settled: an owner with a smaller id holds all of their windows, and all that is sent of them is
    where they end.
    """
    names = ["route", "part", "t1", "owner", "at", "settled"]
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    for batch in batches:
        with no_collector():
            out = sent_rows(batch)
        for some in range(0, len(out), 100_000):
            columns = zip(*out[some : some + 100_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def sent_rows(batch: pa.RecordBatch) -> list[tuple]:
    rows, by_side = [], []
    texts = unpressed(batch.column("text"))
    own = [batch.column(name).to_pylist() for name in ("t1", "owner", "n", "packed")]
    for text, t1, owner, n, data in zip(texts, *own, strict=True):
        for place, at, count in runs_of(n, data):
            if count < WINDOWS:
                rows.append((place, text[at : at + count + LENGTH - 1], t1, owner, at))
            elif count >= LEFT:
                by_side.append((text[at : at + count % STEP + LENGTH - 1], place, count // STEP * STEP, t1, owner, at))
            else:
                for i in range(at, at + count - WINDOWS):
                    window = text[i : i + LENGTH]
                    rows.append((xxhash.xxh64_intdigest(window) - (1 << 63), window, t1, owner, i))
    for some in range(0, len(by_side), 20_000):
        own = by_side[some : some + 20_000]
        for (part, _, _, t1, owner, at), cuts in zip(own, side_routes(*([r[i] for r in own] for i in range(3))), strict=True):
            rows += [(route, part[a : b + LENGTH - 1], t1, owner, at + a) for route, a, b in cuts]
    least: dict[bytes, int] = {}
    for _, part, _, owner, _ in rows:
        if least.get(part, owner) >= owner:
            least[part] = owner
    settled: dict[tuple[int, int], list[tuple[int, int]]] = {}
    out = []
    for row in rows:
        place, part, t1, owner, at = row
        if least[part] == owner:
            out.append((*row, 0))
        else:
            settled.setdefault((t1, owner), []).append((at, at + len(part)))
    for (t1, owner), spans in settled.items():
        out += [(t1 ^ a, b"", t1, owner, a, b) for a, b in merged(spans)]
    return out


def repeated(parts: list[bytes], owners: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Number of a part and span in it, where its windows are equal to windows of a lesser owner."""
    sizes = np.array([len(p) for p in parts])
    data = np.frombuffer(b"".join(parts), np.uint8)
    order = suffix_order(data.astype(np.uint64) + np.uint64(1))
    part = np.repeat(np.arange(len(parts)), sizes)
    ends = np.cumsum(sizes)
    order = order[ends[part[order]] - order >= LENGTH]
    words = words_at(np.concatenate((data, np.zeros(LENGTH, np.uint8))))
    same = np.ones(max(len(order) - 1, 0), bool)
    for shift in [*range(0, LENGTH - 8, 8), LENGTH - 8]:
        value = words[order + shift]
        same &= value[1:] == value[:-1]
    first = np.flatnonzero(np.concatenate(([True], ~same)))
    own = owners[part[order]]
    low = np.minimum.reduceat(own, first)
    hit = np.zeros(len(data) + 1, bool)
    hit[order] = np.repeat(low, np.diff(np.append(first, len(order)))) < own
    # The last bytes of a part begin no window, so no hits go on from part to part.
    edges = np.flatnonzero(np.diff(hit, prepend=False))
    start, stop = edges[::2], edges[1::2]
    number = part[start]
    begin = (ends - sizes)[number]
    return zip(number.tolist(), (start - begin).tolist(), (stop - begin - 1 + LENGTH).tolist(), strict=True)


TOGETHER = MOST // 32  # bytes of parts that are sorted at once, so that they stay in the CPU's cache
COVERED = "t1 bigint, owner bigint, start bigint, stop bigint"


def covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of the owners' texts that repeat something earlier. Rows come sorted by route, part and owner."""
    groups: list[list[tuple[bytes, list[tuple]]]] = []  # of each route the different parts, with their holders
    group: list[tuple[bytes, list[tuple]]] = []
    holders: list[tuple] = []
    held, route, last, out = 0, None, None, []

    def work() -> None:
        together: list[tuple[bytes, list[tuple]]] = []
        size = 0
        for group in [*(g for g in groups if len(g) > 1), []]:
            size += sum(len(part) for part, _ in group)
            if together and (not group or size >= MOST - 1):
                owners = np.array([holders[0][1] for _, holders in together], np.int64)
                for i, a, b in repeated([part for part, _ in together], owners):
                    holders = together[i][1]
                    out.extend((t1, owner, at + a, at + b) for t1, owner, at in holders if owner == holders[0][1])
                together, size = [], sum(len(part) for part, _ in group)
            together += group
        for part, holders in (entry for group in groups for entry in group):
            if len(holders) > 1:
                least, size = holders[0][1], len(part)
                out.extend((t1, owner, at, at + size) for t1, owner, at in holders if owner > least)
        groups.clear()

    def flushed() -> pa.RecordBatch:
        columns = zip(*out, strict=True)
        batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["t1", "owner", "start", "stop"])
        out.clear()
        return batch

    for batch in batches:
        with no_collector():
            columns = [batch.column(name).to_pylist() for name in ("route", "part", "t1", "owner", "at", "settled")]
            for key, part, t1, owner, at, settled in zip(*columns, strict=True):
                if settled:
                    out.append((t1, owner, at, settled))
                    continue
                if key != route:
                    if held >= TOGETHER:
                        work()
                        held = 0
                    route = key
                    group = []
                    groups.append(group)
                    last = None
                if part != last:
                    last, holders = part, []
                    group.append((part, holders))
                    held += len(part)
                holders.append((t1, owner, at))
        if len(out) >= 100_000:
            yield flushed()
    work()
    if out:
        yield flushed()


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


JUDGED = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"


def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        own = [batch.column(name).to_pylist() for name in ("doc_id", "owner", "spans")]
        for text, doc_id, owner, spans in zip(unpressed(batch.column("text")), *own, strict=True):
            if doc_id is None:
                gone = []
            elif doc_id != owner:
                gone = [(0, len(text))] if len(text) >= LENGTH else []
            else:
                gone = merged([(s["start"], s["stop"]) for s in spans or []])
            ends = [0, *(x for span in gone for x in span), len(text)]
            kept = b"".join(text[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True))
            rows.append((len(text), len(text) - len(kept), len(gone), sha256(kept).hexdigest(), kept))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else []
        if rows:
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)


def without_repeats(documents: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes that stay). ``doc_id`` is a long."""
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text.cast("binary").alias("text"),
        F.xxhash64(text).alias("t1"),
        F.xxhash64(F.lit(1), text).alias("t2"),
    )
    owners = keyed.groupBy("t1", "t2").agg(F.min("doc_id").alias("owner"), F.max(F.length("text")).alias("n_bytes"))
    owners = landed(owners, "owners")
    # Whole buckets are worked on at once: their number grows with the text.
    whole = owners.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    tasks = max(int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")), whole // limits.task)
    # A bucket is a task: with more buckets, the rows, one for each task and bucket, would be many and small.
    found = keyed.select("t1", "text").mapInArrow(partial(placed, limits=limits, buckets=tasks), PLACED)
    found = found.repartitionById(tasks, "bucket").mapInArrow(partial(shared, limits=limits, buckets=tasks), BY_TEXT)
    repeating = landed(found.repartitionById(tasks, "bucket").mapInArrow(gathered, REPEATING), "repeating")
    repeating = repeating.join(owners, "t1").select("t1", "t2", F.col("owner").alias("least"), "n", "packed")
    kinds = "doc_id bigint, text binary, t1 bigint, t2 bigint"
    # Both joins read one exchange of the texts: the condition is no join key, and that keys of an inner join are not null
    # is said here, as Spark would otherwise say so on one side only.
    small = keyed.mapInArrow(pressed, kinds).where("t1 is not null and t2 is not null")
    mine = F.coalesce(F.col("doc_id") == F.col("least"), F.lit(False))
    texts = small.join(repeating, ["t1", "t2"]).where(mine)
    texts = texts.select("text", "t1", F.col("doc_id").alias("owner"), "n", "packed")
    parts = texts.mapInArrow(sent, SENT).repartition("route").sortWithinPartitions("route", "part", "owner")
    spans = parts.mapInArrow(covered, COVERED).groupBy("t1", "owner")
    spans = spans.agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    known = owners.join(spans, ["t1", "owner"], "left").select("t1", "t2", "owner", "spans")
    judged_rows = small.join(known, ["t1", "t2"], "left").select("doc_id", "text", "owner", "spans")
    return judged_rows.mapInArrow(judged, "doc_id bigint, " + JUDGED)
