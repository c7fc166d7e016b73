"""Repeated passages against a brute-force version, and the suffix order against sorted suffixes."""

from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from galewatch.llm import passages
from galewatch.llm.suffixes import suffix_order
from tests.llm import brute


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60))
def test_suffix_order(symbols):
    got = suffix_order(np.array(symbols, np.uint64)).tolist()
    assert got == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def digest(frame):
    rows = frame.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    return sorted((tuple(r) for r in rows), key=repr)


def shared_texts():
    random = np.random.default_rng(3)
    prose = lambda n: "".join(random.choice(list("abcdefg hé\n"), n))
    one, two, edge = prose(120), prose(60), prose(50)
    rows = [(i, prose(int(random.integers(0, 300)))) for i in range(60)]
    rows += [(60 + i, prose(40) + one + prose(int(random.integers(0, 90)))) for i in range(30)]
    rows += [(90 + i, prose(7) + two[: 40 + i] + prose(30) + one[i : i + 60]) for i in range(20)]
    rows += [(110, edge), (111, edge), (112, edge[:49]), (113, ""), (114, None), (115, one + one), (116, one)]
    rows += [(117, "ab" * 200), (118, "x" + "ab" * 300), (119, "ba" * 100), (120, " " * 400), (121, " " * 50)]
    rows += [(116, one), (116, one + "!"), (200, rows[70][1]), (201, rows[70][1])]
    return rows


def test_same_as_brute_force(documents):
    rows = shared_texts()
    got = digest(passages.without_repeats(documents(rows, "owner", "t1", "spans", "kept")))
    assert got == sorted(brute.passages(rows), key=repr)


@pytest.mark.parametrize(
    "limits", [passages.Limits(crowd=1), passages.Limits(most_runs=2), passages.Limits(crowd=0, most_runs=0), passages.Limits(block=500)]
)
def test_limits_change_nothing(documents, limits):
    rows = shared_texts()
    assert digest(passages.without_repeats(documents(rows), limits)) == sorted(brute.passages(rows), key=repr)


def test_null_ids_and_no_rows(documents, spark):
    text = "a passage of more than fifty bytes that stands in two rows of the table"
    got = digest(passages.without_repeats(documents([(None, text), (5, text), (7, text)])))
    assert [(r[0], r[2]) for r in got] == [(5, 0), (7, len(text)), (None, 0)]
    assert passages.without_repeats(documents([(1, "x")]).where("false")).collect() == []


def test_tasks_send_a_row_a_bucket_of_texts():
    """Not a row for each text of each task: those grow with texts times tasks."""
    random = np.random.default_rng(5)
    common = "".join(random.choice(list("abcdefgh"), 2_000)).encode()
    texts = {t1: common + b"%d" % t1 for t1 in range(-100, 200)}
    batch = pa.RecordBatch.from_arrays([pa.array(list(texts)), pa.array(list(texts.values()), pa.binary())], ["t1", "text"])
    limits, buckets = passages.Limits(crowd=400), 4
    sent = [row for part in passages.placed(iter([batch]), limits, 8) for row in part.to_pylist()]
    found = []
    for bucket in range(8):
        rows = pa.RecordBatch.from_pylist([row for row in sent if row["bucket"] == bucket])
        found += [row for part in passages.shared(iter([rows]), limits, buckets) for row in part.to_pylist()]
    assert len(found) <= 8 * buckets
    whole = {}
    for bucket in range(buckets):
        rows = pa.RecordBatch.from_pylist([row for row in found if row["bucket"] == bucket])
        for part in passages.gathered(iter([rows, rows])):
            for row in part.to_pylist():
                assert row["t1"] not in whole
                whole[row["t1"]] = list(passages.runs_of(row["n"], row["packed"]))
    assert whole.keys() == texts.keys()
    for runs in whole.values():
        windows = {w for _, at, count in runs for w in range(at, at + count)}
        assert len(windows) == sum(count for _, _, count in runs) >= 1_900


def windows_of(texts):
    """Every window's content -> (text, place, sides) of the run it is in."""
    owner, at, count, place, left, right = passages.runs(texts)
    out = []
    for i, a, n, *own in zip(owner, at, count, place, left, right, strict=True):
        out += [(texts[i][w : w + passages.LENGTH], int(i), *map(int, own)) for w in range(a, a + n)]
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", max_size=160), max_size=6), st.lists(st.integers(0, 90), max_size=6), st.integers(0, 2**32))
def test_equal_windows_agree_in_a_side(texts, cuts, seed):
    random = np.random.default_rng(seed)
    common = "".join(random.choice(list("abcdefgh"), 140))
    texts = [t.encode() for t in texts] + [("x" * cut + common[cut:]).encode() for cut in cuts] + [common[:70].encode()]
    texts += [(common[30:100] * 2).encode()]
    windows = windows_of(texts)
    assert len(windows) == sum(max(len(t) - passages.LENGTH + 1, 0) for t in texts)
    by_content = {}
    for content, _, place, left, right in windows:
        by_content.setdefault(content, []).append((place, left, right))
    for runs in by_content.values():
        assert len({place for place, _, _ in runs}) == 1
        for _, left, right in runs:
            assert all(0 in (left, other_left) or left == other_left or right == other_right for _, other_left, other_right in runs)


PARTED = passages.Limits(crowd=10**6, most_runs=2)


@pytest.mark.parametrize(
    "limits", [PARTED, replace(PARTED, most_sides=3), replace(PARTED, most_loose=0), replace(PARTED, block=700, held=50)]
)
def test_parted_places_change_nothing(documents, limits):
    rows = shared_texts()
    assert digest(passages.without_repeats(documents(rows), limits)) == sorted(brute.passages(rows), key=repr)


def dealt(texts, limits, buckets):
    """What placed() and shared() return for a block of texts."""
    batch = pa.RecordBatch.from_arrays([pa.array(list(texts)), pa.array(list(texts.values()), pa.binary())], ["t1", "text"])
    sent = [row for part in passages.placed(iter([batch]), limits, buckets) for row in part.to_pylist()]
    found = []
    for bucket in sorted({row["bucket"] for row in sent}):
        rows = pa.RecordBatch.from_pylist([row for row in sent if row["bucket"] == bucket])
        found += [row for part in passages.shared(iter([rows]), limits, buckets) for row in part.to_pylist()]
    return sent, found


def test_a_frequent_place_does_not_send_all_windows():
    """A place in many texts, with other bytes around it: only what agrees with another text beside the place is sent."""
    random = np.random.default_rng(7)
    prose = lambda n: bytes(random.choice(list(b"abcdefghijklmnop"), n).astype(np.uint8))
    place = min((prose(16) for _ in range(20_000)), key=lambda p: passages.place_hashes(np.frombuffer(p, np.uint8))[0])
    alike = prose(40)
    texts = {t1: prose(60) + place + (alike if t1 < 10 else prose(40)) + prose(30) for t1 in range(400)}
    _, found = dealt(texts, passages.Limits(crowd=10**6, most_runs=300), 1)
    rows = pa.RecordBatch.from_pylist(found)
    repeating = [row for part in passages.gathered(iter([rows])) for row in part.to_pylist()]
    columns = {name: [r[name] for r in repeating] for name in ("t1", "n", "packed")}
    columns |= {"text": [texts[t1] for t1 in columns["t1"]], "owner": columns["t1"]}
    pressed = next(passages.pressed(iter([pa.RecordBatch.from_pydict(columns)])))
    sent = [row for part in passages.sent(iter([pressed])) for row in part.to_pylist()]
    assert {row["t1"] for row in sent} >= set(range(10))
    assert len(sent) <= 60  # 35 windows of each of 400 texts before


def test_tasks_pack_blocks_together():
    """A row for each bucket of a task, and not of each of its blocks: those grow with blocks times buckets."""
    random = np.random.default_rng(9)
    texts = {t1: bytes(random.choice(list(b"abcdefgh"), 900).astype(np.uint8)) for t1 in range(200)}
    sent, _ = dealt(texts, passages.Limits(block=2_000), 6)
    assert len(sent) <= 6
    sent, _ = dealt(texts, passages.Limits(block=2_000, held=2_500), 6)
    assert 6 < len(sent) <= 6 * 5
