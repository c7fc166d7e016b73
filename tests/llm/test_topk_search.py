"""Exact top-k search against a plain search in Python numbers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from galewatch.llm import topk_search

SCHEMA = "vec_id bigint, embedding array<double>"
EVERY = "vec_id % 5 = 0"


def plain(rows, k, scale=64.0):
    known = {}
    for vec_id, v in rows:
        if vec_id is None or v is None or any(x is None or not np.isfinite(x * scale) for x in v):
            continue
        known[vec_id, tuple(int(np.floor(x * scale)) for x in v)] = None
    out = []
    for q in known:
        if q[0] % 5 == 0:
            scored = [(-max(min(sum(a * b for a, b in zip(q[1], p[1])), 2**63 - 1), 1 - 2**63), p[0]) for p in known if p != q]
            out += [(q[0], rank, p, -s) for rank, (s, p) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def got(spark, rows, k, extra=()):
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", *[f"'clash' as {name}" for name in extra])
    return sorted(map(tuple, topk_search.top_k(frame.repartition(3), F.expr(EVERY), k).collect()))


@pytest.fixture
def small(monkeypatch):
    """Several blocks, batches and buckets of a few rows."""
    for name, size in (("BLOCK_VECTORS", 16), ("BATCH_QUERIES", 8), ("BUCKET", 4)):
        monkeypatch.setattr(topk_search, name, size)


def vectors(n, width, seed, spread=1.0):
    some = np.random.default_rng(seed)
    out = some.normal(size=(n, width)) * np.exp(some.normal(size=(n, 1)) * spread)
    return [(i, row.tolist()) for i, row in enumerate(out)]


@pytest.mark.parametrize(("width", "spread"), [(2, 0.0), (2, 1.5), (8, 0.5)])
def test_like_plain_search(spark, small, width, spread):
    rows = vectors(120, width, width, spread)
    assert got(spark, rows, 3) == plain(rows, 3)


def test_odd_rows(spark, small):
    same = [0.5, -0.25, 1.0]
    rows = [*[(i, same) for i in range(40)], (5, same), (5, same), (5, [9.0, 9.0, 9.0]), (None, same), (41, None), (45, [])]
    rows += [(50, [float("nan"), 1.0, 1.0]), (55, [float("inf"), 0.0, 0.0]), (60, [None, 1.0, 1.0]), (65, [0.0, 0.0, 0.0])]
    rows += [(70, [1.0]), (75, [-1.0, -1.0, -1.0]), (80, [1e12, 1e12, -1e12]), (85, [1e200, 1e-200, 0.0]), (90, [1e307, 0.0, 0.0])]
    assert got(spark, rows, 4, ("score", "grp", "v", "vec_key", "bound")) == plain(rows, 4)
    assert got(spark, rows[:2], 4) == plain(rows[:2], 4)
    assert got(spark, [], 4) == []


def test_pruned_searches_find_the_same():
    """The two ways to prune, and the skipped bucket, in one block."""
    some = np.random.default_rng(1)
    centres = some.normal(size=(30, 3))
    centres *= 10 / np.linalg.norm(centres, axis=1)[:, None]
    for spread in (0.0, 1.0):
        v = np.floor(64 * (np.repeat(centres, 12, axis=0) + 0.02 * some.normal(size=(360, 3))) * np.exp(spread * some.normal(size=(360, 1))))
        p = {"row": np.arange(360), "ids": np.arange(360), "keys": np.zeros(360, np.int64), "vectors": v}
        q = {name: column[::10] for name, column in p.items()}
        asked = []
        search = topk_search.Search(q, np.full(36, topk_search.LEAST), p, 5)
        search.by_coordinates, inner = lambda *a: asked.append(inner(*a)) or asked[-1], search.by_coordinates
        old, topk_search.BUCKET = topk_search.BUCKET, 40
        at, ids, _, scores = search.run()
        topk_search.BUCKET = old
        assert spread or any(asked)
        for i in range(36):
            want = sorted((-int(s), j) for j, s in enumerate(v @ q["vectors"][i]) if j != q["ids"][i])[:5]
            assert [(-s, j) for s, j in zip(scores[at == i].tolist(), ids[at == i].tolist())] == want
