"""Exact search for the largest inner products, by vectors grouped by length.

Components are whole numbers (the floor of a multiple), so products are exact.
Vectors are grouped by length on a fixed geometric scale, and a group is dealt
into blocks by id. Queries meet one block of the longest vectors first; the k-th
best product there is a bound for each query, and a group whose longest vector
can't reach it is not visited at all. Every other pair of a batch of queries and
a block is one task's group of rows.

In a block vectors are cut into buckets of falling length. A query's bound over
its own length and the bucket's is the cosine that a vector there must reach:
above 1 the bucket is skipped. Below, either length decides (products of the
vectors that are long enough) or coordinates do: where the query's largest
components leave few vectors within the interval that this cosine permits, those
few alone are multiplied. Whatever is left is verified by its product, and
bounds rise from bucket to bucket.

Vectors that are null, hold null or a component that is not finite (also once
multiplied), and rows without an id take no part; an empty vector's products are
0. Of vectors of different sizes the shorter counts as ending in zeros. Rows with
one id and one vector are one row; rows that share an id only are rows of their
own, and each is a query of its own. Ties go to the smaller id. Products beyond
64 bits are given as the nearest number of 64 bits. Extra columns are not looked
at. An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galewatch.llm.shared import landed

BLOCK_VECTORS = 16_384
BATCH_QUERIES = 4_096
BUCKET = 1_024
GROUPS_PER_DOUBLING = 4  # of the squared length
FOCUS = 4  # components of a query that coordinate pruning looks at
FEW = 8  # coordinates decide where they leave less than one in so many
EXACT = 2.0**53  # below, sums of whole numbers are exact as doubles
LEAST = -(2**63)  # below every score
MARGIN = 1e-9  # relative; far more than lengths and cosines are off by


def prepared(vectors: DataFrame, scale: float) -> DataFrame:
    """vec_id, vec_key (hash of the vector), v (whole numbers as doubles), squared (length), grp."""

    def whole(x: Column) -> Column:
        """floor() gives a long, which a large double doesn't fit in; such doubles are whole numbers already."""
        y = x.cast("double") * scale
        return F.when(F.abs(y) < 2.0**52, F.floor(y).cast("double")).otherwise(y)

    rows = vectors.where("embedding is not null and vec_id is not null")
    rows = rows.select("vec_id", F.transform("embedding", whole).alias("v"))
    rows = rows.where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    squared = F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x)
    rows = rows.select("vec_id", F.xxhash64("v").alias("vec_key"), "v", squared.alias("squared"))
    step = F.floor(F.log2(F.least("squared", F.lit(1e308))) * GROUPS_PER_DOUBLING)
    return rows.withColumn("grp", F.when(F.col("squared") > 0, step).otherwise(F.lit(-10_000).cast("long")))


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k largest products of each query with any other row, all if there are fewer.

    ``vectors``: vec_id bigint and embedding, an array of numbers. ``is_query``
    chooses the queries by vec_id.
    """
    rows = prepared(vectors, scale)
    # A row for each step of the scale: some ten thousand at most, were there vectors of every length that a double has.
    found = rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.max("squared").alias("longest"), F.count_if(is_query).alias("q"))
    groups = sorted(map(tuple, found.collect()), reverse=True) or [(0, 0, 0.0, 0)]
    batches = max(-(-sum(q for *_, q in groups) // BATCH_QUERIES), 1)
    steps = [(grp, max(-(-n // BLOCK_VECTORS), 1), math.sqrt(longest)) for grp, n, longest, _ in groups]
    blocks = F.create_map(*[F.lit(x).cast("long") for grp, n, _ in steps for x in (grp, n)])
    places = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.element_at(blocks, F.col("grp"))))
    places = places.withColumn("batch", F.explode(F.sequence(F.lit(0), F.lit(batches - 1))))
    queries = rows.where(is_query).withColumn("batch", F.pmod(F.xxhash64("vec_id"), F.lit(batches)).cast("int")).drop("grp")

    head = steps[0][0]
    is_head = (F.col("grp") == head) & (F.col("block") == 0)
    start = queries.withColumns({"grp": F.lit(head).cast("long"), "block": F.lit(0).cast("long"), "bound": F.lit(None).cast("long")})
    seeds = landed(met(start, places.where(is_head), k), "seeds")
    last = seeds.groupBy("query_id", "query_key").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
    last = last.where(F.col("n") >= k).select(F.col("query_id").alias("vec_id"), F.col("query_key").alias("vec_key"), F.col("least").alias("bound"))
    # Products are at most the product of the lengths; a bound of 0 or less keeps all groups.
    listed = F.array(*[F.struct(F.lit(grp).cast("long").alias("grp"), F.lit(n).cast("long").alias("n"), F.lit(longest).alias("longest")) for grp, n, longest in steps])
    bound = F.coalesce("bound", F.lit(0))
    near = F.filter(listed, lambda step: (bound <= 0) | (F.sqrt("squared") * step["longest"] * (1 + MARGIN) >= bound))
    visits = queries.join(last, ["vec_id", "vec_key"], "left").withColumn("step", F.explode(near))
    visits = visits.withColumn("grp", F.col("step.grp")).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("step.n") - 1)))
    met_later = met(visits.where(~is_head).drop("step"), places.where(~is_head), k)
    order = Window.partitionBy("query_id", "query_key").orderBy(F.col("score").desc(), "vec_id", "vec_key")
    ranked = seeds.unionByName(met_later).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def met(queries: DataFrame, places: DataFrame, k: int) -> DataFrame:
    """query_id, query_key, vec_id, vec_key, score: what each batch's queries find in each block they visit, k each at most."""

    def of(left: pa.Table, right: pa.Table) -> pa.Table:
        width = max(pa.compute.max(pa.compute.list_value_length(table.column("v"))).as_py() or 0 for table in (left, right))
        q, p = distinct_rows(left, width), distinct_rows(right, width)
        bound = left.column("bound").fill_null(LEAST).to_numpy()[q["row"]]
        at, ids, keys, scores = best_of_block(q, bound, p, k)
        columns = [q["ids"][at], q["keys"][at], ids, keys, scores]
        return pa.table(dict(zip(["query_id", "query_key", "vec_id", "vec_key", "score"], map(pa.array, columns), strict=True)))

    keys = ["batch", "grp", "block"]
    # Columns of their own: both sides come from one frame.
    left = queries.select(*[F.col(name).alias(name) for name in ("vec_id", "vec_key", "v", "bound", *keys)]).groupBy(*keys)
    right = places.select("vec_id", "vec_key", "v", *keys).groupBy(*keys)
    schema = "query_id bigint, query_key bigint, vec_id bigint, vec_key bigint, score bigint"
    return left.cogroup(right).applyInArrow(of, schema)


def distinct_rows(table: pa.Table, width: int) -> dict[str, np.ndarray]:
    """ids, keys and vectors (zeros at the end) of the distinct rows by (id, key), and each one's place in the table."""
    ids, keys = table.column("vec_id").to_numpy(), table.column("vec_key").to_numpy()
    row = np.lexsort((keys, ids))
    fresh = np.ones(len(row), bool)
    fresh[1:] = (ids[row][1:] != ids[row][:-1]) | (keys[row][1:] != keys[row][:-1])
    row = row[fresh]
    lists = table.column("v").combine_chunks()
    sizes = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    vectors = np.zeros((len(table), width))
    vectors[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return {"row": row, "ids": ids[row], "keys": keys[row], "vectors": vectors[row]}


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole-number rows, exact, as 64-bit numbers; beyond their range the nearest of them."""
    most = a.shape[1] * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0))
    if most < EXACT:
        return (a @ b.T).astype(np.int64)
    if most < 2.0**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    whole = np.frompyfunc(int, 1, 1)
    return np.clip(whole(a) @ whole(b).T, 1 - 2**63, 2**63 - 1).astype(np.int64)


def best_of_block(q: dict, bound: np.ndarray, p: dict, k: int) -> tuple[np.ndarray, ...]:
    """Place of the query, vec_id, vec_key and score of the k best of each query that reach its bound."""
    parts = [(np.zeros(0, np.int64),) * 4]
    large = np.abs(q["vectors"]).max(axis=1, initial=0) >= math.sqrt(EXACT / max(q["vectors"].shape[1], 1))
    for some in (np.flatnonzero(~large), np.flatnonzero(large)):  # few large ones must not take the others from the fast products
        if len(some) and len(p["ids"]):
            at, *found = Search({name: column[some] for name, column in q.items()}, bound[some], p, k).run()
            parts.append((some[at], *found))
    return tuple(np.concatenate(columns) for columns in zip(*parts, strict=True))


class Search:
    def __init__(self, q: dict, bound: np.ndarray, p: dict, k: int):
        self.k, self.q, self.p, self.bound = k, q, fewer_copies(p, k + 1), bound.copy()
        with np.errstate(over="ignore"):
            self.q_length = np.sqrt(np.einsum("ij,ij->i", q["vectors"], q["vectors"]))
            p_length = np.sqrt(np.einsum("ij,ij->i", self.p["vectors"], self.p["vectors"]))
        down = np.argsort(-p_length, kind="stable")
        self.p, self.p_length = {name: column[down] for name, column in self.p.items()}, p_length[down]
        with np.errstate(divide="ignore", invalid="ignore"):
            unit = np.nan_to_num(q["vectors"] / self.q_length[:, None], posinf=0, neginf=0)
        self.focus = np.argsort(-np.abs(unit), axis=1)[:, :FOCUS]
        self.toward = np.take_along_axis(unit, self.focus, axis=1)
        self.best = (np.zeros(0, np.int64),) * 4  # query's place, score, id, key

    def run(self) -> tuple[np.ndarray, ...]:
        for first in range(0, len(self.p_length), BUCKET):
            self.visit(slice(first, first + BUCKET))
        at, scores, ids, keys = self.best
        return at, ids, keys, scores

    def visit(self, bucket: slice) -> None:
        vectors, length = self.p["vectors"][bucket], self.p_length[bucket]
        # A vector must be this long to reach the query's bound.
        with np.errstate(divide="ignore", invalid="ignore"):
            needed = np.where(self.bound > 0, self.bound / (self.q_length * (1 + MARGIN)), -1.0)
        enough = np.searchsorted(-length, -needed, side="right")
        by_place = self.by_coordinates(vectors, length, needed, enough)
        plain = np.flatnonzero((enough > 0) & ~np.isin(np.arange(len(enough)), list(by_place)))
        hits = []
        if len(plain):
            upto = int(enough[plain].max())
            hits.append(self.hits(plain, bucket.start + np.arange(upto)))
        hits += [self.hits(np.array([i]), bucket.start + few) for i, few in by_place.items() if len(few)]
        if hits:
            self.keep([np.concatenate(x) for x in zip(*hits, strict=True)])

    def by_coordinates(self, vectors: np.ndarray, length: np.ndarray, needed: np.ndarray, enough: np.ndarray) -> dict[int, np.ndarray]:
        """For the queries that coordinates decide for: places in the bucket that may reach the bound."""
        if not length[0] or not np.isfinite(length[0]):
            return {}
        cosine = needed / length[0]
        asked = np.flatnonzero((enough > 0) & (cosine > 0) & np.isfinite(self.q_length))
        if not len(asked):
            return {}
        cosine = np.minimum(cosine[asked], 1.0)[:, None]
        unit = vectors / np.where(length > 0, length, 1.0)[:, None]
        order = np.argsort(unit, axis=0)
        ranks = np.take_along_axis(unit, order, axis=0)
        # The angle to an axis differs from the query's by the angle between both at most.
        own, apart = np.arccos(np.clip(self.toward[asked], -1, 1)), np.arccos(cosine)
        low, high = np.cos(np.minimum(own + apart, np.pi)) - MARGIN, np.cos(np.maximum(own - apart, 0)) + MARGIN
        focus, start, stop = self.focus[asked], np.zeros(low.shape, np.int64), np.zeros(low.shape, np.int64)
        for axis in np.unique(focus):
            here = focus == axis
            start[here] = np.searchsorted(ranks[:, axis], low[here], side="left")
            stop[here] = np.searchsorted(ranks[:, axis], high[here], side="right")
        out = {}
        narrow = np.argmin(stop - start, axis=1)
        for i in np.flatnonzero((stop - start).min(axis=1) * FEW < enough[asked]).tolist():
            j = narrow[i]
            few = order[start[i, j] : stop[i, j], focus[i, j]]
            inside = unit[few][:, focus[i]]
            out[int(asked[i])] = few[((inside >= low[i]) & (inside <= high[i])).all(axis=1)]
        return out

    def hits(self, queries: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, ...]:
        scores = products(self.q["vectors"][queries], self.p["vectors"][places])
        ids, keys = self.p["ids"][places], self.p["keys"][places]
        reached = scores >= self.bound[queries][:, None]
        if reached.sum() > 4 * self.k * len(queries) and len(places) > self.k + 1:
            reached &= scores >= np.partition(scores, -self.k - 1, axis=1)[:, [-self.k - 1]]  # the query itself may be above
        reached &= (ids != self.q["ids"][queries][:, None]) | (keys != self.q["keys"][queries][:, None])
        i, j = np.nonzero(reached)
        return queries[i], scores[i, j], ids[j], keys[j]

    def keep(self, hits: list[np.ndarray]) -> None:
        """The k best of each query, and where there are k, the last one's score as its bound."""
        at, scores, ids, keys = (np.concatenate(x) for x in zip(self.best, hits, strict=True))
        order = np.lexsort((keys, ids, -scores, at))
        at = at[order]
        starts = np.searchsorted(at, at)
        place = np.arange(len(at)) - starts
        kept = order[place < self.k]
        full = place == self.k - 1
        self.bound[at[full]] = np.maximum(self.bound[at[full]], scores[order[full]])
        self.best = tuple(np.concatenate(x)[kept] for x in zip(self.best, hits, strict=True))


def fewer_copies(p: dict, most: int) -> dict:
    """Of equal vectors those with the least ids; no others can be among the best."""
    if not p["vectors"].shape[1]:
        kind = np.zeros(len(p["ids"]), np.int64)
    else:
        whole = np.ascontiguousarray(p["vectors"] + 0.0)
        kind = np.unique(whole.view(f"V{whole.shape[1] * 8}").ravel(), return_inverse=True)[1]
    order = np.lexsort((p["keys"], p["ids"], kind))
    place = np.arange(len(order)) - np.searchsorted(kind[order], kind[order])
    chosen = order[place < most]
    return {name: column[chosen] for name, column in p.items()}
