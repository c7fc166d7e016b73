"""Graded quality by ordinal regression on hashed text.

A cumulative-link model: P(grade >= k) is the logistic function of score minus
threshold k. The score is a sum of weights, one set for all grades, over the
hashed words and word shapes that a text holds; the thresholds are ordered. The
model is fitted to graded ratings of a bounded sample; every whole text is then
given its expected grade and the probability of each grade or a better one.

Null and empty texts have no features, so their score is zero. Rows are graded
alike if their texts are; ratings without a document, and null ratings, don't
count; a document rated twice counts with each rating. Without ratings every
weight is zero and no document is refused.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galewatch.llm.shared import landed

SAMPLE = 16_000  # ratings that the model is fitted to, the first by hash
BUCKETS = 1 << 18
LEAST_SEEN = 4  # sampled documents that must hold a feature
LEAST_TELLING = 4.0  # standard deviations by which a feature must be off its share of lower or higher grades
EPOCHS, BATCH, SEED = 12, 128, 11
RATE, SHRINK = 0.15, 2e-5
MOST_KEPT = 300_000  # words that a Python worker remembers
EDGES = ".,;:!?\"'()[]{}"


class Features:
    """Numbers of the features that a text holds: its words without case and edges, and how they are written."""

    def __init__(self) -> None:
        self.known: dict[str, tuple[int, ...]] = {}

    def of_word(self, word: str) -> tuple[int, ...]:
        bare = word.strip(EDGES)
        named = [bare.lower()]
        if len(word) - len(bare) > 1:
            named.append("edge " + word[-2:])
        if len(bare) > 1 and bare.isupper():
            named.append("capitals")
        if bare and not bare.isalnum():
            named.append("signs " + "".join(sorted({c for c in bare if not c.isalnum()}))[:3])
        return tuple(xxhash.xxh32_intdigest(name, SEED) % BUCKETS for name in named)

    def of(self, text: str | None) -> np.ndarray:
        if len(self.known) > MOST_KEPT:
            self.known.clear()
        out: set[int] = set()
        for word in set((text or "").split()):
            numbers = self.known.get(word)
            if numbers is None:
                numbers = self.known[word] = self.of_word(word)
            out.update(numbers)
        return np.fromiter(out, np.int32, len(out))


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one for each grade above the lowest

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """(text, grade) probability of at least each grade from 1."""
        return logistic(scores[:, None] - self.thresholds[None, :])


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def summed(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def telling(rows: list[np.ndarray], grades: np.ndarray, top: int) -> np.ndarray:
    """Features that enough rows hold, and that stand with the grades below or above some threshold more than by chance.

    The many words that say nothing would drown the few that do.
    """
    keep = np.zeros(BUCKETS, bool)
    if not rows:
        return keep
    held = np.bincount(np.concatenate(rows), minlength=BUCKETS)
    for k in range(1, top + 1):
        low = np.flatnonzero(grades < k)
        share = len(low) / len(grades)
        if 0 < share < 1:
            found = np.bincount(np.concatenate([rows[i] for i in low]), minlength=BUCKETS)
            off = np.abs(found - held * share) / np.sqrt(np.maximum(held * share * (1 - share), 1e-9))
            keep |= off >= LEAST_TELLING
    return keep & (held >= LEAST_SEEN)


def fit(rows: list[np.ndarray], grades: np.ndarray, top: int) -> Model:
    """By Adagrad on the log likelihood; features that tell nothing keep weight zero."""
    random = np.random.default_rng(SEED)
    weights, seen = np.zeros(BUCKETS), np.full(BUCKETS, 1e-2)
    share = np.array([(np.count_nonzero(grades >= k) + 1) / (len(grades) + 2) for k in range(1, top + 1)])
    thresholds = np.log((1 - share) / share)
    keep = telling(rows, grades, top)
    rows = [row[keep[row]] for row in rows]
    for _ in range(EPOCHS):
        for some in np.array_split(random.permutation(len(rows)), max(1, -(-len(rows) // BATCH))):
            if not len(some):
                continue
            ids = np.concatenate([rows[i] for i in some])
            sizes = np.array([len(rows[i]) for i in some])
            above = logistic(summed(weights[ids], sizes)[:, None] - thresholds[None, :])
            edges = np.concatenate((np.ones((len(some), 1)), above, np.zeros((len(some), 1))), axis=1)
            each, grade = np.arange(len(some)), grades[some]
            upper, lower = edges[each, grade], edges[each, grade + 1]
            of_score = 1 - upper - lower
            chance = np.maximum(upper - lower, 1e-9)
            move = np.zeros(top + 2)
            np.add.at(move, grade, -upper * (1 - upper) / chance)
            np.add.at(move, grade + 1, lower * (1 - lower) / chance)
            step = np.bincount(ids, np.repeat(of_score, sizes), BUCKETS)
            seen += step * step
            weights += RATE * (step / np.sqrt(seen) - SHRINK * weights * len(some))
            thresholds = thresholds + 0.5 * move[1:-1] / len(some)
            thresholds = np.maximum.accumulate(thresholds + np.arange(top) * -0.05) + np.arange(top) * 0.05
    return Model(weights.astype(np.float32), thresholds.astype(np.float32))


def fitted(documents: DataFrame, ratings: DataFrame, top: int, sample: int = SAMPLE) -> Model:
    """The model of a bounded sample of ratings (doc_id, grade from 0 to ``top``)."""
    some = ratings.where("doc_id is not null and grade is not null").select(F.col("doc_id").alias("_id"), "grade")
    some = landed(some.orderBy(F.xxhash64("_id", F.lit(SEED)), "_id", "grade").limit(sample), "ratings")
    texts = documents.select("doc_id", "text").join(some, F.col("doc_id") == F.col("_id")).select("doc_id", "text", "grade")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            rows = [sorted(features.of(t).tolist()) for t in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id"), batch.column("grade").cast(pa.int32()), pa.array(rows, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "grade", "features"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    found = texts.mapInArrow(of, f"doc_id {kind}, grade int, features array<int>").toArrow()
    rows = [np.array(r, np.int32) for r in found.column("features").to_pylist()]
    grades = np.array(found.column("grade").to_pylist(), np.int64)
    ids = found.column("doc_id").to_pylist()
    order = sorted(range(len(rows)), key=lambda i: (ids[i], grades[i], rows[i].tolist()))
    return fit([rows[i] for i in order], grades[order] if order else grades, top)


def graded(documents: DataFrame, ratings: DataFrame, top: int = 2, cutoff: float = 0.5) -> DataFrame:
    """doc_id, expected_grade, p_at_least_k for each grade k from 1, kept.

    Kept: the best grade is at least as likely as ``cutoff``, or no rating says
    what a good text is.
    """
    model = fitted(documents, ratings, top)
    shared = documents.sparkSession.sparkContext.broadcast(model)  # BUCKETS weights
    names = [f"p_at_least_{k}" for k in range(1, top + 1)]
    blind = not np.any(model.weights)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, weights = Features(), shared.value.weights
        for batch in batches:
            texts = batch.column("text").to_pylist()
            scores = np.array([np.sum(np.sort(weights[features.of(t)]), dtype=np.float64) for t in texts])
            tails = np.round(shared.value.tails(scores), 6).astype(np.float64)
            columns = [batch.column("doc_id"), pa.array(np.round(tails.sum(axis=1), 6))]
            columns += [pa.array(tails[:, k]) for k in range(top)]
            columns.append(pa.array((tails[:, -1] >= cutoff) | blind))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "expected_grade", *names, "kept"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, expected_grade double, {', '.join(f'{n} double' for n in names)}, kept boolean"
    return documents.select("doc_id", "text").mapInArrow(of, schema)
