"""Near-duplicate documents by SimHash, found through segment popcounts.

A fingerprint is cut into 16 segments of 4 bits, and the bit counts of the
segments are a point of a grid. One differing bit moves one count by one, so the
Manhattan distance of two points is a lower bound of the number of differing
bits. Points within distance 2 have a grid cell within distance 1 of both; so
each fingerprint is put on its own cell and its neighbours (33 at most), cells
are joined, and candidates are verified on the bits.

Copies share a fingerprint and are grouped before all this. Where many different
fingerprints meet in a cell, the cell is refined: its fingerprints go on to the
grid of one-bit segments, on which the bound is the distance itself. There a
cell holds at most 65 fingerprints, all linked to each other, and a star
replaces the pairs. No pair is lost, and no group is expanded.

Null, empty and wordless texts have fingerprint zero and are linked like any
other. Repeated rows get a row each. Null ids are left out of the minimum; a
group without any id has a null one. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galewatch.llm.graph import components
from galewatch.llm.shared import CAPITALS, SMALL, landed, text_key

MOST_BITS = 2  # the cells above are built for this distance
SHINGLE = 3  # words
SEED = 42
REFINED_FROM = 16  # fingerprints in a cell; below, its pairs are compared

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(CAPITALS.encode(), SMALL.encode())
BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles' XXH64; 0 without words."""
    words = WORD.findall((text or "").encode().translate(LOWER))
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(len(words) - shingle + 1, 1)
    starts = np.concatenate(([0], ends[: n - 1] + 1)).tolist()
    stops = ends[shingle - 1 :].tolist() if len(words) >= shingle else [len(joined)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)), np.uint64, n)
    # Bit counts from how often each byte value stands at each of the eight places.
    at = hashes.view(np.uint8).reshape(n, 8)
    counts = np.concatenate([np.bincount(at[:, i], minlength=256) @ BYTE_BITS for i in range(8)])
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(documents: DataFrame) -> DataFrame:
    """doc_id, text_key, fp (the 64 bits as a long)."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py()) for t in batch.column("text")), np.uint64, batch.num_rows)
            columns = [batch.column("doc_id"), batch.column("text_key"), pa.array(fps.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "fp"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select("doc_id", "text", text_key(F.col("text")).alias("text_key"))
    return rows.mapInArrow(of, f"doc_id {kind}, text_key bigint, fp bigint")


def counts_of_segments(fp: Column) -> Column:
    """Sixteen 4-bit segments, each replaced by its bit count."""
    lowest = F.lit(0x1111111111111111)
    bits = [F.shiftrightunsigned(fp, i).bitwiseAND(lowest) for i in range(4)]
    return bits[0] + bits[1] + bits[2] + bits[3]


def cells(point: Column) -> Column:
    """The point's cell and those one step away."""
    around = [point]
    for i in range(16):
        count, one = F.shiftrightunsigned(point, 4 * i).bitwiseAND(F.lit(15).cast("long")), F.lit(1 << 4 * i)
        around += [F.when(count < 4, point + one), F.when(count > 0, point - one)]
    return F.array_compact(F.array(*around))


def links(fps: DataFrame) -> DataFrame:
    """u, v: fingerprints at most MOST_BITS apart, enough of them to connect all that are. ``fps``: distinct fp."""
    fps = fps.select("fp")
    put = fps.withColumn("point", counts_of_segments(F.col("fp")))
    put = put.select("fp", "point", F.explode(cells(F.col("point"))).alias("cell"))
    met = put.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("cell"))).where("n > 1")
    met = landed(met, "cells")
    few = met.where(F.col("n") < REFINED_FROM)
    a, b = few.alias("a"), few.alias("b")
    apart = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= MOST_BITS
    # Pairs with equal points meet on all their cells; the own cell is enough.
    once = (F.col("a.point") != F.col("b.point")) | (F.col("a.cell") == F.col("a.point"))
    close = a.join(b, (F.col("a.cell") == F.col("b.cell")) & (F.col("a.fp") < F.col("b.fp")) & apart & once)
    pairs = close.select(F.col("b.fp").alias("u"), F.col("a.fp").alias("v"))
    crowded = met.where(F.col("n") >= REFINED_FROM).select("fp").distinct()
    flips = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(bit)) for bit in one_bits()])
    fine = crowded.select("fp", F.explode(flips).alias("cell"))
    first = fine.withColumn("low", F.min("fp").over(Window.partitionBy("cell")))
    stars = first.where("fp != low").select(F.col("fp").alias("u"), F.col("low").alias("v"))
    return pairs.unionByName(stars).distinct()


def one_bits() -> list[int]:
    return [1 << i for i in range(63)] + [-(1 << 63)]


def grouped_rows(documents: DataFrame) -> DataFrame:
    """doc_id, text_key, fp, least (doc_id and text_key of the group's first row), a row for each row of documents."""
    prints = landed(fingerprints(documents), "fingerprints")
    known_id = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_key"))
    classes = landed(prints.groupBy("fp").agg(F.min(known_id).alias("first")), "classes")
    roots = components(links(classes)).withColumnRenamed("node", "fp")
    rooted = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    heads = rooted.groupBy("root").agg(F.min("first").alias("least"))
    known = rooted.join(heads, "root").select("fp", "least")
    return prints.join(landed(known, "components"), "fp")


def grouped(documents: DataFrame) -> DataFrame:
    """doc_id, fp, component_id (least doc_id of the group), a row for each row of documents."""
    return grouped_rows(documents).select("doc_id", "fp", F.col("least.doc_id").alias("component_id"))


def one_of_each(documents: DataFrame) -> DataFrame:
    """Documents, with all their columns: of each group the row with the least doc_id.

    Rows are told apart by id and text, as ids can be null or repeat. Of a
    group's texts with the least id the one with the least key stays, and of its
    repeated rows one. A group without ids stays whole.
    """
    groups = landed(grouped_rows(documents).select("doc_id", "text_key", "least"), "groups")
    row = F.struct("doc_id", "text_key")
    gone = groups.where(F.col("least").isNotNull() & (row != F.col("least")))
    gone = landed(gone.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct(), "gone")
    key = text_key(documents["text"])
    left = documents.join(gone, documents["doc_id"].eqNullSafe(gone["_id"]) & (key == gone["_key"]), "left_anti")
    twice = groups.where("doc_id is not null").groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    twice = landed(twice.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")), "twice")
    if twice.isEmpty():
        return left
    same = (documents["doc_id"] == twice["_id"]) & (key == twice["_key"])
    once = left.join(twice, same, "left_anti")
    return once.unionByName(left.join(twice, same, "left_semi").dropDuplicates(["doc_id", "text"]))
