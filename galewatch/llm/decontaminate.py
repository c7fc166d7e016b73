"""Benchmark passages in documents, by a prefix-filtered join.

A window is 13 consecutive words of an item, or the whole of a shorter item. A
document holds a window only if it holds all of its shingles, so one necessary
shingle is enough to find candidates: the one that is rarest in the corpus
(prefix filter for containment 1.0). Bounds on position and length follow from
the place of that shingle in window and document; what is left is verified word
by word. Column functions only.

Nulls and texts without words have no words and no hits. Repeated rows each get
their own result row. Ties of rarity go to the smaller hash, then the earlier
place. An empty benchmark leaves every document clean.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galewatch.llm.shared import landed, small_letters, split_words, text_key

BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13  # words
SHINGLE = 3  # words; windows of fewer words use single words
BROADCAST_KEYS = 4_000_000  # necessary shingles of 8 bytes that every executor may hold; beyond, rows are shuffled to them


def words_of(text: Column) -> Column:
    return split_words(small_letters(text), BETWEEN)


def shingle_at(words: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(words, at + i) for i in range(size)])


def item_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """item_id, words: the distinct windows of each item."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("words"))
    items = items.where(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(window))
    starts = F.sequence(F.lit(0), F.size("words") - length)
    items = items.select("item_id", "words", length.alias("length"), F.explode(starts).alias("start"))
    return items.select("item_id", F.slice("words", F.col("start") + 1, F.col("length")).alias("words")).distinct()


def window_shingles(windows: DataFrame, size: int) -> DataFrame:
    """words, place, key: each window's shingles."""
    places = F.sequence(F.lit(0), F.size("words") - size)
    held = windows.select("words", F.explode(places).alias("place"))
    return held.withColumn("key", shingle_at(F.col("words"), F.col("place"), size))


def positions(documents: DataFrame, size: int) -> DataFrame:
    """A row for each word place of each document, and one at -1, which stands for the document itself."""
    placed = documents.select(
        "doc_id", F.col("text"), words_of(F.col("text")).alias("words")
    ).select(
        "doc_id",
        text_key(F.col("text")).alias("text_key"),
        "words",
        F.explode(F.sequence(F.lit(-1), F.size("words") - 1)).alias("at"),
    )
    return placed.withColumn("key", F.when(F.col("at") >= 0, shingle_at(F.col("words"), F.col("at"), size)))


def keyed(rows: DataFrame, keys: DataFrame, how: str = "inner") -> DataFrame:
    """Join on the shingle; the keys travel only while their number is within the bound, checked by a count."""
    small = keys.count() <= BROADCAST_KEYS
    return rows.join(F.broadcast(keys) if small else keys, "key", how)


def necessary_shingles(documents: DataFrame, windows: DataFrame, size: int) -> DataFrame:
    """words, key, place: of each window the shingle that is rarest over all documents."""
    shingles = landed(window_shingles(windows, size), "window-shingles")
    met = keyed(positions(documents, size).select("key"), landed(shingles.select("key").distinct(), "shingle-keys"))
    counts = met.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    rarity = F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("key"), F.col("place"))
    rarest = shingles.join(counts, "key", "left").groupBy("words").agg(F.min(rarity).alias("rarest"))
    return rarest.select("words", "rarest.key", "rarest.place")


def occurrences(documents: DataFrame, windows: DataFrame, size: int, window: int) -> DataFrame:
    """doc_id, text_key, n_words, words, start: verified places of windows, and one row with null words per row of documents."""
    needed = landed(necessary_shingles(documents, windows, size), "needed")
    keys = landed(needed.select("key").distinct().withColumn("necessary", F.lit(True)), "needed-keys")
    # Around a necessary shingle lies all that any of its windows can cover.
    first = F.greatest(F.col("at") - window, F.lit(0))
    around = F.slice("words", first + 1, F.lit(2 * window))
    rows = positions(documents, size).withColumn("n_words", F.size("words"))
    kept = ["doc_id", "text_key", "n_words", "at", "key"]
    if keys.count() <= BROADCAST_KEYS:
        met = rows.join(F.broadcast(keys), "key", "left").where(F.col("necessary") | (F.col("at") < 0))
        met = met.select(*kept, F.when(F.col("at") >= 0, around).alias("around"))
    else:
        met = rows.select(*kept, F.when(F.col("at") >= 0, around).alias("around"))
        met = met.join(keys, "key", "left").where(F.col("necessary") | (F.col("at") < 0)).drop("necessary")
    met = landed(met.select(*kept, "around"), "met")
    start = F.col("at") - F.col("place")
    within = (start >= 0) & (start + F.size("words") <= F.col("n_words"))
    offset = start - F.greatest(F.col("at") - window, F.lit(0))
    same = F.slice("around", offset + 1, F.size("words")) == F.col("words")
    found = met.where("at >= 0").join(needed, "key").where(within).where(same)
    return (
        found.select("doc_id", "text_key", "n_words", "words", start.alias("start"))
        .unionByName(met.where("at < 0").select("doc_id", "text_key", "n_words"), allowMissingColumns=True)
    )


def covered(spans: Column) -> Column:
    """Words inside any of the (start, end) spans."""
    begin = F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n"))

    def step(so_far, span):
        fresh = F.greatest(span["end"] - F.greatest(so_far["upto"], span["start"]), F.lit(0))
        return F.struct(F.greatest(so_far["upto"], span["end"]).alias("upto"), (so_far["n"] + fresh).alias("n"))

    return F.aggregate(F.array_sort(spans), begin, step, lambda last: last["n"])


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, text_key, n_words, n_hit, items (sorted ids as text), contaminated; a row for each row of documents.

    Contaminated: at least a twentieth of the words lie in windows.
    """
    documents = documents.select("doc_id", "text")
    held = landed(item_windows(benchmark, window), "windows")
    windows = held.select("words").distinct()
    sizes = [SHINGLE]
    if not windows.where(F.size("words") < SHINGLE).isEmpty():
        sizes.append(1)
    parts = []
    for size in sizes:
        own = windows.where(F.size("words") >= SHINGLE if size == SHINGLE else F.size("words") < SHINGLE)
        part = occurrences(documents, own, size, window)
        parts.append(part if size == SHINGLE else part.where(F.col("words").isNotNull()))
    rows = landed(reduce(DataFrame.unionByName, parts), "occurrences")
    row = ["doc_id", "text_key"]
    end = F.col("start") + F.size("words")
    span = F.when(F.col("words").isNotNull(), F.struct(F.col("start"), end.alias("end")))
    by_row = rows.groupBy(*row).agg(
        F.max("n_words").alias("n_words"),
        F.count(F.when(F.col("words").isNull(), 1)).alias("copies"),
        covered(F.collect_set(span)).alias("n_hit"),
    )
    hits = rows.where(F.col("words").isNotNull()).select(*row, "words").distinct()
    items = hits.join(held, "words").groupBy(*row).agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    items = items.withColumnsRenamed({"doc_id": "hit_id", "text_key": "hit_key"})
    out = by_row.join(
        items, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_key") == F.col("hit_key")), "left"
    )
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return out.select(
        "doc_id",
        "text_key",
        F.col("n_words").cast("long").alias("n_words"),
        F.col("n_hit").cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def without_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Documents, with all their columns, that are not contaminated."""
    bad = decontaminate(documents, benchmark, window).where("contaminated")
    bad = landed(bad.select(F.col("doc_id").alias("_bad_id"), F.col("text_key").alias("_bad_key")).distinct(), "bad")
    same = documents["doc_id"].eqNullSafe(bad["_bad_id"]) & (text_key(documents["text"]) == bad["_bad_key"])
    return documents.join(bad, same, "left_anti")
