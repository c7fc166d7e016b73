"""Groups spelling variants of a corpus's words: words one code point apart, the rarer led to the much more frequent.

Words are counted where they are read. Each distinct word then gets two rows of
numbers: the nodes of a trie that its prefixes lead to, and those of a trie of
reversed words that its suffixes lead to. Two words differ in one code point at a
place if they have the prefix node before and the suffix node after it in common;
a word lacks one code point of another if the other's pair of nodes around that
code point is its own pair at one place. So all neighbours come from one join on
pairs of integers. A pair of nodes stands for one prefix and one suffix: at most
one word has nothing between them, and at most one per letter has one code point
there. So no group is larger than the alphabet, whatever the words are.

Tries are numbered in ranges of sorted words. The nodes that words of several
ranges share lie on the paths of the ranges' first and last words; these are
numbered by the driver, one path or two a range of WORDS_A_RANGE words, and every
other node where its range is.

Null texts have no words; null ids count as empty in the rule that damages runs.
Repeated rows count each. Ties go to the smallest word in code-point order. Extra
columns are not looked at. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galewatch.llm.shared import landed, small_letters

BETWEEN = "[^A-Za-z\\u00C0-\\u00FF]+"
LEAST_LETTERS = 6
LEAST_COUNT = 5
DAMAGED = 199  # one run in so many, by its hash, has lost a code point
TIMES = 5  # a form is so many times as frequent as its variant
WORDS_A_RANGE = 50_000


def damaged(doc_id: Column, run: Column) -> Column:
    """The run, without one code point where its document's hash says so."""
    hashed = F.crc32(F.encode(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run), "UTF-8"))
    at = F.pmod(hashed, F.char_length(run)).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(F.pmod(hashed, F.lit(DAMAGED)) == 0, shorter).otherwise(run)


def counted_words(documents: DataFrame) -> DataFrame:
    """word, n: the words of all texts that are long and frequent enough."""
    runs = F.explode(F.split(small_letters(F.col("text")), BETWEEN)).alias("run")
    # A run that is shorter than a word can't become one.
    runs = documents.where("text is not null").select("doc_id", runs).where(F.char_length("run") >= LEAST_LETTERS)
    words = runs.select(damaged(F.col("doc_id"), F.col("run")).alias("word")).where(F.char_length("word") >= LEAST_LETTERS)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_COUNT)


def shared_prefix(a: str, b: str) -> int:
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most
    low, high = 0, most - 1  # a[:low] == b[:low]; they differ within high + 1
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def paths(words: Iterable[str], first: int, start: tuple[str, list[int]], stop: tuple[str, list[int]]) -> Iterable[list[int]]:
    """For each of the ascending words the nodes of its prefixes, the empty one included; new ones count from ``first``.

    ``start`` and ``stop``: words at or before the first and at or after the last one, with nodes known already.
    """
    word, nodes = start
    last, ahead = stop
    for new in words:
        held, also = shared_prefix(word, new), shared_prefix(last, new)
        known = ahead[: also + 1] if also > held else nodes[: held + 1]
        fresh = len(new) + 1 - len(known)
        word, nodes = new, known + list(range(first, first + fresh))
        first += fresh
        yield nodes


def with_nodes(words: DataFrame, key: str) -> DataFrame:
    """word, nodes: the trie nodes of all prefixes of ``key`` (a column of distinct strings)."""
    spark = words.sparkSession
    ranges = max(-(-words.count() // WORDS_A_RANGE), 1)
    split = words.repartitionByRange(ranges, key).select("word", F.col(key).alias("key"), F.spark_partition_id().alias("part"))
    split = landed(split, "ranges")
    bounds = split.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last")).orderBy("part").collect()
    ends = sorted({word for row in bounds for word in (row["first"], row["last"])})
    numbered = dict(zip(ends, paths(ends, 1, ("", [0]), ("", [0])), strict=True))
    known = spark.sparkContext.broadcast({r["part"]: [(w, numbered[w]) for w in (r["first"], r["last"])] for r in bounds})

    def of(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        rows = sorted(zip(table.column("key").to_pylist(), table.column("word").to_pylist(), strict=True))
        nodes = list(paths((key for key, _ in rows), part + 1 << 40, *known.value[part]))
        return pa.table({"word": [word for _, word in rows], "nodes": pa.array(nodes, pa.list_(pa.int64()))})

    return split.groupBy("part").applyInArrow(of, "word string, nodes array<bigint>")


def near_words(words: DataFrame) -> DataFrame:
    """word, other, n, other_n: each word with each that is one code point away. ``words``: distinct word, and n."""
    forward = with_nodes(words.select("word"), "word").withColumnRenamed("nodes", "before")
    backward = with_nodes(words.select("word", F.reverse("word").alias("turned")), "turned").withColumnRenamed("nodes", "after")
    placed = words.join(forward, "word").join(backward, "word")
    size = F.char_length("word")

    def pair(i: Column, skipped: int) -> Column:
        """The nodes around ``skipped`` code points from place i on."""
        own = [F.get("before", i).alias("p"), F.get("after", size - i - skipped).alias("s"), F.lit(skipped).alias("skipped")]
        # Of equal code points in a row any may be left out; the first stands for all.
        first = F.lit(False) if not skipped else (i == 0) | (F.substring("word", i + 1, F.lit(1)) != F.substring("word", i, F.lit(1)))
        return F.struct(*own, first.alias("first"))

    places = F.concat(
        F.transform(F.sequence(F.lit(0), size - 1), lambda i: pair(i, 1)),
        F.transform(F.sequence(F.lit(0), size), lambda i: pair(i, 0)),
    )
    keys = landed(placed.select("word", "n", F.inline(places)), "pairs")
    several = keys.groupBy("p", "s").agg(F.count(F.lit(1)).alias("words")).where(F.col("words") > 1).select("p", "s")
    keys = landed(keys.join(several, ["p", "s"]), "met")
    skips, whole = keys.where("skipped = 1"), keys.where("skipped = 0")
    a, b = skips.alias("a"), skips.alias("b")
    same_nodes = (F.col("a.p") == F.col("b.p")) & (F.col("a.s") == F.col("b.s"))
    replaced = a.join(b, same_nodes & (F.col("a.word") != F.col("b.word")))
    longer = whole.alias("a").join(skips.where("first").alias("b"), same_nodes)
    columns = lambda x, y: [F.col(f"{x}.word").alias("word"), F.col(f"{y}.word").alias("other"), F.col(f"{x}.n").alias("n"), F.col(f"{y}.n").alias("other_n")]
    return replaced.select(*columns("a", "b")).unionByName(longer.select(*columns("a", "b"))).unionByName(longer.select(*columns("b", "a")))


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the last word that forms lead to. ``forms``: word, form, without circles.

    Each round doubles the way that is known; a form is TIMES as frequent as its
    word, so ways are short.
    """
    now = landed(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        further = now.join(ahead, F.col("root") == F.col("_word"), "left")
        further = landed(further.select("word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved")), "roots")
        now = further.select("word", "root")
        if further.where("moved").isEmpty():
            return now


def variants(documents: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n: a row for each word of the corpus."""
    words = landed(counted_words(documents), "words")
    near = near_words(words)
    most = near.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), F.max("other_n").alias("form_n"), F.min_by("other", F.struct(-F.col("other_n"), "other")).alias("form"))
    frequent = F.col("form_n") >= TIMES * F.col("n")
    most = most.select("word", "n_near", F.when(frequent, F.col("form")).alias("form"), F.when(frequent, F.col("form_n")).alias("form_n"))
    most = landed(most, "near")
    last = roots(most.where("form is not null"))
    whole = words.join(most, "word", "left").join(last, "word", "left")
    return whole.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
