"""URL rules and a block list held in a cascade of Bloom filters.

The cascade answers membership exactly for all keys of a known universe: the
keys of the whole corpus. Level 0 encodes the listed keys; the keys that it lets
pass wrongly are encoded by level 1, the listed ones that pass there wrongly by
level 2, and so on until nothing passes wrongly. A key is looked up level by
level; the first level that refuses it decides. So pages meet no list and no
join: bits are read from an array. Column functions only.

The bits are 10 a listed key and 2 more each time the universe doubles against
the list, so that few keys pass wrongly; they are sent to all executors while they are within
MOST_BITS, which is checked. A longer list is split over several cascades by key
hash, and pages go to the one of their key.

A null URL, or one without ``://``, has empty host and path and the empty key.
Null keys in a list are left out, repeated ones count once; listed keys outside
the universe are in it from then on. An empty list or an empty table gives the
empty cascade, which lists nothing.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galewatch.llm.shared import landed, small_letters

BITS_PER_KEY = 10
HASHES = 6
WORD = 64
MOST_BITS = 1 << 28  # of one cascade: 32 MB
MOST_LEVELS = 60  # each level holds a few hundredths of the one two above


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    def __str__(self) -> str:
        return f"{self.host}{self.path}"


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z in lower case; empty without."""
    return small_letters(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def fitting(rules: list[Rule], host: Column, path: Column) -> Column:
    """Struct of rule and verdict of the longest rule that fits, null if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(str(r)), str(r))):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.struct(F.lit(str(rule)).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(out)
    return out


def share_of(key: Column, shares: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("share"), key), F.lit(shares)).cast("int")


def places(key: Column, level: int, bits: Column) -> list[Column]:
    """Bits of a key, by double hashing."""
    a = F.xxhash64(F.lit(2 * level), key)
    b = F.xxhash64(F.lit(2 * level + 1), key).bitwiseOR(F.lit(1).cast("long"))
    return [F.pmod(F.pmod(a, bits) + i * F.pmod(b, bits), bits) for i in range(HASHES)]


def passes(key: Column, level: int, bits: Column, words: Column) -> Column:
    """Whether a level of so many bits, kept in an array of words, lets the key pass."""
    held = [
        F.getbit(F.element_at(words, (F.floor(at / WORD) + 1).cast("int")), F.pmod(at, F.lit(WORD)).cast("int")) == 1
        for at in places(key, level, bits)
    ]
    out = held[0]
    for one in held[1:]:
        out = out & one
    return out


def encoded(keys: DataFrame, level: int, bits_per_key: int) -> DataFrame:
    """share, bits, words: the level's filter of each share's keys (columns share, key)."""
    bits = (F.ceil(F.col("n") * bits_per_key / WORD) * WORD).cast("long").alias("bits")
    sizes = landed(keys.groupBy("share").agg(F.count(F.lit(1)).alias("n")).select("share", bits), "sizes")
    at = F.explode(F.array(*places(F.col("key"), level, F.col("bits"))))
    put = keys.join(sizes, "share").select("share", at.alias("at"))
    word = F.floor(F.col("at") / WORD).cast("int")
    bit = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("at", F.lit(WORD)).cast("int")))
    marked = put.groupBy("share", word.alias("word")).agg(bit.alias("value"))
    # Words without a bit are there too, so that a word's place in the array is its number.
    empty = sizes.select("share", F.explode(F.sequence(F.lit(0), (F.col("bits") / WORD - 1).cast("int"))).alias("word"))
    every = marked.unionByName(empty.withColumn("value", F.lit(0).cast("long")))
    every = every.groupBy("share", "word").agg(F.bit_or("value").alias("value"))
    ordered = F.array_sort(F.collect_list(F.struct("word", "value")))
    words = every.groupBy("share").agg(F.transform(ordered, lambda x: x["value"]).alias("words"))
    return words.join(sizes, "share")


@dataclass(frozen=True)
class Cascade:
    """levels: share, and for each level bits_i and words_i (null: the level has no keys of the share)."""

    levels: DataFrame
    depth: int
    shares: int

    def holds(self, frame: DataFrame, key: Column) -> tuple[DataFrame, Column]:
        """The frame with the bits at hand, and the condition that a key of the universe is listed."""
        if not self.depth:
            return frame, F.lit(False)
        if self.shares == 1:
            struct = self.levels.select(F.struct("*").alias("all"))
            view = struct.select(F.col("all")).scalar()
            get = lambda name: view.getField(name)
        else:
            view = self.levels.withColumnsRenamed({name: f"_{name}" for name in self.levels.columns})
            frame = frame.join(view, share_of(key, self.shares) == F.col("_share"), "left")
            get = lambda name: F.col(f"_{name}")
        listed = F.lit(self.depth % 2 == 1)
        for level in reversed(range(self.depth)):
            through = F.coalesce(passes(key, level, get(f"bits_{level}"), get(f"words_{level}")), F.lit(False))
            listed = F.when(~through, F.lit(level % 2 == 1)).otherwise(listed)
        return frame, listed


def cascade(listed: DataFrame, universe: DataFrame, most_bits: int = MOST_BITS) -> Cascade:
    """Exact for the keys of both frames (column ``key``, text)."""
    yes = listed.select("key").where("key is not null").distinct().withColumn("listed", F.lit(True))
    every = universe.select("key").where("key is not null").distinct().join(yes, "key", "full")
    every = landed(every.select("key", F.coalesce("listed", F.lit(False)).alias("listed")), "universe")
    n, rest = every.agg(F.count(F.when(F.col("listed"), 1)), F.count(F.when(~F.col("listed"), 1))).first()
    first = BITS_PER_KEY + 2 * max(0, math.ceil(math.log2(rest / n))) if n and rest else BITS_PER_KEY
    shares = max(1, -(-2 * n * first // most_bits))  # all levels together are under twice the first
    every = every.withColumn("share", share_of(F.col("key"), shares))
    mine, others = every.where("listed"), every.where("not listed")
    levels, depth = None, 0
    while depth < MOST_LEVELS and not mine.isEmpty():
        filters = landed(encoded(mine.select("share", "key"), depth, BITS_PER_KEY if depth else first), "level")
        through = passes(F.col("key"), depth, F.col("bits"), F.col("words"))
        wrong = others.join(filters, "share").where(through).select("key", "share")
        mine, others = landed(wrong, "passed"), mine.select("key", "share")
        own = filters.withColumnsRenamed({"bits": f"bits_{depth}", "words": f"words_{depth}"})
        levels = own if levels is None else levels.join(own, "share", "full")
        depth += 1
    if not mine.isEmpty():
        raise ValueError(f"keys still pass wrongly after {depth} levels")
    return Cascade(landed(levels, "cascade") if depth else mine, depth, shares)
