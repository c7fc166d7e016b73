"""Exact-size samples and splits that come out the same on every run and layout."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galewatch.functions import hashing

SHARES = 64  # parts in which a class is ranked first


def sample_n(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows in seeded hash order of the key.

    The n keys come first, from a scan of the key alone; then the rows of these
    keys are fetched whole. Only they are told apart by a hash of all columns, so
    that the sample is the same on any layout where rows share a key. (Maps have
    no hash; they don't count here.)
    """
    order = lambda column: (hashing.seeded(column, seed), column)
    held = df.select(F.col(key).alias(new_name(df, "key")))
    chosen = held.orderBy(*order(held[0])).limit(n).distinct()
    rows = df.join(chosen, df[key].eqNullSafe(chosen[0])).select(*[df[name] for name in df.columns])
    hashable = [field.name for field in df.schema if "map<" not in field.dataType.simpleString()]
    return rows.orderBy(*order(F.col(key)), F.xxhash64(*hashable)).limit(n)


def new_name(df: DataFrame, like: str) -> str:
    """A column name that the frame doesn't have."""
    while like.lower() in map(str.lower, df.columns):
        like += "_"
    return like


def first_per_class(df: DataFrame, label: str, n: int, *order: str) -> DataFrame:
    """The first n rows of every class in the given order, with their position ``rank``.

    Ranked twice: within shares of a class that the hash of the order key
    deals out, then what is left of them within the class. So no task gets more
    of a class than a share of it, or n rows of each share, whatever n is.
    """
    return ranked(df.withColumn("_share", F.pmod(F.xxhash64(*order), F.lit(SHARES))), label, n, order).drop("_share")


def ranked(df: DataFrame, label: str, n: int, order: Sequence[str | Column]) -> DataFrame:
    """``rank`` of rows with a ``_share``, up to n in each class."""
    first = F.row_number().over(Window.partitionBy(label, "_share").orderBy(*order))
    left = df.withColumn("_first", first).where(F.col("_first") <= n).drop("_first")
    rank = F.row_number().over(Window.partitionBy(label).orderBy(*order))
    return left.withColumn("rank", rank).where(F.col("rank") <= n)


def hash_split(
    df: DataFrame,
    key: str,
    weights: Mapping[str, float] = hashing.SPLIT_WEIGHTS,
    seed: int = hashing.SPLIT_SEED,
) -> DataFrame:
    """Adds ``split``; rows with the same key land in the same part."""
    return df.withColumn("split", hashing.split_name(F.col(key), weights, seed))
