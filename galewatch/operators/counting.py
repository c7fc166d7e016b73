"""Counts by key. All are map-side combined, so a hot key is one partial row per task."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    """(keys, count), most frequent first, ties by key."""
    return df.groupBy(*keys).count().orderBy(F.col("count").desc(), *keys)


def flag_counts(df: DataFrame, flag: str) -> DataFrame:
    """(flag, count) without the rows whose flag is unknown."""
    return count_by(df.where(F.col(flag).isNotNull()), flag)


def total(df: DataFrame, name: str) -> DataFrame:
    """One row (dataset, count)."""
    return df.agg(F.count(F.lit(1)).alias("count")).select(F.lit(name).alias("dataset"), "count")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def state_of(place: Column) -> Column:
    """What follows the first comma of ``City, ST`` (leading blank kept), null without one."""
    return F.get(F.split(place, ","), 1)


def in_states(state: Column, states: Sequence[str]) -> Column:
    """Case-sensitive substring test against any of the states."""
    found = F.lit(False)
    for name in states:
        found = found | state.contains(name)
    return found


def at_states(df: DataFrame, place: str, states: Sequence[str], state: str = "state") -> DataFrame:
    """Rows whose place lies in one of the states, with the state part of the place."""
    known = df.where(F.trim(place).isNotNull()).withColumn(state, state_of(F.col(place)))
    return known.where(in_states(F.col(state), states))


def state_counts(df: DataFrame, place: str, states: Sequence[str]) -> DataFrame:
    """(state, count) ascending, for state parts that begin with a blank."""
    counts = at_states(df, place, states).groupBy("state").count()
    return counts.where(F.col("state").startswith(" ")).orderBy("count", "state")
