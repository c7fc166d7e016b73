"""Repeatable pseudo-random order and splits from row ids.

A hash of the id does not move when partitions are laid out differently or a
lost executor's task runs again, unlike rand() or randomSplit.
"""

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Share of rows and seed of the train/validation/test split.
SPLIT_WEIGHTS = {"train": 0.6, "val": 0.2, "test": 0.2}
SPLIT_SEED = 123


def seeded(key: Column, seed: int) -> Column:
    """md5 hex of ``key:seed``."""
    return F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed))))


def split_name(key: Column, weights: Mapping[str, float] = SPLIT_WEIGHTS, seed: int = SPLIT_SEED) -> Column:
    """Name of the part a row falls in, by where its hash lies in the weights' ranges."""
    names = list(weights)
    total = sum(weights.values())
    digest = seeded(key, seed)
    column = None
    upto = 0.0
    for name in names[:-1]:
        upto += weights[name]
        bound = format(int(round(upto / total, 12) * 0xFFFFFFFF), "08x")
        below = digest < bound
        column = F.when(below, name) if column is None else column.when(below, name)
    return F.lit(names[-1]) if column is None else column.otherwise(names[-1])
