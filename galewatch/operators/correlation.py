"""Pearson correlation of columns, and of the columns of the resulting matrix."""

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galewatch.operators.encoding import present


def matrix_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The matrix as one row per column: (feature, one number per column).

    All pairs are aggregated in one pass over the rows that have every number;
    each task hands on one row of partial moments.
    """
    rows = df.where(present(columns)).select([F.col(name).cast("double").alias(name) for name in columns])
    pairs = list(combinations(columns, 2))
    moments = rows.agg(*[F.corr(x, y).alias(f"{x}|{y}") for x, y in pairs], F.count(F.lit(1)).alias("rows"))

    def cell(x: str, y: str):
        if x == y:
            return F.lit(1.0)
        return F.col(f"`{x}|{y}`" if (x, y) in pairs else f"`{y}|{x}`")

    lines = [F.struct(F.lit(x).alias("feature"), *[cell(x, y).alias(y) for y in columns]) for x in columns]
    return moments.select(F.inline(F.array(*lines)))


def to_long(matrix: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature_x, feature_y, corr), one row per cell."""
    long = matrix.unpivot("feature", list(columns), "feature_y", "corr")
    return long.withColumnRenamed("feature", "feature_x")


def correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature_x, feature_y, corr) of all pairs of columns."""
    return to_long(matrix_rows(df, columns), columns)


def correlation_of_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature_x, feature_y, corr) of the columns of the correlation matrix itself.

    How alike two features correlate with all of them; not the features' own correlation.
    """
    return to_long(matrix_rows(matrix_rows(df, columns), columns), columns)
