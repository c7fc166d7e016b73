"""Stored tables, small parameter tables, and the write side."""

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILES_A_DAY = 16  # at most


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def parameter_table(spark: SparkSession, columns: Sequence[str], rows: Iterable[Sequence]) -> DataFrame:
    """Local relation from caller-given rows.

    Built from Arrow, its exact size is known to the planner, so joins against
    it need no hint: it is broadcast below the threshold and not above.
    """
    by_column = zip(*rows, strict=True)
    return spark.createDataFrame(pa.table(dict(zip(columns, map(list, by_column), strict=True))))


def land(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a frame as Parquet, for instance the flat table parsed once from JSON."""
    df.write.mode(mode).parquet(path)


def land_by_day(df: DataFrame, path: str, day: str = "tweet_date") -> None:
    """Write a frame with a folder for each day. Days that are there already are replaced, others stay as they are.

    So a run may be repeated, or take one day again, and readers of a day scan
    that day's folder only. Rows are dealt out by day and by a hash of the row, so
    that no task has all of a busy day and no day has a file from every task.
    """
    share = F.pmod(F.xxhash64(*[c for c, kind in df.dtypes if "map<" not in kind]), F.lit(FILES_A_DAY))
    dealt = df.repartition(day, share)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def land_by_key(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """Write a frame as a table bucketed and sorted by key, replacing it, and return the stored table.

    Tables with the same number of buckets join by that key without an exchange:
    each task reads a bucket of both sides. Choose the number so that a bucket
    fits a task. A key that holds a large share of all rows makes a large bucket;
    land such a table plainly and let the join split the key.
    """
    spark = df.sparkSession
    writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return spark.table(table)
