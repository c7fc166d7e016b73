"""Hourly counts kept beside the messages: new files are counted once and merged with what was counted before.

The counts are a stored table with a row for each (file, version, date, hour).
A file is known by its path and its time of modification, so a file that was
taken before is not read again, one that has changed is counted anew in place of
its earlier version, and a run that is repeated after a failure changes nothing.
The table grows with files and the hours they hold, not with messages.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from galewatch.operators import calendar
from galewatch.sources import messages

VERSION = ("file", "modified")
HOUR = ("tweet_date", "tweet_hour")


def stored_files(spark: SparkSession, *directories: str) -> DataFrame:
    """(file, modified) of every ``*.json`` of the directories that isn't empty; a listing, no file is opened."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(list(directories))
    return listed.select(F.col("path").alias("file"), F.col("modificationTime").alias("modified"))


def take_files(spark: SparkSession, table: str, *directories: str) -> int:
    """Count the files that the table doesn't hold in this version and add them; how many these were.

    Only those files are read. Their paths go through the driver, as those of any
    scan do.
    """
    found = stored_files(spark, *directories)
    if spark.catalog.tableExists(table):
        found = found.join(spark.table(table).select(*VERSION).distinct(), list(VERSION), "left_anti")
    paths = [row.file for row in found.select("file").collect()]
    if paths:
        lines = spark.read.text(paths).select("value", *version_columns())
        read = messages.parse_messages(lines, keep=["modified"])
        # Files without a well-formed record count as taken too.
        seen = lines.select(*VERSION).distinct()
        add(table, messages.flatten(read.messages, keep=VERSION), seen)
    return len(paths)


def take(table: str, flat: DataFrame, date: str = "tweet_date", clock: str = "tweet_time") -> None:
    """Count the rows of a frame with columns ``file`` and ``modified`` that the table doesn't hold, and add them.

    For frames that don't come from JSON files; :func:`version_columns` gives both
    columns for any file source. Null dates and unreadable hours count nowhere.
    """
    spark = flat.sparkSession
    if spark.catalog.tableExists(table):
        flat = flat.join(spark.table(table).select(*VERSION).distinct(), list(VERSION), "left_anti")
    add(table, flat, None, date, clock)


def version_columns() -> list:
    """``file`` and ``modified`` of a frame that was just read from files."""
    source = {"file": "_metadata.file_path", "modified": "_metadata.file_modification_time"}
    return [F.col(field).alias(name) for name, field in source.items()]


def add(
    table: str, flat: DataFrame, seen: DataFrame | None, date: str = "tweet_date", clock: str = "tweet_time"
) -> None:
    counted = calendar.hourly_counts(flat, date, clock, by=VERSION)
    if seen is not None:
        counted = seen.join(counted, list(VERSION), "left")
    counted.write.mode("append").format("parquet").saveAsTable(table)


def hourly_counts(spark: SparkSession, table: str) -> DataFrame:
    """(tweet_date, tweet_hour, count) over the newest version of every file.

    The same version in the table twice, as two runs at a time may leave it,
    counts once. One exchange by file, one of partial sums by hour.
    """
    versions = Window.partitionBy("file")
    newest = spark.table(table).withColumn("newest", F.max("modified").over(versions))
    rows = newest.where((F.col("modified") == F.col("newest")) & F.col("tweet_hour").isNotNull())
    once = rows.groupBy(*VERSION, *HOUR).agg(F.max("count").alias("count"))
    return once.groupBy(*HOUR).agg(F.sum("count").alias("count"))


def avg_per_hour(spark: SparkSession, table: str) -> DataFrame:
    """As :func:`galewatch.operators.calendar.avg_per_hour`, over what the table holds."""
    return calendar.mean_by_hour(hourly_counts(spark, table))


def running_avg(spark: SparkSession, table: str) -> DataFrame:
    """As :func:`galewatch.operators.calendar.running_avg`, over what the table holds."""
    return calendar.day_so_far(hourly_counts(spark, table))
