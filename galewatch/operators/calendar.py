"""Counts by date and hour of ``created_at`` text."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from galewatch.functions import temporal


def parse_created_at(df: DataFrame, created_at: str) -> DataFrame:
    """Adds tweet_date, tweet_time and the full timestamp created_ts."""
    source = F.col(created_at)
    return df.withColumns(
        {
            "tweet_date": temporal.date_text(source),
            "tweet_time": temporal.time_text(source),
            "created_ts": temporal.instant(source),
        }
    )


def date_counts(df: DataFrame, created_at: str) -> DataFrame:
    """(tweet_date as MM-dd, count) ascending.

    Counts by the raw date text first, so dates are parsed once per distinct
    text after map-side combining instead of once per message. Unreadable
    dates are dropped by their count, not by the date: a filter on that would
    be pushed down to the messages, parsing with it.
    """
    by_text = df.groupBy(temporal.calendar_text(F.col(created_at)).alias("calendar")).count()
    by_day = by_text.select(temporal.month_day(F.col("calendar")).alias("tweet_date"), "count")
    readable = F.when(F.col("tweet_date").isNotNull(), F.col("count"))
    counts = by_day.groupBy("tweet_date").agg(F.sum(readable).alias("count"))
    return counts.where(F.col("count").isNotNull()).orderBy("tweet_date")


def hourly_counts(
    df: DataFrame, date: str = "tweet_date", clock: str = "tweet_time", by: Sequence[str] = ()
) -> DataFrame:
    """(by..., tweet_date, tweet_hour, count), messages without a readable hour left out.

    Those count as 0 and go by that, so that the hour is read once per message.
    """
    hours = df.select(*by, F.col(date).alias("tweet_date"), temporal.hour(F.col(clock)).alias("tweet_hour"))
    counts = hours.groupBy(*by, "tweet_date", "tweet_hour").agg(F.count("tweet_hour").alias("count"))
    return counts.where(F.col("count") > 0)


def mean_by_hour(counts: DataFrame) -> DataFrame:
    """(tweet_hour, avg_tweet_count) of hourly counts: mean over the dates on which the hour occurs."""
    return counts.groupBy("tweet_hour").agg(F.avg("count").alias("avg_tweet_count")).orderBy("tweet_hour")


def day_so_far(counts: DataFrame) -> DataFrame:
    """Hourly counts with their average over the day so far; a day has 24 rows at most."""
    so_far = Window.partitionBy("tweet_date").orderBy("tweet_hour")
    return counts.withColumn("avg_tweet_count", F.avg("count").over(so_far))


def avg_per_hour(df: DataFrame, date: str = "tweet_date", clock: str = "tweet_time") -> DataFrame:
    """(tweet_hour, avg_tweet_count) of messages."""
    return mean_by_hour(hourly_counts(df, date, clock))


def running_avg(df: DataFrame, date: str = "tweet_date", clock: str = "tweet_time") -> DataFrame:
    """Hourly counts of messages with their average over the day so far."""
    return day_so_far(hourly_counts(df, date, clock))
