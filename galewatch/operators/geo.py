"""Points for maps and segments of tracks."""

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from galewatch.sources.tables import parameter_table

# Invented damage positions (latitude, longitude) along the storm's way, in order.
DAMAGE = (
    (24.4, -93.6), (25.0, -94.4), (25.6, -95.1), (26.3, -95.8), (27.1, -96.3), (27.8, -96.8), (28.0, -96.9),
    (28.2, -97.1), (28.7, -97.3), (29.0, -97.5), (29.2, -97.4), (29.3, -97.6), (29.1, -97.5), (29.0, -97.2),
    (28.8, -96.8), (28.6, -96.5), (28.5, -96.2), (28.4, -95.9), (28.2, -95.4), (28.1, -95.0), (28.2, -94.6),
    (28.5, -94.2), (28.9, -93.8), (29.4, -93.6), (29.8, -93.5), (30.1, -93.4), (30.6, -93.1), (31.3, -92.6),
    (31.9, -92.2), (32.5, -91.7), (33.4, -90.9), (34.1, -89.6),
)

# Colours of the two kinds of points, red-green-blue.
COLORS = {"Tweet": (0, 0, 255), "Damage": (255, 0, 0)}


def damage_points(spark: SparkSession, points=DAMAGE) -> DataFrame:
    """(seq, lat, lon, description) of the given points."""
    rows = [(i, lat, lon, f"Damage {i}") for i, (lat, lon) in enumerate(points, start=1)]
    return parameter_table(spark, ["seq", "lat", "lon", "description"], rows)


def located(df: DataFrame, position: str) -> DataFrame:
    """(lat, lon) of the rows with a position; positions are [lat, lon] arrays."""
    known = df.where(F.col(position).isNotNull())
    return known.select(
        F.get(position, F.lit(0)).cast("double").alias("lat"),
        F.get(position, F.lit(1)).cast("double").alias("lon"),
    )


def tagged(points: DataFrame, kind: str) -> DataFrame:
    color = F.array(*[F.lit(part) for part in COLORS[kind]])
    return points.select("lat", "lon", F.lit(kind).alias("type"), color.alias("color"))


def points_union(messages: DataFrame, position: str, damage: DataFrame) -> DataFrame:
    """(lat, lon, type, color) of the located messages and the damage points."""
    return tagged(located(messages, position), "Tweet").unionByName(tagged(damage, "Damage"))


def trajectory_segments(df: DataFrame, track: str, seq: str, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """(track, seq, start_lat, start_lon, end_lat, end_lon) for each point that has a next one.

    ``seq`` is a number, date or timestamp and unique in its track; points
    without track or seq are on no line. A track can hold most of all points, so no window runs over a
    whole one: quantiles of ``seq`` cut it into pieces of about rows / shuffle
    partitions, lead() runs within a piece, and the last point of a piece gets
    the first one of the next piece, found among the pieces' heads (one row
    each).
    """
    points = df.select(
        F.col(track).alias("track"),
        F.col(seq).alias("seq"),
        F.col(lat).alias("start_lat"),
        F.col(lon).alias("start_lon"),
    ).dropna(subset=["track", "seq"])
    count = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = cut(points.withColumn("_place", numeric(points, "seq")), "_place", "piece", count).drop("_place")

    heads = pieces.groupBy("track", "piece").agg(
        F.min_by("start_lat", "seq").alias("lat"), F.min_by("start_lon", "seq").alias("lon")
    )
    by_piece = Window.partitionBy("track").orderBy("piece")
    onward = heads.select(
        "track",
        "piece",
        F.lead("piece").over(by_piece).isNotNull().alias("goes_on"),
        F.lead("lat").over(by_piece).alias("onward_lat"),
        F.lead("lon").over(by_piece).alias("onward_lon"),
    )

    in_piece = Window.partitionBy("track", "piece").orderBy("seq")
    linked = pieces.withColumns(
        {
            "inside": F.lead("seq").over(in_piece).isNotNull(),
            "next_lat": F.lead("start_lat").over(in_piece),
            "next_lon": F.lead("start_lon").over(in_piece),
        }
    )
    return (
        linked.join(onward, ["track", "piece"])
        .where(F.col("inside") | F.col("goes_on"))
        .select(
            "track",
            "seq",
            "start_lat",
            "start_lon",
            F.when(F.col("inside"), F.col("next_lat")).otherwise(F.col("onward_lat")).alias("end_lat"),
            F.when(F.col("inside"), F.col("next_lon")).otherwise(F.col("onward_lon")).alias("end_lon"),
        )
    )


def numeric(df: DataFrame, column: str) -> Column:
    """A number in the order of a column's values."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return F.unix_micros(F.col(column).cast("timestamp"))
    return F.unix_date(column) if isinstance(kind, T.DateType) else F.col(column)


def cut(df: DataFrame, column: str, into: str, pieces: int) -> DataFrame:
    """Adds the number of the quantile range a value lies in; equal values share a range.

    Only the ``pieces - 1`` cut points come to the driver.
    """
    shares = [i / pieces for i in range(1, pieces)]
    points = sorted(set(df.approxQuantile(column, shares, 1 / (4 * pieces)))) if shares else []
    if not points:
        return df.withColumn(into, F.lit(0))
    ranges = Bucketizer(splits=[float("-inf"), *points, float("inf")], inputCol="_cut", outputCol="_range")
    ranged = ranges.transform(df.withColumn("_cut", F.col(column).cast("double")))
    return ranged.withColumn(into, F.col("_range").cast("int")).drop("_cut", "_range")
