"""Raw messages (JSON Lines) and topic labels (TSV) as typed frames."""

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from galewatch import schemas
from galewatch.functions import temporal
from galewatch.sources.tables import land_by_key


# Texts that the JSON reader takes for a double.
NOT_FINITE = ("NaN", "Infinity", "+Infinity", "-Infinity", "INF", "+INF", "-INF")


class MessageScan(NamedTuple):
    """Well-formed records; and the malformed ones, with their text, file and the fields that failed."""

    messages: DataFrame
    quarantine: DataFrame


def scan_messages(spark: SparkSession, *directories: str) -> MessageScan:
    """Read every ``*.json`` of all directories in one scan under one schema."""
    lines = spark.read.option("pathGlobFilter", "*.json").text(list(directories))
    return parse_messages(lines.select("value", F.col("_metadata.file_path").alias("file")))


def parse_messages(lines: DataFrame, keep: Sequence[str] = ()) -> MessageScan:
    """Records of JSON lines (columns ``value``, ``file``, and those to keep); blank lines are none.

    A record is malformed when it is no JSON object or any field has another
    type. Each line is parsed as a whole for that, whatever columns a query
    asks for: the JSON source would parse the asked ones only, so that counts
    would differ from query to query, and could not count records at all next
    to a corrupt-record column. ``inline`` makes it one parse per line; a plain
    column would be parsed again for the filter. Land the records with
    :func:`galewatch.sources.tables.land` once; scans of that read only what
    they need.

    Malformed lines come with the fields that failed (:func:`failed_fields`);
    only they are parsed for that. Well-formed ones have the columns to keep (and
    ``file`` then) beside the record.
    """
    schema = T.StructType([*schemas.RAW_MESSAGE.fields, T.StructField(schemas.CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT}
    parsed = F.inline(F.array(F.from_json("value", schema, options)))
    records = lines.where(F.col("value").rlike(r"\S")).select("file", *keep, parsed)
    corrupt = F.col(schemas.CORRUPT)
    fields = failed_fields(corrupt, schemas.RAW_MESSAGE)
    good = records.where(corrupt.isNull()).drop(schemas.CORRUPT)
    return MessageScan(
        messages=good if keep else good.drop("file"),
        quarantine=records.where(corrupt.isNotNull()).select("file", schemas.CORRUPT, fields.alias("fields")),
    )


def failed_fields(line: Column, schema: T.StructType) -> Column:
    """Paths of a JSON line's fields that have another type than the schema says, in the schema's order.

    ``user.id`` names a field, ``geo.coordinates[]`` an element of a list. The list
    is empty for a line that is no JSON at all or is cut off, and holds ``$`` for
    JSON that is no object. Null and missing fields are right for any type, any
    value is right for a text field.
    """
    value = F.try_parse_json(line)
    found = F.array_distinct(failed(value, schema, "$"))
    return F.when(value.isNull(), F.array().cast("array<string>")).otherwise(found)


def failed(value: Column, kind: T.DataType, path: str) -> Column:
    """Paths at or below a variant value that don't fit a type."""
    shape = F.schema_of_variant(value)
    none = F.array().cast("array<string>")
    below = none
    if isinstance(kind, T.StructType):
        fits = shape.startswith("OBJECT")
        inner = [
            failed(
                F.try_variant_get(value, f"$['{field.name}']", "variant"),
                field.dataType,
                field.name if path == "$" else f"{path}.{field.name}",
            )
            for field in kind.fields
            if not isinstance(field.dataType, T.StringType)
        ]
        below = F.concat(none, *inner)
    elif isinstance(kind, T.ArrayType):
        fits = shape.startswith("ARRAY")
        elements = F.try_variant_get(value, "$", "array<variant>")
        below = F.flatten(F.transform(elements, lambda element: failed(element, kind.elementType, f"{path}[]")))
    elif isinstance(kind, T.DoubleType):
        text = F.try_variant_get(value, "$", "string")
        fits = shape.isin("BIGINT", "DOUBLE", "FLOAT") | shape.startswith("DECIMAL") | text.isin(*NOT_FINITE)
    elif isinstance(kind, T.StringType):
        fits = F.lit(True)
    else:
        fits = shape == {T.LongType: "BIGINT", T.BooleanType: "BOOLEAN"}[type(kind)]
    wrong = F.array(F.lit(path))
    return F.when(value.isNull() | (shape == "VOID"), none).when(~fits, wrong).otherwise(F.coalesce(below, none))


def quarantine_counts(scan: MessageScan) -> DataFrame:
    """(file, field, count): malformed lines of each file by the field that failed.

    The field is null for lines without one to name (no JSON, cut off). A line
    with several counts for each of them.
    """
    named = scan.quarantine.select("file", F.explode_outer("fields").alias("field"))
    return named.groupBy("file", "field").count()


def flatten(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Nested records -> the 14-column flat message table, after the columns to keep."""
    created = F.col("created_at")
    return raw.select(
        *keep,
        F.col("id").alias("tweet_id"),
        created.alias("tweet_date_full"),
        F.col("geo.coordinates").alias("tweet_pos"),
        F.col("place.full_name").alias("tweet_place"),
        F.col("aidr.crisis_name").alias("crisis_name"),
        F.col("user.id").alias("user_id"),
        F.col("user.name").alias("user_name"),
        F.col("user.location").alias("user_location"),
        F.col("user.followers_count").alias("user_followers"),
        F.col("user.verified").alias("user_verified"),
        F.col("text"),
        F.col("entities.hashtags.text").alias("hashtags"),
        temporal.date_text(created).alias("tweet_date"),
        temporal.time_text(created).alias("tweet_time"),
    )


def read_messages(spark: SparkSession, *directories: str) -> DataFrame:
    """Flat message table of the well-formed records; :func:`scan_messages` has the others as well."""
    return flatten(scan_messages(spark, *directories).messages)


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """Label table, all strings: tweet_id, AIDRLabel, AIDRConfidence.

    ``enforceSchema=False`` makes a file with other columns, or the same in
    another order, fail instead of being paired up silently.
    """
    raw = (
        spark.read.schema(schemas.RAW_LABEL)
        .option("sep", "\t")
        .option("header", True)
        .option("enforceSchema", False)
        .csv(path)
    )
    return label_columns(raw)


def parse_labels(lines: DataFrame) -> DataFrame:
    """The same table from tab-separated lines (column ``value``) without a header; empty fields are null."""
    row = F.from_csv("value", schemas.RAW_LABEL.simpleString()[len("struct<") : -1].replace(":", " "), {"sep": "\t"})
    return label_columns(lines.select(F.inline(F.array(row))))


def label_columns(raw: DataFrame) -> DataFrame:
    return raw.withColumnRenamed("TweetID", "tweet_id").drop("Date")


def union_all(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name; a column some frame lacks is null there."""
    first, *others = frames
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def join_labels(messages: DataFrame, labels: DataFrame, key: str = "tweet_id") -> DataFrame:
    """Inner join; repeated keys on either side multiply rows, ids that are not numbers drop out.

    No broadcast hint: the label table grows with the messages, so Catalyst
    broadcasts it only below its threshold and otherwise sort-merges, where
    AQE splits a skewed key.
    """
    return messages.join(keyed_like(labels, messages, key), key, "inner")


def keyed_like(labels: DataFrame, messages: DataFrame, key: str = "tweet_id") -> DataFrame:
    """Labels with their key in the messages' type, null where the text is none."""
    return labels.withColumn(key, F.col(key).try_cast(messages.schema[key].dataType))


def land_for_join(
    messages: DataFrame, labels: DataFrame, tables: tuple[str, str], buckets: int, key: str = "tweet_id"
) -> DataFrame:
    """Store both sides bucketed and sorted by key under two table names; the join of the stored tables.

    Every question about labelled messages then reads and merges bucket by bucket;
    neither side passes an exchange again. The join is the same as
    :func:`join_labels`.
    """
    stored = land_by_key(messages, tables[0], key, buckets)
    known = keyed_like(labels, messages, key).where(F.col(key).isNotNull())
    # A hint, as labels below the broadcast threshold would be sent to all tasks each time.
    return stored.join(land_by_key(known, tables[1], key, buckets).hint("merge"), key, "inner")
