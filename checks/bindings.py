"""The library's operators bound to the stored test tables: key -> (spark, directory) -> DataFrame.

A binding only projects stored columns into the shape an operator expects;
each query reads whole tables.
"""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import params
from galewatch.functions import wordlists
from galewatch.operators import (
    calendar,
    classify,
    correlation,
    counting,
    encoding,
    geo,
    metrics,
    sampling,
    sentiment,
    words,
)
from galewatch.plans import hourly, reports
from galewatch.sources import messages
from galewatch.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


# ---- inputs -----------------------------------------------------------------


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return read_table(spark, f"{directory}/{name}.parquet")


def created_at(ts: str = "ts"):
    return F.date_format(ts, "EEE MMM dd HH:mm:ss '+0000' yyyy")


def posts(spark: SparkSession, directory: str) -> DataFrame:
    """Events with the two texts taken from their ``created_at`` text."""
    events = table(spark, directory, "events")
    return calendar.parse_created_at(events.withColumn("created_at", created_at()), "created_at")


def nested_posts(spark: SparkSession, directory: str) -> DataFrame:
    """Events in the layout of raw messages; no position for errors, no place for views."""
    return table(spark, directory, "events").select(
        F.col("event_id").alias("id"),
        created_at().alias("created_at"),
        F.when(
            F.col("event_type") != "error",
            F.struct(F.array(F.col("value"), -F.col("value")).alias("coordinates")),
        ).alias("geo"),
        F.when(
            F.col("event_type") != "view", F.struct(F.concat("event_type", F.lit(", TX")).alias("full_name"))
        ).alias("place"),
        F.struct(F.lit("storm").alias("crisis_name")).alias("aidr"),
        F.struct(
            F.col("user_id").alias("id"),
            F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("name"),
            F.col("event_type").alias("location"),
            F.floor("value").alias("followers_count"),
            (F.col("event_type") == "purchase").alias("verified"),
        ).alias("user"),
        F.col("props").alias("text"),
        F.struct(
            F.array(F.struct(F.col("event_type").alias("text")), F.struct(F.lit("Storm").alias("text"))).alias(
                "hashtags"
            )
        ).alias("entities"),
    )


def labelled(spark: SparkSession, directory: str) -> DataFrame:
    """Documents with their label; ids arrive as text, as in the label file."""
    labels = table(spark, directory, "labels").select(
        F.col("doc_id").cast("string").alias("doc_id"),
        "quality",
        "toxic",
        F.concat_ws("_", F.col("quality").cast("string"), F.col("toxic").cast("string")).alias("label"),
    )
    return messages.join_labels(table(spark, directory, "documents"), labels, "doc_id")


def scored_documents(spark: SparkSession, documents: DataFrame) -> DataFrame:
    return sentiment.score_texts(documents, "text", params.LEXICON, ["doc_id"], params.RULES)


def placed_documents(spark: SparkSession, directory: str) -> DataFrame:
    """Labelled documents with a place made from their language; some have none, or one without a state."""
    place = F.lit(None).cast("string")
    for lang, name in params.PLACES.items():
        place = F.when(F.col("lang") == lang, name).otherwise(place)
    return labelled(spark, directory).withColumn("tweet_place", place)


def state_sentiment(spark: SparkSession, directory: str) -> reports.Sentiment:
    return reports.state_sentiment(
        placed_documents(spark, directory), params.LEXICON, params.PLACED, ["doc_id"], rules=params.RULES
    )


# ---- import-time pipeline -----------------------------------------------------


def flat_columns(flat: DataFrame) -> DataFrame:
    """The flat message table with its arrays as plain columns."""
    return flat.select(
        "tweet_id",
        "tweet_date_full",
        F.get("tweet_pos", F.lit(0)).alias("lat"),
        F.get("tweet_pos", F.lit(1)).alias("lon"),
        "tweet_place",
        "crisis_name",
        "user_id",
        "user_name",
        "user_location",
        "user_followers",
        "user_verified",
        "text",
        F.array_join("hashtags", ",").alias("hashtags"),
        "tweet_date",
        "tweet_time",
    )


def message_lines(spark: SparkSession, directory: str) -> DataFrame:
    """Events as JSON lines, some of them cut off."""
    posts = nested_posts(spark, directory)
    line = F.to_json(F.struct("*"))
    cut_off = F.col("id") % 97 == 5
    return posts.select(F.when(cut_off, F.substring(line, 1, 40)).otherwise(line).alias("value"), F.lit("events").alias("file"))


@query
def flatten_nested(spark, directory):
    return flat_columns(messages.flatten(nested_posts(spark, directory)))


@query
def json_scan(spark, directory):
    return flat_columns(messages.flatten(messages.parse_messages(message_lines(spark, directory)).messages))


@query
def json_quarantine(spark, directory):
    return counting.total(messages.parse_messages(message_lines(spark, directory)).quarantine, "malformed")


def damaged_lines(spark: SparkSession, directory: str) -> DataFrame:
    """Events as JSON lines; some with fields of another type, some cut off."""
    record = nested_posts(spark, directory).select(F.col("id").alias("number"), "user")
    number = F.col("number").cast("string")
    text_id = F.when(F.col("number") % 7 == 3, F.concat(F.lit('"n'), number, F.lit('"'))).otherwise(number)
    wrong = F.col("user").withField("followers_count", F.lit("many")).withField("verified", F.lit("no"))
    user = F.when(F.col("number") % 11 == 4, F.to_json(wrong)).otherwise(F.to_json("user"))
    line = F.concat(F.lit('{"id": '), text_id, F.lit(', "user": '), user, F.lit("}"))
    cut_off = F.col("number") % 13 == 5
    return record.select(
        F.when(cut_off, F.substring(line, 1, 12)).otherwise(line).alias("value"), F.lit("events").alias("file")
    )


@query
def json_quarantine_fields(spark, directory):
    return messages.quarantine_counts(messages.parse_messages(damaged_lines(spark, directory)))


@query
def label_scan(spark, directory):
    confidence = F.when(F.col("quality") == 1, F.concat(F.lit("0."), F.col("toxic").cast("string")))
    fields = ["doc_id", F.lit("2017-08-28"), F.concat_ws("_", "quality", "toxic"), F.coalesce(confidence, F.lit(""))]
    lines = table(spark, directory, "labels").select(F.concat_ws("\t", *fields).alias("value"))
    return messages.parse_labels(lines)


@query
def parse_created_at(spark, directory):
    since = "make_dt_interval(0, 0, 0, cast(unix_seconds(created_ts) as decimal(18, 6)))"
    at_utc = F.expr(f"timestamp_ntz'1970-01-01 00:00:00' + {since}")
    return posts(spark, directory).select("event_id", "tweet_date", "tweet_time", at_utc.alias("created_ts"))


@query
def union_all(spark, directory):
    return messages.union_all(
        table(spark, directory, "conversations").withColumnRenamed("conv_id", "id"),
        table(spark, directory, "documents").withColumnRenamed("doc_id", "id"),
    )


@query
def label_join(spark, directory):
    return labelled(spark, directory)


@query
def label_join_stored(spark, directory):
    """Both sides are landed by key first, under new names: a catalog in memory doesn't know what an earlier session stored."""
    labels = table(spark, directory, "labels").withColumn("doc_id", F.col("doc_id").cast("string"))
    names = [f"galewatch_{side}_{uuid.uuid4().hex}" for side in ("messages", "labels")]
    return messages.land_for_join(table(spark, directory, "documents"), labels, tuple(names), params.BUCKETS, "doc_id")


# ---- previews -------------------------------------------------------------------


@query
def dataset_preview(spark, directory):
    sample = sampling.sample_n(table(spark, directory, "documents"), "doc_id", 15, 44)
    return sample.select(F.col("doc_id").cast("string"), "text", "lang", "source", "n_chars")


@query
def sample_n(spark, directory):
    return sampling.sample_n(table(spark, directory, "labels"), "doc_id", 15, 42)


@query
def dataset_count(spark, directory):
    return messages.union_all(
        *[counting.total(table(spark, directory, name), name) for name in ("documents", "labels")]
    )


# ---- counts ---------------------------------------------------------------------


@query
def flag_counts(spark, directory):
    verified = F.when(F.col("event_type") != "error", F.col("event_type") == "purchase")
    return counting.flag_counts(table(spark, directory, "events").select(verified.alias("verified")), "verified")


@query
def date_counts(spark, directory):
    return calendar.date_counts(table(spark, directory, "events").select(created_at().alias("at")), "at")


@query
def avg_per_hour(spark, directory):
    return calendar.avg_per_hour(posts(spark, directory))


@query
def running_avg(spark, directory):
    return calendar.running_avg(posts(spark, directory))


def hours_taken(spark: SparkSession, directory: str) -> str:
    """The table, newly named, of the hours counted from events, which are offered to it twice."""
    name = f"galewatch_hours_{uuid.uuid4().hex}"
    versioned = table(spark, directory, "events").select("ts", *hourly.version_columns())
    flat = calendar.parse_created_at(versioned.withColumn("created_at", created_at()), "created_at")
    for _ in range(2):
        hourly.take(name, flat)
    return name


@query
def avg_per_hour_stored(spark, directory):
    return hourly.avg_per_hour(spark, hours_taken(spark, directory))


@query
def running_avg_stored(spark, directory):
    return hourly.running_avg(spark, hours_taken(spark, directory))


@query
def label_counts(spark, directory):
    return counting.count_by(labelled(spark, directory), "label")


@query
def distinct_labels(spark, directory):
    return counting.distinct_values(labelled(spark, directory), "label")


@query
def state_counts(spark, directory):
    customers = table(spark, directory, "customer")
    nations = table(spark, directory, "nation")
    regions = table(spark, directory, "region")
    placed = customers.join(nations, customers.c_nationkey == nations.n_nationkey).join(
        regions, nations.n_regionkey == regions.r_regionkey
    )
    place = F.when(F.col("r_name") == "EUROPE", F.col("n_name")).otherwise(F.concat_ws(", ", "n_name", "r_name"))
    return counting.state_counts(placed.select(place.alias("place")), "place", params.STATES)


# ---- words ------------------------------------------------------------------------


@query
def word_topk(spark, directory):
    stops = wordlists.ENGLISH | wordlists.OVERALL_TERMS
    return words.top_words(table(spark, directory, "documents"), "text", 20, stops)


@query
def word_topk_by_label(spark, directory):
    stops = wordlists.ENGLISH | wordlists.PER_LABEL_TERMS
    return words.top_words_by(labelled(spark, directory), "label", "text", 20, stops)


@query
def hashtag_topk(spark, directory):
    tags = F.array(F.replace("p_name", F.lit(" "), F.lit(",")), F.upper("p_type"))
    return words.top_tags(table(spark, directory, "part").select(tags.alias("tags")), "tags", 15)


# ---- maps -------------------------------------------------------------------------


@query
def geo_points_union(spark, directory):
    points = geo.points_union(table(spark, directory, "embeddings"), "embedding", geo.damage_points(spark))
    return points.withColumn("color", F.array_join(F.col("color").cast("array<string>"), ","))


@query
def trajectory_segments(spark, directory):
    points = table(spark, directory, "embeddings").select(
        "vec_id",
        "label",
        F.get("embedding", F.lit(0)).cast("double").alias("lat"),
        F.get("embedding", F.lit(1)).cast("double").alias("lon"),
    )
    return geo.trajectory_segments(points, "label", "vec_id")


# ---- sentiment --------------------------------------------------------------------


@query
def sentiment_score(spark, directory):
    scored = scored_documents(spark, table(spark, directory, "documents"))
    return scored.select("doc_id", "copies", "score", "sentiment")


@query
def sentiment_counts(spark, directory):
    return sentiment.sentiment_counts(scored_documents(spark, table(spark, directory, "documents")))


@query
def sentiment_samples(spark, directory):
    documents = table(spark, directory, "documents")
    return sentiment.sentiment_samples(documents, scored_documents(spark, documents), "text", ["doc_id"])


@query
def sentiment_counts_by_state(spark, directory):
    return state_sentiment(spark, directory).counts


@query
def sentiment_samples_by_state(spark, directory):
    return state_sentiment(spark, directory).samples


# ---- learning ---------------------------------------------------------------------


@query
def feature_encode(spark, directory):
    confidence = F.when(F.col("source") == "src3", "n/a").otherwise(F.col("quality").cast("string"))
    rows = labelled(spark, directory).withColumns({"confidence": confidence, "flag": F.col("toxic") == 1})
    encoded = encoding.feature_encode(rows, "lang", "flag", ["n_chars"], "confidence", keep=["doc_id"])
    return encoded.rows.drop("lang")


@query
def label_index(spark, directory):
    return encoding.label_index(table(spark, directory, "documents"), "lang")


@query
def correlation_matrix(spark, directory):
    return rounded(correlation.correlation(labelled(spark, directory), params.FEATURES))


@query
def correlation_of_matrix(spark, directory):
    return rounded(correlation.correlation_of_matrix(labelled(spark, directory), params.FEATURES))


def rounded(matrix: DataFrame) -> DataFrame:
    return matrix.withColumn("corr", F.round("corr", 6))


@query
def hash_split(spark, directory):
    return sampling.hash_split(table(spark, directory, "documents"), "doc_id")


def rule_cells(spark: SparkSession, directory: str) -> DataFrame:
    """Confusion counts of a fixed rule: long texts are good ones."""
    long = (F.col("n_chars") >= params.LONG_TEXT).cast("int")
    return metrics.confusion(labelled(spark, directory).withColumn("long", long), "quality", "long")


@query
def metrics_by_label(spark, directory):
    return metrics.metrics_by_label(rule_cells(spark, directory))


@query
def metrics_overall(spark, directory):
    return metrics.metrics_overall(rule_cells(spark, directory)).withColumn("value", F.round("value", 9))


def topics(spark: SparkSession, directory: str) -> DataFrame:
    """Labelled documents under the names of labelled messages; the confidence tells the label."""
    return labelled(spark, directory).select(
        F.col("doc_id").alias("tweet_id"),
        "text",
        F.when(F.col("quality") == 1, "good").otherwise("poor").alias("AIDRLabel"),
        F.col("quality").cast("string").alias("AIDRConfidence"),
        F.col("n_chars").alias("user_followers"),
        (F.col("toxic") == 1).alias("user_verified"),
    )


def shown(result: classify.Classification) -> DataFrame:
    return result.by_label.withColumns(
        {"val_accuracy": F.lit(result.val_accuracy), "test_accuracy": F.lit(result.test_accuracy)}
    )


@query
def classify_rf(spark, directory):
    return shown(reports.classify_random_forest(topics(spark, directory)))


@query
def classify_lr(spark, directory):
    return shown(reports.classify_logistic_regression(topics(spark, directory)))


@query
def classify_overall(spark, directory):
    return reports.classify_logistic_regression(topics(spark, directory)).overall


@query
def classify_rf_overall(spark, directory):
    return reports.classify_random_forest(topics(spark, directory)).overall


@query
def classify_rf_distribution(spark, directory):
    return reports.classify_random_forest(topics(spark, directory)).label_distribution


@query
def classify_distribution(spark, directory):
    return reports.classify_logistic_regression(topics(spark, directory)).label_distribution


@query
def feature_correlation(spark, directory):
    rows = topics(spark, directory).withColumn(
        "AIDRConfidence", F.when(F.col("user_followers") % 5 == 0, "n/a").otherwise(F.col("AIDRConfidence"))
    )
    return rounded(reports.feature_correlation(rows).matrix)


# The key of the plain matrix; the function is named apart from the module it calls.
QUERIES["correlation"] = QUERIES.pop("correlation_matrix")
