"""Explicit schemas of the two inputs and of the flat message table."""

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

RAW_MESSAGE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("geo", T.StructType([T.StructField("coordinates", T.ArrayType(T.DoubleType()))])),
        T.StructField("place", T.StructType([T.StructField("full_name", T.StringType())])),
        T.StructField("aidr", T.StructType([T.StructField("crisis_name", T.StringType())])),
        T.StructField(
            "user",
            T.StructType(
                [
                    T.StructField("id", T.LongType()),
                    T.StructField("name", T.StringType()),
                    T.StructField("location", T.StringType()),
                    T.StructField("followers_count", T.LongType()),
                    T.StructField("verified", T.BooleanType()),
                ]
            ),
        ),
        T.StructField("text", T.StringType()),
        T.StructField(
            "entities",
            T.StructType(
                [
                    T.StructField(
                        "hashtags",
                        T.ArrayType(T.StructType([T.StructField("text", T.StringType())])),
                    )
                ]
            ),
        ),
    ]
)

RAW_LABEL = T.StructType(
    [
        T.StructField("TweetID", T.StringType()),
        T.StructField("Date", T.StringType()),
        T.StructField("AIDRLabel", T.StringType()),
        T.StructField("AIDRConfidence", T.StringType()),
    ]
)

FLAT_MESSAGE = T.StructType(
    [
        T.StructField("tweet_id", T.LongType()),
        T.StructField("tweet_date_full", T.StringType()),
        T.StructField("tweet_pos", T.ArrayType(T.DoubleType())),
        T.StructField("tweet_place", T.StringType()),
        T.StructField("crisis_name", T.StringType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("user_name", T.StringType()),
        T.StructField("user_location", T.StringType()),
        T.StructField("user_followers", T.LongType()),
        T.StructField("user_verified", T.BooleanType()),
        T.StructField("text", T.StringType()),
        T.StructField("hashtags", T.ArrayType(T.StringType())),
        T.StructField("tweet_date", T.StringType()),
        T.StructField("tweet_time", T.StringType()),
    ]
)

# The label domain of the classification file.
LABELS = (
    "not_related_or_irrelevant",
    "donation_and_volunteering",
    "relevant_information",
    "sympathy_and_support",
    "personal",
    "caution_and_advice",
    "infrastructure_and_utilities_damage",
    "injured_or_dead_people",
    "affected_individual",
    "missing_and_found_people",
    "response_efforts",
    "displaced_and_evacuations",
)
