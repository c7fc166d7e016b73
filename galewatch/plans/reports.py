"""The questions asked of the message table, the label table and the two joined.

``messages`` is the flat table of :func:`galewatch.sources.messages.read_messages`,
``labels`` that of ``read_labels``, ``labelled`` their ``join_labels``. Each
function returns frames; the classifiers train when called, the encoding fits the
label's index, and a track looks up the quantiles of its order.
"""

from collections.abc import Sequence
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galewatch import schemas
from galewatch.functions import wordlists
from galewatch.operators import (
    calendar,
    classify,
    correlation,
    counting,
    encoding,
    geo,
    sampling,
    sentiment,
    words,
)

# Size and seeds of the previews, the states asked about, the learned features.
PREVIEW_ROWS = 15
MESSAGE_SEED = 44
LABEL_SEED = 42
STATES = ("TX", "LA")
FEATURES = ("user_followers", "AIDRConfidence_numeric", "user_verified_index")
CORRELATED = ("user_followers", "AIDRLabel_index", "AIDRConfidence_numeric", "user_verified_index")

MESSAGE_COLUMNS = (
    "user_name", "user_followers", "user_verified", "text", "hashtags", "tweet_date", "tweet_time",
    "user_location", "tweet_place", "tweet_pos",
)


class Preview(NamedTuple):
    sample: DataFrame
    count: DataFrame


class Sentiment(NamedTuple):
    """Distribution and samples share ``scored``; persist that when acting on both."""

    scored: DataFrame
    counts: DataFrame
    samples: DataFrame


class Correlation(NamedTuple):
    matrix: DataFrame
    matrix_of_matrix: DataFrame
    before: DataFrame
    after: DataFrame


def message_preview(messages: DataFrame, n: int = PREVIEW_ROWS, seed: int = MESSAGE_SEED) -> Preview:
    """Sample of the messages with ids as text, and how many there are."""
    shown = sampling.sample_n(messages, "tweet_id", n, seed).select(
        F.col("tweet_id").cast("string"), F.col("user_id").cast("string"), *MESSAGE_COLUMNS
    )
    return Preview(shown, counting.total(messages, "messages"))


def label_preview(labels: DataFrame, n: int = PREVIEW_ROWS, seed: int = LABEL_SEED) -> Preview:
    """Sample of the label table, and how many labels there are."""
    shown = sampling.sample_n(labels, "tweet_id", n, seed).select("tweet_id", "AIDRLabel", "AIDRConfidence")
    return Preview(shown, counting.total(labels, "labels"))


def messages_per_hour(messages: DataFrame) -> DataFrame:
    """(tweet_hour, avg_tweet_count)."""
    return calendar.avg_per_hour(messages)


def messages_by_verified(messages: DataFrame) -> DataFrame:
    """(user_verified, count)."""
    return counting.flag_counts(messages, "user_verified")


def messages_per_date(messages: DataFrame) -> DataFrame:
    """(tweet_date, count)."""
    return calendar.date_counts(messages, "tweet_date_full")


def frequent_words(messages: DataFrame, k: int = words.TOP_WORDS) -> DataFrame:
    """(word, count) over all messages."""
    return words.top_words(messages, "text", k, wordlists.ENGLISH | wordlists.OVERALL_TERMS)


def messages_per_label(labelled: DataFrame) -> DataFrame:
    """(AIDRLabel, count)."""
    return counting.count_by(labelled, "AIDRLabel")


def frequent_words_per_label(
    labelled: DataFrame, k: int = words.TOP_WORDS, labels: Sequence[str] = schemas.LABELS
) -> DataFrame:
    """(AIDRLabel, word, count, rank) of the labels asked about."""
    stops = wordlists.ENGLISH | wordlists.PER_LABEL_TERMS
    return words.top_words_by(labelled.where(F.col("AIDRLabel").isin(*labels)), "AIDRLabel", "text", k, stops)


def frequent_hashtags(messages: DataFrame, k: int = words.TOP_TAGS) -> DataFrame:
    """(word, count)."""
    return words.top_tags(messages, "hashtags", k)


def map_points(messages: DataFrame, damage: DataFrame | None = None) -> DataFrame:
    """(lat, lon, type, color) of messages with a position and of damage points."""
    damage = geo.damage_points(messages.sparkSession) if damage is None else damage
    return geo.points_union(messages, "tweet_pos", damage)


def storm_track(damage: DataFrame) -> DataFrame:
    """Segments between consecutive damage points."""
    return geo.trajectory_segments(damage.withColumn("track", F.lit("Damage")), "track", "seq")


def messages_per_state(labelled: DataFrame, states: Sequence[str] = STATES) -> DataFrame:
    """(state, count) of the states asked about."""
    return counting.state_counts(labelled, "tweet_place", states)


def message_sentiment(
    messages: DataFrame,
    lexicon: sentiment.Lexicon,
    keys: Sequence[str] = ("tweet_id",),
    n: int = 5,
    rules: sentiment.Rules = sentiment.PUBLISHED,
) -> Sentiment:
    """(scored, counts, samples) of all messages with a text."""
    scored = sentiment.score_texts(messages, "text", lexicon, keys, rules)
    samples = sentiment.sentiment_samples(messages, scored, "text", keys, n)
    return Sentiment(scored, sentiment.sentiment_counts(scored), samples)


def state_sentiment(
    labelled: DataFrame,
    lexicon: sentiment.Lexicon,
    states: Sequence[str] = STATES,
    keys: Sequence[str] = ("tweet_id",),
    n: int = 5,
    rules: sentiment.Rules = sentiment.PUBLISHED,
) -> Sentiment:
    """Sentiment of the labelled messages placed in the states; the state need not begin with a blank here."""
    return message_sentiment(counting.at_states(labelled, "tweet_place", states), lexicon, keys, n, rules)


def encode(labelled: DataFrame) -> encoding.Encoded:
    """Numeric features of the labelled messages."""
    return encoding.feature_encode(
        labelled,
        label="AIDRLabel",
        flag="user_verified",
        numbers=["user_followers"],
        confidence="AIDRConfidence",
        keep=["tweet_id"],
    )


def feature_correlation(labelled: DataFrame) -> Correlation:
    """Pearson matrix, the correlation of its columns, and the features before and after encoding."""
    rows = encode(labelled).rows
    return Correlation(
        matrix=correlation.correlation(rows, CORRELATED),
        matrix_of_matrix=correlation.correlation_of_matrix(rows, CORRELATED),
        before=labelled.select("user_followers", "user_verified", "AIDRLabel", "AIDRConfidence"),
        after=rows.select("user_followers", "user_verified_index", "AIDRLabel_index", "AIDRConfidence_numeric"),
    )


def trained(labelled: DataFrame, classifier, features: Sequence[str]) -> classify.Classification:
    """Index and training read the few columns they need from one pass over the join."""
    needed = labelled.select("tweet_id", "AIDRLabel", "AIDRConfidence", "user_followers", "user_verified")
    needed = needed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return classify.classify(encode(needed), classifier, "tweet_id", "AIDRLabel", features)
    finally:
        needed.unpersist()


def classify_random_forest(
    labelled: DataFrame, features: Sequence[str] = FEATURES, trees: int = classify.TREES
) -> classify.Classification:
    """Random forest on the label. The label's own index is no feature unless ``features`` names it."""
    return trained(labelled, classify.random_forest("AIDRLabel_index", trees), features)


def classify_logistic_regression(
    labelled: DataFrame, features: Sequence[str] = FEATURES
) -> classify.Classification:
    """Logistic regression on the label, same rows and features."""
    return trained(labelled, classify.logistic_regression("AIDRLabel_index"), features)
