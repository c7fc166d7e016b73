"""The reports over messages and labels read from files."""

import pytest
from pyspark.sql import functions as F

from galewatch.operators import sentiment
from galewatch.plans import reports
from galewatch.sources.tables import parameter_table


@pytest.fixture(scope="module")
def lexicon(spark):
    return parameter_table(spark, ["word", "valence"], [("good", 1.9), ("awful", -2.0)])


def rows(df):
    return [tuple(row) for row in df.collect()]


def test_message_preview(flat):
    preview = reports.message_preview(flat, n=4)
    assert preview.sample.columns == ["tweet_id", "user_id", *reports.MESSAGE_COLUMNS]
    assert dict(preview.sample.dtypes)["tweet_id"] == dict(preview.sample.dtypes)["user_id"] == "string"
    assert preview.sample.count() == 4
    assert rows(preview.count) == [("messages", 9)]
    again = reports.message_preview(flat.repartition(5), n=4).sample
    assert sorted(r.tweet_id for r in again.collect()) == sorted(r.tweet_id for r in preview.sample.collect())


def test_label_preview(labels):
    preview = reports.label_preview(labels)
    assert preview.sample.count() == 15
    assert rows(preview.count) == [("labels", 21)]


def test_messages_per_hour(flat):
    # 10 h: 2 on Aug 28 and 2 on Aug 29; hours of unreadable or missing times are left out
    assert rows(reports.messages_per_hour(flat)) == [(0, 1.0), (10, 2.0), (12, 1.0), (23, 1.0)]


def test_messages_by_verified(flat):
    assert rows(reports.messages_by_verified(flat)) == [(False, 2), (True, 2)]


def test_messages_per_date(flat):
    # Feb 29 of a leap year stays, Feb 30 and empty texts do not
    assert rows(reports.messages_per_date(flat)) == [("02-29", 1), ("08-28", 2), ("08-29", 2), ("08-30", 1)]


def test_frequent_words(flat):
    counts = dict(rows(reports.frequent_words(flat)))
    assert counts == {
        "shelter": 5, "good": 4, "awful": 3, "water": 2, "flood": 1, "harvey": 1, "citt": 1, "x": 1, "ab": 1,
    }
    assert rows(reports.frequent_words(flat, 6)) == [
        ("shelter", 5), ("good", 4), ("awful", 3), ("water", 2), ("ab", 1), ("citt", 1),
    ]


def test_messages_per_label(labelled):
    assert rows(reports.messages_per_label(labelled)) == [
        ("donation_and_volunteering", 3),
        ("displaced_and_evacuations", 2),
        ("personal", 2),
        (None, 1),
        ("infrastructure_and_utilities_damage", 1),
    ]


def test_frequent_words_per_label(labelled):
    found = rows(reports.frequent_words_per_label(labelled, k=2).orderBy("AIDRLabel", "rank"))
    assert found == [
        ("displaced_and_evacuations", "good", 1, 1),
        ("displaced_and_evacuations", "shelter", 1, 2),
        ("donation_and_volunteering", "shelter", 4, 1),
        ("donation_and_volunteering", "good", 3, 2),
        ("infrastructure_and_utilities_damage", "awful", 1, 1),
        ("infrastructure_and_utilities_damage", "flood", 1, 2),
    ]
    only = reports.frequent_words_per_label(labelled, labels=["personal", "displaced_and_evacuations"])
    assert {row[0] for row in rows(only)} == {"displaced_and_evacuations"}


def test_frequent_hashtags(flat):
    assert rows(reports.frequent_hashtags(flat)) == [("harvey", 2), ("flood", 1), ("houston", 1)]


def test_map_points(flat):
    points = reports.map_points(flat)
    assert points.columns == ["lat", "lon", "type", "color"]
    assert rows(points.where("type = 'Tweet'")) == [(29.76, -95.36, "Tweet", [0, 0, 255])]
    damage = points.where("type = 'Damage'")
    assert damage.count() == 32
    assert damage.where((F.col("lat") == 24.4) & (F.col("lon") == -93.6)).count() == 1


def test_messages_per_state(labelled):
    # "Austin,TX" has no blank before the state, "Texas" has no state part
    assert rows(reports.messages_per_state(labelled)) == [(" TX", 1), (" LA", 2)]


def test_message_sentiment(flat, lexicon):
    result = reports.message_sentiment(flat, lexicon)
    assert sum(count for _, count in rows(result.counts)) == flat.where("text is not null").count() == 7
    assert dict(rows(result.counts)) == {"neutral": 2, "positive": 2, "negative": 3}
    samples = result.samples.orderBy("sentiment", "rank").select("tweet_id", "sentiment", "rank")
    assert rows(samples) == [
        (2, "negative", 1), (3, "negative", 2), (3, "negative", 3),
        (4, "neutral", 1), (6, "neutral", 2),
        (1, "positive", 1), (7, "positive", 2),
    ]


def test_sentiment_without_keys_is_per_text(flat, lexicon):
    assert dict(rows(reports.message_sentiment(flat, lexicon, keys=()).counts)) == {
        "neutral": 2, "positive": 2, "negative": 3,
    }


def test_state_sentiment(labelled, lexicon):
    # the state needs no blank here, but message 5 has no text
    assert dict(rows(reports.state_sentiment(labelled, lexicon).counts)) == {"positive": 1, "negative": 2}


def test_encode_sets_incomplete_rows_apart(labelled):
    encoded = reports.encode(labelled)
    assert sorted(row.tweet_id for row in encoded.rows.collect()) == [1, 2, 3, 3, 8]
    assert sorted(row.tweet_id for row in encoded.skipped.collect()) == [4, 5, 6, 7]
    # most frequent first, ties alphabetical
    assert encoded.index.labels == [
        "donation_and_volunteering",
        "displaced_and_evacuations",
        "personal",
        "infrastructure_and_utilities_damage",
    ]
    flags = {row.tweet_id: row.user_verified_index for row in encoded.rows.collect()}
    assert flags == {1: 1, 2: 0, 3: 0, 8: 0}


def test_feature_correlation(labelled):
    result = reports.feature_correlation(labelled)
    matrix = {(x, y): corr for x, y, corr in rows(result.matrix)}
    assert len(matrix) == 16
    for x, y in matrix:
        assert matrix[x, y] == matrix[y, x]
    assert all(matrix[name, name] == 1.0 for name in reports.CORRELATED)
    values = result.after.toPandas().astype(float)
    for (x, y), corr in matrix.items():
        assert corr == pytest.approx(values[x].corr(values[y]))
    second = {(x, y): corr for x, y, corr in rows(result.matrix_of_matrix)}
    table = values[list(reports.CORRELATED)].corr().corr()
    for (x, y), corr in second.items():
        assert corr == pytest.approx(table.loc[x, y])
    assert result.before.columns == ["user_followers", "user_verified", "AIDRLabel", "AIDRConfidence"]
    assert result.before.count() == 9


def test_storm_track(spark):
    from galewatch.operators import geo

    segments = reports.storm_track(geo.damage_points(spark)).orderBy("seq").collect()
    assert len(segments) == 31
    pairs = [((s.start_lat, s.start_lon), (s.end_lat, s.end_lon)) for s in segments]
    assert pairs == list(zip(geo.DAMAGE, geo.DAMAGE[1:], strict=False))


def test_sentiment_threshold_is_polar(spark):
    scores = spark.createDataFrame([(0.05,), (-0.05,), (0.0499,), (0.0,)], "score double")
    classes = [row[0] for row in scores.select(sentiment.sentiment_class(F.col("score"))).collect()]
    assert classes == ["positive", "negative", "neutral", "neutral"]
