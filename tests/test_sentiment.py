import random

import pytest
from pyspark.sql import functions as F

from galewatch.functions import text as tx
from galewatch.operators import sentiment
from galewatch.sources.tables import parameter_table
from tests import scorer

LEXICON = {
    "good": 1.9, "awful": -2.0, "kind": 2.4, "great": 3.1, "bad": -2.5, "ass": -2.5, "shit": -2.6, "death": -2.9,
    "right": 0.4, "kiss": 1.8, ":-)": 1.3,
}


@pytest.fixture(scope="module")
def lexicon(spark):
    return parameter_table(spark, ["word", "valence"], LEXICON.items())


def scores(spark, lexicon, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    scored = sentiment.score_texts(df, "text", lexicon, ["id"]).collect()
    return [row.score for row in sorted(scored, key=lambda row: row.id)]


# Worked out by hand from the rules.
EXPECTED = {
    "this is good": 0.4404,
    "this is not good": -0.3412,
    "this is very good": 0.4927,
    "this is GOOD": 0.5622,
    "good but awful": -0.4678,
    "good!!": 0.5399,
    "nothing here": 0.0,
    "": 0.0,
    "THIS IS GOOD": 0.4404,
    "kind of good": 0.4404,
    "least good": -0.3412,
}

# A word of the lexicon before another neither boosts, negates nor strengthens it, nor lets an idiom or phrase act.
GUARDED = {"love": 3.2, "good": 1.9, "very": 0.5, "not": -1.0, "never": -0.5, "right": 0.4, "bad": -2.5, "great": 3.1}
GUARDED_EXPECTED = {
    "love was so good": 0.8122,  # no 1.25 for "so": 3.2 + 1.9 + 0.293
    "very good": 0.4404,  # no booster: 1.9
    "not good": 0.2263,  # no negation: -1 + 1.9
    "never this good": 0.34,  # no 1.5: -0.5 + 1.9
    "good it yeah right": 0.5106,  # no idiom: 1.9 + 0.4
    "bad sort of great": 0.1531,  # no dampening phrase: -2.5 + 3.1
    "plain sort of great": 0.5868,  # with it: 3.1 - 0.293
}


def test_hand_computed_sentences(spark, lexicon):
    assert scores(spark, lexicon, list(EXPECTED)) == list(EXPECTED.values())


def test_words_of_the_lexicon_change_no_other(spark):
    rows = list(GUARDED.items())
    assert scores(spark, rows, list(GUARDED_EXPECTED)) == list(GUARDED_EXPECTED.values())
    assert [scorer.score(text, GUARDED) for text in GUARDED_EXPECTED] == pytest.approx(list(GUARDED_EXPECTED.values()))


def test_repeated_lexicon_words_count_once(spark):
    repeated = [("good", 1.9), ("Good", 1.0), ("good", 1.9)]
    frame = spark.createDataFrame(repeated, "word string, valence double")
    texts = ["good storm", "storm good"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    for lexicon in (repeated, frame):
        scored = sentiment.score_texts(df, "text", lexicon, ["id"]).collect()
        assert [(row.copies, row.score) for row in scored] == [(1, 0.4404)] * 2


def test_no_lexicon_scores_nothing(spark):
    assert scores(spark, [], ["good", ""]) == [0.0, 0.0]


def test_samples_hash_only_texts_whose_keys_match(spark, lexicon):
    df = spark.createDataFrame([(1, "good")], "id long, text string")
    scored = sentiment.score_texts(df, "text", lexicon, ["id"]).localCheckpoint()
    plan = sentiment.sentiment_samples(df, scored, "text", ["id"])._jdf.queryExecution().optimizedPlan().toString()
    below_join = plan[plan.index("Join") :].split("\n", 1)[1]
    assert "md5" not in below_join


def test_boosters_fade_with_distance(spark, lexicon):
    near, middle, far, none = scores(
        spark, lexicon, ["it is very good", "it very is good", "very it is good", "it it is good"]
    )
    assert near > middle > far > none


def test_all_rules_against_the_plain_scorer(spark, lexicon):
    rng = random.Random(7)
    words = [
        *LEXICON, *["GOOD", "Awful", "good!!", "'bad", "awful?!?", "good!!!!", "(good)", "very", "VERY", "barely", "sort",
        "of", "kind", "not", "isn't", "never", "so", "this", "least", "at", "but", "BUT,", "a", "the", "yeah", "just",
        "enough", "cut", "hand", "mouth", "to", "bomb", "plain", "words", "?", "!", "Città", "ÈÀ", "x1"],
    ]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 14))) for _ in range(1500)]
    both = LEXICON | {"so": 0.5, "never": -0.6, "this": 0.2, "least": -0.4, "barely": -0.3, "not": -0.2}
    got = scores(spark, lexicon, texts) + scores(spark, both.items(), texts)
    want = [scorer.score(text, LEXICON) for text in texts] + [scorer.score(text, both) for text in texts]
    texts = texts * 2
    assert [(t, g, w) for t, g, w in zip(texts, got, want, strict=True) if abs(g - w) > 1.01e-4] == []
    assert sum(g == w for g, w in zip(got, want, strict=True)) > 2980
    assert all(-1 <= g <= 1 for g in got)


def test_tokens(spark):
    text = "a  good!! 'tis :-) (well) end...\tnow, l'aria città! x !!!"
    tokens = spark.createDataFrame([(text,)], "text string").select(tx.cased_tokens(F.col("text"))).first()[0]
    assert tokens == ["good", "tis", ":-)", "(well)", "end...", "now", "l'aria", "città", "!!!"]


def test_repeats_are_scored_once_and_counted(spark, lexicon):
    rows = [(1, "this is good")] * 3 + [(1, "awful"), (2, "this is good"), (None, "good")] + [(3, None)]
    df = spark.createDataFrame(rows, "id long, text string").repartition(4)
    scored = sentiment.score_texts(df, "text", lexicon, ["id"])
    found = {(row.id, row.score): row.copies for row in scored.collect()}
    assert found == {(1, 0.4404): 3, (1, -0.4588): 1, (2, 0.4404): 1, (None, 0.4404): 1}
    assert {tuple(row) for row in sentiment.sentiment_counts(scored).collect()} == {("positive", 5), ("negative", 1)}
    samples = sentiment.sentiment_samples(df, scored, "text", ["id"], n=4).where("sentiment = 'positive'")
    assert sorted((row.id or 0, row.text) for row in samples.collect()) == [
        (0, "good"), (1, "this is good"), (1, "this is good"), (1, "this is good"),
    ]


def test_large_lexicon_is_joined_without_broadcast(spark, lexicon):
    texts = ["this is not good", "good but awful"]
    expected = scores(spark, lexicon, texts)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
        scored = sentiment.score_texts(df, "text", lexicon, ["id"])
        assert "BroadcastHashJoin" not in scored._jdf.queryExecution().executedPlan().toString()
        assert [row.score for row in sorted(scored.collect(), key=lambda row: row.id)] == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
