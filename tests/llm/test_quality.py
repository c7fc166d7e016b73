"""Quality rules and the ordinal classifier."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from galewatch.llm import ordinal, quality_rules
from tests.llm import brute

TEXTS = [
    None, "", "   ", "a b c", "word " * 40, "one two three four five six seven eight " * 3, "x\n\n x\nx\n \nx", "#*$%&|<> !? ABC",
    " ".join(f"w{i}" for i in range(100)), "\x0b\x0c a\tb\r\nc", " ".join(f"w{i % 37}" for i in range(20_000)),
    " ".join([*[f"w{i}" for i in range(90)], *[f"w{i}" for i in range(10)]]),
]


def test_measures(documents):
    rows = [*enumerate(TEXTS), (3, TEXTS[3])]
    got = quality_rules.measured(documents(rows, "n_words", "kept")).select("doc_id", "_measures.*").collect()
    assert len(got) == len(rows)
    for row in got:
        text = TEXTS[row.doc_id] or ""
        words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
        lines = [line for line in text.split("\n") if line.strip(" \t\n\x0b\x0c\r")]
        assert row.n_words == len(words) and row.word_chars == sum(map(len, words))
        assert row.n_symbols == sum(c in "#*$%&|<>" for c in text)
        assert row.n_dup_lines == len(lines) - len(set(lines))
        assert row.n_repeat_words == brute.repeat_words(text)
        assert row.base_failed == (len(words) < 20 or 100 * row.n_repeat_words > 30 * len(words))


@pytest.mark.parametrize(("n", "k", "rate"), [(10, 0, 0.01), (1000, 3, 0.002), (4000, 0, 0.002), (200_000, 300, 0.002), (5, 5, 0.3)])
def test_binomial_tail(spark, n, k, rate):
    row = spark.range(1).select(quality_rules.binomial_tail(F.lit(n).cast("long"), F.lit(k).cast("long"), F.lit(rate)).alias("p")).first()
    terms = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(rate) + (n - i) * math.log1p(-rate) for i in range(k + 1)]
    assert row.p == pytest.approx(sum(map(math.exp, terms)), rel=1e-8)


PLAIN, MARKED = (" ".join(f"word{i}{marks}" for i in range(40)) for marks in ("", "!?!?"))


def labelled(spark, documents, good, bad, lang="en"):
    rows = [(i, PLAIN, lang, "s") for i in range(good)] + [(good + i, MARKED, lang, "s") for i in range(bad)]
    labels = [(i, 1, 0) for i in range(good)] + [(good + i, 0, 0) for i in range(bad)]
    return documents(rows, "quality"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_enough_labels_certify_a_cutoff(spark, documents):
    frame, labels = labelled(spark, documents, 3500, 300)
    kept = quality_rules.without_rejected(frame, labels)
    assert kept.columns == frame.columns
    assert kept.agg(F.count("*"), F.max("doc_id")).first() == (3500, 3499)


def test_columns_of_the_same_names_come_back(spark, documents):
    names = ["_words", "_sorted", "_lines", "_kept", "_measures", "_stratum", "_cut_marks", "_windows", "_counts", "row", "stratum", "_good"]
    frame, labels = labelled(spark, documents, 30, 5)
    for name in names:
        frame = frame.withColumn(name, F.lit("clash"))
    kept = quality_rules.without_rejected(frame, labels)
    assert kept.columns == frame.columns and kept.count() == 35
    assert set(kept.select(*names).distinct().first()) == {"clash"}


def test_few_labels_certify_none(spark, documents):
    frame, labels = labelled(spark, documents, 500, 300)
    assert quality_rules.without_rejected(frame, labels).count() == 800


def test_strata_are_for_themselves_and_null_is_one(spark, documents):
    frame, labels = labelled(spark, documents, 3500, 300, lang=None)
    other = documents([(9_000 + i, MARKED, "xx", "s") for i in range(10)], "quality")
    kept = quality_rules.without_rejected(frame.unionByName(other), labels)
    assert kept.where("lang is null").count() == 3500 and kept.where("lang = 'xx'").count() == 10


def test_rules_without_rows_or_labels(spark, documents):
    frame, labels = labelled(spark, documents, 30, 5)
    none = labels.where("false")
    assert quality_rules.rules(frame, none).where("_kept").count() == 35
    assert quality_rules.rules(frame.where("false"), labels).collect() == []
    nulls = labels.select("doc_id", F.lit(None).cast("int").alias("quality"), "toxic")
    assert quality_rules.without_rejected(frame, nulls).count() == 35


def test_ordinal_gradient_and_order():
    random = np.random.default_rng(0)
    rows, grades = [], []
    for grade in (0, 1, 2):
        for _ in range(80):
            rows.append(np.unique(np.concatenate((random.integers(100, 160, 10), [grade])).astype(np.int32)))
            grades.append(grade)
    model = ordinal.fit(rows, np.array(grades), 2)
    assert model.weights[0] < model.weights[1] < model.weights[2]
    assert (np.diff(model.thresholds) > 0).all()
    tails = model.tails(np.linspace(-5, 5, 20))
    assert (tails[:, 0] > tails[:, 1]).all() and (np.diff(tails, axis=0) > 0).all()


def test_held_out_grades(spark):
    documents = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).otherwise(2)
    ratings = labels.select("doc_id", grade.alias("grade"))
    train, held = ratings.where("doc_id % 4 != 0"), ratings.where("doc_id % 4 = 0")
    got = ordinal.graded(documents, train).join(held, "doc_id")
    table = {(r.grade, r.kept): r.n for r in got.groupBy("grade", "kept").agg(F.count("*").alias("n")).collect()}
    rejected = lambda g: table.get((g, False), 0) / (table.get((g, False), 0) + table.get((g, True), 0))
    print(table)
    assert rejected(0) >= 0.95 and rejected(2) <= 0.05
    means = {r.grade: r.m for r in got.groupBy("grade").agg(F.avg("expected_grade").alias("m")).collect()}
    assert means[0] < means[1] < means[2]


def test_graded_rows(spark, documents):
    rows = [(1, None), (2, ""), (3, "fine words here"), (3, "fine words here"), (None, "x " * 20_000), (5, "awful scum")]
    ratings = spark.createDataFrame([(3, 2), (5, 0), (5, None), (None, 1), (99, 1)], "doc_id bigint, grade int")
    frame = documents(rows, "grade", "kept")
    got = ordinal.graded(frame, ratings).collect()
    assert len(got) == len(rows)
    assert all(0 <= r.p_at_least_2 <= r.p_at_least_1 <= 1 for r in got)
    assert all(r.kept for r in ordinal.graded(frame, ratings.where("false")).collect())
    assert ordinal.graded(frame.where("false"), ratings).collect() == []
