"""Properties of single operators, and the shape of their plans."""

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from galewatch.functions import hashing
from galewatch.operators import (
    calendar,
    classify,
    correlation,
    counting,
    encoding,
    geo,
    metrics,
    sampling,
    words,
)
from galewatch.sources.tables import parameter_table


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def numbers(spark):
    """Half of the rows carry one hot label."""
    return spark.range(4000).select(
        "id",
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("l"), (F.col("id") % 7).cast("string"))).alias("label"),
        (F.col("id") * 37 % 101).alias("x"),
        (F.col("id") * 53 % 89).alias("y"),
    )


def test_sample_is_exact_and_independent_of_layout(numbers):
    first = sampling.sample_n(numbers, "id", 15, 44).collect()
    assert len(first) == 15
    assert first == sampling.sample_n(numbers.repartition(7), "id", 15, 44).collect()
    assert first != sampling.sample_n(numbers, "id", 15, 42).collect()
    assert "TakeOrderedAndProject" in plan_of(sampling.sample_n(numbers, "id", 15, 44))


def test_sample_repeats_with_repeated_keys(spark):
    df = spark.range(100).select(F.lit(1).alias("id"), F.col("id").alias("x"))
    first = sampling.sample_n(df, "id", 5, 44).collect()
    assert first == sampling.sample_n(df.repartition(7), "id", 5, 44).collect()


def test_sample_reads_the_key_first(spark, tmp_path):
    path = str(tmp_path / "rows")
    rows = [(i % 7 if i % 7 else None, i, f"text {i}", f"clash {i}") for i in range(200)]
    df = spark.createDataFrame(rows, "id long, x long, text string, key string").repartition(3)
    df.write.parquet(path)
    stored = spark.read.parquet(path)
    for n in (0, 3, 40, 500):
        got = sampling.sample_n(stored, "id", n, 44).collect()
        whole = df.orderBy(hashing.seeded(F.col("id"), 44), "id", F.xxhash64(*df.columns)).limit(n).collect()
        assert got == whole and len(got) == min(n, 200)
    scans = [line for line in plan_of(sampling.sample_n(stored, "id", 15, 44)).splitlines() if "FileScan" in line]
    assert sum("ReadSchema: struct<id:bigint>" in line for line in scans) == 1 and len(scans) == 2


def test_ranks_beyond_the_group_limit(numbers, spark):
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "-1")
    try:
        got = sampling.first_per_class(numbers, "label", 1500, "x", "id").collect()
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    hot = sorted((r.x, r.id) for r in numbers.where("label = 'hot'").collect())[:1500]
    assert [(r.x, r.id) for r in sorted((r for r in got if r.label == "hot"), key=lambda r: r["rank"])] == hot
    assert "_share" in plan_of(sampling.first_per_class(numbers, "label", 1500, "x", "id"))


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_tracks_in_order_of_time(spark, kind):
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int"))
    df = spark.range(40).select(F.lit("t").alias("track"), day.cast(kind).alias("seq"), F.col("id").cast("double").alias("lat"), F.lit(0.0).alias("lon"))
    got = geo.trajectory_segments(df.repartition(3), "track", "seq").collect()
    assert sorted((r.start_lat, r.end_lat) for r in got) == [(float(i), float(i + 1)) for i in range(39)]


def test_labels_are_numbered_in_ranges(spark):
    """A thousand labels over all partitions, one of them with half of the rows; none goes through one task."""
    counts = {f"l{i:04d}": 1 + i % 7 for i in range(1_000)} | {"hot": 4_000}
    df = spark.createDataFrame([(x,) for x, n in counts.items() for _ in range(n)], "label string").repartition(7)
    index = encoding.label_index(df, "label")
    want = [(x, i, n) for i, (x, n) in enumerate(sorted(counts.items(), key=lambda item: (-item[1], item[0])))]
    assert sorted(map(tuple, index.collect()), key=lambda row: row[1]) == want
    assert "SinglePartition" not in plan_of(index) and "Window" not in plan_of(index)
    assert encoding.label_index(df.where("false"), "label").collect() == []


def test_split_covers_all_rows_once(numbers):
    parts = sampling.hash_split(numbers, "id")
    counts = {row.split: row["count"] for row in parts.groupBy("split").count().collect()}
    assert sum(counts.values()) == 4000
    assert counts["train"] == pytest.approx(2400, abs=120)
    assert counts["val"] == pytest.approx(800, abs=100)
    again = sampling.hash_split(numbers.repartition(5), "id")
    assert parts.exceptAll(again).count() == 0
    assert "Exchange" not in plan_of(parts)
    halves = sampling.hash_split(numbers, "id", {"a": 1, "b": 1})
    assert {row.split for row in halves.select("split").distinct().collect()} == {"a", "b"}


def test_counts_sum_to_the_total(numbers):
    counts = counting.count_by(numbers, "label").collect()
    assert counts[0] == ("hot", 2000)
    assert sum(row["count"] for row in counts) == 4000


def test_top_words_break_ties_by_word(spark):
    df = spark.createDataFrame([("e d c b a",), ("f f",)], "text string").repartition(3)
    assert words.top_words(df, "text", 3).collect() == [("f", 2), ("a", 1), ("b", 1)]


def test_stop_words_as_list_and_as_table_agree(spark):
    df = spark.createDataFrame([("the storm and the flood",), (None,)], "text string")
    table = parameter_table(spark, ["word"], [("the",), ("and",)])
    for stops in (["the", "and"], table):
        assert words.top_words(df, "text", 9, stops).collect() == [("flood", 1), ("storm", 1)]


def test_ranking_limits_before_the_exchange(spark, numbers):
    texts = numbers.select("label", F.concat_ws(" ", F.lit("w"), F.concat(F.lit("v"), "x")).alias("text"))
    ranked = words.top_words_by(texts, "label", "text", 2)
    plan = plan_of(ranked)
    assert plan.index("Final") < plan.index("Exchange hashpartitioning(label") < plan.index("Partial")
    assert all(row["count"] >= 1 and row["rank"] <= 2 for row in ranked.collect())
    assert ranked.where("label = 'hot'").orderBy("rank").first() == ("hot", "w", 2000, 1)


def test_dates_are_parsed_per_distinct_text(spark):
    df = spark.createDataFrame([("Mon Aug 28 10:11:12 +0000 2017",)] * 3, "at string")
    plan = plan_of(calendar.date_counts(df, "at"))
    assert "date_format" not in plan.split("Exchange")[-1]


def test_hours_are_read_once_per_message(spark):
    df = spark.createDataFrame([("d", "10:11:12")], "tweet_date string, tweet_time string")
    assert plan_of(calendar.avg_per_hour(df)).count("RLIKE") == 1


@pytest.mark.parametrize(
    "clock, hour",
    [("00:00:00", 0), ("23:59:59", 23), ("24:00:00", None), ("", None), ("7:00:00", None), ("ab:cd:ef", None), (None, None)],
)
def test_hours(spark, clock, hour):
    df = spark.createDataFrame([("d", clock)], "tweet_date string, tweet_time string")
    assert [row.tweet_hour for row in calendar.hourly_counts(df).collect()] == ([] if hour is None else [hour])


def test_created_at_to_timestamp(spark):
    df = spark.createDataFrame([("Mon Aug 28 10:11:12 +0200 2017",), ("nonsense",), (None,)], "at string")
    stamps = calendar.parse_created_at(df, "at").select(F.col("created_ts").cast("string")).collect()
    assert [row[0] for row in stamps] == ["2017-08-28 08:11:12", None, None]


def test_running_average(spark):
    rows = [("d", f"{hour:02}:00:00") for hour in (1, 1, 1, 2, 5, 5)]
    df = spark.createDataFrame(rows, "tweet_date string, tweet_time string")
    got = calendar.running_avg(df).orderBy("tweet_hour").collect()
    assert got == [("d", 1, 3, 3.0), ("d", 2, 1, 2.0), ("d", 5, 2, 2.0)]


@pytest.mark.parametrize("pieces", ["1", "3", "8", "64"])
def test_segments_do_not_depend_on_the_pieces(spark, pieces):
    points = spark.range(300).select(
        F.when(F.col("id") < 200, "long").when(F.col("id") < 299, "short").otherwise("single").alias("track"),
        (F.col("id") * F.col("id")).alias("seq"),
        F.when(F.col("id") % 10 != 0, F.col("id").cast("double")).alias("lat"),
        (-F.col("id")).cast("double").alias("lon"),
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", pieces)
    try:
        got = sorted(geo.trajectory_segments(points.repartition(5), "track", "seq").collect(), key=lambda r: r.seq)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    ids = [i for i in range(298) if i != 199]

    def lat(i):
        return float(i) if i % 10 else None

    want = [
        ("long" if i < 200 else "short", i * i, lat(i), float(-i), lat(i + 1), float(-i - 1)) for i in ids
    ]
    assert [tuple(row) for row in got] == want


def test_label_index_orders_by_count_then_name(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "label string")
    assert sorted(encoding.label_index(df, "label").collect()) == [("a", 1, 1), ("b", 2, 1), ("c", 0, 2)]
    model = encoding.fit_label_index(df, "label", "i")
    assert model.labels == ["c", "a", "b"]


def test_encoding_moves_no_rows(numbers):
    df = numbers.withColumn("flag", F.col("x") > 50)
    rows = encoding.feature_encode(df, "label", "flag", ["x", "y"], keep=["id"]).rows
    assert "Exchange" not in plan_of(rows) and "Join" not in plan_of(rows)


def test_correlation_matrix(numbers):
    matrix = {(r.feature_x, r.feature_y): r["corr"] for r in correlation.correlation(numbers, ["id", "x", "y"]).collect()}
    table = numbers.toPandas()[["id", "x", "y"]].corr()
    assert len(matrix) == 9
    for (a, b), value in matrix.items():
        assert value == matrix[b, a] == pytest.approx(table.loc[a, b])


def test_correlation_skips_rows_without_every_number(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 1.0), (2.0, 4.0, 5.0), (3.0, 7.0, 2.0), (4.0, None, 9.0), (5.0, 1.0, float("nan"))],
        "a double, b double, c double",
    )
    matrix = {(r.feature_x, r.feature_y): r["corr"] for r in correlation.correlation(df, ["a", "b", "c"]).collect()}
    table = df.toPandas().dropna().corr()
    assert all(value == pytest.approx(table.loc[pair]) for pair, value in matrix.items())


def test_metrics_agree_with_the_evaluator(numbers):
    predictions = numbers.select(
        (F.col("id") % 4).cast("double").alias("label"), (F.col("x") % 3).cast("double").alias("prediction")
    )
    cells = metrics.confusion(predictions, "label", "prediction")
    overall = {row.metric: row.value for row in metrics.metrics_overall(cells).collect()}
    evaluator = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")

    def evaluate(name, **params):
        return evaluator.evaluate(predictions, {evaluator.metricName: name, **params})

    assert overall["Precision"] == pytest.approx(evaluate("weightedPrecision"))
    assert overall["Recall"] == pytest.approx(evaluate("weightedRecall"))
    assert overall["Accuracy"] == pytest.approx(evaluate("accuracy"))
    assert overall["Recall"] == pytest.approx(overall["Accuracy"])
    assert metrics.accuracy(cells).first().accuracy == pytest.approx(overall["Accuracy"])
    by_label = {row.label: row for row in metrics.metrics_by_label(cells).collect()}
    assert set(by_label) == {0.0, 1.0, 2.0, 3.0}
    for label, row in by_label.items():
        at = {evaluator.metricLabel: label}
        for column, name in (("precision", "precisionByLabel"), ("recall", "recallByLabel"), ("f1", "fMeasureByLabel")):
            assert row[column] == pytest.approx(evaluator.evaluate(predictions, {evaluator.metricName: name, **at}))
    assert by_label[3.0].precision == 0  # never predicted


def test_metrics_leave_out_labels_that_do_not_occur(spark):
    df = spark.createDataFrame([("a", "b"), ("a", "a")], "y string, p string")
    cells = metrics.confusion(df, "y", "p")
    assert metrics.metrics_by_label(cells).collect() == [("a", 1.0, 0.5, pytest.approx(2 / 3), 2)]


@pytest.fixture(scope="module")
def encoded(spark):
    rows = spark.range(900).select(
        "id",
        F.when(F.col("id") % 3 == 0, "low").when(F.col("id") % 3 == 1, "mid").otherwise("high").alias("label"),
        ((F.col("id") % 3) * 10 + F.col("id") % 4).alias("x"),
        (F.col("id") % 2 == 0).alias("flag"),
    )
    return encoding.feature_encode(rows, "label", "flag", ["x"], keep=["id"])


@pytest.mark.parametrize("name", ["random_forest", "logistic_regression"])
def test_classifiers_learn_and_repeat(encoded, name):
    def run():
        classifier = getattr(classify, name)("label_index")
        return classify.classify(encoded, classifier, "id", "label", ["x", "flag_index"])

    first, second = run(), run()
    assert first.val_accuracy == second.val_accuracy == 1.0
    assert first.test_accuracy == second.test_accuracy == 1.0
    assert sorted(row.label for row in first.by_label.collect()) == ["high", "low", "mid"]
    assert first.label_distribution.collect() == [("high", 0, 300), ("low", 1, 300), ("mid", 2, 300)]
    assert {row.metric: row.value for row in first.overall.collect()} == {"Precision": 1.0, "Recall": 1.0, "Accuracy": 1.0}


def test_no_query_leaves_the_jvm_or_multiplies_rows(spark):
    from checks.bindings import QUERIES

    for key in [key for key in QUERIES if not key.startswith("classify")]:
        plan = plan_of(QUERIES[key](spark, "/root/testdata/sf0.001"))
        for node in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "RoundRobinPartitioning"):
            assert node not in plan, f"{node} in {key}"
