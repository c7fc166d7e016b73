"""Topic classification with random forest and logistic regression."""

from collections.abc import Sequence
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galewatch.functions import hashing
from galewatch.operators import metrics
from galewatch.operators.encoding import Encoded

# Size and seed of the forest.
TREES = 100
FOREST_SEED = 123


class Classification(NamedTuple):
    """Result of one trained classifier; ``by_label`` and ``overall`` are of the test part."""

    val_accuracy: float | None
    test_accuracy: float | None
    overall: DataFrame
    label_distribution: DataFrame
    by_label: DataFrame


def random_forest(label_index: str, trees: int = TREES, seed: int = FOREST_SEED) -> RandomForestClassifier:
    return RandomForestClassifier(featuresCol="features", labelCol=label_index, numTrees=trees, seed=seed)


def logistic_regression(label_index: str) -> LogisticRegression:
    return LogisticRegression(featuresCol="features", labelCol=label_index, family="auto")


def classify(
    encoded: Encoded, classifier, key: str, label: str, features: Sequence[str], seed: int = hashing.SPLIT_SEED
) -> Classification:
    """Trains on 60 % of the rows, scores the rest once and derives every figure from those counts.

    Rows are split by the hash of ``key``; a feature without a number is an
    error, as the encoding has set such rows apart. They are kept, as numbers only, for
    the passes of the training; a part lost with its executor is recomputed
    from the source. What reaches the driver is one count per split and pair
    of classes.
    """
    label_index = f"{label}_index"
    spark = encoded.rows.sparkSession
    numbers = encoded.rows.select(
        hashing.split_name(F.col(key), seed=seed).alias("split"),
        *dict.fromkeys([*features, label_index]),
    )
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")
    vectors = assembler.transform(numbers).select("split", label_index, "features")
    vectors = vectors.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        distribution = vectors.groupBy(label_index).count().collect()
        model = Pipeline(stages=[classifier]).fit(vectors.where(F.col("split") == "train"))
        scored = model.transform(vectors.where(F.col("split") != "train"))
        cells = metrics.confusion(scored, label_index, "prediction", "split").collect()
    finally:
        vectors.unpersist()

    names = encoded.index.labels
    parts = spark.createDataFrame(
        [(row["split"], names[int(row["actual"])], names[int(row["predicted"])], row["count"]) for row in cells],
        "split string, actual string, predicted string, count bigint",
    )
    tested = parts.where(F.col("split") == "test")
    distribution_table = spark.createDataFrame(
        sorted((names[int(index)], int(index), count) for index, count in distribution),
        "label string, label_index int, count bigint",
    )
    return Classification(
        val_accuracy=share_right(cells, "val"),
        test_accuracy=share_right(cells, "test"),
        overall=metrics.metrics_overall(tested),
        label_distribution=distribution_table.orderBy("label_index"),
        by_label=metrics.metrics_by_label(tested),
    )


def share_right(cells: Sequence, split: str) -> float | None:
    """Share of the split's rows on the diagonal, None when it has no rows."""
    part = [row for row in cells if row["split"] == split]
    right = sum(row["count"] for row in part if row["actual"] == row["predicted"])
    everything = sum(row["count"] for row in part)
    return right / everything if everything else None
