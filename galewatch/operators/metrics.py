"""Classification metrics from confusion counts (one row per pair of classes)."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion(predictions: DataFrame, actual: str, predicted: str, *by: str) -> DataFrame:
    """(by..., actual, predicted, count)."""
    pairs = predictions.select(*by, F.col(actual).alias("actual"), F.col(predicted).alias("predicted"))
    return pairs.groupBy(*by, "actual", "predicted").count()


def label_totals(cells: DataFrame) -> DataFrame:
    """(label, support, predicted, hits) of each label that occurs.

    A cell counts as support of its actual label and as prediction of its
    predicted one, so one aggregate over both sides replaces a join.
    """
    count, none = F.col("count"), F.lit(0).cast("bigint")
    hits = F.when(F.col("actual") == F.col("predicted"), count).otherwise(none)

    def side(label: str, support: Column, predicted: Column, hits: Column) -> Column:
        return F.struct(
            F.col(label).alias("label"), support.alias("support"), predicted.alias("predicted"), hits.alias("hits")
        )

    sides = F.array(side("actual", count, none, hits), side("predicted", none, count, none))
    totals = cells.select(F.inline(sides)).groupBy("label")
    return totals.agg(*[F.sum(name).alias(name) for name in ("support", "predicted", "hits")]).where(
        F.col("support") > 0
    )


def precision() -> Column:
    return F.when(F.col("predicted") > 0, F.col("hits") / F.col("predicted")).otherwise(0.0)


def recall() -> Column:
    return F.col("hits") / F.col("support")


def metrics_by_label(cells: DataFrame) -> DataFrame:
    """(label, precision, recall, f1, support); a label never predicted has precision 0."""
    p, r = F.col("precision"), F.col("recall")
    f1 = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0)
    rates = label_totals(cells).select("label", precision().alias("precision"), recall().alias("recall"), "support")
    return rates.select("label", "precision", "recall", f1.alias("f1"), "support")


def metrics_overall(cells: DataFrame) -> DataFrame:
    """(metric, value): precision and recall weighted by support, and accuracy."""
    support = F.col("support")
    everything = label_totals(cells).agg(
        (F.sum(precision() * support) / F.sum(support)).alias("Precision"),
        (F.sum(recall() * support) / F.sum(support)).alias("Recall"),
        (F.sum("hits") / F.sum(support)).alias("Accuracy"),
    )
    return everything.unpivot([], ["Precision", "Recall", "Accuracy"], "metric", "value")


def accuracy(cells: DataFrame, *by: str) -> DataFrame:
    """(by..., accuracy)."""
    hits = F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("count")).otherwise(0))
    return cells.groupBy(*by).agg((hits / F.sum("count")).alias("accuracy"))
