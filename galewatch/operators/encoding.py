"""Numbers for learning: label indexes, flags and confidences."""

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate
from operator import and_
from typing import NamedTuple

from pyspark.ml.feature import StringIndexer, StringIndexerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW_BITS = 33  # of Spark's ids that are unique and ascending: a partition's rows; the bits above are the partition


class Encoded(NamedTuple):
    """Rows with every number present, those without, and the fitted index of the label."""

    rows: DataFrame
    skipped: DataFrame
    index: StringIndexerModel


def flag_index(flag: Column) -> Column:
    """1 when true, 0 when false or unknown."""
    return F.when(flag, 1).otherwise(0)


def label_index(df: DataFrame, label: str) -> DataFrame:
    """(label, label_index, count): 0 for the most frequent label, ties alphabetical; null labels left out."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).count()
    index = numbered(counts, [F.col("count").desc(), F.col(label)], "label_index")
    return index.select(label, F.col("label_index").cast("int").alias("label_index"), "count")


def numbered(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``df`` with the place of each row in the given order, from 0.

    Rows are sorted in ranges and numbered within their range by the task that
    has it; how many rows each range holds is the only thing that is gathered, a
    number for each partition. The ranges are kept from the counting to the
    numbering, and a lost one is sorted again with the same bounds.
    """
    place = f"{name}_in_range"
    ranged = df.orderBy(*order).withColumn(place, F.monotonically_increasing_id()).persist()
    part, within = F.shiftright(place, ROW_BITS), F.col(place).bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    sizes = dict(ranged.groupBy(part.alias("part")).count().collect())
    starts = accumulate((sizes.get(i, 0) for i in range(max(sizes, default=0))), initial=0)
    start = F.expr(f"array({', '.join(f'{at}L' for at in starts)})")
    return ranged.withColumn(name, F.get(start, part.cast("int")) + within).drop(place)


def fit_label_index(df: DataFrame, label: str, output: str) -> StringIndexerModel:
    """The same index as a fitted model: it is applied per row, so no row moves to meet its label."""
    indexer = StringIndexer(inputCol=label, outputCol=output, stringOrderType="frequencyDesc", handleInvalid="skip")
    return indexer.fit(df.select(label))


def present(columns: Sequence[str]) -> Column:
    """Whether all columns hold a number."""
    return reduce(and_, [F.col(name).isNotNull() & ~F.isnan(F.col(name).cast("double")) for name in columns])


def feature_encode(
    df: DataFrame,
    label: str,
    flag: str,
    numbers: Sequence[str],
    confidence: str | None = None,
    keep: Sequence[str] = (),
) -> Encoded:
    """Rows as (keep..., numbers..., <label>_index, <confidence>_numeric, <flag>_index).

    Confidences that are not numbers, and rows without label, are not errors:
    such rows are set apart as ``skipped``.
    """
    index_name = f"{label}_index"
    index = fit_label_index(df, label, index_name)
    columns = [*keep, label, *[F.col(name).cast("double").alias(name) for name in numbers]]
    encoded = [*numbers, index_name]
    if confidence is not None:
        columns.append(F.col(confidence).try_cast("double").alias(f"{confidence}_numeric"))
        encoded.append(f"{confidence}_numeric")
    columns.append(flag_index(F.col(flag)).alias(f"{flag}_index"))
    encoded.append(f"{flag}_index")
    narrow = df.select(*columns)
    complete = F.col(label).isNotNull() & present([name for name in encoded if name != index_name])
    rows = index.transform(narrow.where(complete)).select(*keep, label, *encoded)
    return Encoded(rows, narrow.where(~complete), index)
