"""Most frequent words and tags.

Words are counted before they are ranked, and every exchange carries partial
counts, never single words.
"""

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galewatch.functions.literals import listed
from galewatch.functions.text import lower_words
from galewatch.operators import sampling

TOP_WORDS = 20
TOP_TAGS = 15

StopWords = Iterable[str] | DataFrame


def words(df: DataFrame, text: str, stop_words: StopWords = (), carry: Sequence[str] = ()) -> DataFrame:
    """One row (carry..., word) per word of the text that is not a stop word.

    A list of stop words becomes one hash-set test per word; a one-column frame
    of them is anti-joined, for lists too long for a plan.
    """
    found = df.select(*carry, F.explode(lower_words(F.col(text))).alias("word")).where(F.col("word") != "")
    if isinstance(stop_words, DataFrame):
        stops = stop_words.select(F.col(stop_words.columns[0]).alias("word"))
        return found.join(stops, "word", "left_anti").select(*carry, "word")
    stops = sorted(stop_words)
    return found.where(f"word not in {listed(stops)}") if stops else found


def top(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values (column, count), ties by value."""
    return df.groupBy(column).count().orderBy(F.col("count").desc(), column).limit(k)


def top_words(df: DataFrame, text: str, k: int = TOP_WORDS, stop_words: StopWords = ()) -> DataFrame:
    """(word, count) of the k most frequent words."""
    return top(words(df, text, stop_words), "word", k)


def top_words_by(
    df: DataFrame, label: str, text: str, k: int = TOP_WORDS, stop_words: StopWords = ()
) -> DataFrame:
    """(label, word, count, rank) of the k most frequent words of every label, in one job.

    A label's words are ranked in shares first, by word, so a label's task gets
    k words of each share, not all of the label's words.
    """
    counts = words(df, text, stop_words, carry=[label]).groupBy(label, "word").count()
    shared = counts.withColumn("_share", F.pmod(F.xxhash64("word"), F.lit(sampling.SHARES)))
    return sampling.ranked(shared, label, k, [F.col("count").desc(), "word"]).drop("_share")


def top_tags(df: DataFrame, tags: str, k: int = TOP_TAGS) -> DataFrame:
    """(word, count) of the k most frequent lower-cased tags; a tag with commas counts as several."""
    listed = df.select(F.explode(tags).alias("tag"))
    return top(listed.select(F.explode(F.split(F.lower("tag"), ",")).alias("word")), "word", k)
