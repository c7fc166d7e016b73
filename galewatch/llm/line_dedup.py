"""Boilerplate lines by site-relative frequency.

A site's pages are its rows. A line is boilerplate of a site if the share of the
site's pages that hold it exceeds ``ratio``. At least ``least_pages`` pages must
hold it: on a site of a few pages one page or two copies of it are above any
ratio by chance. Lines without a word are never counted or
dropped. A line counts once per page, however often the page repeats it. Column
functions only.

Lines are counted by their 64-bit hash. At most (lines per page) / ratio lines
of a site can exceed the ratio, which bounds the list that each site's pages are
read against.

Null texts stay null and count as pages without lines; a null site is a site of
its own; repeated rows are pages of their own; a page that loses all lines
becomes the empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galewatch.llm.shared import landed

RATIO = 0.1
LEAST_PAGES = 3


def worded(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def boilerplate(pages: DataFrame, site: str, text: str, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """_site, _dropped: the hashes of each site's boilerplate lines. Sites without any have no row."""
    pages = pages.select(F.col(site).alias("_site"), F.col(text).alias("_text"))
    lines = F.array_distinct(F.filter(F.split("_text", "\n"), worded))
    held = pages.select("_site", F.explode(F.transform(lines, lambda line: F.xxhash64(line))).alias("_line"))
    often = held.groupBy("_site", "_line").agg(F.count(F.lit(1)).alias("_held")).where(F.col("_held") >= least_pages)
    totals = pages.groupBy(F.col("_site").alias("_of")).agg(F.count(F.lit(1)).alias("_pages"))
    above = often.join(totals, F.col("_site").eqNullSafe(F.col("_of"))).where(F.col("_held") > ratio * F.col("_pages"))
    return landed(above.groupBy("_site").agg(F.sort_array(F.collect_list("_line")).alias("_dropped")), "boilerplate")


def with_lines_judged(
    pages: DataFrame, site: str = "source", text: str = "text", ratio: float = RATIO, least_pages: int = LEAST_PAGES
) -> DataFrame:
    """Pages with ``_lines`` and ``_left``: all lines of the text, and those that are no boilerplate of its site.

    The pages' own names must not begin with an underscore.
    """
    dropped = boilerplate(pages, site, text, ratio, least_pages)
    out = pages.join(dropped, F.col(site).eqNullSafe(F.col("_site")), "left").drop("_site")
    out = out.withColumn("_lines", F.split(F.col(text), "\n"))
    stays = lambda line: ~(worded(line) & F.array_contains("_dropped", F.xxhash64(line)))
    left = F.when(F.col("_dropped").isNull(), F.col("_lines")).otherwise(F.filter("_lines", stays))
    return out.withColumn("_left", left).drop("_dropped")


def without_boilerplate(
    documents: DataFrame, site: str = "source", text: str = "text", ratio: float = RATIO, least_pages: int = LEAST_PAGES
) -> DataFrame:
    """Documents with the same columns; the text without boilerplate, n_chars (if there) of the new text."""
    # The row stays in one column, so that no name of its own meets one of those made here.
    packed = documents.select(F.struct("*").alias("row"), F.col(site).alias("site"), F.col(text).alias("text"))
    out = with_lines_judged(packed, "site", "text", ratio, least_pages).withColumn("text", F.array_join("_left", "\n"))
    new = {text: F.col("text")}
    if "n_chars" in documents.columns:
        new["n_chars"] = F.length("text").cast(documents.schema["n_chars"].dataType)
    return out.select(*[new.get(name, F.col("row").getField(name)).alias(name) for name in documents.columns])
