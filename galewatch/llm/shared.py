"""What several operators need: intermediate tables in the cluster's shared folder, and plain column helpers."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = r"[\x20\x09-\x0D]+"  # between words


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables that the driver and all executors see.

    It is ``spark.checkpoint.dir``, else the checkpoint folder that the session's
    context has been given. Where there is neither, a session in local mode
    (one machine, as in tests) gets a new temporary folder as its checkpoint
    folder; on a cluster that is an error, since executors would not find it.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("name a folder that all executors see: spark.checkpoint.dir or SparkContext.setCheckpointDir")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="galewatch-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def landed(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame once to the shared folder and read it back.

    Cuts the lineage so that a lost executor costs tasks and not the whole
    history, and gives the planner the table's size: joins against it are
    broadcast by Catalyst's own threshold.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def small_letters(text: Column) -> Column:
    """A-Z in lower case; every other letter stays."""
    return F.translate(text, CAPITALS, SMALL)


def split_words(text: Column, between: str) -> Column:
    """Words between runs of separators, [] for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), between), "")


def text_key(text: Column) -> Column:
    """Tells apart the texts of rows that share an id; null has its own value."""
    return F.xxhash64(text, text.isNull())


@contextmanager
def no_collector() -> Iterator[None]:
    """For work with millions of small objects and no cycles; a Python worker's later tasks have the collector again."""
    before = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if before:
            gc.enable()
