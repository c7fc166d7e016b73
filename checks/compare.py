"""Runs bound queries next to their SQL counterparts: python -m checks.compare [directory] [key ...]."""

import datetime
import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.bindings import QUERIES
from checks.oracles import ORACLES

# Spark type -> DuckDB type of a column with the same values.
SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def local_session(cores: int | str = "*") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("galewatch")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def open_tables(directory: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(directory).glob("*.parquet")):
        connection.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 12)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def by_name(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def difference(frame: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What sets the two results apart, None when schema and rows are equal."""
    answer = connection.execute(sql)
    names = [column[0] for column in answer.description]
    types = dict(zip(names, [str(column[1]) for column in answer.description], strict=True))
    want_rows = answer.fetchall()
    have_types = {name: SAME_TYPE.get(kind, kind) for name, kind in frame.dtypes}
    if have_types != types:
        return f"schema: {have_types} against {types}"
    have, want = by_name(frame.columns, frame.collect()), by_name(names, want_rows)
    if len(have) != len(want):
        return f"rows: {len(have)} against {len(want)}"
    apart = [(ours, theirs) for ours, theirs in zip(have, want, strict=True) if ours != theirs]
    return f"values: {len(apart)} of {len(have)} rows, first {apart[0]}" if apart else None


def main(directory: str = "/root/testdata/sf0.01", *keys: str) -> int:
    spark, connection = local_session(), open_tables(directory)
    failures = 0
    for key in keys or QUERIES:
        started = time.perf_counter()
        frame = QUERIES[key](spark, directory)
        if key in ORACLES:
            outcome = difference(frame, connection, ORACLES[key])
        else:
            outcome = None if frame.collect() else "no rows"
        failures += outcome is not None
        kind = "same" if key in ORACLES else "rows only"
        print(f"{key:28s} {time.perf_counter() - started:6.2f}s  {outcome or kind}", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(min(main(*sys.argv[1:]), 1))
