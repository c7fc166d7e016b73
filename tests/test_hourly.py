import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from galewatch.operators import calendar
from galewatch.plans import hourly
from galewatch.sources import messages as sources


@pytest.fixture
def table(spark):
    name = f"hours_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"drop table if exists {name}")


def write(path, *stamps):
    path.write_text("".join(json.dumps({"id": i, "created_at": at}) + "\n" for i, at in enumerate(stamps)))


def at(clock, day="Mon Aug 28"):
    return f"{day} {clock} +0000 2017"


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def same_as_from_scratch(spark, table, *directories):
    flat = sources.read_messages(spark, *directories)
    assert rows(hourly.hourly_counts(spark, table)) == rows(calendar.hourly_counts(flat))
    assert rows(hourly.avg_per_hour(spark, table)) == rows(calendar.avg_per_hour(flat))
    assert rows(hourly.running_avg(spark, table)) == rows(calendar.running_avg(flat))


def test_new_files_are_merged_and_known_ones_left(spark, table, tmp_path):
    write(tmp_path / "a.json", at("10:00:00"), at("10:30:00"), at("11:00:00"), "no date")
    (tmp_path / "bad.json").write_text("not json\n")
    (tmp_path / "none.json").write_text("")  # no listing shows files without a byte
    assert hourly.take_files(spark, table, str(tmp_path)) == 2
    same_as_from_scratch(spark, table, str(tmp_path))
    write(tmp_path / "b.json", at("10:59:59"), at("23:00:00", "Tue Aug 29"))
    assert hourly.take_files(spark, table, str(tmp_path)) == 1
    same_as_from_scratch(spark, table, str(tmp_path))
    before = spark.table(table).count()
    assert hourly.take_files(spark, table, str(tmp_path)) == 0
    assert spark.table(table).count() == before


def test_a_changed_file_replaces_its_earlier_version(spark, table, tmp_path):
    path = tmp_path / "a.json"
    write(path, at("10:00:00"), at("12:00:00"))
    write(tmp_path / "b.json", at("12:00:00"))
    assert hourly.take_files(spark, table, str(tmp_path)) == 2
    write(path, at("10:00:00"), at("10:00:00"))
    later = path.stat().st_mtime + 60
    os.utime(path, (later, later))
    assert hourly.take_files(spark, table, str(tmp_path)) == 1
    assert rows(hourly.hourly_counts(spark, table)) == [("Mon Aug 28", 10, 2), ("Mon Aug 28", 12, 1)]


def test_the_same_version_twice_counts_once(spark, table, tmp_path):
    write(tmp_path / "a.json", at("10:00:00"), at("10:00:01"))
    hourly.take_files(spark, table, str(tmp_path))
    spark.table(table).limit(10).cache().write.mode("append").saveAsTable(table)
    assert spark.table(table).count() == 2
    assert rows(hourly.hourly_counts(spark, table)) == [("Mon Aug 28", 10, 2)]


def test_frames_with_versions(spark, table):
    version = "file string, modified timestamp, tweet_date string, tweet_time string"
    hour = F.expr("timestamp'2020-01-01 00:00:00'")
    flat = spark.createDataFrame(
        [("f", None, "d", "01:00:00"), ("f", None, "d", "x"), ("g", None, None, "01:00:00")], version
    ).withColumn("modified", hour)
    hourly.take(table, flat)
    hourly.take(table, flat.where("file = 'f'"))
    assert rows(hourly.hourly_counts(spark, table)) == [("d", 1, 1), (None, 1, 1)]


def test_reading_takes_one_exchange_by_file(spark, table, tmp_path):
    write(tmp_path / "a.json", at("10:00:00"))
    hourly.take_files(spark, table, str(tmp_path))
    plan = hourly.hourly_counts(spark, table)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
