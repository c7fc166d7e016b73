import uuid

import pytest
from pyspark.sql import functions as F

from galewatch import schemas
from galewatch.sources import messages as sources
from galewatch.sources.tables import land, land_by_day, parameter_table, read_table


def test_flat_schema_is_the_declared_one(flat):
    assert flat.schema.simpleString() == schemas.FLAT_MESSAGE.simpleString()


def test_both_directories_only_json_files(flat):
    ids = sorted(row.tweet_id for row in flat.select("tweet_id").collect())
    assert ids == [1, 2, 3, 3, 4, 5, 6, 7, 8]


def test_malformed_lines_are_set_apart(spark, message_dirs):
    scan = sources.scan_messages(spark, *message_dirs)
    assert scan.messages.count() == 9
    (bad,) = scan.quarantine.collect()
    assert bad[schemas.CORRUPT] == "not json"
    assert bad.file.endswith("a.json")


def test_lines_are_parsed_once_and_whole(spark, tmp_path):
    good = '{"id": 1, "user": {"id": 2}}'
    wrong = '{"id": 3, "user": {"id": "x"}}'
    (tmp_path / "a.json").write_text(f"{good}\n\n{wrong}\n")
    scan = sources.scan_messages(spark, str(tmp_path))
    # the wrong field counts although nobody asks for it
    assert scan.messages.count() == 1
    assert [row.id for row in scan.messages.select("id").collect()] == [1]
    assert scan.quarantine.select(schemas.CORRUPT).collect() == [(wrong,)]
    assert plan_of(scan.messages.select("id", "text")).count("from_json") == 1


WRONG = [
    ('{"id": "1", "user": {"id": 2}}', ["id"]),
    ('{"id": 1, "user": {"id": 2.5, "verified": "yes"}, "text": "x"}', ["user.id", "user.verified"]),
    ('{"id": 1, "geo": {"coordinates": [1, 2.5, "x", "y"]}}', ["geo.coordinates[]"]),
    ('{"id": 1, "geo": {"coordinates": {"lat": 1}}}', ["geo.coordinates"]),
    ('{"id": 1, "entities": {"hashtags": [{"text": "a"}, "b"]}}', ["entities.hashtags[]"]),
    ('{"id": 1, "user": [3], "place": "here"}', ["place", "user"]),
    ('{"id": 123456789012345678901}', ["id"]),
    ('"text"', ["$"]),
    ('{"id": 1, "user": {"id"', []),
    ("not json", []),
]
RIGHT = [
    '{"id": null, "user": null, "geo": {"coordinates": [null, 1, "NaN"]}, "entities": {"hashtags": [null]}}',
    '{"id": 1, "text": {"any": [1]}, "created_at": 5, "other": {"id": "x"}}',
    "{}",
]


def test_malformed_lines_name_the_fields_that_failed(spark):
    lines = spark.createDataFrame([(value, "f") for value in [*RIGHT, *(line for line, _ in WRONG)]], "value string, file string")
    scan = sources.parse_messages(lines)
    assert scan.messages.count() == len(RIGHT)
    got = {row[schemas.CORRUPT]: row.fields for row in scan.quarantine.collect()}
    assert got == dict(WRONG)


def test_quarantine_is_counted_by_field(spark):
    lines = spark.createDataFrame([(line, "f") for line, _ in WRONG], "value string, file string")
    counts = {row.field: row["count"] for row in sources.quarantine_counts(sources.parse_messages(lines)).collect()}
    assert counts[None] == 2 and counts["id"] == 2 and counts["user.verified"] == 1
    none = sources.parse_messages(lines.where("false"))
    assert sources.quarantine_counts(none).count() == 0


def test_right_lines_are_not_parsed_for_their_fields(spark):
    lines = spark.createDataFrame([("{}", "f")], "value string, file string")
    assert "parse_json" not in plan_of(sources.parse_messages(lines).messages)


def test_field_values(flat):
    row = flat.where("tweet_id = 1").first()
    assert (row.tweet_pos, row.tweet_place, row.crisis_name) == ([29.76, -95.36], "Houston, TX", "storm")
    assert (row.user_id, row.user_followers, row.user_verified) == (11, 10, True)
    assert row.hashtags == ["Harvey", "Houston,Flood"]
    assert (row.tweet_date, row.tweet_time) == ("Mon Aug 28", "10:11:12")


def test_directory_without_positions(spark, message_dirs):
    assert sources.read_messages(spark, message_dirs[1]).select("tweet_pos").distinct().collect() == [(None,)]


def test_labels_are_text_without_date(labels):
    assert labels.dtypes == [("tweet_id", "string"), ("AIDRLabel", "string"), ("AIDRConfidence", "string")]


def test_label_file_with_other_columns_fails(spark, tmp_path):
    path = tmp_path / "labels.txt"
    path.write_text("Date\tTweetID\tAIDRLabel\tAIDRConfidence\nx\t1\tpersonal\t0.5\n")
    with pytest.raises(Exception, match="(?i)header"):
        sources.read_labels(spark, str(path)).collect()


def test_join_keeps_repeats_and_drops_ids_that_are_no_numbers(labelled):
    ids = sorted(row.tweet_id for row in labelled.select("tweet_id").collect())
    assert ids == [1, 2, 3, 3, 4, 5, 6, 7, 8]
    assert dict(labelled.dtypes)["tweet_id"] == "bigint"


def test_union_by_name_fills_missing_columns(spark):
    left = spark.createDataFrame([(1, "a")], "id int, x string")
    right = spark.createDataFrame([("b", 2)], "y string, id int")
    got = sources.union_all(left, right).select("id", "x", "y").collect()
    assert sorted(got) == [(1, "a", None), (2, None, "b")]


def test_landed_table_reads_back(spark, flat, tmp_path):
    path = str(tmp_path / "flat")
    land(flat, path)
    assert read_table(spark, path).count() == 9
    pruned = read_table(spark, path).select(F.size("hashtags"))
    assert "ReadSchema: struct<hashtags:array<string>>" in plan_of(pruned)


def test_days_are_replaced_one_by_one(spark, flat, tmp_path):
    path = str(tmp_path / "days")
    land_by_day(flat, path)
    first = sorted(map(tuple, read_table(spark, path).select("tweet_id", "tweet_date").collect()), key=repr)
    land_by_day(flat, path)  # again: nothing doubles
    assert sorted(map(tuple, read_table(spark, path).select("tweet_id", "tweet_date").collect()), key=repr) == first
    assert len(first) == flat.count()
    land_by_day(flat.where("tweet_id = 2"), path)
    after = read_table(spark, path).groupBy("tweet_date").count().collect()
    before = {day: sum(d == day for _, d in first) for _, day in first}
    assert dict(map(tuple, after)) == before | {"Mon Aug 28": 1}
    plan = plan_of(read_table(spark, path).where("tweet_date = 'Mon Aug 28'"))
    assert "PartitionFilters: [isnotnull(tweet_date" in plan


STORED = tuple(f"stored_{side}_{uuid.uuid4().hex}" for side in ("messages", "labels"))


def test_stored_tables_join_without_exchange(spark, flat, labels, labelled):
    joined = sources.land_for_join(flat, labels, STORED, 4)
    assert "Exchange" not in plan_of(joined) and "SortMergeJoin" in plan_of(joined)
    assert joined.columns == labelled.columns
    both = [sorted(map(repr, frame.collect())) for frame in (joined, labelled)]
    assert both[0] == both[1]
    again = sources.land_for_join(flat, labels, STORED, 4)
    assert again.count() == len(both[1])
    for name in STORED:
        spark.sql(f"drop table {name}")


def test_parameter_table_has_known_size(spark):
    assert "LocalTableScan" in plan_of(parameter_table(spark, ["word", "valence"], [("good", 1.9)]))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
