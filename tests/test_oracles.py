"""Every bound query against its SQL counterpart on the stored test tables."""

import os

import pytest

from checks.bindings import QUERIES
from checks.compare import difference, open_tables
from checks.oracles import ORACLES

DIRECTORY = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def tables():
    return open_tables(DIRECTORY)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_same_as_sql(spark, tables, key):
    assert difference(QUERIES[key](spark, DIRECTORY), tables, ORACLES[key]) is None


@pytest.mark.parametrize("key", ["flatten_nested", "parse_created_at", "date_counts", "avg_per_hour", "running_avg"])
def test_same_in_another_time_zone(spark, tables, key):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        assert difference(QUERIES[key](spark, DIRECTORY), tables, ORACLES[key]) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
