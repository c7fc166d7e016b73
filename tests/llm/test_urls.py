"""URL parts, rules, and the filter cascade against plain membership."""

import pytest
from pyspark.sql import functions as F

from galewatch.llm import url_filter
from galewatch.llm.queries import RULES

URLS = {
    "http://WWW.Example.com/en/x?q=/#f": ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
    "https://a.example.com/en/": ("a.example.com", "/en/", "example.com/en/", "block"),
    "https://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
    "x://b.net/es/1": ("b.net", "/es/1", "net/es/", "block"),
    "x://net/fr/": ("net", "/fr/", "net/fr/", "block"),
    "x://b.net/es": ("b.net", "/es", None, None),
    "http://host.com": ("host.com", "", None, None),
    "http://host.com?x=/": ("host.com", "", None, None),
    "http://É.com/": ("É.com", "/", "com/", "allow"),
    "a://b://c/d": ("b:", "//c/d", None, None),
    "line\n://h.com/x": ("h.com", "/x", "com/", "allow"),
    "no scheme.com/en/": ("", "", None, None),
    "": ("", "", None, None),
    None: ("", "", None, None),
    "http:///p": ("", "/p", None, None),
}


def test_parts_and_rules(spark):
    host, path = url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url"))
    rule = url_filter.fitting(RULES, F.col("host"), F.col("path"))
    frame = spark.createDataFrame([(u,) for u in URLS], "url string").select("url", host.alias("host"), path.alias("path"))
    got = {r.url: (r.host, r.path, r.rule, r.verdict) for r in frame.select("*", rule.rule.alias("rule"), rule.verdict.alias("verdict")).collect()}
    assert got == URLS


@pytest.mark.parametrize(
    ("listed", "others", "most_bits"),
    [(500, 5_000, url_filter.MOST_BITS), (3_000, 40, 4_000), (1, 0, url_filter.MOST_BITS), (0, 50, 4_000), (7, 20_000, 4_000)],
)
def test_cascade_is_exact(spark, listed, others, most_bits):
    keys = spark.range(listed + others).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") < listed).alias("listed"))
    repeated = keys.unionByName(keys).selectExpr("key", "listed", "'clash' as share", "1 as bits_0")
    extra = spark.createDataFrame([(None,), ("k0",)] if listed else [(None,)], "key string")
    cascade = url_filter.cascade(keys.where("listed").select("key").unionByName(extra), repeated, most_bits)
    assert cascade.shares == 1 or most_bits == 4_000
    frame, is_listed = cascade.holds(repeated, F.col("key"))
    assert frame.select(F.sum((is_listed != F.col("listed")).cast("int"))).first()[0] in (0, None)
    assert frame.select(is_listed.alias("x"), "listed").count() == 2 * (listed + others)


def test_one_cascade_meets_no_join(spark):
    keys = spark.range(1000).select(F.concat(F.lit("k"), "id").alias("key"))
    frame, is_listed = url_filter.cascade(keys.where("key like '%7'"), keys).holds(keys, F.col("key"))
    plan = frame.where(is_listed)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_nothing_at_all(spark):
    none = spark.createDataFrame([], "key string")
    frame, is_listed = url_filter.cascade(none, none).holds(none, F.col("key"))
    assert frame.where(is_listed).collect() == []
