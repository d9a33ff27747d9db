"""Keyed tables: bucket pruning, joins without a shuffle, the same rows."""

import re

from plume.sources.keyed import buckets_for, of_key, write_keyed
from pyspark.sql import functions as F
from table_rows import rows


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_bucket_is_read_and_joins_do_not_shuffle(spark):
    left = spark.range(5000).select((F.col("id") % 700).cast("string").alias("k"), F.col("id").alias("v"))
    right = spark.range(700).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).alias("w"))
    a, b = write_keyed(left, "keyed_a", "k", 16), write_keyed(right, "keyed_b", "k", 16)
    one = of_key(spark, "keyed_a", "k", "33")
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # the plan then shows the buckets
    try:
        shown = of_key(spark, "keyed_a", "k", "33")._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 1 out of 16" in shown
    assert re.search(r"PushedFilters: \[.*EqualTo\(k,33\)", _plan(one))
    assert rows(one) == [("33", 33 + 700 * i) for i in range(8) if 33 + 700 * i < 5000]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined, plain = a.join(b, "k"), left.join(right, "k")
        assert "Exchange" not in _plan(joined) and "Exchange" in _plan(plain)
        assert rows(joined) == rows(plain)
        assert "Exchange" not in _plan(a.groupBy("k").count())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_null_keys_empty_tables_and_replacing(spark):
    df = spark.createDataFrame([(None, 1), ("x", 2), (None, 3)], "k string, v int")
    assert write_keyed(df, "keyed_c", "k", 4).count() == 3 and of_key(spark, "keyed_c", "k", "x").count() == 1
    assert write_keyed(df.limit(0), "keyed_c", "k", 4).count() == 0
    assert buckets_for(0) == 8 and buckets_for(16_000_001) == 16 and buckets_for(10**9) == 512


def test_registered_query_does_not_shuffle_for_its_join(spark):
    import __spark_entry__ as E
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = E.queries()["edges_with_author_kpis"](spark, "/root/testdata/sf0.001")
        assert "Exchange" not in _plan(df) and df.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
