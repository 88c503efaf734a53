"""Bucketed tables: no shuffle on the key, and no bucket for a key that is everywhere."""

import re

from pyspark.sql import functions as F
from sf_paths import SF_SMALL

from strata.plans import lake
from strata.sources import buckets


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def without_broadcast(spark):
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    return keep


def test_master_over_bucketed_tables_has_no_exchange(spark):
    keep = without_broadcast(spark)
    try:
        plan = plan_of(lake.bucketed_master(spark, SF_SMALL))
        assert "Exchange" not in plan
        assert len(re.findall("SortMergeJoin", plan)) >= 16 and "Bucketed: true" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)


def test_a_key_that_is_everywhere_is_not_bucketed(spark, tmp_path):
    hot = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    assert not buckets.write_bucketed(hot, "bucket_test", "hot", str(tmp_path / "hot"), "k", 16)
    even = spark.range(1000).select((F.col("id") % 100).alias("k"), "id")
    assert buckets.write_bucketed(even, "bucket_test", "even", str(tmp_path / "even"), "k", 16)
    for name, df in (("hot", hot), ("even", even)):
        assert sorted(map(tuple, spark.table(f"bucket_test.{name}").collect())) == sorted(map(tuple, df.collect()))
    assert "Exchange" not in plan_of(spark.table("bucket_test.even").groupBy("k").count())
    assert "Exchange" in plan_of(spark.table("bucket_test.hot").groupBy("k").count())
    empty = even.limit(0)
    assert buckets.write_bucketed(empty, "bucket_test", "none", str(tmp_path / "none"), "k", 4)
    assert spark.table("bucket_test.none").count() == 0 and buckets.heaviest_share(empty, "k") == 0.0
