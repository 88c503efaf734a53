"""Rows of a class are not brought together to meet their class's count."""

import pytest
from pyspark.sql import functions as F

from strata.operators import prep
from strata.operators.rank import class_positions


@pytest.fixture
def long_tables(spark):
    """Joins as Spark plans them for tables that it takes for long."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark.range(0, 4000, 1, 8).select(F.col("id").alias("k"), F.when(F.col("id") % 10 > 0, (F.col("id") % 10 == 1).cast("int")).alias("y"))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _largest(df):
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def test_weights_leave_rows_where_they_are(long_tables):
    out = prep.class_weight(long_tables, "y")
    assert _largest(out) == 500
    assert {tuple(r) for r in out.select("y", "weight").distinct().collect()} == {(None, 1.0), (0, 1.0), (1, 9.0)}
    balanced = prep.class_weight(long_tables, "y", "balanced").groupBy("y").agg(F.sum("weight").alias("w")).collect()
    assert len(balanced) == 3 and all(r["w"] == pytest.approx(4000 / 3) for r in balanced)


def test_positions_leave_rows_where_they_are(long_tables):
    out = class_positions(long_tables, "y", ["k"], 8)
    assert _largest(out) < 1000  # the largest class has 3,200 rows
    got = {(r["y"], r["n_class"], r["n"], r["top"]) for r in out.groupBy("y", "n_class").agg(
        F.countDistinct("pos_in_class").alias("n"), F.max("pos_in_class").alias("top")).collect()}
    assert got == {(None, 400, 400, 399), (0, 3200, 3200, 3199), (1, 400, 400, 399)}
