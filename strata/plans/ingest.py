"""Ingestion plans: the events table is landed as raw files (CSV with bad lines, fixed width)
by Spark, then converted back to Parquet by the streaming ingestion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

from strata.plans import fixtures as fx
from strata.session import scratch_path
from strata.streaming.ingest import FixedField, ingest_csv, ingest_fixed_width, read_bronze

TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
EVENTS_SCHEMA = StructType([
    StructField("event_id", LongType()), StructField("ts", TimestampNTZType()), StructField("user_id", LongType()),
    StructField("event_type", StringType()), StructField("value", DoubleType()), StructField("props", StringType()),
])
BAD_EVERY = 97
FIXED_FIELDS = [FixedField("event_id", 1, 12, "long"), FixedField("event_type", 13, 10, "string"),
                FixedField("user_id", 23, 10, "long"), FixedField("value", 33, 24, "double")]


def land_events_csv(spark: SparkSession, sf_dir: str, landing: str) -> None:
    e = fx.read(spark, sf_dir, "events")
    e.select("event_id", F.date_format("ts", TS_FORMAT).alias("ts"), "user_id", "event_type", "value", "props") \
        .write.mode("overwrite").csv(landing)
    bad = e.filter(F.col("event_id") % BAD_EVERY == 0).select(
        F.concat(F.col("event_id").cast("string"), F.lit(",not-a-timestamp,x")).alias("value"))
    bad.write.mode("append").text(landing)


def _csv_run(spark, sf_dir):
    base = scratch_path(spark, "ingest-csv")
    landing, valid, invalid = f"{base}/landing", f"{base}/bronze", f"{base}/quarantine"
    land_events_csv(spark, sf_dir, landing)
    ingest_csv(spark, landing, EVENTS_SCHEMA, valid, invalid, f"{base}/_checkpoint", timestamp_ntz_format=TS_FORMAT)
    return valid, invalid


def ingest_csv_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = _csv_run(spark, sf_dir)
    return read_bronze(spark, valid)


def route_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, invalid = _csv_run(spark, sf_dir)
    return read_bronze(spark, invalid)


def land_events_fixed_width(spark: SparkSession, sf_dir: str, landing: str) -> None:
    e = fx.read(spark, sf_dir, "events")
    line = F.concat(
        F.lpad(F.col("event_id").cast("string"), 12, " "),
        F.rpad(F.col("event_type"), 10, " "),
        F.lpad(F.col("user_id").cast("string"), 10, " "),
        F.lpad(F.col("value").cast("string"), 24, " "),
    )
    e.select(line.alias("value")).write.mode("overwrite").text(landing)
    short = e.filter(F.col("event_id") % BAD_EVERY == 0).select(
        F.lpad(F.col("event_id").cast("string"), 12, " ").alias("value"))
    short.write.mode("append").text(landing)


def ingest_fixed_width_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "ingest-fixed")
    landing, valid, invalid = f"{base}/landing", f"{base}/bronze", f"{base}/quarantine"
    land_events_fixed_width(spark, sf_dir, landing)
    ingest_fixed_width(spark, landing, FIXED_FIELDS, valid, invalid, f"{base}/_checkpoint")
    return read_bronze(spark, valid)


ORACLE = {
    "ingest_csv": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "route_invalid": f"SELECT CAST(event_id AS VARCHAR) || ',not-a-timestamp,x' AS raw FROM events "
                     f"WHERE event_id % {BAD_EVERY} = 0",
    "ingest_fixed_width": "SELECT event_id, event_type, user_id, value FROM events",
}
QUERIES = {"ingest_csv": ingest_csv_events, "route_invalid": route_invalid,
           "ingest_fixed_width": ingest_fixed_width_events}
