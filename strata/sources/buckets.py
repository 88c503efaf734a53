"""Bucketed tables: rows of a key lie in one bucket, sorted, so that aggregates and joins on the key need no shuffle.

A bucket is read by one task. A key that holds a large share of the rows would make one bucket, and the task that reads
it, as large; such a table is measured first and registered without buckets, where the shuffle can split it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.sources import catalog, sinks


def heaviest_share(df: DataFrame, key: str) -> float:
    """The largest share of the rows that one value of ``key`` holds (null is a value; no row: 0)."""
    per = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))  # combined before the shuffle: a hot key is a row a task
    row = per.agg(F.max("n"), F.sum("n")).first()
    return row[0] / row[1] if row[1] else 0.0


def write_bucketed(df: DataFrame, database: str, table: str, location: str, key: str, buckets: int,
                   max_share: float | None = None) -> bool:
    """Write ``df`` to ``location`` and register it as ``database.table``, bucketed and sorted by ``key`` with one file
    a bucket. False, and without buckets, if one key holds more than ``max_share`` of the rows (four buckets' worth by
    default). ``df`` is written once before it is measured."""
    spark = df.sparkSession
    plain = f"{location.rstrip('/')}/_plain"
    sinks.write_overwrite(df, plain)
    written = spark.read.schema(df.schema).parquet(plain)
    fits = heaviest_share(written, key) <= (4 / buckets if max_share is None else max_share)
    catalog.create_database(spark, database)
    spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{table}`")
    at = f"{location.rstrip('/')}/data"
    if fits:
        (written.repartition(buckets, key).write.format("parquet").mode("overwrite").option("path", at)
         .bucketBy(buckets, key).sortBy(key).saveAsTable(f"`{database}`.`{table}`"))
    else:
        sinks.write_overwrite(written, at)
        catalog.register_table(spark, database, table, at, df.schema)
    return fits
