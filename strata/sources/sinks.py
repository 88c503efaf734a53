"""Writers for the lake layers and reports.

File sizes are bounded by ``maxRecordsPerFile`` instead of forcing a fixed
partition count (``coalesce(4)`` / ``repartition(8)`` would funnel a whole
layer through 4 or 8 tasks at scale).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.sources.scan import list_files

DEFAULT_MAX_RECORDS = 5_000_000


def write_overwrite(df: DataFrame, path: str, max_records_per_file: int = DEFAULT_MAX_RECORDS,
                    partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite").option("compression", "snappy").option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_sorted(df: DataFrame, path: str, order: list, max_records_per_file: int = DEFAULT_MAX_RECORDS) -> None:
    """Globally ordered output (range-partitioned sort), e.g. scores best first."""
    write_overwrite(df.orderBy(*order), path, max_records_per_file)


def write_report_csv(df: DataFrame, path: str) -> None:
    """Small report tables: one CSV file with a header (reports are bounded, e.g. ten deciles)."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def table_exists(spark, path: str) -> bool:
    """True only when the location exists and holds at least one data file."""
    try:
        return list_files(spark, path).limit(1).count() > 0
    except Exception as e:  # a missing path is "absent"; anything else is a real error
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return False
        raise


def count_written(spark, path: str) -> DataFrame:
    """Row count of a written table, from the files (no recompute of the producing plan)."""
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"))
