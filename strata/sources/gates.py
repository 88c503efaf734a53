"""Layer quality gates as Spark jobs (instead of counting directory entries).

A gate computes, in one pass per table: rows, distinct input files, rows with a
null key and duplicate keys, and compares them to thresholds.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.scan import list_files
from strata.sources.sinks import table_exists


@dataclass(frozen=True)
class Gate:
    min_rows: int = 1
    min_files: int = 1
    max_null_keys: int = 0
    max_duplicate_keys: int = 0


class GateFailed(RuntimeError):
    pass


def gate_stats(df: DataFrame, name: str, keys: Sequence[str], gate: Gate = Gate()) -> DataFrame:
    """One status row: table, n_rows, n_files, null_keys, duplicate_keys, passed."""
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    stats = df.withColumn("_file", F.input_file_name()).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("_file").alias("n_files"),
        F.count_if(any_null).alias("null_keys"),
        F.countDistinct(*keys).alias("_distinct_keys"),
    )
    passed = (
        (F.col("n_rows") >= gate.min_rows)
        & (F.col("n_files") >= gate.min_files)
        & (F.col("null_keys") <= gate.max_null_keys)
        & (F.col("duplicate_keys") <= gate.max_duplicate_keys)
    )
    return (
        stats.withColumn("duplicate_keys", F.col("n_rows") - F.col("null_keys") - F.col("_distinct_keys"))
        .select(F.lit(name).alias("table"), "n_rows", "n_files", "null_keys", "duplicate_keys")
        .withColumn("passed", passed)
    )


def gate_path(spark: SparkSession, path: str, name: str, gate: Gate = Gate()) -> DataFrame:
    """One status row ``table, n_rows, n_files, passed`` for Parquet files at ``path``: files from the
    listing, rows from the footers. A path that does not exist is a failed gate with no files."""
    if not table_exists(spark, path):
        return spark.createDataFrame([(name, 0, 0, False)], "table string, n_rows long, n_files long, passed boolean")
    files = list_files(spark, path).count()
    rows = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.select(F.lit(name).alias("table"), "n_rows", F.lit(files).cast("long").alias("n_files"),
                       ((F.col("n_rows") >= gate.min_rows) & F.lit(files >= gate.min_files)).alias("passed"))


def check(status: DataFrame) -> DataFrame:
    """Raise ``GateFailed`` when any gate row failed; return the status otherwise."""
    failed = [r["table"] for r in status.filter(~F.col("passed")).select("table").collect()]
    if failed:
        raise GateFailed(f"quality gate failed for {failed}")
    return status
