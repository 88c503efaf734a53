"""Raw-file ingestion as Structured Streaming: landing directory -> Bronze Parquet.

The file source tracks which files it has already taken in its checkpoint, so a
re-run (``trigger(availableNow=True)``) converts only new files: the
"watch and convert" flow of the original stack, without a separate watcher.
Each micro-batch is routed with ``foreachBatch``: parsed rows to the Bronze
table, unparsable lines to a quarantine table. Both are written to a directory
per batch id with overwrite, so a retried batch replaces its own output
(idempotent, exactly-once on the file sink side). Once both are complete the
batch is entered in each table's list of committed batches, which ``read_bronze``
follows: a batch that stopped between the two writes is not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.functions.casts import tolerant_cast
from strata.session import folders

CORRUPT = "_corrupt_record"
BATCH = "_batch"
COMMITTED = "_committed"


@dataclass(frozen=True)
class FixedField:
    name: str
    start: int  # 1-based
    width: int
    dtype: str = "string"
    nullable: bool = True  # a blank field is null; False: a blank field makes the line invalid


def _route(valid_dir: str, invalid_dir: str, valid_pred, invalid_cols: Sequence[str], data_cols: Sequence[str]):
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            good = batch.filter(valid_pred).select(*data_cols)
            bad = batch.filter(~valid_pred).select(*invalid_cols)
            good.write.mode("overwrite").parquet(f"{valid_dir}/{BATCH}={batch_id}")
            bad.write.mode("overwrite").parquet(f"{invalid_dir}/{BATCH}={batch_id}")
        finally:
            batch.unpersist()
        # the quarantine first: a batch whose rows can be read has its bad lines there too
        for folder in (invalid_dir, valid_dir):
            commit_batch(batch.sparkSession, folder, batch_id)

    return write


def commit_batch(spark: SparkSession, table: str, batch_id: int) -> None:
    """Enter a batch in the table's list (a folder a batch, so that a repeated entry replaces itself)."""
    spark.range(batch_id, batch_id + 1).toDF(BATCH).coalesce(1).write.mode("overwrite").parquet(f"{table}/{COMMITTED}/id={batch_id}")


def committed_ranges(spark: SparkSession, table: str) -> list[tuple[int, int]]:
    """Ranges (first, last) of committed batches. Ids follow each other, so there is one range, and one more for
    each batch that was given up."""
    if not folders(spark, f"{table}/{COMMITTED}"):
        return []
    ids = spark.read.schema(f"{BATCH} long").parquet(f"{table}/{COMMITTED}").select(BATCH)
    # a row a batch: the window over them is bounded by the batches of one table
    numbered = ids.withColumn("_gap", F.col(BATCH) - F.row_number().over(Window.orderBy(BATCH)))
    rows = numbered.groupBy("_gap").agg(F.min(BATCH), F.max(BATCH)).collect()
    return sorted((r[1], r[2]) for r in rows)


def ingest_csv(spark: SparkSession, landing: str, schema: StructType, valid_dir: str, invalid_dir: str,
               checkpoint: str, header: bool = False, timestamp_ntz_format: str | None = None,
               max_files_per_trigger: int | None = None) -> None:
    """Convert every CSV file not yet seen under ``landing``; malformed lines go to ``invalid_dir``."""
    full = StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])
    reader = (
        spark.readStream.schema(full)
        .option("header", str(header).lower())
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    if timestamp_ntz_format:
        reader = reader.option("timestampNTZFormat", timestamp_ntz_format)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.csv(landing)
    data_cols = [f.name for f in schema.fields]
    route = _route(valid_dir, invalid_dir, F.col(CORRUPT).isNull(), [F.col(CORRUPT).alias("raw")], data_cols)
    q = stream.writeStream.foreachBatch(route).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def parse_fixed_width(lines: DataFrame, fields: Sequence[FixedField], line_col: str = "value") -> DataFrame:
    """Cut each line into fields, trim, tolerant-cast; adds ``_valid``: the length is right, every field that is
    not blank parsed, and no field that must hold a value is blank."""
    line = F.col(line_col)
    width = max(f.start + f.width - 1 for f in fields)
    parsed = [tolerant_cast(F.trim(F.substring(line, f.start, f.width)), f.dtype).alias(f.name) for f in fields]
    out = lines.select(line.alias("raw"), *parsed)
    ok = F.length("raw") == width
    for f in fields:
        blank = F.trim(F.substring(F.col("raw"), f.start, f.width)) == ""
        ok = ok & (F.col(f.name).isNotNull() | (blank if f.nullable else F.lit(False)))
    return out.withColumn("_valid", ok)


def ingest_fixed_width(spark: SparkSession, landing: str, fields: Sequence[FixedField], valid_dir: str,
                       invalid_dir: str, checkpoint: str) -> None:
    stream = parse_fixed_width(spark.readStream.text(landing), fields)
    route = _route(valid_dir, invalid_dir, F.col("_valid"), ["raw"], [f.name for f in fields])
    q = stream.writeStream.foreachBatch(route).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """The committed batches of the converted table, without the batch-id column. Others are pruned as partitions."""
    own = [F.col(BATCH).between(lo, hi) for lo, hi in committed_ranges(spark, path)]
    return spark.read.parquet(path).where(reduce(lambda a, b: a | b, own, F.lit(False))).drop(BATCH)
