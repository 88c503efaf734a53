"""Table discovery and Parquet scans.

Listings run as Spark jobs over file metadata (``binaryFile`` without the
content column reads no file bodies), so a directory with millions of files is
listed by the cluster, not by a driver loop.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

DATA_GLOB = "*.parquet"
DATA_SUBDIR = "data"


def list_files(spark: SparkSession, base: str, glob: str = DATA_GLOB, recursive: bool = True) -> DataFrame:
    """``path, length, modificationTime`` of every matching file under ``base``."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(base)
        .select("path", "length", "modificationTime")
    )


def list_tables(spark: SparkSession, base: str, glob: str = DATA_GLOB) -> DataFrame:
    """One row per table under ``base``: a table is a top-level directory or a top-level data file.

    Columns: ``table``, ``layout`` (``data/`` sub-directory, flat directory, or single file),
    ``location``, ``n_files``, ``total_bytes``. Files under a ``metadata`` directory are not data.
    """
    root = base.rstrip("/")
    files = list_files(spark, root, glob)
    local = root.split(":", 1)[-1] if "://" not in root else "/" + root.split("://", 1)[1].split("/", 1)[1]
    # path relative to the base: everything after "<base>/"
    rel = F.expr(f"substring(path, instr(path, '{local}/') + {len(local) + 1})")
    parts = F.split(rel, "/")
    top = parts.getItem(0)
    depth = F.size(parts)
    layout = (
        F.when(depth == 1, F.lit("file"))
        .when((depth >= 3) & (parts.getItem(1) == DATA_SUBDIR), F.lit("data_subdir"))
        .otherwise(F.lit("flat"))
    )
    table = F.regexp_replace(top, r"\.parquet$", "")
    return (
        files.filter(~F.array_contains(parts, "metadata"))
        .select(table.alias("table"), layout.alias("layout"), F.col("length"))
        .groupBy("table", "layout")
        .agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("total_bytes"))
        .withColumn("location", F.when(F.col("layout") == "data_subdir",
                                       F.concat(F.lit(root + "/"), F.col("table"), F.lit("/" + DATA_SUBDIR)))
                    .when(F.col("layout") == "file", F.concat(F.lit(root + "/"), F.col("table"), F.lit(".parquet")))
                    .otherwise(F.concat(F.lit(root + "/"), F.col("table"))))
    )


def detect_layout(spark: SparkSession, table_dir: str) -> str:
    """``data/`` sub-directory if it holds Parquet files, else the directory itself."""
    sub = f"{table_dir.rstrip('/')}/{DATA_SUBDIR}"
    try:
        if list_files(spark, sub, recursive=False).limit(1).count() > 0:
            return sub
    except AnalysisException:
        pass
    return table_dir.rstrip("/")


def scan_parquet(spark: SparkSession, location: str, schema: StructType | None = None) -> DataFrame:
    """Read the Parquet data files of one table (other files, e.g. metadata, are skipped)."""
    reader = spark.read.option("pathGlobFilter", DATA_GLOB)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(location)


def scan_multi(spark: SparkSession, locations: Sequence[str], merge_schema: bool = True) -> DataFrame:
    """One scan over several locations; ``mergeSchema`` unions their columns (missing -> null)."""
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(*locations)


def _path_missing(e: Exception) -> bool:
    msg = str(e)
    return "PATH_NOT_FOUND" in msg or "Path does not exist" in msg


def scan_tolerant(spark: SparkSession, locations: Sequence[str]) -> DataFrame:
    """Read each location, skip only the ones that do not exist, union by name (missing -> null).

    Any other error (corrupt file, bad schema) is raised. Raises if no location exists.
    """
    frames = []
    for loc in locations:
        try:
            frames.append(scan_parquet(spark, loc))
        except AnalysisException as e:
            if not _path_missing(e):
                raise
    if not frames:
        raise FileNotFoundError(f"none of the sources exists: {list(locations)}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
