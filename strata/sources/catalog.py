"""Catalogue registration: databases and external Parquet tables in Spark's catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType, DecimalType, StructType, TimestampNTZType

#: The names of Spark's types in Hive's DDL. Types that are not here are declared STRING.
HIVE_TYPES = {"byte": "INT", "short": "INT", "integer": "INT", "long": "BIGINT", "float": "FLOAT", "double": "DOUBLE",
              "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP", "binary": "BINARY"}


def hive_type(dtype: DataType) -> str:
    """Name in Hive's DDL; a decimal keeps its precision and scale."""
    return dtype.simpleString().upper() if isinstance(dtype, DecimalType) else HIVE_TYPES.get(dtype.typeName(), "STRING")


def ddl_type(dtype: DataType) -> str:
    """Spark DDL name that keeps nested and timestamp_ntz types (used for our own tables)."""
    if isinstance(dtype, TimestampNTZType):
        return "TIMESTAMP_NTZ"
    return dtype.simpleString().upper() if not isinstance(dtype, StructType) else dtype.simpleString()


def column_ddl(schema: StructType, hive: bool = False, sep: str = ",\n    ") -> str:
    """Back-quoted ``name TYPE`` list in schema order."""
    conv = hive_type if hive else ddl_type
    return sep.join(f"`{f.name}` {conv(f.dataType)}" for f in schema.fields)


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{loc}")


def register_table(spark: SparkSession, database: str, table: str, location: str, schema: StructType | None = None,
                   fatal: bool = True) -> bool:
    """Drop and re-create ``database.table`` over Parquet files at ``location`` (schema follows the data).

    With ``fatal=False`` a failure is reported by returning False (the data is already written).
    """
    try:
        create_database(spark, database)
        if schema is None:
            schema = spark.read.parquet(location).schema
        name = f"`{database}`.`{table}`"
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} ({column_ddl(schema)}) USING parquet LOCATION '{location}'")
        spark.sql(f"REFRESH TABLE {name}")
        return True
    except Exception:
        if fatal:
            raise
        return False


def table(spark: SparkSession, database: str, name: str) -> DataFrame:
    return spark.table(f"`{database}`.`{name}`")
