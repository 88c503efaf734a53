import pytest
from pyspark.sql.types import (BinaryType, BooleanType, ByteType, DateType, DecimalType, DoubleType, FloatType,
                               IntegerType, LongType, MapType, ShortType, StringType, StructField, StructType,
                               TimestampType)

from strata.sources import catalog, gates


@pytest.mark.parametrize("t,name", [
    (IntegerType(), "INT"), (ShortType(), "INT"), (ByteType(), "INT"), (LongType(), "BIGINT"),
    (DoubleType(), "DOUBLE"), (FloatType(), "FLOAT"), (BooleanType(), "BOOLEAN"), (DateType(), "DATE"),
    (TimestampType(), "TIMESTAMP"), (DecimalType(18, 4), "DECIMAL(18,4)"), (DecimalType(10, 0), "DECIMAL(10,0)"),
    (BinaryType(), "BINARY"), (StringType(), "STRING"), (MapType(StringType(), StringType()), "STRING"),
])
def test_hive_type(t, name):
    assert catalog.hive_type(t) == name


def test_column_ddl():
    schema = StructType([StructField("ID", LongType()), StructField("LABEL", StringType()),
                         StructField("AMOUNT", DecimalType(15, 2)), StructField("DATE_CHARG", DateType()),
                         StructField("my col", StringType())])
    assert catalog.column_ddl(schema, hive=True, sep=", ") == (
        "`ID` BIGINT, `LABEL` STRING, `AMOUNT` DECIMAL(15,2), `DATE_CHARG` DATE, `my col` STRING")


def test_gate_thresholds(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    row = gates.gate_stats(df, "t", ["k"], gates.Gate(min_rows=4)).first()
    assert (row.n_rows, row.null_keys, row.duplicate_keys, row.passed) == (4, 1, 1, False)
    ok = spark.createDataFrame([(1,), (2,)], "k int")
    assert gates.gate_stats(ok, "t", ["k"], gates.Gate(min_rows=2)).first().passed
    assert not gates.gate_stats(ok, "t", ["k"], gates.Gate(min_rows=3)).first().passed
    with pytest.raises(gates.GateFailed):
        gates.check(gates.gate_stats(df, "t", ["k"]))


def test_gate_on_a_path(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(6).repartition(3).write.parquet(path)
    assert tuple(gates.gate_path(spark, path, "t").first()) == ("t", 6, 3, True)
    assert not gates.gate_path(spark, path, "t", gates.Gate(min_files=4)).first().passed
    assert not gates.gate_path(spark, path, "t", gates.Gate(min_rows=7)).first().passed
    gone = gates.gate_path(spark, str(tmp_path / "gone"), "gone")
    assert tuple(gone.first()) == ("gone", 0, 0, False)
    with pytest.raises(gates.GateFailed):
        gates.check(gone)


def test_register_and_read_back(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "id long, s string")
    path = str(tmp_path / "t")
    df.write.parquet(path)
    assert catalog.register_table(spark, "test_db", "t1", path)
    assert catalog.table(spark, "test_db", "t1").count() == 1
    assert catalog.register_table(spark, "test_db", "t2", str(tmp_path / "missing"), fatal=False) is False
