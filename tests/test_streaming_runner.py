from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from strata.operators.clean import CleanSpec
from strata.plans.lake import LakePaths, run_clean
from strata.streaming.ingest import ingest_csv, read_bronze

SCHEMA = StructType([StructField("id", LongType()), StructField("name", StringType()), StructField("v", DoubleType())])


def test_ingest_takes_only_new_files_and_quarantines(spark, tmp_path):
    landing, valid, bad, ckpt = (str(tmp_path / x) for x in ("landing", "bronze", "bad", "ckpt"))
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "f1.csv").write_text("1,a,1.5\n2,b,x\n")
    ingest_csv(spark, landing, SCHEMA, valid, bad, ckpt)
    assert read_bronze(spark, valid).count() == 1
    assert [r.raw for r in read_bronze(spark, bad).collect()] == ["2,b,x"]
    (tmp_path / "landing" / "f2.csv").write_text("3,c,2.0\n")
    ingest_csv(spark, landing, SCHEMA, valid, bad, ckpt)
    assert sorted(r.id for r in read_bronze(spark, valid).collect()) == [1, 3]


def test_run_clean_skip_force_unknown(spark, tmp_path):
    src = spark.createDataFrame([("1", "5"), ("2", "-1")], "CONTRAT string, A string")
    specs = {"t": CleanSpec(sources=("s",), renames={"CONTRAT": "RADICAL"}, casts={"RADICAL": "long", "A": "double"},
                            non_negative=("A",))}
    paths = LakePaths(str(tmp_path / "lake"))
    first = run_clean(spark, specs, lambda name: src, paths).first()
    assert first.status == "written"
    assert spark.read.parquet(paths.table("silver", "t")).count() == 1
    assert run_clean(spark, specs, lambda name: src, paths).first().status == "skipped"
    assert run_clean(spark, specs, lambda name: src, paths, force=True).first().status == "written"
    # an unknown name is a status row, and the known tables still run
    assert [(r.table, r.status) for r in run_clean(spark, specs, lambda name: src, paths, only=["nope", "t"]).collect()] == [
        ("nope", "unknown"), ("t", "skipped")]
    broken = run_clean(spark, specs, lambda name: src.drop("A").selectExpr("CONTRAT", "nope"), paths, force=True)
    assert broken.first().status == "failed"


def test_run_clean_absent_sources(spark, tmp_path):
    src = spark.createDataFrame([("1", "5")], "RADICAL string, A string")
    casts = {"RADICAL": "long", "A": "double"}
    specs = {"open": CleanSpec(sources=("s", "gone"), allow_missing=True, casts=casts),
             "none": CleanSpec(sources=("gone",), allow_missing=True, casts=casts),
             "strict": CleanSpec(sources=("s", "gone"), casts=casts),
             "corrupt": CleanSpec(sources=("s", "bad"), allow_missing=True, casts=casts)}
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_text("no parquet")

    def read(name):
        return src if name == "s" else spark.read.parquet(str(tmp_path / name))

    rows = {r.table: r for r in run_clean(spark, specs, read, LakePaths(str(tmp_path / "lake"))).collect()}
    assert {n: r.status for n, r in rows.items()} == {
        "open": "written", "none": "failed", "strict": "failed", "corrupt": "failed"}
    assert rows["open"].error.startswith("gone: ")


def test_every_entity_has_a_spec_and_its_known_rules():
    from strata.plans import entities, fixtures

    specs = entities.SPECS
    assert set(specs) == set(fixtures.ENTITIES)
    assert len(specs["comptes"].sources) >= 2 and {"RADICAL", "CCLE"} <= set(specs["comptes"].not_null)
    assert specs["perimetre"].date_floor == "1900-01-01" and specs["perimetre"].normalize_gender
    assert specs["gab"].allow_missing and specs["tpe"].allow_missing
    assert specs["soldes"].non_negative == ("SOLDEVERIF",) and specs["depot"].non_negative == ("MONTANT_DEPOT",)
    assert specs["retrait"].dedup == ("RADICAL", "NUM_CARTE", "DATE_OP", "MONTANT")
    assert specs["virement"].renames == specs["vignette"].renames == {"CONTRAT": "RADICAL"}
    assert "NUMERO_CARTE" in specs["carte"].not_null
    assert len(specs["digital"].sources) == len(specs["perimetre"].sources) == 1


def test_a_batch_that_stopped_between_its_writes_is_not_read(spark, tmp_path, monkeypatch):
    import pytest
    from pyspark.sql.readwriter import DataFrameWriter

    landing, valid, bad, ckpt = (str(tmp_path / x) for x in ("landing", "bronze", "bad", "ckpt"))
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "f1.csv").write_text("1,a,1.5\n2,b,x\n")
    ingest_csv(spark, landing, SCHEMA, valid, bad, ckpt)
    (tmp_path / "landing" / "f2.csv").write_text("3,c,2.0\n4,d,y\n")
    parquet = DataFrameWriter.parquet

    def stops(self, path, *args, **kw):
        if path.startswith(bad):
            raise OSError("the quarantine cannot be written")
        parquet(self, path, *args, **kw)

    monkeypatch.setattr(DataFrameWriter, "parquet", stops)
    with pytest.raises(Exception, match="quarantine"):
        ingest_csv(spark, landing, SCHEMA, valid, bad, ckpt)
    assert (tmp_path / "bronze" / "_batch=1").exists()  # the first of the two writes was done
    assert [r.id for r in read_bronze(spark, valid).collect()] == [1]
    monkeypatch.undo()
    ingest_csv(spark, landing, SCHEMA, valid, bad, ckpt)  # the batch is run again as a whole
    assert sorted(r.id for r in read_bronze(spark, valid).collect()) == [1, 3]
    assert sorted(r.raw for r in read_bronze(spark, bad).collect()) == ["2,b,x", "4,d,y"]


def test_tables_side_by_side_give_the_same_status_rows(spark, tmp_path):
    src = spark.createDataFrame([("1", "5"), ("2", "-1")], "RADICAL string, A string")
    specs = {f"t{i}": CleanSpec(sources=("s",) if i % 3 else ("gone",), casts={"RADICAL": "long", "A": "double"}) for i in range(7)}

    def read(name):
        if name == "gone":
            raise OSError("cannot be read")
        return src

    def rows(parallelism):
        paths = LakePaths(str(tmp_path / f"lake{parallelism}"))
        out = run_clean(spark, specs, read, paths, database=f"side{parallelism}", parallelism=parallelism).collect()
        assert all(spark.read.parquet(paths.table(f"side{parallelism}", r.table)).count() == 2 for r in out if r.status == "written")
        return [tuple(r) for r in out]

    assert rows(1) == rows(4)
    assert [r[1] for r in rows(4)] == ["failed", "skipped", "skipped", "failed", "skipped", "skipped", "failed"]


def test_scratch_folder_of_a_cluster_must_be_shared():
    import pytest

    from strata.session import unshared

    for folder in ("file:/home/x/_strata_scratch", "/home/x/_strata_scratch"):
        unshared("local[8]", folder)
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            unshared("spark://host:7077", folder)
    unshared("yarn", "hdfs://lake/warehouse/_strata_scratch")
