"""Lake plans: scans, writes, catalogue registration, gates and the Silver job runner."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.clean import CleanSpec, clean
from strata.plans import analysis, gold, silver
from strata.session import scratch_path, table_path
from strata.sources import catalog, gates, scan, sinks


@dataclass(frozen=True)
class LakePaths:
    """Base URI per layer; a table is one directory under its layer."""

    root: str

    def layer(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def table(self, layer: str, name: str) -> str:
        return f"{self.layer(layer)}/{name}"


def _absent(e: Exception) -> bool:
    return isinstance(e, FileNotFoundError) or "PATH_NOT_FOUND" in str(e)


def _clean_table(spark, name, specs, read_source, paths, force, as_of, database) -> tuple:
    """The status row of one table (see ``run_clean``)."""
    if name not in specs:
        return name, "unknown", None, "no such table"
    out = paths.table(database, name)
    if not force and sinks.table_exists(spark, out):
        return name, "skipped", None, None
    spec, sources, notes = specs[name], [], []
    for s in spec.sources:
        try:
            sources.append(read_source(s))
        except (AnalysisException, FileNotFoundError) as e:
            if not (spec.allow_missing and _absent(e)):
                raise
            notes.append(f"{s}: {e}")
    if not sources:
        raise ValueError("no source can be read: " + "; ".join(notes))
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=spec.allow_missing), sources)
    sinks.write_overwrite(clean(df, spec, as_of), out)
    try:
        registered = catalog.register_table(spark, database, name, out)
    except Exception as e:  # the data is written
        registered = False
        notes.append(f"registration: {e}")
    return name, "written", registered, "; ".join(notes) or None


def run_clean(
    spark: SparkSession,
    specs: Mapping[str, CleanSpec],
    read_source: Callable[[str], DataFrame],
    paths: LakePaths,
    only: Sequence[str] | None = None,
    force: bool = False,
    as_of=None,
    database: str = "silver",
    parallelism: int = 4,
) -> DataFrame:
    """Clean, write and register each selected entity, ``parallelism`` of them at a time; returns one status row per
    table, in the order of the names.

    An unknown name gets the status ``unknown``; a table already written (non-empty) is skipped unless
    ``force``; where the spec allows missing sources an absent one is left out and named in ``error`` (with
    none left the table fails), while a source that is there but cannot be read, or one absent from any
    other spec, fails the table; a failure of one table is recorded and the others still run;
    catalogue registration failure is not fatal (the data is written), its reason is kept.
    """
    names = list(only) if only else list(specs)

    @inheritable_thread_target(spark)
    def run(name: str) -> tuple:
        # a pool of its own: with the fair scheduler a small table does not wait behind a large one
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"clean-{name}")
        try:
            return _clean_table(spark, name, specs, read_source, paths, force, as_of, database)
        except Exception as e:  # isolate per-table failures
            return name, "failed", None, str(e)
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPool(max(1, parallelism)) as pool:
        rows = pool.map(run, names, chunksize=1)
    return spark.createDataFrame(rows, "table string, status string, registered boolean, error string")


# ------------------------------------------------------------------ registered queries
def list_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.list_tables(spark, sf_dir).select("table", "layout", "n_files")


def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.scan_parquet(spark, scan.detect_layout(spark, table_path(sf_dir, "orders")))


def scan_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.scan_multi(spark, [table_path(sf_dir, "customer"), table_path(sf_dir, "supplier")])


def scan_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.scan_tolerant(spark, [table_path(sf_dir, "customer"), table_path(sf_dir, "no_such_table"),
                                      table_path(sf_dir, "supplier")])


def write_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "silver-accounts")
    sinks.write_overwrite(silver.clean_full(spark, sf_dir), out, max_records_per_file=4000)
    return spark.read.parquet(out)


def write_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "gold-master")
    sinks.write_overwrite(gold.master_table(spark, sf_dir), out)
    return spark.read.parquet(out)


def register_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "silver-accounts")
    sinks.write_overwrite(silver.clean_full(spark, sf_dir), out)
    catalog.register_table(spark, "silver", "accounts", out)
    return catalog.table(spark, "silver", "accounts")


GATED = {"customer": ["c_custkey"], "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"],
         "part": ["p_partkey"]}


def gate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = [gates.gate_stats(scan.scan_parquet(spark, table_path(sf_dir, t)), t, keys) for t, keys in GATED.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.drop("n_files")


def gate_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gates on locations: rows and files against thresholds, an absent location included."""
    wanted = {"orders": gates.Gate(), "customer": gates.Gate(min_files=2), "no_such_table": gates.Gate()}
    return reduce(DataFrame.unionByName,
                  [gates.gate_path(spark, table_path(sf_dir, t), t, g) for t, g in wanted.items()])


def score_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored base written best-first with its key, read back."""
    from strata.plans import evaluation

    out = scratch_path(spark, "scores")
    sinks.write_sorted(evaluation.score_table(spark, sf_dir), out, [F.col("score_ensemble").desc(), F.col("key")])
    return spark.read.parquet(out)


def preprocessed_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "gold-preprocessed")
    sinks.write_overwrite(analysis.encode_features(spark, sf_dir), out)
    return spark.read.parquet(out)


def register_bronze(spark: SparkSession, base: str, database: str = "bronze") -> DataFrame:
    """Catalogue every table directory under ``base``: detect its layout, take the schema from the
    Parquet footers, (re)create the external table. One status row per table
    (``registered`` / ``skipped`` when no data file / ``error``); one table's failure does not stop
    the others."""
    catalog.create_database(spark, database)
    rows = []
    for t in scan.list_tables(spark, base).select("table", "layout", "location").collect():  # one row per table
        if t["layout"] == "file":
            rows.append((t["table"], t["layout"], t["location"], "skipped"))
            continue
        loc = scan.detect_layout(spark, f"{base.rstrip('/')}/{t['table']}")
        try:
            schema = scan.scan_parquet(spark, loc).schema
            catalog.register_table(spark, database, t["table"], loc, schema)
            rows.append((t["table"], t["layout"], loc, "registered"))
        except Exception as e:  # noqa: BLE001 - recorded per table
            rows.append((t["table"], t["layout"], loc, "error: " + str(e)))
    return spark.createDataFrame(rows, "table string, layout string, location string, status string")


def detect_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables landed in the two layouts (flat directory; ``data/`` sub-directory next to a
    ``metadata/`` directory); both are catalogued and read back through the catalogue."""
    root = scratch_path(spark, "bronze")
    spark.read.parquet(table_path(sf_dir, "orders")).write.parquet(f"{root}/accounts")
    spark.read.parquet(table_path(sf_dir, "customer")).write.parquet(f"{root}/parties/data")
    spark.createDataFrame([("snapshot-1",)], "v string").write.text(f"{root}/parties/metadata")
    status = register_bronze(spark, root, "bronze")
    frames = []
    for t in status.filter(F.col("status") == "registered").collect():
        frames.append(catalog.table(spark, "bronze", t["table"]).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(t["table"]).alias("table"), F.lit(t["layout"]).alias("layout"), "n_rows"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# ------------------------------------------------------------------ end-to-end: Bronze -> Silver -> Gold
def lakehouse_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole layered flow on the fixture: the sources of 17 entities are written as Bronze tables,
    read, cleaned, written and registered as Silver tables by the job runner, the master table is built
    from the written Silver tables, written to Gold and read back."""
    from strata.operators.master import build_master
    from strata.plans import entities
    from strata.plans import fixtures as fx

    paths = LakePaths(scratch_path(spark, "lake"))
    specs = entities.SPECS
    reader = entities.land(spark, sf_dir, paths, list(specs), defects=False)
    status = run_clean(spark, specs, reader, paths, as_of=fx.AS_OF)
    failed = status.filter(F.col("status") == "failed").collect()  # 17 status rows at most
    if failed:
        raise RuntimeError(f"silver tables failed: {[(r.table, r.error) for r in failed]}")
    silver_tables = {n: spark.read.parquet(paths.table("silver", n)).drop("_silver_ts") for n in specs}
    # layer gates: every Silver table has rows and no null key; the base is unique per key
    # before the left joins (a duplicate would silently multiply master rows)
    checks = [gates.gate_stats(df, n, ["RADICAL"], gates.Gate(max_duplicate_keys=2**62))
              for n, df in silver_tables.items() if n != "perimetre"]
    checks.append(gates.gate_stats(silver_tables["perimetre"], "perimetre", ["RADICAL"], gates.Gate()))
    gates.check(reduce(DataFrame.unionByName, checks))
    master = gold.rounded(build_master(gold.dealt(silver_tables), fx.AS_OF))
    gold_path = paths.table("gold", "master_table")
    sinks.write_overwrite(master, gold_path)
    written = spark.read.parquet(gold_path)
    gates.check(gates.gate_stats(written, "master_table", ["RADICAL"], gates.Gate()))
    return written


ROWS_A_BUCKET = 400_000


def bucket_number(lengths: list[int], least: int, rows: int = ROWS_A_BUCKET) -> int:
    """Buckets for tables of these lengths: ``least``, or more so that one of the longest table holds about ``rows``."""
    return max(least, -(-max(lengths) // rows))


def bucketed_silver(spark: SparkSession, sf_dir: str, database: str, buckets: int = 16) -> dict[str, DataFrame]:
    """Silver tables of the fixture, bucketed and sorted by the customer key and read through the catalogue. All have
    the same number of buckets (``buckets`` at least, see ``bucket_number``): one task reads a bucket of every table."""
    from strata.plans import entities
    from strata.plans import fixtures as fx
    from strata.sources import buckets as bk

    paths = LakePaths(scratch_path(spark, "lake-buckets"))
    specs = entities.SPECS
    reader = entities.land(spark, sf_dir, paths, list(specs), defects=False)
    status = run_clean(spark, specs, reader, paths, as_of=fx.AS_OF, database=f"{database}_plain")
    failed = status.filter(F.col("status") == "failed").collect()  # 17 status rows at most
    if failed:
        raise RuntimeError(f"silver tables failed: {[(r.table, r.error) for r in failed]}")

    # lengths come from the footers
    buckets = bucket_number([spark.read.parquet(paths.table(f"{database}_plain", n)).count() for n in specs], buckets)

    @inheritable_thread_target(spark)
    def bucket(name: str) -> None:
        own = spark.read.parquet(paths.table(f"{database}_plain", name)).drop("_silver_ts")
        bk.write_bucketed(own, database, name, paths.table(database, name), "RADICAL", buckets)

    with ThreadPool(4) as pool:
        pool.map(bucket, list(specs), chunksize=1)
    return {n: spark.table(f"`{database}`.`{n}`") for n in specs}


def bucketed_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The master table over bucketed Silver tables: 16 aggregates and 16 joins without a shuffle."""
    from strata.operators.master import build_master
    from strata.plans import fixtures as fx

    return gold.rounded(build_master(bucketed_silver(spark, sf_dir, "silver_buckets"), fx.AS_OF))


def report_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report table written as one CSV file with header, read back with its schema."""
    from strata.operators import evaluate as ev
    from strata.plans import evaluation

    report = ev.lift_table(evaluation.scored(spark, sf_dir), model="model_a")
    out = scratch_path(spark, "reports/lift_table")
    sinks.write_report_csv(report, out)
    return spark.read.schema(report.schema).option("header", True).csv(out)
