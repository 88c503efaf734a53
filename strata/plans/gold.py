"""Gold plans over the fixture entities: feature groups and the master table."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import features as feat
from strata.operators.master import add_derived, build_master, fill_zero, join_features
from strata.plans import fixtures as fx
from strata.session import checkpoint_dir, folders
from strata.sources.scan import list_files
from strata.sources.sinks import write_overwrite


def entities(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: fx.entity(spark, sf_dir, name) for name in fx.ENTITIES}


def base_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.base_customers(fx.perimetre(spark, sf_dir), fx.AS_OF)


def feature(spark: SparkSession, sf_dir: str, group: str) -> DataFrame:
    g = feat.GROUPS[group]
    return rounded(g.build(fx.entity(spark, sf_dir, g.entity), fx.AS_OF))


def rounded(df: DataFrame) -> DataFrame:
    """Standard deviations to four digits, as the reports show them (engines differ in the last bits)."""
    cols = [c for c in ("std_balance", "std_flux_cred") if c in df.columns]
    return df.withColumns({c: F.round(c, 4) for c in cols}) if cols else df


def master_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(build_master(entities(spark, sf_dir), fx.AS_OF))


CUSTOMERS_A_TASK = 25_000


def dealt(tables: dict[str, DataFrame], customers: int = CUSTOMERS_A_TASK) -> dict[str, DataFrame]:
    """``tables`` with the base dealt out by key to a fixed number of tasks, each with about ``customers`` rows at most.
    A task of the joins holds 16 aggregates and 17 sorts at once; left to adaptive execution, which goes by shuffled
    bytes, it would get so many customers that these do not fit. A base that is one task's share stays as it is."""
    base = tables["perimetre"]
    n = base.count()
    if n <= customers:
        return tables
    tasks = max(int(base.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // customers))
    return {**tables, "perimetre": base.repartition(tasks, feat.KEY)}


def written_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The master table as it lies in Gold, which profiling, preparation and modelling read. It is written once for an
    application and a state of the source files (their paths, lengths and times); a folder that is gone or incomplete
    is written again."""
    state = list_files(spark, sf_dir).agg(F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))).first()[0]
    own = f"{spark.sparkContext.applicationId}-{zlib.crc32(f'{sf_dir} {state}'.encode()):08x}"
    at = f"{checkpoint_dir(spark).rstrip('/')}/strata-gold-{own}/master_table"
    if "_SUCCESS" not in folders(spark, at):
        write_overwrite(rounded(build_master(dealt(entities(spark, sf_dir)), fx.AS_OF)), at)
    return spark.read.parquet(at)


def master_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minimum slice: base + balances + income, filled, two derived ratios."""
    base = base_customers(spark, sf_dir)
    joined = fill_zero(join_features(base, [feature(spark, sf_dir, "soldes"), feature(spark, sf_dir, "flux")]))
    return joined.select(
        "RADICAL",
        "avg_balance",
        "last_balance",
        "avg_flux_cred",
        F.try_divide(F.col("avg_balance"), F.col("avg_flux_cred") + 1).alias("savings_ratio"),
        (F.col("last_balance") - F.col("min_balance")).alias("balance_trend"),
    )


def last_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.latest_value(fx.soldes(spark, sf_dir), "RADICAL", "SOLDEVERIF", "DATE_CHARG", "last_balance")


def derived_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = master_table(spark, sf_dir)
    return m.select("RADICAL", "savings_ratio", "digital_score", "spending_diversity", "product_breadth",
                    "balance_trend", "avg_monthly_spend")


__all__ = ["add_derived", "base_customers", "derived_features", "entities", "feature", "master_slice", "master_table", "written_master"]
