"""Silver plans: Bronze-shaped sources derived from the driver tables, and their cleaning.

``accounts_raw`` is the orders table as text, the way a flat file would land:
padded keys, several date and amount defects, lower-case codes. The clean
specs below are the fixture entities' specs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.text import gender_expr
from strata.operators.clean import (
    CleanSpec,
    apply_filters,
    clean,
    conform,
    dedup,
    quality_conditions,
)
from strata.plans import fixtures as fx

ACCOUNTS_SPEC = CleanSpec(
    sources=("orders",),
    allow_missing=False,
    renames={"CONTRAT": "RADICAL"},
    date_floor="1996-01-01",
    casts={"RADICAL": "long", "CCLE": "long", "DTOUVR": ("date", "yyyy-MM-dd"), "SOLDE": "double",
           "NB": "int", "STATUS": "string"},
    not_null=("RADICAL",),
    dedup=("RADICAL", "DTOUVR"),
    non_negative=("SOLDE",),
    uppercase=("STATUS",),
)

PARTIES_SPEC = CleanSpec(
    sources=("customer", "supplier"),
    allow_missing=True,
    renames={"CONTRAT": "RADICAL", "ID_FOURN": "RADICAL", "NUMERO": "NUM"},
    casts={"RADICAL": "long", "SOLDE": "double"},
    not_null=("RADICAL",),
)

LINES_DEDUP_KEYS = ("l_orderkey", "l_linenumber")


def accounts_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = fx.read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    key_txt = F.col("o_custkey").cast("string")
    date_txt = F.date_format(F.col("o_orderdate"), "yyyy-MM-dd")
    price_txt = F.col("o_totalprice").cast("string")
    return o.select(
        F.when(k % 53 == 0, F.lit(None).cast("string"))
        .when(k % 7 == 0, F.concat(F.lit("  "), key_txt, F.lit(" ")))
        .otherwise(key_txt).alias("CONTRAT"),
        k.cast("string").alias("CCLE"),
        F.when(k % 97 == 0, F.lit("n/a"))
        .when(k % 89 == 0, F.lit(None).cast("string"))
        .when(k % 13 == 0, F.lit("1899-12-31"))
        .when(k % 17 == 0, F.lit("2030-01-01"))
        .otherwise(date_txt).alias("DTOUVR"),
        F.when(k % 101 == 0, F.lit("x"))
        .when(k % 103 == 0, F.lit(""))
        .when(k % 11 == 0, F.concat(F.lit("-"), price_txt))
        .otherwise(price_txt).alias("SOLDE"),
        F.when(k % 19 == 0, F.lit("3.7")).otherwise((k % 9).cast("string")).alias("NB"),
        F.when(k % 5 == 0, F.concat(F.lit(" "), F.lower("o_orderstatus"), F.lit(" ")))
        .otherwise(F.lower("o_orderstatus")).alias("STATUS"),
    )


def parties_sources(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    c = fx.read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("CONTRAT"), F.col("c_name").alias("NOM"),
        F.col("c_acctbal").alias("SOLDE"), F.col("c_mktsegment").alias("SEGMENT"))
    s = fx.read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("ID_FOURN"), F.col("s_name").alias("NOM"),
        F.col("s_acctbal").alias("SOLDE"), F.col("s_nationkey").alias("NATION"))
    return [c, s]


def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parties_sources(spark, sf_dir))


def rename_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(union_sources(spark, sf_dir), PARTIES_SPEC.renames)


def _typed_accounts(spark, sf_dir):
    return conform(accounts_raw(spark, sf_dir), ACCOUNTS_SPEC.renames, ACCOUNTS_SPEC.casts, ACCOUNTS_SPEC.uppercase)


def clean_cast(spark, sf_dir):
    return _typed_accounts(spark, sf_dir)


def _only(spark, sf_dir, **which):
    df = _typed_accounts(spark, sf_dir)
    flags = {"date_range": False, "non_negative": False, "not_null": False, **which}
    return apply_filters(df, quality_conditions(df, ACCOUNTS_SPEC, fx.as_of_col(), **flags))


def clean_date_range(spark, sf_dir):
    return _only(spark, sf_dir, date_range=True)


def clean_non_negative(spark, sf_dir):
    return _only(spark, sf_dir, non_negative=True)


def clean_not_null(spark, sf_dir):
    return _only(spark, sf_dir, not_null=True)


def clean_full(spark, sf_dir):
    return clean(accounts_raw(spark, sf_dir), ACCOUNTS_SPEC, fx.as_of_col(), load_ts=False)


def clean_parties(spark, sf_dir):
    return clean(union_sources(spark, sf_dir), PARTIES_SPEC, fx.as_of_col(), load_ts=False)


def dedup_keys(spark, sf_dir):
    li = fx.read(spark, sf_dir, "lineitem")
    return dedup(li, LINES_DEDUP_KEYS)


def normalize_gender(spark, sf_dir):
    raw = fx.perimetre_raw(spark, sf_dir)
    return raw.select("RADICAL", F.col("GENDER").alias("GENDER_RAW"),
                      gender_expr(F.trim(F.col("GENDER"))).alias("GENDER"))
