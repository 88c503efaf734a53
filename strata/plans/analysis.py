"""Profiling and preparation plans over the master table (notebook sections 1-2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import prep, profile
from strata.plans import gold

# The notebook's report column lists.
OUTLIER_COLS = ["avg_balance", "max_balance", "total_flux_cred", "total_gab_amount", "total_tpe_amount",
                "total_retrait_amount", "total_virement_amount", "savings_ratio", "avg_monthly_spend"]
CORR_COLS = ["age", "avg_balance", "max_balance", "total_flux_cred", "nb_gab_transactions", "nb_tpe_transactions",
             "nb_online_transactions", "has_digital_product", "has_carte", "has_pack", "has_vignette",
             "savings_ratio", "digital_score", "spending_diversity", "product_breadth", "balance_trend",
             "avg_monthly_spend", "anciennete_days", "nb_accounts"]
SAMPLE_ROWS = 500
UNDERSAMPLE_TARGETS = {0: 500}


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = gold.written_master(spark, sf_dir)
    return m.withColumn("label_any", profile.label_any(m))


def label_distribution(spark, sf_dir):
    return profile.label_distribution(gold.written_master(spark, sf_dir))


def label_any(spark, sf_dir):
    return labelled(spark, sf_dir).select("RADICAL", "label_any")


def null_profile(spark, sf_dir):
    return profile.null_profile(gold.written_master(spark, sf_dir))


def percentile_profile(spark, sf_dir):
    return profile.percentile_profile(gold.written_master(spark, sf_dir), OUTLIER_COLS)


def p99_caps(spark, sf_dir):
    return prep.p99_caps(gold.written_master(spark, sf_dir)).select("column", F.round("p99", 6).alias("p99"))


def cap_outliers(spark, sf_dir):
    m = gold.written_master(spark, sf_dir)
    capped = prep.cap_outliers(m, prep.cap_values(m))
    return capped.select("RADICAL", "NOMBRE_ENFANT", *(F.round(c, 6).alias(c) for c in prep.CAP_COLS))


def corr_label(spark, sf_dir):
    return profile.corr_with_label(labelled(spark, sf_dir), CORR_COLS, "label_any")


def corr_matrix(spark, sf_dir):
    # two passes (means, then the Gramian): read the materialised master
    return profile.corr_pairs(gold.written_master(spark, sf_dir), CORR_COLS)


def age_by_label(spark, sf_dir):
    m = gold.written_master(spark, sf_dir)
    return profile.age_by_label(m, profile.label_any(m))


def string_index(spark, sf_dir):
    enc = prep.string_index(gold.written_master(spark, sf_dir))
    return enc.select("RADICAL", *(f"{c}_idx" for c in prep.CAT_COLS))


def encode_features(spark, sf_dir):
    return prep.encode_features(gold.written_master(spark, sf_dir))


def stratified_split(spark, sf_dir):
    return prep.stratified_split(label_any(spark, sf_dir), "label_any", "RADICAL", 0.2)


def split_rates(spark, sf_dir):
    return prep.split_rates(stratified_split(spark, sf_dir), "label_any")


def sample_n(spark, sf_dir):
    return prep.sample_n(labelled(spark, sf_dir).select("RADICAL", "label_any", "age"), SAMPLE_ROWS, "RADICAL")


def undersample(spark, sf_dir):
    return prep.undersample(label_any(spark, sf_dir), "label_any", "RADICAL", UNDERSAMPLE_TARGETS)


def class_weight(spark, sf_dir):
    return prep.class_weight(label_any(spark, sf_dir), "label_any")


def approx_percentile_profile(spark, sf_dir):
    """The notebook's own method: percentile_approx (bounded-memory sketch), all columns in one pass."""
    return profile.approx_percentile_profile(gold.written_master(spark, sf_dir), OUTLIER_COLS)


def approx_rank_error(spark, sf_dir):
    """Whether the sketch's percentiles keep their promised rank error."""
    return profile.rank_errors(gold.written_master(spark, sf_dir), OUTLIER_COLS)
