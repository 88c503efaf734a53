"""Master table: customer base left-joined to every feature group, filled, derived.

All feature groups are aggregated on RADICAL, so each arrives hash-partitioned
on the key; sort-merge left joins then reuse that partitioning and only the base
is shuffled once. Spark broadcasts a group only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` (per-customer groups grow with the
customer count, so at scale they are joined by sort-merge). Feature rows are
unique per key, so the joins do not multiply base rows.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.features import GROUPS, KEY, base_customers

# Columns never zero-filled: identifiers, free text and the date column.
NO_FILL = ["RADICAL", "GENDER", "MARITAL_STATUS", "CODE_VILLE", "LIBELLE_VILLE", "BPR", "TAILLE_ENTREPRI", "first_account_date"]


def join_features(base: DataFrame, groups: list[DataFrame]) -> DataFrame:
    return reduce(lambda acc, g: acc.join(g, on=KEY, how="left"), groups, base)


def fill_zero(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Zero-fill every column except ``keep`` (string columns get ``'0'``, NaN becomes 0)."""
    keep = set(NO_FILL if keep is None else keep)
    fill = {c: 0 for c, t in df.dtypes if c not in keep and t not in ("date", "timestamp", "timestamp_ntz")}
    return df.fillna(fill)


def _flag(c: str) -> Column:
    return F.when(F.col(c) > 0, 1).otherwise(0)


def derived_columns() -> dict[str, Column]:
    col = F.col
    return {
        "savings_ratio": F.try_divide(col("avg_balance"), col("avg_flux_cred") + 1),
        "digital_score": col("has_digital_product") + _flag("nb_payfac_transactions") + _flag("nb_online_transactions"),
        "spending_diversity": _flag("nb_gab_transactions") + _flag("nb_tpe_transactions")
        + _flag("nb_online_transactions") + _flag("nb_virements"),
        "product_breadth": col("has_carte") + col("has_pack") + col("has_digital_product") + col("has_vignette")
        + col("has_attamine") + col("has_injad") + _flag("nb_depots"),
        "balance_trend": col("last_balance") - col("min_balance"),
        "avg_monthly_spend": (col("total_gab_amount") + col("total_tpe_amount") + col("total_online_amount"))
        / F.greatest(col("nb_flux_months"), F.lit(1)),
    }


def add_derived(master: DataFrame) -> DataFrame:
    """The six derived features, computed after the fill, in one projection."""
    return master.withColumns(derived_columns())


def build_master(entities: dict[str, DataFrame], as_of: dt.date | Column | None = None) -> DataFrame:
    """``entities`` maps entity name (perimetre, assurance, ...) to its Silver DataFrame."""
    base = base_customers(entities["perimetre"], as_of)
    groups = [g.build(entities[g.entity], as_of) for g in GROUPS.values()]
    return add_derived(fill_zero(join_features(base, groups)))
