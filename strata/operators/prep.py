"""Feature preparation: caps, category encoding, splits, samples and class balance.

Splits and samples are exact and reproducible: rows are ordered by a hash of
(key, seed) inside each class, and positions come from the distributed global
order of ``rank.class_positions`` (no window over a whole class in one task).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.profile import exact_percentiles
from strata.operators.rank import class_positions, fixed_partitions, prefix_sums

# Notebook column groups and caps.
CAT_COLS = ["GENDER", "MARITAL_STATUS", "CUSTOMER_RATING", "CODE_VILLE", "BPR"]
DROP_COLS = ["RADICAL", "first_account_date", "LIBELLE_VILLE", "TAILLE_ENTREPRI", "has_valid_carte"]
LEAKY_COLS = ["nb_insurance_products"]
CAP_COLS = [
    "avg_balance", "max_balance", "min_balance", "last_balance",
    "total_flux_cred", "avg_flux_cred", "max_flux_cred",
    "total_gab_amount", "avg_gab_amount", "max_gab_amount",
    "total_tpe_amount", "avg_tpe_amount", "max_tpe_amount",
    "total_retrait_amount", "avg_retrait_amount",
    "total_online_amount", "avg_online_amount",
    "total_payfac_amount", "total_virement_amount",
    "total_depot_amount", "total_mad_amount",
    "savings_ratio", "avg_monthly_spend", "balance_trend",
]
CHILDREN_CAP = 10
SEED = 42


def p99_caps(df: DataFrame, columns: Sequence[str] = CAP_COLS) -> DataFrame:
    """Exact 99th percentile per column (long form ``column, p99``)."""
    return exact_percentiles(df, columns, [0.99]).select("column", F.col("q0").alias("p99"))


def cap_values(df: DataFrame, columns: Sequence[str] = CAP_COLS) -> dict[str, float]:
    """Positive p99 caps as numbers (one small row per column reaches the driver)."""
    return {r["column"]: r["p99"] for r in p99_caps(df, columns).collect() if r["p99"] is not None and r["p99"] > 0}


def cap_outliers(df: DataFrame, caps: Mapping[str, float], children_cap: int | None = CHILDREN_CAP) -> DataFrame:
    """``least(col, cap)`` for each capped column (only caps > 0), and the fixed children cap."""
    exprs = {c: F.least(F.col(c), F.lit(v)) for c, v in caps.items() if v is not None and v > 0}
    if children_cap is not None and "NOMBRE_ENFANT" in df.columns:
        exprs["NOMBRE_ENFANT"] = F.least(F.col("NOMBRE_ENFANT"), F.lit(children_cap))
    return df.withColumns(exprs)


def string_index(df: DataFrame, columns: Sequence[str] = CAT_COLS, suffix: str = "_idx") -> DataFrame:
    """``StringIndexer`` per column (frequency descending, ties alphabetical; null and unseen -> last index).

    Fitting collects one (label, count) list per column: bounded by the category cardinality.
    """
    indexer = StringIndexer(inputCols=list(columns), outputCols=[f"{c}{suffix}" for c in columns], handleInvalid="keep")
    return indexer.fit(df).transform(df)  # one job counts the categories of all columns


def encode_features(df: DataFrame, cat_cols: Sequence[str] = CAT_COLS, drop_cols: Sequence[str] = DROP_COLS,
                    leaky: Sequence[str] = LEAKY_COLS, keep_key: str | None = "RADICAL") -> DataFrame:
    """Index categories, drop raw categories / identifiers / leaky columns, zero-fill."""
    enc = string_index(df, cat_cols)
    drop = [c for c in [*cat_cols, *drop_cols, *leaky] if c != keep_key]
    return enc.drop(*drop).fillna(0)


def hash_order(key: str, seed: int = SEED) -> Column:
    """Reproducible pseudo-random order: md5 of the key and the seed."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))


def stratified_split(df: DataFrame, label: str, key: str, test_fraction: float = 0.2, seed: int = SEED,
                     names: tuple[str, str] = ("train", "test")) -> DataFrame:
    """Exact stratified split: in each class, the first floor(n_class * fraction) rows in hash order
    go to the second split. Adds ``split``."""
    ranked = class_positions(df, label, [hash_order(key, seed), F.col(key)], fixed_partitions(df))
    cut = F.floor(F.col("n_class") * F.lit(float(test_fraction)))
    return ranked.withColumn("split", F.when(F.col("pos_in_class") < cut, names[1]).otherwise(names[0])).drop(
        "pos_in_class", "n_class")


def split_rates(split: DataFrame, label: str) -> DataFrame:
    return split.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(label), 4).alias("pos_rate"))


def sample_n(df: DataFrame, n: int, key: str, seed: int = SEED) -> DataFrame:
    """Exactly ``n`` rows (or all), the first in hash order: distributed, no single-task top-n. Rows without a
    key come first in that order."""
    # a cut-off on a hash keeps a few more than n rows; only those are ordered exactly
    total = df.count()
    if n >= total:
        return df
    top = (1 << 32) - 1
    share = F.coalesce(F.conv(F.substring(hash_order(key, seed), 1, 8), 16, 10).cast("long"), F.lit(0))
    rest, cut = None, int(top * min(1.0, (n + 6 * n**0.5 + 50) / total))
    while rest is None or cut < top and rest.count() < n:  # the margin is six deviations; widen it if it fails
        cut = cut if rest is None else min(top, 2 * cut + 1)
        rest = df.where(share <= cut)
    ranked = prefix_sums(rest, [hash_order(key, seed), F.col(key)], None, totals=False)
    return ranked.filter(F.col("pos") < n).drop("pos")


def undersample(df: DataFrame, label: str, key: str, targets: Mapping[int, int], seed: int = SEED) -> DataFrame:
    """Keep at most ``targets[c]`` rows of each class ``c`` (first in hash order); classes without a
    target are kept whole."""
    ranked = class_positions(df, label, [hash_order(key, seed), F.col(key)])
    keep = F.lit(True)
    for cls, target in targets.items():
        keep = F.when(F.col(label) == F.lit(cls), F.col("pos_in_class") < F.lit(int(target))).otherwise(keep)
    return ranked.filter(keep).drop("pos_in_class", "n_class")


def class_weight(df: DataFrame, label: str, mode: str = "scale_pos") -> DataFrame:
    """Adds ``weight``: ``scale_pos`` gives positives neg/pos and negatives 1; ``balanced`` gives
    n / (n_classes * n_c). Class counts are one row per class and are broadcast: by its own estimate Spark takes those of
    a long table for long, deals its rows out by class, and then a task or two read them all. Without a positive, ``scale_pos`` has no row to weigh; null labels are a class of their own."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n_c"))
    # one row per class: the window over it and the broadcast are bounded by the class count
    w = (counts.selectExpr(
        f"{label} as _class", "_n_c",
        "sum(_n_c) over () as _n", "count(1) over () as _k",
        f"sum(case when {label} = 1 then _n_c end) over () as _pos"))
    out = df.join(F.broadcast(w), F.col(label).eqNullSafe(F.col("_class")), "left").drop("_class")
    if mode == "balanced":
        weight = F.try_divide(F.col("_n"), F.col("_k") * F.col("_n_c"))
    else:
        weight = F.when(F.col(label) == 1, F.try_divide(F.col("_n") - F.col("_pos"), F.col("_pos"))).otherwise(F.lit(1.0))
    return out.withColumn("weight", weight).drop("_n_c", "_n", "_k", "_pos")
