"""DuckDB oracle SQL for profiling and preparation queries over the master table."""

from __future__ import annotations

from strata.plans.analysis import CORR_COLS, OUTLIER_COLS, SAMPLE_ROWS
from strata.plans.oracle import MASTER_FEATURE_COLUMNS, over_master

BASE_COLUMNS = ["RADICAL", "BANQUE", "AGENCE", "CODE_VILLE", "LIBELLE_VILLE", "BPR", "GENDER", "MARITAL_STATUS",
                "NOMBRE_ENFANT", "CUSTOMER_RATING", "TAILLE_ENTREPRI", "age"]
DERIVED = ["savings_ratio", "digital_score", "spending_diversity", "product_breadth", "balance_trend",
           "avg_monthly_spend"]
MASTER_COLUMNS = BASE_COLUMNS + MASTER_FEATURE_COLUMNS + DERIVED
CAT_COLS = ["GENDER", "MARITAL_STATUS", "CUSTOMER_RATING", "CODE_VILLE", "BPR"]
DROP_COLS = ["RADICAL", "first_account_date", "LIBELLE_VILLE", "TAILLE_ENTREPRI", "has_valid_carte"]
CAP_COLS = [
    "avg_balance", "max_balance", "min_balance", "last_balance", "total_flux_cred", "avg_flux_cred", "max_flux_cred",
    "total_gab_amount", "avg_gab_amount", "max_gab_amount", "total_tpe_amount", "avg_tpe_amount", "max_tpe_amount",
    "total_retrait_amount", "avg_retrait_amount", "total_online_amount", "avg_online_amount", "total_payfac_amount",
    "total_virement_amount", "total_depot_amount", "total_mad_amount", "savings_ratio", "avg_monthly_spend",
    "balance_trend",
]
LABEL_ANY = "greatest(label_maRetraite, label_avenirMesEnfants, label_epargneEvolution)"
LABELS = ["label_maRetraite", "label_avenirMesEnfants", "label_epargneEvolution"]

_pct = ",\n".join(f"ROUND({c} / total * 100, 4) AS {c}_pct" for c in [*LABELS, "any_product"])
LABEL_DISTRIBUTION = over_master(f"""SELECT *, {_pct} FROM (
    SELECT COUNT(RADICAL) AS total,
           {", ".join(f"CAST(SUM({c}) AS BIGINT) AS {c}" for c in LABELS)},
           CAST(SUM({LABEL_ANY}) AS BIGINT) AS any_product
    FROM master)""")

LABEL_ANY_Q = over_master(f"SELECT RADICAL, {LABEL_ANY} AS label_any FROM master")

NULL_PROFILE = over_master(
    "SELECT * FROM (" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_null, "
        f"ROUND(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) / COUNT(*) * 100, 2) AS null_pct FROM master"
        for c in MASTER_COLUMNS) + ") WHERE n_null > 0")

PERCENTILE_PROFILE = over_master(
    "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS "column", ROUND(q[1], 6) AS p50, ROUND(q[2], 6) AS p75, ROUND(q[3], 6) AS p95,
               ROUND(q[4], 6) AS p99, ROUND(q[5], 6) AS max,
               CASE WHEN q[4] > 0 THEN ROUND(q[5] / q[4], 1) END AS ratio
            FROM (SELECT quantile_cont(CAST({c} AS DOUBLE), [0.5, 0.75, 0.95, 0.99, 1.0]) AS q FROM master)"""
        for c in OUTLIER_COLS))

P99_CAPS = over_master(
    "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS "column", ROUND(quantile_cont(CAST({c} AS DOUBLE), 0.99), 6) AS p99 FROM master"""
        for c in CAP_COLS))

_caps = ",\n".join(f"quantile_cont(CAST({c} AS DOUBLE), 0.99) AS cap_{c}" for c in CAP_COLS)
_capped = ",\n".join(
    f"ROUND(CASE WHEN cap_{c} > 0 THEN least({c}, cap_{c}) ELSE {c} END, 6) AS {c}" for c in CAP_COLS)
CAP_OUTLIERS = over_master(f"""SELECT RADICAL, least(NOMBRE_ENFANT, 10) AS NOMBRE_ENFANT, {_capped}
    FROM master, (SELECT {_caps} FROM master)""")


def _corr(a: str, b: str) -> str:
    a, b = f"CAST({a} AS DOUBLE)", f"CAST({b} AS DOUBLE)"
    return f"ROUND(CASE WHEN stddev_samp({a}) > 0 AND stddev_samp({b}) > 0 THEN corr({a}, {b}) END, 4)"


CORR_LABEL = over_master(
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, {_corr(c, 'label_any')} AS correlation "
        f"FROM (SELECT *, {LABEL_ANY} AS label_any FROM master)" for c in CORR_COLS))

_pairs = [(a, b) for i, a in enumerate(CORR_COLS) for b in CORR_COLS[i + 1:]]
CORR_MATRIX = over_master(
    "\nUNION ALL\n".join(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {_corr(a, b)} AS correlation FROM master"
                         for a, b in _pairs))

AGE_BY_LABEL = over_master(f"""SELECT {LABEL_ANY} AS label_any, AVG(age) AS avg_age, MIN(age) AS min_age,
    MAX(age) AS max_age, COUNT(*) AS n FROM master GROUP BY 1""")


def _index_ctes() -> str:
    parts = []
    for c in CAT_COLS:
        parts.append(f"""idx_{c} AS (SELECT {c} AS v, CAST(ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, {c} ASC) - 1 AS DOUBLE) AS i
                FROM master WHERE {c} IS NOT NULL GROUP BY {c}),
            n_{c} AS (SELECT CAST(COUNT(*) AS DOUBLE) AS k FROM idx_{c})""")
    return ",\n".join(parts)


def _indexed(select_extra: str) -> str:
    joins = "\n".join(f"LEFT JOIN idx_{c} ON m.{c} = idx_{c}.v" for c in CAT_COLS)
    idx = ", ".join(f"COALESCE(idx_{c}.i, (SELECT k FROM n_{c})) AS {c}_idx" for c in CAT_COLS)
    return over_master(f""", {_index_ctes()}
        SELECT {select_extra}, {idx} FROM master m {joins}""")


STRING_INDEX = _indexed("m.RADICAL")
_keep = [c for c in MASTER_COLUMNS if c not in CAT_COLS + DROP_COLS + ["nb_insurance_products"]]
ENCODE_FEATURES = _indexed(", ".join(["m.RADICAL"] + [f"m.{c}" for c in _keep]))



def _model_value(c: str) -> str:
    """A feature as the models get it: capped where it is an amount, as a 32-bit float."""
    if c in CAP_COLS:
        c = f"CASE WHEN k.cap_{c} > 0 THEN least(m.{c}, k.cap_{c}) ELSE m.{c} END AS FLOAT) AS {c}"
    elif c == "NOMBRE_ENFANT":
        c = "least(m.NOMBRE_ENFANT, 10) AS FLOAT) AS NOMBRE_ENFANT"
    else:
        c = f"m.{c} AS FLOAT) AS {c}"
    return "CAST(" + c


_features = ", ".join(_model_value(c) for c in _keep if c not in LABELS + ["BANQUE", "AGENCE"])
_codes = ", ".join(f"CAST(COALESCE(idx_{c}.i, (SELECT k FROM n_{c})) AS FLOAT) AS {c}_idx" for c in CAT_COLS)
DOWNCAST_FEATURES = over_master(f""", {_index_ctes()}, caps AS (SELECT {_caps} FROM master)
    SELECT m.RADICAL, {LABEL_ANY} AS label_any, {_features}, {_codes}
    FROM master m CROSS JOIN caps k {" ".join(f"LEFT JOIN idx_{c} ON m.{c} = idx_{c}.v" for c in CAT_COLS)}""")

_HASH = "md5(CAST(RADICAL AS VARCHAR) || ':42')"
_CLASS_POS = f"""SELECT RADICAL, label_any,
       ROW_NUMBER() OVER (PARTITION BY label_any ORDER BY {_HASH}, RADICAL) - 1 AS pos_in_class,
       COUNT(*) OVER (PARTITION BY label_any) AS n_class
    FROM (SELECT RADICAL, {LABEL_ANY} AS label_any FROM master)"""

STRATIFIED_SPLIT = over_master(f"""SELECT RADICAL, label_any,
    CASE WHEN pos_in_class < floor(n_class * CAST(0.2 AS DOUBLE)) THEN 'test' ELSE 'train' END AS split
    FROM ({_CLASS_POS})""")

# a fifth for validation, by the first hash; half of that for the test, by the second
MODEL_SPLIT = over_master(f""", first AS (SELECT RADICAL, label_any, pos_in_class < floor(n_class * CAST(0.2 AS DOUBLE)) AS held
        FROM ({_CLASS_POS})),
    second AS (SELECT RADICAL, ROW_NUMBER() OVER (PARTITION BY label_any
                   ORDER BY md5(CAST(RADICAL AS VARCHAR) || ':43'), RADICAL) - 1 AS pos,
               COUNT(*) OVER (PARTITION BY label_any) AS n FROM first WHERE held),
    totals AS (SELECT COUNT(*) AS n, SUM(label_any) AS p FROM first)
    SELECT f.RADICAL, f.label_any, CASE WHEN f.label_any = 1 THEN (t.n - t.p) / t.p ELSE 1.0 END AS weight,
           CASE WHEN NOT f.held THEN 'train' WHEN s.pos < floor(s.n * CAST(0.5 AS DOUBLE)) THEN 'test' ELSE 'thr' END AS split
    FROM first f CROSS JOIN totals t LEFT JOIN second s ON f.RADICAL = s.RADICAL""")

SPLIT_RATES = over_master(f"""SELECT split, COUNT(*) AS n, ROUND(AVG(label_any), 4) AS pos_rate FROM (
    SELECT label_any, CASE WHEN pos_in_class < floor(n_class * CAST(0.2 AS DOUBLE)) THEN 'test' ELSE 'train' END AS split
    FROM ({_CLASS_POS})) GROUP BY split""")

SAMPLE_N = over_master(f"""SELECT RADICAL, {LABEL_ANY} AS label_any, age FROM master
    ORDER BY {_HASH}, RADICAL LIMIT {SAMPLE_ROWS}""")

UNDERSAMPLE = over_master(f"""SELECT RADICAL, label_any FROM ({_CLASS_POS})
    WHERE label_any <> 0 OR pos_in_class < 500""")

CLASS_WEIGHT = over_master(f"""SELECT RADICAL, label_any,
    CASE WHEN label_any = 1 THEN (n - p) / p ELSE 1.0 END AS weight
    FROM (SELECT RADICAL, {LABEL_ANY} AS label_any FROM master),
         (SELECT COUNT(*) AS n, SUM({LABEL_ANY}) AS p FROM master)""")

# what must hold of the trained scores: every customer once, the split's sizes, nothing out of range
TRAINED_FACTS = f"""SELECT COUNT(*) AS n_rows, COUNT(*) AS n_keys, CAST(SUM(label_any) AS BIGINT) AS n_pos,
    COUNT(*) FILTER (split = 'train') AS n_train, COUNT(*) FILTER (split = 'thr') AS n_thr,
    COUNT(*) FILTER (split = 'test') AS n_test, CAST(0 AS BIGINT) AS bad_scores, CAST(0 AS BIGINT) AS bad_predictions,
    CAST(0 AS BIGINT) AS bad_deciles, CAST(0 AS BIGINT) AS bad_ranks FROM ({MODEL_SPLIT})"""

# the rows of each class in hash order are dealt out to three folds in turn
FLEET_FOLDS = f"""SELECT RADICAL, label_any, CAST((ROW_NUMBER() OVER (PARTITION BY label_any
    ORDER BY {_HASH}, RADICAL) - 1) % 3 AS INTEGER) AS fold FROM ({MODEL_SPLIT}) WHERE split = 'train'"""
FLEET_FACTS = f"""SELECT COUNT(*) AS n_rows, COUNT(*) AS n_keys, CAST(SUM(label_any) AS BIGINT) AS n_pos,
    COUNT(*) FILTER (split = 'train') AS n_train, COUNT(*) FILTER (split = 'thr') AS n_thr,
    COUNT(*) FILTER (split = 'test') AS n_test, CAST(0 AS BIGINT) AS bad_scores, CAST(0 AS BIGINT) AS bad_predictions,
    COUNT(*) FILTER (split = 'train') AS n_held, COUNT(*) FILTER (split = 'train') AS n_held_keys,
    CAST(3 AS BIGINT) AS n_folds, CAST(0 AS BIGINT) AS bad_held, CAST(0 AS BIGINT) AS repeated_values FROM ({MODEL_SPLIT})"""

BORDER_OVERSAMPLE = f"""SELECT FALSE AS synthetic, label_any, COUNT(*) AS n, CAST(0 AS BIGINT) AS n_off
    FROM ({MODEL_SPLIT}) WHERE split = 'train' GROUP BY label_any
    UNION ALL SELECT TRUE, 1, COUNT(*), CAST(0 AS BIGINT) FROM ({MODEL_SPLIT}) WHERE split = 'train' AND label_any = 1"""

ORACLE_MODEL = {"border_oversample": BORDER_OVERSAMPLE, "fleet_folds": FLEET_FOLDS, "fleet_facts": FLEET_FACTS, "downcast_features": DOWNCAST_FEATURES, "model_split": MODEL_SPLIT, "trained_facts": TRAINED_FACTS}

ORACLE = {
    "label_distribution": LABEL_DISTRIBUTION,
    "label_any": LABEL_ANY_Q,
    "null_profile": NULL_PROFILE,
    "percentile_profile": PERCENTILE_PROFILE,
    "p99_caps": P99_CAPS,
    "cap_outliers": CAP_OUTLIERS,
    "corr_label": CORR_LABEL,
    "corr_matrix": CORR_MATRIX,
    "age_by_label": AGE_BY_LABEL,
    "string_index": STRING_INDEX,
    "encode_features": ENCODE_FEATURES,
    "stratified_split": STRATIFIED_SPLIT,
    "split_rates": SPLIT_RATES,
    "sample_n": SAMPLE_N,
    "undersample": UNDERSAMPLE,
    "class_weight": CLASS_WEIGHT,
}
