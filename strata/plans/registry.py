"""Named queries (``(spark, sf_dir) -> DataFrame``) and their DuckDB oracle SQL.

``queries()`` and ``oracle_sql()`` feed ``__spark_entry__``. A query without an
oracle entry is one whose result is not SQL-expressible (model training,
streaming ingestion, file listings); those get row-level checks in tests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.plans import gold
from strata.plans import oracle as o

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLE[name] = sql
        return fn

    return deco


# ------------------------------------------------------------------ gold
register("base_customers", o.with_ctes(o.BASE_SQL, ["perimetre"]))(gold.base_customers)

_FEATURE_QUERY = {
    "labels": "feat_labels", "comptes": "feat_comptes", "soldes": "feat_soldes", "flux": "feat_flux",
    "gab": "feat_gab", "tpe": "feat_tpe", "retrait": "feat_retrait", "online": "feat_online",
    "digital": "feat_digital", "payfac": "feat_payfac", "virement": "feat_virement", "carte": "feat_carte",
    "opk": "feat_opk", "depot": "feat_depot", "mad": "feat_mad", "vignette": "feat_vignette",
}


def _feature_query(group: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return gold.feature(spark, sf_dir, group)

    q.__name__ = f"feat_{group}"
    return q


for _g, _name in _FEATURE_QUERY.items():
    register(_name, o.feature_query(_g))(_feature_query(_g))

register("master_table", o.over_master("SELECT * FROM master"))(gold.master_table)
register(
    "derived_features",
    o.over_master("SELECT RADICAL, savings_ratio, digital_score, spending_diversity, product_breadth, "
                  "balance_trend, avg_monthly_spend FROM master"),
)(gold.derived_features)
register(
    "master_slice",
    o.with_ctes(
        f"""SELECT RADICAL, COALESCE(avg_balance, 0) AS avg_balance, COALESCE(last_balance, 0) AS last_balance,
                  COALESCE(avg_flux_cred, 0) AS avg_flux_cred,
                  COALESCE(avg_balance, 0) / (COALESCE(avg_flux_cred, 0) + 1) AS savings_ratio,
                  COALESCE(last_balance, 0) - COALESCE(min_balance, 0) AS balance_trend
           FROM ({o.BASE_SQL}) b
           LEFT JOIN ({o.FEATURE_SQL["soldes"]}) s USING (RADICAL)
           LEFT JOIN ({o.FEATURE_SQL["flux"]}) f USING (RADICAL)""",
        ["perimetre", "soldes", "flux"],
    ),
)(gold.master_slice)


# ------------------------------------------------------------------ evaluation and scoring
from strata.plans import evaluation as _ev  # noqa: E402
from strata.plans.oracle_eval import ORACLE as _EV_SQL  # noqa: E402

for _name in _EV_SQL:
    register(_name, _EV_SQL[_name])(getattr(_ev, _name))


# ------------------------------------------------------------------ silver (cleaning)
from strata.plans import silver as _si  # noqa: E402
from strata.plans.oracle_silver import ORACLE as _SI_SQL  # noqa: E402

for _name in _SI_SQL:
    register(_name, _SI_SQL[_name])(getattr(_si, _name))


# ------------------------------------------------------------------ profiling and preparation
from strata.plans import analysis as _an  # noqa: E402
from strata.plans.oracle_analysis import ORACLE as _AN_SQL  # noqa: E402

for _name in _AN_SQL:
    register(_name, _AN_SQL[_name])(getattr(_an, _name))


# ------------------------------------------------------------------ lake: scans, sinks, catalogue, gates
from strata.plans import lake as _lk  # noqa: E402
from strata.plans.oracle import over_master as _over_master  # noqa: E402
from strata.plans.oracle_eval import ORACLE as _EV  # noqa: E402
from strata.plans.oracle_silver import GATE_PATHS as _GATE_PATHS  # noqa: E402
from strata.plans.oracle_silver import ORACLE_LAKE as _LK_SQL  # noqa: E402

for _name in _LK_SQL:
    register(_name, _LK_SQL[_name])(getattr(_lk, _name))
register("gate_paths", _GATE_PATHS)(_lk.gate_paths)
register("write_master", _over_master("SELECT * FROM master"))(_lk.write_master)
register("score_sink", _EV["score_table"])(_lk.score_sink)
register("preprocessed_sink", _AN_SQL["encode_features"])(_lk.preprocessed_sink)
register("list_tables")(_lk.list_tables)
register("lakehouse_master", _over_master("SELECT * FROM master"))(_lk.lakehouse_master)
register("bucketed_master", _over_master("SELECT * FROM master"))(_lk.bucketed_master)
from strata.plans.oracle_eval import SCORED as _SCORED, _lift_table_sql  # noqa: E402

register("report_csv", f"WITH {_SCORED}, {_lift_table_sql('y_proba', 'model_a', 'a')} SELECT * FROM lt_a")(
    _lk.report_csv)
register("approx_percentile_profile")(_an.approx_percentile_profile)
register("approx_rank_error", """SELECT c AS "column", p AS percentile, TRUE AS within
    FROM (SELECT unnest([%s]) AS c), (SELECT unnest(['p50', 'p75', 'p95', 'p99', 'max']) AS p)"""
         % ", ".join(f"'{c}'" for c in _an.OUTLIER_COLS))(_an.approx_rank_error)
register("detect_layout", """SELECT 'accounts' AS "table", 'flat' AS layout, COUNT(*) AS n_rows FROM orders
    UNION ALL SELECT 'parties' AS "table", 'data_subdir' AS layout, COUNT(*) AS n_rows FROM customer""")(
    _lk.detect_layout)
register("last_balance", o.with_ctes("""SELECT RADICAL, SOLDEVERIF AS last_balance FROM (
    SELECT RADICAL, SOLDEVERIF, ROW_NUMBER() OVER (PARTITION BY RADICAL
        ORDER BY DATE_CHARG DESC NULLS LAST, SOLDEVERIF DESC NULLS LAST) AS rn FROM soldes) WHERE rn = 1""",
    ["soldes"]))(gold.last_balance)


# ------------------------------------------------------------------ Silver entities
from strata.plans import entities as _en  # noqa: E402
from strata.plans.oracle_entities import ORACLE as _EN_SQL  # noqa: E402

for _name, _fn in _en.QUERIES.items():
    register(_name, _EN_SQL[_name])(_fn)


# ------------------------------------------------------------------ streaming ingestion
from strata.plans import ingest as _in  # noqa: E402

for _name, _fn in _in.QUERIES.items():
    register(_name, _in.ORACLE[_name])(_fn)


# ------------------------------------------------------------------ models (Spark ML; rows-only checks)
from strata.plans import modeling as _md  # noqa: E402
from strata.plans.oracle_analysis import ORACLE_MODEL as _MD_SQL  # noqa: E402

for _name, _fn in _md.QUERIES.items():
    register(_name, _MD_SQL.get(_name))(_fn)

from strata.plans import model_chain as _mc  # noqa: E402

for _name, _fn in _mc.QUERIES.items():
    register(_name, _MD_SQL.get(_name))(_fn)

from strata.plans import model_fleet as _mf  # noqa: E402

for _name, _fn in _mf.QUERIES.items():
    register(_name, _MD_SQL.get(_name))(_fn)


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)
