"""DuckDB oracle SQL for the evaluation and scoring queries (brute-force windows)."""

from __future__ import annotations

from strata.plans.oracle import ENTITY_SQL

SCORED = f"scored AS ({ENTITY_SQL['scored']})"


def ranked_cte(src: str = "scored", p: str = "y_proba", name: str = "ranked") -> str:
    return f"""{name} AS (SELECT *, ROW_NUMBER() OVER (ORDER BY {p} DESC, key ASC) - 1 AS pos,
        COUNT(*) OVER () AS total_rows, SUM(y_true) OVER () AS total_pos FROM {src})"""


def curve_cte(src: str, p: str = "y_proba", name: str = "curve") -> str:
    return f"""{name}_s AS (SELECT {p} AS threshold, COUNT(*) AS n_s, SUM(y_true) AS pos_s FROM {src} GROUP BY {p}),
    {name}_c AS (SELECT *, SUM(n_s) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS cum_n,
                     SUM(pos_s) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS cum_pos,
                     SUM(pos_s) OVER () AS total_pos FROM {name}_s),
    {name} AS (SELECT threshold, CAST(cum_pos AS BIGINT) AS tp, CAST(cum_n - cum_pos AS BIGINT) AS fp,
                   cum_pos / cum_n AS precision, cum_pos / total_pos AS recall,
                   2.0 * (cum_pos / cum_n) * (cum_pos / total_pos)
                     / ((cum_pos / cum_n) + (cum_pos / total_pos) + 1e-10) AS f1
               FROM {name}_c)"""


def opt_cte(src: str, p: str = "y_proba", name: str = "opt") -> str:
    return f"""{curve_cte(src, p, name + "_curve")},
    {name} AS (SELECT threshold AS t FROM {name}_curve ORDER BY f1 DESC, threshold ASC LIMIT 1)"""


HALVES = "thr AS (SELECT * FROM scored WHERE key % 2 = 0), test AS (SELECT * FROM scored WHERE key % 2 = 1)"

LIFT_AT_K = f"""WITH {SCORED}, {ranked_cte()}
SELECT CAST(0.4 AS DOUBLE) AS k, ROUND((tp / p) / CAST(0.4 AS DOUBLE), 4) AS lift, ROUND(tp / p, 4) AS capture
FROM (SELECT SUM(CASE WHEN pos < floor(total_rows * CAST(0.4 AS DOUBLE)) THEN y_true ELSE 0 END) AS tp,
             ANY_VALUE(total_pos) AS p FROM ranked)"""

CENTILES = f"""WITH {SCORED}, {ranked_cte()},
cuts AS (SELECT unnest([1, 2, 5, 10, 20, 30, 40, 50]) AS centile),
agg AS (SELECT c.centile, CAST(floor(ANY_VALUE(r.total_rows) * c.centile / 100) AS BIGINT) AS nt,
               CAST(SUM(CASE WHEN r.pos < floor(r.total_rows * c.centile / 100) THEN r.y_true ELSE 0 END) AS BIGINT) AS tp,
               ANY_VALUE(r.total_pos) AS p, ANY_VALUE(r.total_rows) AS n
        FROM ranked r, cuts c GROUP BY c.centile)
SELECT '' AS model, centile, nt AS n, tp AS n_pos, ROUND(tp / p * 100, 2) AS capture_pct,
       ROUND(CASE WHEN nt > 0 THEN tp / nt ELSE 0.0 END, 4) AS precision,
       ROUND(CASE WHEN p / n > 0 AND nt > 0 THEN (tp / nt) / (p / n) ELSE 0.0 END, 4) AS lift
FROM agg"""

LIFT_TABLE = f"""WITH {SCORED}, {ranked_cte()},
d AS (SELECT *, CAST(CASE WHEN total_rows <= 1 THEN 1
                          ELSE greatest(1, ceil(10 * pos / (total_rows - 1))) END AS INTEGER) AS gain_decile FROM ranked),
t AS (SELECT gain_decile, COUNT(*) AS n, CAST(SUM(y_true) AS BIGINT) AS n_pos, AVG(y_proba) AS avg_score,
             ANY_VALUE(total_pos) AS p, ANY_VALUE(total_rows) AS nn FROM d GROUP BY gain_decile)
SELECT gain_decile, n, n_pos, ROUND(avg_score, 6) AS avg_score, ROUND(n_pos / n, 4) AS pos_rate,
       ROUND(ROUND(n_pos / n, 4) / (p / nn), 4) AS lift,
       ROUND(SUM(n_pos) OVER (ORDER BY gain_decile ROWS UNBOUNDED PRECEDING) / p * 100, 2) AS cum_cap_pct,
       '' AS model
FROM t"""

LIFT_CURVE = f"""WITH {SCORED}, {ranked_cte()},
params AS (SELECT ANY_VALUE(total_rows) AS n, greatest(1, ANY_VALUE(total_rows) // 200) AS step,
                  ANY_VALUE(total_pos) AS p FROM ranked),
pts AS (SELECT j * step + 1 AS i, n, p FROM (SELECT unnest(range(0, (n - 1) // step + 1)) AS j, step, n, p FROM params)),
cap AS (SELECT i, n, p, (SELECT SUM(y_true) FROM ranked WHERE pos < i) AS captured FROM pts)
SELECT i AS n_top, ROUND(i / n * 100, 6) AS pct_population, ROUND(captured / p * 100, 6) AS pct_captured,
       ROUND(CASE WHEN i / n * 100 > 0 THEN (captured / p * 100) / (i / n * 100) ELSE 1.0 END, 6) AS lift
FROM cap"""

def _lift_table_sql(p: str, model: str, tag: str) -> str:
    return f"""{ranked_cte("scored", p, "rk_" + tag)},
d_{tag} AS (SELECT *, CAST(CASE WHEN total_rows <= 1 THEN 1
                          ELSE greatest(1, ceil(10 * pos / (total_rows - 1))) END AS INTEGER) AS gain_decile FROM rk_{tag}),
t_{tag} AS (SELECT gain_decile, COUNT(*) AS n, CAST(SUM(y_true) AS BIGINT) AS n_pos, AVG({p}) AS avg_score,
             ANY_VALUE(total_pos) AS p, ANY_VALUE(total_rows) AS nn FROM d_{tag} GROUP BY gain_decile),
lt_{tag} AS (SELECT gain_decile, n, n_pos, ROUND(avg_score, 6) AS avg_score, ROUND(n_pos / n, 4) AS pos_rate,
       ROUND(ROUND(n_pos / n, 4) / (p / nn), 4) AS lift,
       ROUND(SUM(n_pos) OVER (ORDER BY gain_decile ROWS UNBOUNDED PRECEDING) / p * 100, 2) AS cum_cap_pct,
       '{model}' AS model FROM t_{tag})"""


def _centiles_sql(p: str, model: str, tag: str) -> str:
    return f"""{ranked_cte("scored", p, "ck_" + tag)},
ca_{tag} AS (SELECT c.centile, CAST(floor(ANY_VALUE(r.total_rows) * c.centile / 100) AS BIGINT) AS nt,
               CAST(SUM(CASE WHEN r.pos < floor(r.total_rows * c.centile / 100) THEN r.y_true ELSE 0 END) AS BIGINT) AS tp,
               ANY_VALUE(r.total_pos) AS p, ANY_VALUE(r.total_rows) AS n
        FROM ck_{tag} r, (SELECT unnest([1, 2, 5, 10, 20, 30, 40, 50]) AS centile) c GROUP BY c.centile),
ct_{tag} AS (SELECT '{model}' AS model, centile, nt AS n, tp AS n_pos, ROUND(tp / p * 100, 2) AS capture_pct,
       ROUND(CASE WHEN nt > 0 THEN tp / nt ELSE 0.0 END, 4) AS precision,
       ROUND(CASE WHEN p / n > 0 AND nt > 0 THEN (tp / nt) / (p / n) ELSE 0.0 END, 4) AS lift FROM ca_{tag})"""


_EV_MODELS = {"model_a": "y_proba", "model_b": "y_proba_b", "model_c": "y_proba_c"}
LIFT_TABLES = (f"WITH {SCORED}, " + ",\n".join(_lift_table_sql(p, m, m) for m, p in _EV_MODELS.items())
               + "\n" + " UNION ALL ".join(f"SELECT * FROM lt_{m}" for m in _EV_MODELS))
CENTILE_TABLES = (f"WITH {SCORED}, " + ",\n".join(_centiles_sql(p, m, m) for m, p in _EV_MODELS.items())
                  + "\n" + " UNION ALL ".join(f"SELECT * FROM ct_{m}" for m in _EV_MODELS))

PR_AUC = f"""WITH {SCORED}, {curve_cte("scored")}
SELECT ROUND(SUM(pos_s * (cum_pos / cum_n)) / SUM(pos_s), 6) AS pr_auc FROM curve_c"""

ROC_AUC = f"""WITH {SCORED},
r AS (SELECT y_true, RANK() OVER (ORDER BY y_proba) + (COUNT(*) OVER (PARTITION BY y_proba) - 1) / 2.0 AS avg_rank
      FROM scored),
a AS (SELECT SUM(CASE WHEN y_true = 1 THEN avg_rank ELSE 0 END) AS rs, SUM(y_true) AS p, COUNT(*) - SUM(y_true) AS nn FROM r)
SELECT ROUND((rs - p * (p + 1) / 2) / (p * nn), 6) AS roc_auc FROM a"""

PR_CURVE = f"WITH {SCORED}, {curve_cte('scored')} SELECT * FROM curve"

BEST_F1 = f"""WITH {SCORED}, {curve_cte('scored')}
SELECT threshold, f1 FROM curve ORDER BY f1 DESC, threshold ASC LIMIT 1"""


def _confusion_sql(src: str, thresholds_cte: str, opt: str | None) -> str:
    is_opt = f"abs(t - (SELECT t FROM {opt})) < 1e-6" if opt else "false"
    return f"""c AS (SELECT ts.t, COUNT(*) AS n,
           CAST(SUM(CASE WHEN y_proba >= ts.t AND y_true = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
           CAST(SUM(CASE WHEN y_proba >= ts.t AND y_true <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
           CAST(SUM(CASE WHEN y_proba < ts.t AND y_true = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn
    FROM {src}, {thresholds_cte} ts GROUP BY ts.t),
m AS (SELECT *, n - tp - fp - fn AS tn,
             CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS pr,
             CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS rc FROM c)
SELECT ROUND(t, 4) AS threshold, tp + fp AS n_predicted_pos, ROUND((tp + fp) / n * 100, 2) AS pct_predicted_pos,
       tp, fp, CAST(tn AS BIGINT) AS tn, fn, ROUND(pr, 4) AS precision, ROUND(rc, 4) AS recall,
       ROUND(CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END, 4) AS f1,
       {is_opt} AS is_optimal_f1
FROM m"""


THRESHOLD_SWEEP = f"""WITH {SCORED}, {HALVES}, {opt_cte("thr")},
ts AS (SELECT unnest([0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8]::DOUBLE[]) AS t UNION SELECT t FROM opt),
{_confusion_sql("test", "ts", "opt")}"""


def _model_metrics_sql(p: str, model: str) -> str:
    """One metrics row for score column ``p``: threshold from thr, everything on test."""
    tag = model
    return f"""{opt_cte("thr", p, f"opt_{tag}")},
    {ranked_cte("test", p, f"rk_{tag}")},
    lk_{tag} AS (SELECT SUM(CASE WHEN pos < floor(total_rows * CAST(0.4 AS DOUBLE)) THEN y_true ELSE 0 END)
                        / ANY_VALUE(total_pos) AS cap FROM rk_{tag}),
    {curve_cte("test", p, f"cv_{tag}")},
    ap_{tag} AS (SELECT ROUND(SUM(pos_s * (cum_pos / cum_n)) / SUM(pos_s), 4) AS pr_auc FROM cv_{tag}_c),
    rr_{tag} AS (SELECT y_true, RANK() OVER (ORDER BY {p}) + (COUNT(*) OVER (PARTITION BY {p}) - 1) / 2.0 AS avg_rank
                 FROM test),
    auc_{tag} AS (SELECT ROUND((SUM(CASE WHEN y_true = 1 THEN avg_rank ELSE 0 END) - SUM(y_true) * (SUM(y_true) + 1) / 2)
                       / (SUM(y_true) * (COUNT(*) - SUM(y_true))), 4) AS roc_auc FROM rr_{tag}),
    cm_{tag} AS (SELECT CAST(SUM(CASE WHEN {p} >= (SELECT t FROM opt_{tag}) AND y_true = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
                        CAST(SUM(CASE WHEN {p} >= (SELECT t FROM opt_{tag}) AND y_true <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
                        CAST(SUM(CASE WHEN {p} < (SELECT t FROM opt_{tag}) AND y_true = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn
                 FROM test),
    pm_{tag} AS (SELECT CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS pr,
                        CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS rc FROM cm_{tag}),
    row_{tag} AS (SELECT '{model}' AS model, ROUND(lk.cap / CAST(0.4 AS DOUBLE), 4) AS lift_40pct,
                         ROUND(lk.cap, 4) AS capture_40pct, ap.pr_auc, auc.roc_auc,
                         ROUND((SELECT t FROM opt_{tag}), 4) AS threshold,
                         ROUND(CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END, 4) AS f1,
                         ROUND(pr, 4) AS precision, ROUND(rc, 4) AS recall
                  FROM lk_{tag} lk, ap_{tag} ap, auc_{tag} auc, pm_{tag})"""


_MODELS = {"model_a": "y_proba", "model_b": "y_proba_b", "model_c": "y_proba_c"}
_MM_CTES = ",\n".join(_model_metrics_sql(p, m) for m, p in _MODELS.items())
_MM_UNION = " UNION ALL ".join(f"SELECT * FROM row_{m}" for m in _MODELS)

MODEL_METRICS = f"WITH {SCORED}, {HALVES}, {_MM_CTES}\n{_MM_UNION}"

MODEL_BENCHMARK = f"""WITH {SCORED}, {HALVES}, {_MM_CTES}, mm AS ({_MM_UNION})
SELECT *, ROW_NUMBER() OVER (ORDER BY f1 DESC, model ASC) AS position FROM mm"""

_ENSEMBLE = f"""{SCORED}, {HALVES}, {_MM_CTES}, mm AS ({_MM_UNION}),
w AS (SELECT (SELECT f1 FROM mm WHERE model = 'model_a') AS fa, (SELECT f1 FROM mm WHERE model = 'model_b') AS fb,
             (SELECT f1 FROM mm WHERE model = 'model_c') AS fc),
wn AS (SELECT fa / (fa + fb + fc) AS wa, fb / (fa + fb + fc) AS wb, fc / (fa + fb + fc) AS wc FROM w),
ens AS (SELECT key, y_true, wa * y_proba + wb * y_proba_b + wc * y_proba_c AS score_ensemble FROM scored, wn)"""

ENSEMBLE_WEIGHTED = f"WITH {_ENSEMBLE} SELECT * FROM ens"

SCORE_RANK = f"""WITH {SCORED}
SELECT key, y_proba, CAST(floor(RANK() OVER (ORDER BY y_proba DESC) + (COUNT(*) OVER (PARTITION BY y_proba) - 1) / 2.0) AS BIGINT) AS rank
FROM scored"""


def _decile_expr(score: str, edges: str) -> str:
    return "CAST(1 + " + " + ".join(f"CASE WHEN {score} > {edges}[{j}] THEN 1 ELSE 0 END" for j in range(1, 10)) + " AS INTEGER)"


_QS = "[0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]"

SCORE_DECILES = f"""WITH {SCORED}, e AS (SELECT quantile_cont(y_proba, {_QS}) AS q FROM scored),
d AS (SELECT y_true, y_proba, {_decile_expr("y_proba", "q")} AS score_decile FROM scored, e)
SELECT score_decile, COUNT(*) AS n, ROUND(AVG(y_proba), 6) AS avg_score, CAST(SUM(y_true) AS BIGINT) AS n_pos,
       ROUND(SUM(y_true) / COUNT(*), 4) AS pos_rate
FROM d GROUP BY score_decile"""

SCORE_PREDICT = f"""WITH {SCORED}, {HALVES}, {opt_cte("thr")}
SELECT key, CAST(y_proba >= (SELECT t FROM opt) AS INTEGER) AS prediction FROM scored"""

SCORE_TABLE = f"""WITH {_ENSEMBLE},
ens_thr AS (SELECT key, y_true, score_ensemble FROM ens WHERE key % 2 = 0),
{opt_cte("ens_thr", "score_ensemble", "eopt")},
e AS (SELECT quantile_cont(score_ensemble, {_QS}) AS q FROM ens)
SELECT key, y_true, score_ensemble,
       CAST(floor(RANK() OVER (ORDER BY score_ensemble DESC)
                  + (COUNT(*) OVER (PARTITION BY score_ensemble) - 1) / 2.0) AS BIGINT) AS rank,
       {_decile_expr("score_ensemble", "q")} AS score_decile,
       CAST(score_ensemble >= (SELECT t FROM eopt) AS INTEGER) AS prediction
FROM ens, e"""

ORACLE = {
    "lift_at_k": LIFT_AT_K,
    "centile_analysis": CENTILES,
    "lift_table": LIFT_TABLE,
    "lift_curve": LIFT_CURVE,
    "pr_auc": PR_AUC,
    "roc_auc": ROC_AUC,
    "pr_curve": PR_CURVE,
    "best_f1_threshold": BEST_F1,
    "threshold_sweep": THRESHOLD_SWEEP,
    "model_metrics": MODEL_METRICS,
    "model_benchmark": MODEL_BENCHMARK,
    "ensemble_weighted": ENSEMBLE_WEIGHTED,
    "score_rank": SCORE_RANK,
    "score_deciles": SCORE_DECILES,
    "score_predict": SCORE_PREDICT,
    "score_table": SCORE_TABLE,
    "lift_tables": LIFT_TABLES,
    "centile_tables": CENTILE_TABLES,
}
