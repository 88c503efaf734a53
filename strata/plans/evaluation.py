"""Evaluation and scoring plans over the scored-orders frame (fixtures.scored_orders).

The frame stands in for model outputs: three score columns (``y_proba``,
``y_proba_b``, ``y_proba_c``) play three models. Validation is split in two
fixed halves by key parity: thresholds are chosen on the even half ("thr") and
reported on the odd half ("test"), as the honest protocol requires.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.operators import evaluate as ev
from strata.operators.rank import average_rank, exact_quantiles, value_decile
from strata.plans import fixtures as fx

MODELS = {"model_a": "y_proba", "model_b": "y_proba_b", "model_c": "y_proba_c"}


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.scored_orders(spark, sf_dir)


def halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    s = scored(spark, sf_dir)
    return s.filter(F.col("key") % 2 == 0), s.filter(F.col("key") % 2 == 1)


def optimal_threshold(df: DataFrame, p: str = "y_proba") -> float:
    """Best-F1 threshold as a number (one row reaches the driver)."""
    return float(ev.best_f1_threshold(df, p=p).first()["threshold"])


def lift_at_k(spark, sf_dir):
    return ev.lift_at_k(scored(spark, sf_dir), 0.40)


def centile_analysis(spark, sf_dir):
    return ev.centile_analysis(scored(spark, sf_dir))


def lift_table(spark, sf_dir):
    return ev.lift_table(scored(spark, sf_dir))


def lift_curve(spark, sf_dir):
    return ev.gain_curve(scored(spark, sf_dir))


def pr_auc(spark, sf_dir):
    return ev.average_precision(scored(spark, sf_dir))


def roc_auc(spark, sf_dir):
    return ev.roc_auc(scored(spark, sf_dir))


def pr_curve(spark, sf_dir):
    return ev.pr_curve(scored(spark, sf_dir))


def best_f1_threshold(spark, sf_dir):
    return ev.best_f1_threshold(scored(spark, sf_dir))


def threshold_sweep(spark, sf_dir):
    thr, test = halves(spark, sf_dir)
    return ev.confusion_at(test, ev.SWEEP_THRESHOLDS, optimal=optimal_threshold(thr))


def model_metrics(spark, sf_dir):
    thr, test = halves(spark, sf_dir)
    rows = [ev.model_metrics(test, optimal_threshold(thr, p), model=m, p=p) for m, p in MODELS.items()]
    return reduce(DataFrame.unionByName, rows)


def model_benchmark(spark, sf_dir):
    """Model rows ordered by F1 (then name), numbered from 1; bounded by the number of models."""
    m = model_metrics(spark, sf_dir)
    w = Window.orderBy(F.col("f1").desc(), F.col("model").asc())
    return m.withColumn("position", F.row_number().over(w))


def ensemble_weights(spark, sf_dir) -> dict[str, float]:
    """Weights proportional to each model's test F1 at the threshold chosen on the other half."""
    thr, test = halves(spark, sf_dir)
    f1 = {m: ev.confusion_at(test, [optimal_threshold(thr, p)], p=p).first()["f1"] for m, p in MODELS.items()}
    total = 0.0
    for m in MODELS:
        total += f1[m]
    return {m: f1[m] / total for m in MODELS}


def ensemble_weighted(spark, sf_dir):
    """Weighted mean of the model scores, weights proportional to each model's test F1."""
    w = ensemble_weights(spark, sf_dir)
    s = scored(spark, sf_dir)
    expr = None
    for m, col in MODELS.items():
        term = F.lit(w[m]) * F.col(col)
        expr = term if expr is None else expr + term
    return s.select("key", "y_true", expr.alias("score_ensemble"))


def score_rank(spark, sf_dir):
    s = scored(spark, sf_dir).select("key", "y_proba")
    return average_rank(s, "y_proba", "rank")


def _deciled(spark, sf_dir):
    s = scored(spark, sf_dir)
    edges = exact_quantiles(s, "y_proba", [j / 10 for j in range(1, 10)], key="key")
    return s.withColumn("score_decile", value_decile(F.col("y_proba"), edges))


def score_deciles(spark, sf_dir):
    d = _deciled(spark, sf_dir)
    return d.groupBy("score_decile").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("y_proba"), 6).alias("avg_score"),
        F.sum("y_true").cast("long").alias("n_pos"),
        F.round(F.sum("y_true") / F.count(F.lit(1)), 4).alias("pos_rate"),
    )


def score_predict(spark, sf_dir):
    thr, _ = halves(spark, sf_dir)
    t = optimal_threshold(thr)
    return scored(spark, sf_dir).select("key", (F.col("y_proba") >= F.lit(t)).cast("int").alias("prediction"))


def score_table(spark, sf_dir):
    """Full-base scoring output: ensemble score, average rank, value decile, yes/no; best first."""
    ens = ensemble_weighted(spark, sf_dir)
    thr_half = ens.filter(F.col("key") % 2 == 0)
    t = optimal_threshold(thr_half, "score_ensemble")
    edges = exact_quantiles(ens, "score_ensemble", [j / 10 for j in range(1, 10)], key="key")
    ranked = average_rank(ens, "score_ensemble", "rank")
    return ranked.select(
        "key", "y_true", "score_ensemble", "rank",
        value_decile(F.col("score_ensemble"), edges).alias("score_decile"),
        (F.col("score_ensemble") >= F.lit(t)).cast("int").alias("prediction"),
    ).orderBy(F.col("score_ensemble").desc(), F.col("key").asc())


def lift_tables(spark, sf_dir):
    """Lift tables of every model in one frame (union by name), labelled by model."""
    s = scored(spark, sf_dir)
    return reduce(DataFrame.unionByName, [ev.lift_table(s, p=p, model=m) for m, p in MODELS.items()])


def centile_tables(spark, sf_dir):
    s = scored(spark, sf_dir)
    return reduce(DataFrame.unionByName, [ev.centile_analysis(s, p=p, model=m) for m, p in MODELS.items()])
