"""Ranking and classification metrics over a scored frame ``(key, y_true, y_proba)``.

Everything is a DataFrame job: position-based metrics (lift@k, centiles, lift
table, gain curve) use exact global positions from ``rank.positions``;
threshold-based metrics (average precision, ROC AUC, best-F1 threshold, PR curve)
use one row per distinct score with distributed prefix sums. Ties in position
metrics are broken by the key (score desc, key asc).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.rank import position_decile, positions, score_stats

# Report cut-offs and the F1 smoothing constant.
CENTILES = [1, 2, 5, 10, 20, 30, 40, 50]
SWEEP_THRESHOLDS = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8]
F1_EPS = 1e-10
LIFT_K = 0.40


def _stack(df: DataFrame, rows: list[tuple[Column, ...]], names: list[str]) -> DataFrame:
    """Turn one wide row into several rows (array of structs + explode)."""
    arr = F.array(*(F.struct(*(c.alias(n) for c, n in zip(r, names))) for r in rows))
    return df.select(F.explode(arr).alias("_r")).select(*(F.col(f"_r.{n}").alias(n) for n in names))


# ------------------------------------------------------------------ position metrics
def ranked(scored: DataFrame, key: str = "key", y: str = "y_true", p: str = "y_proba") -> DataFrame:
    return positions(scored.select(key, y, p), p, key, y)


def lift_at_k(scored: DataFrame, k: float = LIFT_K, key="key", y="y_true", p="y_proba") -> DataFrame:
    """``cap`` = positives in the top int(n*k) rows / all positives; ``lift`` = cap / k (4 digits)."""
    r = ranked(scored, key, y, p)
    cut = F.floor(F.col("total_rows") * F.lit(float(k)))
    agg = r.agg(
        F.sum(F.when(F.col("pos") < cut, F.col(y)).otherwise(0)).alias("_tp"),
        F.first("total_pos").alias("_p"),
    )
    cap = F.try_divide("_tp", "_p")
    return agg.select(
        F.lit(float(k)).alias("k"),
        F.round(cap / F.lit(float(k)), 4).alias("lift"),
        F.round(cap, 4).alias("capture"),
    )


def centile_analysis(scored: DataFrame, centiles: Sequence[int] = CENTILES, key="key", y="y_true", p="y_proba",
                     model: str = "") -> DataFrame:
    r = ranked(scored, key, y, p)
    n = F.col("total_rows")
    cuts = {c: F.floor(n * c / 100) for c in centiles}
    wide = r.agg(
        F.first("total_rows").alias("_n"),
        F.first("total_pos").alias("_p"),
        *(F.sum(F.when(F.col("pos") < cuts[c], F.col(y)).otherwise(0)).alias(f"_tp{c}") for c in centiles),
    )
    rows = []
    for c in centiles:
        nt = F.floor(F.col("_n") * c / 100)
        tp = F.col(f"_tp{c}")
        rate = F.try_divide("_p", "_n")
        prec = F.when(nt > 0, F.try_divide(tp, nt)).otherwise(F.lit(0.0))
        rows.append((
            F.lit(model), F.lit(c), nt.cast("long"), tp.cast("long"),
            F.round(F.try_divide(tp, F.col("_p")) * 100, 2),
            F.round(prec, 4),
            F.round(F.when((rate > 0) & (nt > 0), F.try_divide(F.try_divide(tp, nt), rate)).otherwise(F.lit(0.0)), 4),
        ))
    return _stack(wide, rows, ["model", "centile", "n", "n_pos", "capture_pct", "precision", "lift"])


def lift_table(scored: DataFrame, key="key", y="y_true", p="y_proba", model: str = "") -> DataFrame:
    """Ten equal-count position deciles (1 = highest scores): n, positives, mean score, rate,
    lift on the rounded rate, cumulative capture %."""
    r = ranked(scored, key, y, p).withColumn("gain_decile", position_decile(F.col("pos"), F.col("total_rows")))
    t = r.groupBy("gain_decile").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(y).cast("long").alias("n_pos"),
        F.avg(p).alias("avg_score"),
        F.first("total_pos").alias("_p"),
        F.first("total_rows").alias("_n"),
    )
    # ten rows: an unpartitioned window is bounded here
    cum = Window.orderBy("gain_decile").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rate = F.try_divide("_p", "_n")
    pos_rate = F.round(F.col("n_pos") / F.col("n"), 4)
    return t.select(
        "gain_decile", "n", "n_pos", F.round("avg_score", 6).alias("avg_score"),
        pos_rate.alias("pos_rate"),
        F.round(F.try_divide(pos_rate, rate), 4).alias("lift"),
        F.round(F.try_divide(F.sum("n_pos").over(cum), F.col("_p")) * 100, 2).alias("cum_cap_pct"),
        F.lit(model).alias("model"),
    )


def gain_curve(scored: DataFrame, points: int = 200, key="key", y="y_true", p="y_proba") -> DataFrame:
    """Cumulative gain and lift at every ``step = max(1, n // points)`` rows: population %, captured %, lift."""
    r = ranked(scored, key, y, p)
    row = r.select("total_rows").first()
    n = row[0] if row else 0
    step = max(1, n // points)
    n_points = (n - 1) // step + 1 if n else 0  # i = 1, 1+step, ... <= n
    # a row at position pos is inside the top i rows for every point j with 1 + j*step > pos
    first_point = F.ceil(F.col("pos") / F.lit(step)).cast("long")
    hits = r.groupBy(first_point.alias("j")).agg(F.sum(y).alias("_hits"))
    # at most n_points + 1 buckets: windows over them are bounded
    hits = hits.withColumn("_p", F.sum("_hits").over(Window.partitionBy(F.lit(0))))
    grid = scored.sparkSession.range(n_points).withColumnRenamed("id", "j")
    cum = Window.orderBy("j").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    curve = (
        grid.join(hits, "j", "left")
        .withColumn("_p", F.max("_p").over(Window.partitionBy(F.lit(0))))
        .withColumn("i", F.col("j") * step + 1)
        .withColumn("captured", F.sum(F.coalesce("_hits", F.lit(0))).over(cum))
    )
    pct_pop = F.try_divide(F.col("i"), F.lit(n)) * 100
    pct_cap = F.try_divide("captured", "_p") * 100
    return curve.select(
        F.col("i").alias("n_top"),
        F.round(pct_pop, 6).alias("pct_population"),
        F.round(pct_cap, 6).alias("pct_captured"),
        F.round(F.when(pct_pop > 0, F.try_divide(pct_cap, pct_pop)).otherwise(F.lit(1.0)), 6).alias("lift"),
    )


# ------------------------------------------------------------------ threshold metrics
def _stats(scored: DataFrame, y: str, p: str) -> DataFrame:
    return score_stats(scored.select(y, p), p, y)


def average_precision(scored: DataFrame, y="y_true", p="y_proba", digits: int = 6) -> DataFrame:
    """Step-wise AP: sum over distinct thresholds of (recall gain) * precision."""
    s = _stats(scored, y, p)
    return s.agg(
        F.round(F.try_divide(F.sum(F.col("pos_s") * (F.col("cum_pos") / F.col("cum_n"))), F.sum("pos_s")), digits).alias("pr_auc")
    )


def roc_auc(scored: DataFrame, y="y_true", p="y_proba", digits: int = 6) -> DataFrame:
    """Rank-sum (Mann-Whitney) AUC with average ranks for ties."""
    s = _stats(scored, y, p)
    agg = s.agg(
        F.sum("n_s").alias("_n"),
        F.sum("pos_s").alias("_p"),
        # rank from below of score s = rows below + (ties + 1) / 2
        F.sum(F.col("pos_s") * ((F.col("total_n") - F.col("cum_n")) + (F.col("n_s") + 1) / 2)).alias("_ranksum"),
    )
    p_, n_ = F.col("_p"), F.col("_n") - F.col("_p")
    return agg.select(F.round(F.try_divide(F.col("_ranksum") - p_ * (p_ + 1) / 2, p_ * n_), digits).alias("roc_auc"))


def pr_curve(scored: DataFrame, y="y_true", p="y_proba") -> DataFrame:
    """Precision, recall and F1 at every distinct score taken as threshold (score >= t)."""
    s = _stats(scored, y, p)
    prec = F.col("cum_pos") / F.col("cum_n")
    rec = F.try_divide("cum_pos", "total_pos")
    return s.select(
        F.col(p).alias("threshold"),
        F.col("cum_pos").alias("tp"),
        (F.col("cum_n") - F.col("cum_pos")).alias("fp"),
        prec.alias("precision"),
        rec.alias("recall"),
        (F.lit(2.0) * prec * rec / (prec + rec + F.lit(F1_EPS))).alias("f1"),
    )


def best_f1_threshold(scored: DataFrame, y="y_true", p="y_proba") -> DataFrame:
    """The threshold maximising F1 = 2PR/(P+R+1e-10); the lowest threshold wins ties."""
    c = pr_curve(scored, y, p)
    return c.orderBy(F.col("f1").desc(), F.col("threshold").asc()).limit(1).select("threshold", "f1")


def confusion_at(scored: DataFrame, thresholds: Sequence[float], y="y_true", p="y_proba",
                 optimal: float | None = None) -> DataFrame:
    """tp/fp/tn/fn, precision, recall, F1 and predicted share for each threshold (one pass)."""
    # an optimum equal to a fixed threshold keeps a row of its own
    ts = sorted([*{float(t) for t in thresholds}, *([float(optimal)] if optimal is not None else [])])
    yc, pc = F.col(y), F.col(p)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, t in enumerate(ts):
        pred = pc >= F.lit(t)
        aggs += [
            F.sum(F.when(pred & (yc == 1), 1).otherwise(0)).alias(f"_tp{i}"),
            F.sum(F.when(pred & (yc != 1), 1).otherwise(0)).alias(f"_fp{i}"),
            F.sum(F.when(~pred & (yc == 1), 1).otherwise(0)).alias(f"_fn{i}"),
        ]
    wide = scored.agg(*aggs)
    rows = []
    for i, t in enumerate(ts):
        tp, fp, fn = F.col(f"_tp{i}"), F.col(f"_fp{i}"), F.col(f"_fn{i}")
        tn = F.col("_n") - tp - fp - fn
        prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
        rec = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
        f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
        rows.append((
            F.lit(round(t, 4)), (tp + fp).cast("long"), F.round(F.try_divide(tp + fp, F.col("_n")) * 100, 2),
            tp.cast("long"), fp.cast("long"), tn.cast("long"), fn.cast("long"),
            F.round(prec, 4), F.round(rec, 4), F.round(f1, 4),
            F.lit(optimal is not None and abs(t - optimal) < 1e-6),
        ))
    names = ["threshold", "n_predicted_pos", "pct_predicted_pos", "tp", "fp", "tn", "fn",
             "precision", "recall", "f1", "is_optimal_f1"]
    return _stack(wide, rows, names)


def model_metrics(scored: DataFrame, threshold: float, model: str = "", k: float = LIFT_K,
                  y="y_true", p="y_proba", key="key") -> DataFrame:
    """One evaluation row: lift/capture at k, AP, AUC, threshold, F1, precision, recall."""
    kk = int(round(k * 100))
    cm = confusion_at(scored, [threshold], y, p)
    lk = lift_at_k(scored, k, key=key, y=y, p=p)
    parts = [
        lk.select(F.lit(f"lift_{kk}pct").alias("metric"), F.col("lift").alias("value")),
        lk.select(F.lit(f"capture_{kk}pct").alias("metric"), F.col("capture").alias("value")),
        average_precision(scored, y, p, 4).select(F.lit("pr_auc").alias("metric"), F.col("pr_auc").alias("value")),
        roc_auc(scored, y, p, 4).select(F.lit("roc_auc").alias("metric"), F.col("roc_auc").alias("value")),
        *(cm.select(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("f1", "precision", "recall")),
    ]
    names = [f"lift_{kk}pct", f"capture_{kk}pct", "pr_auc", "roc_auc", "f1", "precision", "recall"]
    long = reduce(DataFrame.unionByName, parts).withColumn("model", F.lit(model))
    wide = long.groupBy("model").pivot("metric", names).agg(F.first("value"))
    return wide.select("model", *names[:4], F.lit(round(threshold, 4)).alias("threshold"), *names[4:])
