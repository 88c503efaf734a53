"""Distributed rank / metric operators against brute force on small frames with ties and a hot score."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strata.operators import evaluate as ev
from strata.operators.rank import average_rank, class_positions, exact_quantiles, positions, prefix_sums


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(7)
    rows = []
    for k in range(600):
        # a third of the rows share one score (hot value); the rest are coarse, with ties
        p = 0.5 if k % 3 == 0 else round(rng.random(), 2)
        y = 1 if rng.random() < p * 0.6 else 0
        rows.append((k, y, p))
    df = spark.createDataFrame(rows, "key long, y_true int, y_proba double").repartition(5)
    return df, pd.DataFrame(rows, columns=["key", "y_true", "y_proba"])


def _sorted(pdf):
    return pdf.sort_values(["y_proba", "key"], ascending=[False, True]).reset_index(drop=True)


def test_positions_match_sort(spark, scored):
    df, pdf = scored
    got = positions(df, "y_proba", "key", "y_true", partitions=7).toPandas().sort_values("pos")
    exp = _sorted(pdf)
    assert list(got["key"]) == list(exp["key"])
    assert list(got["cum_pos"]) == list(exp["y_true"].cumsum())
    assert set(got["total_rows"]) == {600}


def test_prefix_sums_multiple_partitions(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    got = prefix_sums(df, ["id"], {"v": "v"}, partitions=9).orderBy("id").toPandas()
    assert list(got["cum_v"]) == list(np.cumsum([i % 7 for i in range(1000)]))
    assert list(got["pos"]) == list(range(1000))


def test_exact_quantiles(spark, scored):
    df, pdf = scored
    qs = [0.1, 0.25, 0.5, 0.9, 0.99, 1.0]
    got = exact_quantiles(df, "y_proba", qs, key="key", partitions=4)
    exp = np.percentile(pdf["y_proba"], [q * 100 for q in qs])
    assert np.allclose(got, exp, rtol=0, atol=1e-12)


def test_average_rank(spark, scored):
    df, pdf = scored
    got = average_rank(df, "y_proba").toPandas().set_index("key")["rank"]
    exp = pdf.set_index("key")["y_proba"].rank(ascending=False).astype(int)
    assert (got.sort_index() == exp.sort_index()).all()


def test_class_positions(spark, scored):
    df, pdf = scored
    got = class_positions(df, "y_true", [F.col("key")], partitions=3).toPandas()
    for cls, g in got.groupby("y_true"):
        assert list(g.sort_values("key")["pos_in_class"]) == list(range(len(g)))
        assert set(g["n_class"]) == {len(g)}


def _brute(pdf, k=0.4):
    s = _sorted(pdf)
    arr = s["y_true"].to_numpy()
    n_top = int(len(arr) * k)
    cap = arr[:n_top].sum() / arr.sum()
    return round(cap / k, 4), round(cap, 4)


def test_lift_at_k(spark, scored):
    df, pdf = scored
    r = ev.lift_at_k(df, 0.4).first()
    assert (r["lift"], r["capture"]) == _brute(pdf)


def test_average_precision_and_auc(spark, scored):
    df, pdf = scored
    # step-wise AP over distinct thresholds
    y, p = pdf["y_true"].to_numpy(), pdf["y_proba"].to_numpy()
    ap = 0.0
    for t in sorted(set(p), reverse=True):
        sel = p >= t
        tp = y[sel].sum()
        ap += (y[p == t].sum() / y.sum()) * (tp / sel.sum())
    assert math.isclose(ev.average_precision(df).first()["pr_auc"], round(ap, 6), abs_tol=1e-9)
    ranks = pd.Series(p).rank()
    auc = (ranks[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))
    assert math.isclose(ev.roc_auc(df).first()["roc_auc"], round(auc, 6), abs_tol=1e-9)


def test_best_f1_threshold(spark, scored):
    df, pdf = scored
    y, p = pdf["y_true"].to_numpy(), pdf["y_proba"].to_numpy()
    best = None
    for t in sorted(set(p)):
        sel = p >= t
        prec, rec = y[sel].sum() / sel.sum(), y[sel].sum() / y.sum()
        f1 = 2 * prec * rec / (prec + rec + 1e-10)
        if best is None or f1 > best[1]:
            best = (t, f1)
    r = ev.best_f1_threshold(df).first()
    assert r["threshold"] == best[0]


def test_lift_table_deciles(spark, scored):
    df, pdf = scored
    t = ev.lift_table(df).orderBy("gain_decile").toPandas()
    s = _sorted(pdf)
    s["decile"] = pd.qcut(s.index, 10, labels=False) + 1
    exp = s.groupby("decile").agg(n=("y_true", "count"), n_pos=("y_true", "sum")).reset_index()
    assert list(t["n"]) == list(exp["n"]) and list(t["n_pos"]) == list(exp["n_pos"])
    assert t["cum_cap_pct"].iloc[-1] == 100.0


def test_centiles_and_sweep(spark, scored):
    df, pdf = scored
    c = ev.centile_analysis(df).orderBy("centile").toPandas()
    s = _sorted(pdf)
    for _, r in c.iterrows():
        nt = int(len(s) * r["centile"] / 100)
        assert r["n"] == nt and r["n_pos"] == s["y_true"][:nt].sum()
    sw = ev.confusion_at(df, [0.3, 0.5], optimal=0.5).orderBy("threshold").toPandas()
    for _, r in sw.iterrows():
        pred = pdf["y_proba"] >= r["threshold"]
        assert r["tp"] == int((pred & (pdf["y_true"] == 1)).sum())
        assert r["tn"] == int((~pred & (pdf["y_true"] == 0)).sum())
    assert list(sw["is_optimal_f1"]) == [False, True, True]  # the optimum has a row of its own


def test_hot_score_is_split_across_partitions(spark):
    """A score shared by a third of the rows must not land in one task."""
    from strata.operators.rank import ordered_partitions

    n = 30000
    df = spark.range(n).select(F.col("id").alias("key"),
                               F.when(F.col("id") % 3 == 0, F.lit(0.5)).otherwise(F.rand(3)).alias("score"))
    parts = ordered_partitions(df, [F.col("score").desc(), F.col("key").asc()], partitions=6)
    sizes = [r["count"] for r in parts.groupBy("_part").count().collect()]
    assert sum(sizes) == n and len(sizes) == 6
    assert max(sizes) <= 2 * n / 6, sizes
    hot = parts.filter(F.col("score") == 0.5).select("_part").distinct().count()
    assert hot >= 2  # the hot value spans several range partitions


def test_dedup_and_features_with_hot_key(spark):
    """Results stay whole and exact when one key holds a third of the rows."""
    from strata.operators.clean import dedup
    from strata.operators.features import latest_value

    n = 9000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                               (F.col("id") % 97).alias("d"), F.col("id").cast("double").alias("v"))
    out = dedup(df, ["k"])
    assert out.count() == df.select("k").distinct().count()
    hot = out.filter(F.col("k") == 0).first()
    assert (hot.d, hot.v) == (0, 0.0)  # smallest remaining row of the hot key
    last = latest_value(df, "k", "v", "d", "last").filter(F.col("k") == 0).first()["last"]
    exp = df.filter(F.col("k") == 0).orderBy(F.col("d").desc(), F.col("v").desc()).first()["v"]
    assert last == exp


def test_prefix_sums_run_in_order_without_a_second_shuffle(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.randint(0, 50), rnd.choice([0, 1, None]), rnd.random()) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, s int, y int, w double")
    out = prefix_sums(df, [F.col("s").desc(), F.col("k")], {"y": "y", "w": "w"}, partitions=7)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan.split("BroadcastExchange")[0]  # only the offsets, a row a partition, use one
    got = sorted(out.collect(), key=lambda r: r["pos"])
    n = w = 0
    for r, (k, s, y, x) in zip(got, sorted(rows, key=lambda r: (-r[1], r[0])), strict=True):
        n, w = n + (y or 0), w + x
        assert (r["k"], r["s"], r["cum_y"]) == (k, s, n) and abs(r["cum_w"] - w) < 1e-6
    assert {r["total_y"] for r in got} == {n}
    assert prefix_sums(df.limit(0), ["s", "k"], {"y": "y"}).count() == 0
