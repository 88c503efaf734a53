"""Rows and digits that earlier versions lost: null labels, nulls beside a pair, small amounts, hot values, blanks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.functions.aggs import money_avg, money_sum
from strata.operators import evaluate as ev
from strata.operators import prep, profile, train
from strata.operators.clean import dedup
from strata.streaming.ingest import FixedField, parse_fixed_width


def test_null_labels_stay(spark):
    df = spark.createDataFrame([(i, i % 2 if i % 5 else None) for i in range(100)], "k long, y int")
    assert prep.stratified_split(df, "y", "k", 0.2).count() == 100
    assert prep.undersample(df, "y", "k", {0: 3}).where("y is null").count() == 20
    w = prep.class_weight(df, "y", "balanced")
    assert w.count() == 100 and w.where("weight is null").count() == 0


def test_correlations_are_pairwise(spark):
    rows = [(float(i), float(i % 7) if i % 3 else None, 3.0 * i + (i % 2), 5.0, None) for i in range(60)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double")
    got = {(r[0], r[1]): r[2] for r in profile.corr_pairs(df, ["a", "b", "c", "d", "e"], digits=9).collect()}
    want = df.toPandas().corr()
    for (x, y), v in got.items():
        w = want.loc[x, y]
        assert (v is None) == (w != w) and (v is None or v == pytest.approx(w, abs=1e-8)), (x, y)
    assert profile.corr_pairs(df.limit(0), ["a", "b"]).collect() == [("a", "b", None)]


def test_money_keeps_small_and_huge_amounts(spark):
    df = spark.createDataFrame([("s", 0.00004), ("s", 0.00004), ("b", 1e17), ("b", 1.0), ("h", 1e35), ("h", 1e35), ("n", None)],
                               "g string, v double")
    got = {r["g"]: (r["s"], r["a"]) for r in df.groupBy("g").agg(money_sum("v").alias("s"), money_avg("v").alias("a")).collect()}
    assert got["s"] == (0.00008, 0.00004) and got["b"][0] == 1e17 + 1 and got["h"][0] == 2e35 and got["n"] == (None, None)


def test_metrics_without_positives_or_rows(spark):
    none = spark.createDataFrame([(i, 0, i / 10) for i in range(10)], "key long, y_true int, y_proba double")
    for df in (none, none.limit(0)):
        assert ev.lift_at_k(df).first()["lift"] is None
        assert ev.average_precision(df).first()["pr_auc"] is None
        assert ev.roc_auc(df).first()["roc_auc"] is None
        for f in (ev.lift_table, ev.centile_analysis, ev.pr_curve, ev.gain_curve, ev.best_f1_threshold):
            f(df).collect()
    assert prep.class_weight(none, "y_true").where("weight is null").count() == 0


def test_an_optimum_on_a_fixed_threshold_keeps_its_row(spark):
    df = spark.createDataFrame([(1, 1, 0.5), (2, 0, 0.2)], "key long, y_true int, y_proba double")
    rows = ev.confusion_at(df, ev.SWEEP_THRESHOLDS, optimal=0.5).collect()
    assert len(rows) == len(ev.SWEEP_THRESHOLDS) + 1 and sum(r["is_optimal_f1"] for r in rows) == 2


def test_percentiles_count_equal_values_first(spark):
    from strata.operators import selection

    values = [0.0] * 900 + [float(i) for i in range(100)]
    df = spark.createDataFrame([(v, -v if i % 2 else None) for i, v in enumerate(values)], "a double, b double")
    qs = [0.0, 0.5, 0.9, 0.951, 0.99, 1.0]
    got = {r["column"]: [r[f"q{i}"] for i in range(len(qs))] for r in profile.exact_percentiles(df, ["a", "b"], qs).collect()}
    for c, want in df.toPandas().quantile(qs).items():
        assert got[c] == pytest.approx(list(want))
    plan = df.sparkSession._jvm.PythonSQLUtils.explainString(
        selection.value_counts(df, {("a", 5): (0.0, 9.0)})._jdf.queryExecution(), "simple")
    assert "partial_count" in plan


def test_blank_fixed_width_fields(spark):
    fields = [FixedField("id", 1, 3, "int", nullable=False), FixedField("v", 4, 3, "int")]
    lines = spark.createDataFrame([("001  7",), ("002   ",), ("   123",), ("003 x ",), ("0041",)], "value string")
    assert [r["_valid"] for r in parse_fixed_width(lines, fields).collect()] == [True, True, False, False, False]


def test_dedup_prefers_filled_rows(spark):
    df = spark.createDataFrame([(1, None, None), (1, 5, dt.date(2020, 1, 1)), (2, None, None)], "k int, a int, d date")
    assert {r["k"]: r["a"] for r in dedup(df, ["k"]).collect()} == {1: 5, 2: None}


def test_text_features_are_an_error(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "k int, name string, v double")
    with pytest.raises(ValueError, match="name"):
        train.feature_columns(df, ["k"])
    assert train.feature_columns(df, ["k", "name"]) == ["v"]


def test_sample_is_exact(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    got = {r["k"] for r in prep.sample_n(df, 137, "k").collect()}
    order = [r["k"] for r in df.orderBy(prep.hash_order("k"), "k").limit(137).collect()]
    assert got == set(order) and prep.sample_n(df, 9000, "k").count() == 5000


def test_elimination_stops_and_marks_the_best(spark):
    rows = [(i, i % 2, *[float((i * (j + 3)) % 11) + (i % 2) * (j < 2) for j in range(12)]) for i in range(200)]
    cols = [f"f{j}" for j in range(12)]
    df = spark.createDataFrame(rows, "k long, y int, " + ", ".join(f"{c} double" for c in cols))
    out = train.rfe(lambda: train.random_forest("y", trees=5, max_depth=3), df, df, cols, "k", "y").collect()
    assert [r["n_features"] for r in out] == [12, 11, 10] and sum(r["best"] for r in out) == 1
    assert all(r["capture"] is not None and r["pr_auc"] is not None for r in out)
    best = spark.createDataFrame(out)
    assert train.consensus([best, best]).count() == next(r["n_features"] for r in out if r["best"])


def test_permutation_changes_one_feature_at_a_time(spark):
    df = spark.createDataFrame([(i, float(i), float(-i)) for i in range(40)], "k long, a double, b double")
    out = train._permuted(df, ["a", "b"], "k", 1, 3).select("k", "_feature", F.col("features")).collect()
    assert len(out) == 80
    for f, at in (("a", 0), ("b", 1)):
        own = {r["k"]: r["features"].toArray() for r in out if r["_feature"] == f}
        assert all(v[1 - at] == (k if at == 1 else -k) for k, v in own.items())  # the other one is untouched
        assert sorted(v[at] for v in own.values()) == sorted((1 - 2 * at) * k for k in own)  # a permutation
        assert sum(v[at] != (1 - 2 * at) * k for k, v in own.items()) > 20


def test_sample_of_rows_without_a_key(spark):
    df = spark.createDataFrame([(i if i < 10 else None, i) for i in range(60)], "k long, v long").repartition(3)
    for n in (5, 25, 55, 60):
        got = [r["v"] for r in prep.sample_n(df, n, "k").collect()]
        assert len(got) == len(set(got)) == n
