"""What one task holds, and how many tasks a short table costs."""

import threading

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.operators import boost, smote, stacking, train
from strata.operators.rank import ordered_partitions, positions
from strata.plans import gold, lake


def test_a_short_table_is_ordered_in_few_tasks(spark):
    df = spark.range(500).select("id", (F.col("id") % 7).alias("s"))
    parts = ordered_partitions(df, [F.col("s").desc(), F.col("id")])
    assert parts.select("_part").distinct().count() < int(spark.conf.get("spark.sql.shuffle.partitions"))
    got = [r["id"] for r in positions(df, "s", "id").orderBy("pos").collect()]
    assert got == sorted(range(500), key=lambda i: (-(i % 7), i))


def test_a_fit_reads_bounded_tasks(spark):
    df = spark.range(0, 1000, 1, 2)
    assert train.spread(df, 100).rdd.getNumPartitions() == 10 and train.spread(df, 100).count() == 1000
    assert train.spread(df, 600).rdd.getNumPartitions() == 2


def test_fits_run_side_by_side_in_order(spark):
    meet = threading.Barrier(3, timeout=60)
    assert train.side_by_side(spark, [lambda k=k: (meet.wait(), k)[1] for k in range(3)], 3) == [0, 1, 2]

    def fails():
        raise ValueError("a fit")

    with pytest.raises(ValueError, match="a fit"):
        train.side_by_side(spark, [fails])


def test_a_model_is_cut_off_the_main_thread(spark):
    df = train.assemble(spark.range(200).select((F.col("id") % 2).cast("double").alias("y"), (F.col("id") % 5).cast("double").alias("x")), ["x"])
    model, losses = train.side_by_side(spark, [lambda: boost.fit_stopped(train.gbt("y", max_iter=3), df, df, 2)])[0]
    assert len(losses) == 3 and 1 <= model.getNumTrees <= 3


def test_the_base_is_dealt_out_by_key(spark):
    tables = {"perimetre": spark.range(100).withColumnRenamed("id", "RADICAL"), "other": spark.range(3)}
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    few, many = (gold.dealt(tables, n)["perimetre"] for n in (99, 4))
    assert gold.dealt(tables, 100) is tables
    assert few.rdd.getNumPartitions() == least and many.rdd.getNumPartitions() == 25 and many.count() == 100
    sums = spark.range(300).groupBy((F.col("id") % 100).alias("RADICAL")).count()
    tasks = few.join(sums.hint("merge"), "RADICAL").select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks == least  # adaptive execution does not join them


def test_buckets_grow_with_the_longest_table():
    assert lake.bucket_number([10, 90], 16, 10) == 16 and lake.bucket_number([10, 901], 16, 10) == 91
    assert lake.bucket_number([0], 16) == 16


def test_nearest_rows_of_a_leaf():
    rng = np.random.default_rng(5)
    x, keys = rng.integers(0, 4, size=(40, 3)).astype(float), [*range(30), *range(10)]  # ties, and ten keys that come twice
    asked = [k % 3 == 0 for k in keys]
    leaf = pa.table({"key": pa.array(keys, pa.int64()), "row": range(40), "asked": asked, "vec": pa.array(x.tolist(), pa.list_(pa.float64()))})
    got = {}
    for r in smote._nearest(5, block=4)(leaf).to_pylist():
        got.setdefault(r["row"], []).append((r["distance"], r["neighbour"], r["other"]))
        assert r["query"] == keys[r["row"]]
    far = lambda i, j: float(np.sqrt(((x[i] - x[j]) ** 2).sum()))
    want = {i: sorted((far(i, j), keys[j], j) for j in range(40) if keys[j] != keys[i])[:5] for i in range(40) if asked[i]}
    assert got == want


def test_a_key_that_comes_twice(spark):
    rows = spark.createDataFrame([(1, [0.0]), (1, [4.0]), (2, [1.0]), (3, [5.0]), (None, [0.5])], "key long, vec array<double>")
    near = smote.neighbours(rows, rows.where("key = 1"), 1, 3)
    assert [tuple(r) for r in near.orderBy("place").select("query", "neighbour", "distance", "place").collect()] == [
        (1, 2, 1.0, 1), (1, 3, 1.0, 2), (1, 2, 3.0, 3)]


def _learnable(spark, n=300):
    own = spark.range(0, n, 1, 2).withColumnRenamed("id", "key")
    return own.select("key", (F.col("key") % 3 == 0).cast("int").alias("y"), (F.col("key") % 3).cast("double").alias("a"),
                      (F.col("key") % 5).cast("double").alias("b"), (F.col("key") % 7).cast("double").alias("c"))


def test_a_round_is_judged_beside_the_next_fit(spark, monkeypatch):
    df, begun, whole = _learnable(spark), [], train.ev.lift_at_k
    second = threading.Event()

    def forest():
        begun.append(1)
        if len(begun) > 1:
            second.set()
        return train.random_forest("y", trees=3, max_depth=2)

    def judged(*args, **options):
        assert second.wait(60)  # the first round's judgement meets the second round's fit
        return whole(*args, **options)

    monkeypatch.setattr(train.ev, "lift_at_k", judged)
    rounds = train.rfe(forest, df, df, ["a", "b", "c"], "key", "y", drop_fraction=0.3, min_features=1).orderBy("round").collect()
    assert [(r["round"], r["n_features"], len(r["features"])) for r in rounds] == [(0, 3, 3), (1, 2, 2), (2, 1, 1)]
    assert rounds[2]["features"] == ["a"] and rounds[2]["best"] and rounds[2]["pr_auc"] == 1.0


def test_permuted_rows_are_scored_in_bounded_tasks(spark, monkeypatch):
    df, feats = _learnable(spark), ["a", "b", "c"]
    monkeypatch.setattr(train, "VARIANTS_A_TASK", 150)
    kept, made = [], train._permuted
    monkeypatch.setattr(train, "_permuted", lambda *args: kept.append(made(*args)) or kept[-1])
    model = train.fit(train.gbt("y", max_iter=2, max_depth=2), df, feats)
    drops = {r["feature"]: r["perm_importance"] for r in train.permutation_importance(model, df, feats, "key", "y", 2, buckets=64).collect()}
    assert drops["a"] > 0.1 and drops["b"] == drops["c"] == 0
    assert len(kept) == 2
    for long in kept:  # six tasks by their rows, and not fewer
        assert long.count() == 900 and long.select(F.spark_partition_id()).distinct().count() == 6


def test_folds_are_scored_side_by_side(spark, monkeypatch):
    meet, whole = threading.Barrier(3, timeout=60), stacking.scores_of

    def scores(*args):
        meet.wait()
        return whole(*args)

    monkeypatch.setattr(stacking, "scores_of", scores)
    held = stacking.out_of_fold({"gbt": lambda: train.gbt("y", max_iter=2, max_depth=2)}, _learnable(spark), ["a", "b", "c"], "key", "y", 3)
    assert held.count() == 300 and sorted(r["count"] for r in held.groupBy("fold").count().collect()) == [99, 100, 101]


def test_rows_of_a_fold_are_kept_while_its_fits_read_them(spark):
    seen = []

    class Noted:
        def fit(self, df):
            seen.append((df, df.storageLevel.useMemory and df.storageLevel.useDisk, set(df.columns)))
            return train.gbt("y", max_iter=2, max_depth=2).fit(df)

    bases, df = {"one": Noted, "two": Noted}, _learnable(spark)
    models, _, held = stacking.stacked(bases, train.gbt("y", max_iter=1), df, ["a", "b", "c"], "key", "y", 3)
    assert set(models) == set(bases) and held.count() == 300
    assert len(seen) == 8 and all(kept for _, kept, _ in seen)  # three folds and the whole, two fits each
    assert all({"key", "y", "a", "b", "c", train.FEATURES} <= columns for _, _, columns in seen)  # a base may read any column
    assert not any(df.storageLevel.useMemory for df, _, _ in seen)  # and let go after them
