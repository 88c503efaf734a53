"""Border over-sampling against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import smote


def points(n, width, seed, share=0.15):
    rng = np.random.default_rng(seed)
    y = (rng.random(n) < share).astype(int)
    x = rng.normal(size=(n, width)) * np.linspace(1, 3, width) + y[:, None] * 1.2
    return x, y


def frame(spark, x, y):
    rows = [(int(i), int(c), *map(float, v)) for i, (c, v) in enumerate(zip(y, x))]
    return spark.createDataFrame(rows, ", ".join(["key long", "y int", *(f"f{j} double" for j in range(x.shape[1]))])).repartition(4)


def nearest(x, own, among, m):
    out = {}
    for i in own:
        d = np.sqrt(((x[among] - x[i]) ** 2).sum(axis=1))
        order = [j for _, j in sorted(zip(d, among)) if j != i][:m]
        out[int(i)] = [int(j) for j in order]
    return out


def test_small_tables_are_exact(spark):
    x, y = points(180, 4, 1)
    names = [f"f{j}" for j in range(4)]
    df = frame(spark, x, y)
    rows = smote.vectors(df, "key", "y", names, scale=False)
    minority = np.flatnonzero(y == 1)
    near = smote.neighbours(rows, rows.where("y = 1"), 4, 10)
    got = {}
    for r in near.orderBy("query", "place").collect():
        got.setdefault(r["query"], []).append(r["neighbour"])
    want = nearest(x, minority, np.arange(180), 10)
    assert got == want
    edge = {i for i, js in want.items() if 5 <= sum(y[j] != 1 for j in js) < 10}
    assert {r["key"] for r in smote.border(rows, near, 10).collect()} == edge and 0 < len(edge) < len(minority)

    total = len(minority) + 2 * len(edge) + 3
    out = smote.oversample(df, "key", "y", names, total, scale=False)
    new = [r for r in out.collect() if r["synthetic"]]
    assert out.where("not synthetic").count() == 180 and len(new) == total - len(minority)
    close = nearest(x, sorted(edge), minority, 5)
    made = {}
    for r in new:
        assert r["key"] is None and r["y"] == 1 and r["neighbour"] in close[r["parent"]]
        a, b, p = x[r["parent"]], x[r["neighbour"]], np.array([r[c] for c in names])
        t = float((p - a) @ (b - a) / ((b - a) @ (b - a)))
        assert 0 <= t < 1 and p == pytest.approx(a + t * (b - a))
        made[r["parent"]] = made.get(r["parent"], 0) + 1
    assert set(made) == edge and set(made.values()) <= {2, 3}
    again = {(r["parent"], r["neighbour"], r["f0"]) for r in smote.oversample(df.repartition(7), "key", "y", names, total, scale=False).collect() if r["synthetic"]}
    assert again == {(r["parent"], r["neighbour"], r["f0"]) for r in new}


def test_recall_of_the_forest(spark):
    x, y = points(3000, 6, 2)
    x[:900] = x[:900].round(0)  # many ties
    x[1000:1400] = x[1000]  # and copies, more than a leaf holds
    rows = smote.vectors(frame(spark, x, y), "key", "y", [f"f{j}" for j in range(6)], scale=False).cache()
    placed = smote.leaves(rows, 6, 3000, 3, 200, 1)
    sizes = [r["count"] for r in placed.groupBy("tree", "leaf").count().collect()]
    assert max(sizes) <= 200 and sum(sizes) == 9000
    queries = [7, 333, 950, 1200, 1800, 2222, 2999]
    found = smote.neighbours(rows, rows.where(F.col("key").isin(queries)), 6, 10)
    assert smote.recall(rows, found, queries, 10) >= 0.9
    assert found.groupBy("query").count().where("count != 10").count() == 0


def test_nothing_to_make(spark):
    x, y = points(40, 2, 3)
    df = frame(spark, x, y)
    assert smote.oversample(df, "key", "y", ["f0", "f1"], 1).where("synthetic").count() == 0
    one = df.withColumn("y", (F.col("key") == 3).cast("int"))
    assert smote.oversample(one, "key", "y", ["f0", "f1"], 9).where("synthetic").count() == 0
    empty = df.limit(0)
    assert smote.oversample(empty, "key", "y", ["f0", "f1"], 9).count() == 0
    odd = df.withColumn("f0", F.when(F.col("key") % 5 != 0, F.col("f0"))).withColumn("y", F.when(F.col("key") % 7 != 0, F.col("y")))
    out = smote.oversample(odd, "key", "y", ["f0", "f1"], 12)
    assert out.where("not synthetic").count() == 40 and out.where("f0 is null or f1 is null").count() == 0


def test_rows_are_not_broadcast(spark, monkeypatch):
    """An array of features is one value to Spark's estimate: joins with all rows must not be left to it."""
    x, y = points(300, 4, 4)
    names, plans = [f"f{j}" for j in range(4)], []
    monkeypatch.setattr(smote, "store", lambda df, name: (plans.append(df), df.cache())[1])
    out = smote.oversample(frame(spark, x, y), "key", "y", names, 2 * int(y.sum()))
    assert out.where("synthetic").count() == y.sum()
    text = [df._jdf.queryExecution().optimizedPlan().toString() for df in (out, *plans)]
    joins = [line for t in text for line in t.splitlines() if " Join " in line]
    # what is broadcast by hint is one row a partition or class; nothing is left to the estimate
    assert any("strategy=merge" in j for j in joins) and all("strategy=" in j for j in joins)
