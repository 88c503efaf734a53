"""Adaptive boosting, early stopping, the search and stacking, each against plain Python."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param.shared import HasProbabilityCol
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from strata.operators import boost, search, stacking, train


def table(n=240, seed=5):
    """(key, y, x0 .. x3): few distinct values, a noisy label."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        x = [rnd.randint(0, k) for k in (9, 7, 5, 3)]
        y = int(x[0] + 0.9 * x[1] - 1.3 * x[2] + 2.1 * rnd.random() * x[3] > 5.0)
        rows.append((i, y, *map(float, x)))
    return rows


X = ["x0", "x1", "x2", "x3"]
SCHEMA = "key long, y int, x0 double, x1 double, x2 double, x3 double"


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(table(), SCHEMA).repartition(4).cache()


@pytest.fixture(scope="module")
def assembled(frame):
    return train.assemble(frame, X).cache()


# ------------------------------------------------------------- adaptive boosting

def stump(x, y, w):
    """(feature, threshold, left, right) of the split with the lowest weighted Gini impurity."""
    def impurity(a, b):
        return 2 * a * b / (a + b) if a + b else 0.0

    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for t in (values[1:] + values[:-1]) / 2:
            left = x[:, f] <= t
            lp, ln, rp, rn = (w[m & (y == c)].sum() for m in (left, ~left) for c in (1, 0))
            cost = impurity(lp, ln) + impurity(rp, rn)
            if best is None or cost < best[0] - 1e-12:
                best = (cost, f, t, int(lp > ln), int(rp > rn))
    return best[1:]


def samme(x, y, w, rounds, step):
    stages, w = [], w / w.sum()
    for _ in range(rounds):
        f, t, left, right = stump(x, y, w)
        said = np.where(x[:, f] <= t, left, right)
        error = w[said != y].sum() / w.sum()
        if error >= 0.5:
            break
        stages.append((f, t, left, right, step * math.log((1 - error) / error), error))
        w = w * np.where(said != y, math.exp(stages[-1][4]), 1.0)
        w = w / w.sum()
    return stages


def samme_scores(stages, x):
    votes = sum(a * (2 * np.where(x[:, f] <= t, left, right) - 1) for f, t, left, right, a, _ in stages)
    return 1 / (1 + np.exp(-2 * votes / sum(s[4] for s in stages)))


@pytest.mark.parametrize("weighted", [False, True])
def test_adaboost_equals_plain_samme(assembled, weighted):
    rows = np.array(table())
    x, y = rows[:, 2:], rows[:, 1].astype(int)
    w = np.where(y == 1, 2.5, 1.0) if weighted else np.ones(len(y))
    want = samme(x, y, w, 6, 0.7)
    df = assembled.withColumn("w", F.when(F.col("y") == 1, 2.5).otherwise(1.0))
    model = boost.AdaBoostClassifier(labelCol="y", weightCol="w" if weighted else None, maxIter=6, stepSize=0.7).fit(df)
    assert model.errors == pytest.approx([s[5] for s in want], abs=1e-9)
    assert model.stages == pytest.approx([s[4] for s in want], abs=1e-9)
    got = {r["key"]: r["probability"][1] for r in model.transform(df).select("key", "probability").collect()}
    assert [got[i] for i in range(len(y))] == pytest.approx(samme_scores(want, x).tolist(), abs=1e-9)
    share = np.zeros(4)
    for f, _, left, right, stage, _ in want:
        share[f] += stage * (left != right)  # a tree that says the same on both sides uses no feature
    assert boost.importances(model, 4) == pytest.approx(share / sum(s[4] for s in want))


def test_adaboost_stops_early(spark, tmp_path):
    exact = train.assemble(spark.createDataFrame([(i, int(i >= 5), float(i)) for i in range(10)], "key long, y int, x double"), ["x"])
    model = boost.AdaBoostClassifier(labelCol="y", maxIter=9).fit(exact)
    assert model.errors == [0.0] and model.stages == [1.0]
    odd = train.assemble(spark.createDataFrame([(0, 0, 1.0), (1, 1, 1.0)] * 5, "key long, y int, x double"), ["x"])
    with pytest.raises(boost.WeakStage):
        boost.AdaBoostClassifier(labelCol="y", maxIter=3).fit(odd)
    with pytest.raises(boost.WeakStage):
        boost.deepening(lambda d: boost.AdaBoostClassifier(labelCol="y", maxDepth=d), odd, [1, 2])
    with pytest.raises(ValueError, match="no row"):
        boost.AdaBoostClassifier(labelCol="y", weightCol="w").fit(exact.withColumn("w", F.lit(0.0)))
    found, depth = boost.deepening(lambda d: boost.AdaBoostClassifier(labelCol="y", maxDepth=d, maxIter=2), exact, [1, 2])
    assert depth == 1 and len(found.trees) == 1


def test_deeper_trees_where_a_stump_has_no_stage(spark):
    """Two classes on the corners of a square: one split is a guess, two are exact."""
    rows = [(i, (i // 2 + i) % 2, float(i % 2), float(i // 2 % 2)) for i in range(40)]
    square = train.assemble(spark.createDataFrame([(k, int(a != b), a, b) for k, _, a, b in rows], "key long, y int, a double, b double"), ["a", "b"])
    make = lambda d: boost.AdaBoostClassifier(labelCol="y", maxDepth=d, maxIter=3)
    with pytest.raises(boost.WeakStage):
        make(1).fit(square)
    # the first split of a tree brings no gain here either, so no depth has a stage: the error says so
    with pytest.raises(boost.WeakStage, match="any depth"):
        boost.deepening(make, square, [1, 2])


def test_adaboost_is_saved_and_loaded(assembled, tmp_path):
    model = boost.AdaBoostClassifier(labelCol="y", maxIter=4, maxDepth=2).fit(assembled)
    model.save(f"{tmp_path}/ada")
    again = boost.AdaBoostModel.load(f"{tmp_path}/ada")
    a, b = (sorted((r["key"], r["probability"][1]) for r in m.transform(assembled).select("key", "probability").collect())
            for m in (model, again))
    assert a == b and again.stages == model.stages


# ------------------------------------------------------------- early stopping

def test_best_round_with_patience():
    assert boost.best_round([3, 2, 1, 2, 2, 0.5], 2) == 3
    assert boost.best_round([3, 2, 1, 2, 2, 0.5], 3) == 6
    assert boost.best_round([1.0], 5) == 1
    assert boost.best_round([2, 2, 2, 1], 2) == 1


def test_stopped_model_is_the_prefix(assembled):
    fit, valid = assembled.where("key % 3 != 0"), assembled.where("key % 3 = 0")
    make = lambda n: GBTClassifier(labelCol="y", featuresCol="features", maxIter=n, maxDepth=3, stepSize=0.4, seed=1)
    model, losses = boost.fit_stopped(make(25), fit, valid, patience=4)
    best = boost.best_round(losses, 4)
    assert model.getNumTrees == best <= 25 and losses[best - 1] == min(losses[:best + 4])
    # the loss of each prefix, recomputed from that prefix's scores
    for k in (1, best):
        rows = boost.first_rounds(model, k).transform(valid).select("y", "rawPrediction").collect()
        loss = np.mean([2 * math.log1p(math.exp(-2 * (2 * r["y"] - 1) * r["rawPrediction"][1])) for r in rows])
        assert loss == pytest.approx(losses[k - 1], rel=1e-6)
    short = make(best).fit(fit)
    a, b = ({r["key"]: r["probability"][1] for r in m.transform(valid).select("key", "probability").collect()} for m in (model, short))
    assert a == pytest.approx(b)
    assert len(boost.importances(model, 4)) == 4


# ------------------------------------------------------------- search

def best_f1(pairs):
    best = 0.0
    for t in {p for p, _ in pairs}:
        tp = sum(y for p, y in pairs if p >= t)
        said, pos = sum(p >= t for p, _ in pairs), sum(y for _, y in pairs)
        best = max(best, 2 * tp / (said + pos))
    return best


def test_evaluators(spark):
    rnd = random.Random(2)
    rows = [(i, int(rnd.random() < 0.3), round(rnd.random(), 1)) for i in range(200)]
    df = spark.createDataFrame(rows, "key long, y int, p double").withColumn("probability", array_to_vector(F.array(1 - F.col("p"), "p")))
    judge = lambda o, **kw: search.RankingEvaluator(labelCol="y", objective=o, **kw).evaluate(df)
    assert judge("f1") == pytest.approx(best_f1([(p, y) for _, y, p in rows]), abs=1e-6)
    top = sorted(rows, key=lambda r: (-r[2], r[0]))[:80]
    assert judge("lift") == pytest.approx(sum(y for _, y, _ in top) / 80 / (sum(y for _, y, _ in rows) / 200), abs=1e-3)
    none = search.RankingEvaluator(labelCol="z", objective="f1").evaluate(df.withColumn("z", F.lit(0)))
    assert none == 0.0 and search.RankingEvaluator().isLargerBetter()
    with pytest.raises(ValueError):
        search.RankingEvaluator(objective="auc")


def test_evaluator_inside_spark_tuning(assembled):
    gbt = GBTClassifier(labelCol="y", featuresCol="features", maxDepth=2, seed=1)
    grid = ParamGridBuilder().addGrid(gbt.maxIter, [1, 8]).build()
    judge = search.RankingEvaluator(labelCol="y", objective="pr_auc")
    folds = assembled.withColumn("fold", (F.col("key") % 2).cast("int"))
    found = CrossValidator(estimator=gbt, estimatorParamMaps=grid, evaluator=judge, numFolds=2, foldCol="fold", parallelism=2).fit(folds)
    assert found.avgMetrics[1] > found.avgMetrics[0] and found.bestModel.getNumTrees == 8


@pytest.mark.parametrize("objective", ["f1", "lift"])
def test_search_side_by_side_equals_one_after_the_other(assembled, objective):
    fit, valid = assembled.where("key % 3 != 0"), assembled.where("key % 3 = 0")
    families = {n: search.FAMILIES[n] for n in ("gbt", "ada")}

    def run(parallelism):
        return search.halving(fit, valid, "key", "y", families=families, objective=objective, trials=2, budgets=(1, 2), keep=0.5,
                              parallelism=parallelism, seed=3)

    def rows_of(df):
        return sorted(tuple(r) for r in df.collect())

    found = run(4)
    assert rows_of(found) == rows_of(run(1))
    rows = [r.asDict() for r in found.collect()]
    for name in families:
        own = [r for r in rows if r["family"] == name]
        assert sum(r["rung"] == 0 for r in own) == 2 and sum(r["rung"] == 1 for r in own) == 1 == sum(r["best"] for r in own)
        first = [r for r in own if r["rung"] == 0]
        stay = min(first, key=lambda r: (-r["value"], r["trial"]))
        assert [r["trial"] for r in first if r["survived"]] == [stay["trial"]]
    settings, budget = search.best_settings(found)["gbt"]
    model = search.fit_trial(families["gbt"], settings, budget, fit, "y")
    again = search.RankingEvaluator(labelCol="y", objective=objective).evaluate(model.transform(valid))
    value = next(r["value"] for r in rows if r["best"] and r["family"] == "gbt")
    assert again == pytest.approx(value) and budget == 2 and json.loads(json.dumps(settings)) == settings


# ------------------------------------------------------------- stacking

class Memory(Estimator):
    """Its model gives 1 to rows whose first feature it has seen, else 0."""

    def _fit(self, dataset):
        return MemoryModel([r[0] for r in dataset.select("x0").distinct().collect()])


class MemoryModel(Model, HasProbabilityCol):
    def __init__(self, seen=()):
        super().__init__()
        self.seen = list(seen)

    def setProbabilityCol(self, value):
        return self._set(probabilityCol=value)

    def _transform(self, dataset):
        p = F.col("x0").isin(self.seen).cast("double")
        return dataset.withColumn(self.getProbabilityCol(), array_to_vector(F.array(1 - p, p)))


def test_no_fold_model_saw_its_rows(spark):
    rows = [(i, int(i % 7 == 0), float(i)) for i in range(203)]
    df = spark.createDataFrame(rows, "key long, y int, x0 double").repartition(5)
    held = stacking.out_of_fold({"m": Memory}, df, ["x0"], "key", "y", folds=4).collect()
    assert sorted(r["key"] for r in held) == list(range(203))
    assert all(r["score_m"] == 0.0 for r in held)
    for c in (0, 1):
        sizes = [sum(r["fold"] == f and r["y"] == c for r in held) for f in range(4)]
        assert max(sizes) - min(sizes) <= 1
    models, _, _ = stacking.stacked({"m": Memory}, GBTClassifier(labelCol="y", featuresCol="features", maxIter=1), df, ["x0"], "key", "y", 2)
    seen = stacking.scores_of(models, df, ["x0"], ["key"]).collect()
    assert all(r["score_m"] == 1.0 for r in seen)  # new rows are scored by models of all rows
    with pytest.raises(ValueError):
        stacking.out_of_fold({"m": Memory}, df, ["x0"], "key", "y", folds=1)


def test_stack_scores_every_row(frame):
    bases = {"gbt": lambda: GBTClassifier(labelCol="y", featuresCol="features", maxIter=3, seed=1),
             "ada": lambda: boost.AdaBoostClassifier(labelCol="y", maxIter=3)}
    meta = GBTClassifier(labelCol="y", featuresCol="features", maxIter=3, maxDepth=2, seed=1)
    fit, new = frame.where("key < 180"), frame.where("key >= 180")
    models, top, held = stacking.stacked(bases, meta, fit, X, "key", "y", folds=3)
    out = stacking.stack_scores(models, top, new, X, ["key", "y"]).collect()
    assert sorted(r["key"] for r in out) == list(range(180, 240)) and held.count() == 180
    assert all(0 <= r[c] <= 1 for r in out for c in ("score_gbt", "score_ada", "score_stack"))
    assert best_f1([(r["score_stack"], r["y"]) for r in out]) > 0.6


def test_eliminations_of_families_side_by_side(frame):
    """Boosted trees and adaptive boosting drop the columns that say nothing; the consensus is what both keep."""
    df = frame.withColumns({f"noise{i}": F.hash("key", F.lit(i)).cast("double") % 3 * 0 + i for i in range(2)})
    names = [*X, "noise0", "noise1"]
    families = {"gbt": lambda: GBTClassifier(labelCol="y", featuresCol="features", maxIter=2, seed=1),
                "ada": lambda: boost.AdaBoostClassifier(labelCol="y", maxIter=2, maxDepth=2)}
    found = train.eliminations(families, df.where("key % 3 != 0"), df.where("key % 3 = 0"), names, "key", "y",
                               drop_fraction=0.34, min_features=3)
    for rounds in found.values():
        rows = rounds.orderBy("round").collect()
        assert [r["n_features"] for r in rows] == [6, 4, 3] and set(rows[1]["features"]) == set(X)
    keep = {r["feature"] for r in train.consensus(list(found.values())).collect()}
    best = [set(r.where("best").first()["features"]) for r in found.values()]
    assert keep == best[0] & best[1]
