"""Searches, stacks and eliminations with the notebooks' families and budgets, and what they leave behind or repeat."""

import inspect
import random
import threading

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from strata.operators import boost, search, stacking, train
from strata.plans import model_fleet as mf
from strata.plans import modeling as md
from strata.session import checkpoint_dir, folders, passing, store

X = ["x0", "x1", "x2", "x3"]


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(11)
    out = []
    for i in range(300):
        x = [rnd.randint(0, k) for k in (9, 7, 5, 3)]
        out.append((i, int(x[0] + 0.9 * x[1] - 1.3 * x[2] + 6 * rnd.random() > 8.0), 1.0, ("train", "train", "train", "thr", "test")[i % 5], *map(float, x)))
    return spark.createDataFrame(out, f"{md.KEY} long, {md.Y} int, {md.W} double, split string, " + ", ".join(f"{c} double" for c in X)).repartition(4).cache()


def test_tables_of_a_measure_are_removed(spark):
    left = lambda: set(folders(spark, checkpoint_dir(spark)))
    before = left()
    with passing(spark):
        assert store(spark.range(5), "passing").count() == 5
        other = []
        t = threading.Thread(target=lambda: other.append(store(spark.range(3), "elsewhere")))
        t.start()
        t.join()
        assert len(left() - before) == 2
    assert len(left() - before) == 1 and other[0].count() == 3  # another thread's table stays
    kept = store(spark.range(2), "kept")
    assert kept.count() == 2


def test_trials_leave_no_tables(spark, rows):
    ready = train.assemble(rows, X).cache()
    fit, valid = ready.where("split = 'train'"), ready.where("split = 'thr'")
    before = set(folders(spark, checkpoint_dir(spark)))
    search.halving(fit, valid, md.KEY, md.Y, families={"gbt": search.FAMILIES["gbt"]}, trials=2, budgets=(1,))
    train.random_search(rows.where("split = 'train'"), rows.where("split = 'thr'"), X, md.KEY, md.Y, None, 2, rounds=(1,))
    train.rfe(lambda: train.gbt(md.Y, max_iter=1), rows.where("split = 'train'"), rows.where("split = 'thr'"), X, md.KEY, md.Y, min_features=3)
    assert set(folders(spark, checkpoint_dir(spark))) == before


def test_rows_are_dealt_out_once_for_all_rounds(rows, monkeypatch):
    """What a round's fit reads is the kept vector, cut to the round's features."""
    calls, own = [], train.spread
    monkeypatch.setattr(train, "spread", lambda df, *a: (calls.append(1), own(df, *a))[1])
    tr, thr = rows.where("split = 'train'"), rows.where("split = 'thr'")
    make = {n: lambda n=n: GBTClassifier(labelCol=md.Y, featuresCol="features", maxIter=n, seed=1) for n in (1, 2)}
    found = train.eliminations(make, tr, thr, X, md.KEY, md.Y, min_features=2)
    train.random_search(tr, thr, X, md.KEY, md.Y, None, 3, rounds=(1,))
    assert len(calls) == 2
    for n, rounds in found.items():
        used = rounds.orderBy("round").collect()
        assert [r["n_features"] for r in used] == [4, 3, 2]
        for a, b in zip(used, used[1:]):  # as by fits over the columns themselves
            model = make[n]().fit(train.assemble(tr, a["features"]))
            weakest = min(zip(model.featureImportances.toArray(), a["features"]))[1]
            assert set(a["features"]) - set(b["features"]) == {weakest}
            assert a["lift"] == train.lift_of(model, thr, a["features"], md.KEY, md.Y)


def test_short_tables_are_put_together(spark):
    df = spark.range(0, 1000, 1, 8)
    assert [train.packed(df, n).rdd.getNumPartitions() for n in (1000, 400, 50)] == [1, 3, 20]
    assert train.packed(df, 400).count() == 1000


def test_early_stopping_fits_no_rounds_far_beyond_its_stop(rows):
    ready = train.assemble(rows, X).cache()
    fit, valid = ready.where("split = 'train'"), ready.where("split != 'train'")
    make = lambda n: GBTClassifier(labelCol=md.Y, featuresCol="features", maxIter=n, maxDepth=5, stepSize=0.5, seed=1)
    model, losses = boost.fit_stopped(make(60), fit, valid, patience=3)
    whole = make(24).fit(fit).evaluateEachIteration(valid)
    assert len(losses) < 60 and model.getNumTrees + 3 <= len(losses) <= 24
    assert losses == pytest.approx(whole[:len(losses)]) and model.getNumTrees == boost.best_round(whole, 3)
    assert len(boost.fit_stopped(make(2), fit, valid, patience=3)[1]) == 2


def test_stack_of_four_families(rows, monkeypatch):
    seen, own = [], stacking.stacked
    monkeypatch.setattr(stacking, "stacked", lambda bases, meta, df, *a: (seen.append((bases, meta, df)), own(bases, meta, df, *a))[1])
    out = md.stack_of_four(rows, X, rounds=2, trees=3, stages=2, meta_rounds=2, folds=2)
    assert out.columns == [md.KEY, md.Y, "y_proba_stack"]
    got = {r[0]: r[2] for r in out.collect()}
    assert set(got) == {r[0] for r in rows.where("split = 'test'").select(md.KEY).collect()} and all(0 <= p <= 1 for p in got.values())
    bases, meta, df = seen[0]
    assert list(bases) == ["gbt", "gbt_deep", "rf", "ada"] and isinstance(meta, GBTClassifier)
    assert {r[0] for r in df.select("split").distinct().collect()} == {"train"}  # the meta-model learns from out-of-fold scores


def test_consensus_of_four_families(rows, monkeypatch):
    seen, own = {}, train.eliminations

    def spy(families, *a, **kw):
        seen.update(own(families, *a, **kw, min_features=3))
        return seen

    monkeypatch.setattr(train, "eliminations", spy)
    keep = {r["feature"] for r in md.consensus_of_four(rows, X, rounds=1, trees=2, stages=1).collect()}
    assert list(seen) == ["gbt", "gbt_deep", "rf", "ada"]
    assert keep == set.intersection(*(set(r.where("best").first()["features"]) for r in seen.values()))


def test_budgets_are_the_notebooks(monkeypatch, rows):
    s = mf.Settings()
    assert s.trials == 30 and 200 <= s.budgets[-1] <= 800 and s.rounds == 1000 and s.patience == 50 and s.meta_rounds == 200
    defaults = {n: p.default for n, p in inspect.signature(md.consensus_of_four).parameters.items()}
    assert (defaults["rounds"], defaults["trees"], defaults["stages"]) == (300, 100, 100)
    seen = {}
    monkeypatch.setattr(md, "_parts", lambda spark, sf_dir: (rows, X))
    monkeypatch.setattr(train, "random_search", lambda *a, **kw: seen.update(trials=a[6], **kw))
    md.tune(None, None)
    assert seen["trials"] == 30 and min(seen["rounds"]) == 200 and max(seen["rounds"]) == 800
