"""The whole model flow in one chain: each step uses what the step before it found.

importance -> drop correlated -> keep what permutation shows to help -> tune -> final fits ->
thresholds -> metrics -> scores of every customer. The parts of the split keep to their roles:
fits, correlations and tuning (with a validation fifth of its own) see ``train`` alone; permutation,
thresholds and ensemble weights use ``thr``; metrics are reported on ``test``, which no step before has seen.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.operators import evaluate as ev
from strata.operators import prep, profile, train
from strata.operators.features import LABELS
from strata.operators.rank import average_rank, exact_quantiles, value_decile
from strata.plans import modeling as md
from strata.session import checkpoint_dir, cut_lineage, folders, store

KEY, Y, W = md.KEY, md.Y, md.W


@dataclass(frozen=True)
class Settings:
    """Budgets of the fits; every one is a number of distributed fits or trees, none cuts rows."""

    rounds: int = 50
    trees: int = 100
    repeats: int = 3
    trials: int = 4
    search_rounds: tuple[int, ...] = (20, 50)


def select_features(tr: DataFrame, thr: DataFrame, feats: list[str], s: Settings) -> DataFrame:
    """``feature, importance, perm_importance, status``, a row per feature; status is the step it left at:
    ``unused`` by the trees, ``correlated`` with a more important one, ``no_gain`` when permuted, or ``final``.
    Where no feature gains (a tiny ``thr``), those that were left are all final."""
    imp = train.feature_importance(md._gbt_model(tr, feats, s.rounds), feats)
    importance = {r["feature"]: r["importance"] for r in imp.collect()}  # one row per feature
    useful = [f for f in feats if importance[f] > 0]
    pairs = profile.corr_pairs(tr, useful)
    dropped = {r["dropped"] for r in train.prune_correlated(pairs, imp, md.CORR_THRESHOLD).collect()}
    kept = [f for f in useful if f not in dropped]
    model = md._gbt_model(tr, kept, s.rounds)
    perm = train.permutation_importance(model, thr, kept, KEY, Y, repeats=s.repeats).collect()
    gain = {r["feature"]: r["perm_importance"] for r in perm}
    none_gains = not any((gain.get(f) or 0) > 0 for f in kept)

    def status(f: str) -> str:
        if f not in useful:
            return "unused"
        if f in dropped:
            return "correlated"
        return "final" if none_gains or (gain.get(f) or 0) > 0 else "no_gain"

    return tr.sparkSession.createDataFrame(
        [(f, importance[f], gain.get(f), status(f)) for f in feats],
        "feature string, importance double, perm_importance double, status string")


def run(d: DataFrame, feats: list[str], s: Settings = Settings()) -> dict[str, DataFrame]:
    """Stored tables of one run over the prepared frame ``d`` (``modeling.model_data``, stored):
    ``features``, ``trials`` (the search), ``benchmark`` (test metrics by model) and ``scores``."""
    tr, thr = d.filter(F.col("split") == "train"), d.filter(F.col("split") == "thr")
    features = store(select_features(tr, thr, feats, s), "chain-features")
    final = [r["feature"] for r in features.where("status = 'final'").orderBy("feature").collect()]

    folds = cut_lineage(prep.stratified_split(tr.drop("split"), Y, KEY, 0.2, seed=44, names=("fit", "valid")))
    find = lambda: store(train.random_search(folds.where("split = 'fit'"), folds.where("split = 'valid'"), final, KEY, Y, W,
                                             s.trials, rounds=s.search_rounds), "chain-trials")
    forest = lambda: train.fit(train.random_forest(Y, W, s.trees), tr, final)
    trials, rf = train.side_by_side(d.sparkSession, [find, forest])  # the forest waits for no trial
    best = trials.orderBy(F.col("f1").desc(), "trial").first()
    tuned = train.gbt(Y, W, best["max_iter"], best["max_depth"], best["step"], best["subsample"])
    models = {"gbt": train.fit(tuned, tr, final), "rf": rf}

    labels = [c for c in LABELS if c in d.columns]
    full = cut_lineage(md._multi_score(models, d, final, keep=["split", *labels]))
    cuts = [lambda n=n: ev.best_f1_threshold(full.where("split = 'thr'"), y=Y, p=f"score_{n}").first() for n in models]
    chosen = dict(zip(models, train.side_by_side(d.sparkSession, cuts), strict=True))
    total = sum(r["f1"] for r in chosen.values())
    if total == 0:
        raise ValueError("no model finds a positive on the threshold half: the ensemble has no weights")
    weights = {f"score_{n}": r["f1"] / total for n, r in chosen.items()}
    blended = cut_lineage(full.withColumn("score_ensemble", train.ensemble_columns(weights)))
    chosen["ensemble"] = ev.best_f1_threshold(blended.where("split = 'thr'"), y=Y, p="score_ensemble").first()

    test = blended.where("split = 'test'")
    metrics = [lambda n=n, r=r: ev.model_metrics(test, r["threshold"], n, y=Y, p=f"score_{n}", key=KEY)
               .withColumn("exact_threshold", F.lit(r["threshold"])) for n, r in chosen.items()]
    orders = [lambda: exact_quantiles(blended, "score_ensemble", [j / 10 for j in range(1, 10)], key=KEY),
              lambda: average_rank(blended, "score_ensemble", "rank")]
    edges, ranked, *rows = train.side_by_side(d.sparkSession, [*orders, *metrics])
    # one row per model
    by_f1 = Window.orderBy(F.col("f1").desc(), F.col("model"))
    benchmark = store(reduce(DataFrame.unionByName, rows).withColumn("position", F.row_number().over(by_f1)),
                      "chain-benchmark")

    scores = ranked.select(
        KEY, *labels, Y, "split", *(f"score_{n}" for n in models), "score_ensemble", "rank",
        value_decile(F.col("score_ensemble"), edges).alias("score_decile"),
        (F.col("score_ensemble") >= F.lit(chosen["ensemble"]["threshold"])).cast("int").alias("prediction"))
    return {"features": features, "trials": trials, "benchmark": benchmark, "scores": store(scores, "chain-scores")}


TABLES = ("features", "trials", "benchmark", "scores")


def _run(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The tables of this application's run over ``sf_dir``, in a folder of its own; it is built if the table that is
    written last is not complete."""
    at = f"{checkpoint_dir(spark).rstrip('/')}/strata-chain-{spark.sparkContext.applicationId}-{zlib.crc32(sf_dir.encode()):08x}"
    if "_SUCCESS" not in folders(spark, f"{at}/{TABLES[-1]}"):
        out = run(*md._parts(spark, sf_dir))
        for name in TABLES:
            out[name].write.mode("overwrite").parquet(f"{at}/{name}")
    return {name: spark.read.parquet(f"{at}/{name}") for name in TABLES}


def final_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir)["features"]


def trained_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test metrics of the tuned boosted trees, the forest and their ensemble, best F1 first."""
    return _run(spark, sf_dir)["benchmark"]


def trained_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer with labels, both scores, ensemble score, rank, decile and yes/no."""
    return _run(spark, sf_dir)["scores"]


def facts(scores: DataFrame, benchmark: DataFrame) -> DataFrame:
    """What must hold of any run, whatever the models learned: one row of counts."""
    threshold = benchmark.where("model = 'ensemble'").first()["exact_threshold"]
    cols = [c for c in scores.columns if c.startswith("score_") and c != "score_decile"]
    bad = reduce(lambda a, b: a | b, [F.col(c).isNull() | F.isnan(c) | ~F.col(c).between(0.0, 1.0) for c in cols])
    wrong = F.col("prediction") != (F.col("score_ensemble") >= F.lit(threshold)).cast("int")
    count = lambda c: F.count(F.when(c, 1))
    return scores.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(KEY).alias("n_keys"), F.sum(Y).cast("long").alias("n_pos"),
        *(count(F.col("split") == p).alias(f"n_{p}") for p in ("train", "thr", "test")),
        count(bad).alias("bad_scores"), count(wrong).alias("bad_predictions"),
        count(~F.col("score_decile").between(1, 10)).alias("bad_deciles"),
        count(~F.col("rank").between(1, 1 << 62)).alias("bad_ranks"))


def trained_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _run(spark, sf_dir)
    return facts(tables["scores"], tables["benchmark"])


QUERIES = {f.__name__: f for f in (final_features, trained_benchmark, trained_scores, trained_facts)}
