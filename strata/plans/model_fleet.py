"""Four families from the search to stored models: tuned, stopped early, stacked, saved, logged and scored.

search (successive halving, trials side by side) for best F1 and for lift -> two boosted families, a forest and
adaptive boosting -> rounds of the boosted ones by early stopping -> out-of-fold scores -> boosted meta-model ->
thresholds and ensemble weights on ``thr`` -> metrics on ``test`` -> a version of stored models and a row set of the
run table. Scoring loads the stored version and fits nothing. Fits see ``train`` alone; the search and early stopping
judge on a fifth of it.

Everything a run leaves lies in one named folder (``home``); a folder that is gone or incomplete is built again.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Estimator
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import boost, model_store, prep, search, stacking, train
from strata.operators import evaluate as ev
from strata.operators.rank import average_rank, exact_quantiles, value_decile
from strata.plans import modeling as md
from strata.session import checkpoint_dir, cut_lineage, folders

KEY, Y = md.KEY, md.Y
BASES = ("gbt", "gbt_lift", "rf", "ada")
DEPTHS = (1, 2, 3, 5, 6)


@dataclass(frozen=True)
class Settings:
    """Budgets: numbers of trials, trees, rounds and folds; none of them cuts rows. They are the notebooks': 30 trials a family
    and objective, the best ones with 200 rounds or trees (the notebooks draw 200 to 800 rounds, 100 to 400 trees and 50 to 200
    stages), early stopping after 50 of at most 1000 rounds, a meta-model of 200 rounds."""

    trials: int = 30
    budgets: tuple[int, ...] = (22, 66, 200)
    rounds: int = 1000
    patience: int = 50
    folds: int = 3
    meta_rounds: int = 200
    parallelism: int = 4


def home(spark: SparkSession, sf_dir: str) -> str:
    """The folder of this application's run over ``sf_dir``."""
    own = f"{spark.sparkContext.applicationId}-{zlib.crc32(sf_dir.encode()):08x}"
    return f"{checkpoint_dir(spark).rstrip('/')}/strata-fleet-{own}"


def tables(spark: SparkSession, sf_dir: str, settings: Settings = Settings()) -> Callable[[str], DataFrame]:
    """Reads a table of the run by name; builds the run if its last table is not complete."""
    at = home(spark, sf_dir)
    if "_SUCCESS" not in folders(spark, f"{at}/benchmark"):
        d = md.model_data(spark, sf_dir)
        d.write.mode("overwrite").parquet(f"{at}/prepared")
        build(spark.read.parquet(f"{at}/prepared"), at, settings)
    return lambda name: spark.read.parquet(f"{at}/{name}")


def _estimators(found: dict[str, tuple[dict, int]], rounds: dict[str, int], positive: str) -> dict[str, Callable[[], Estimator]]:
    """What fits each base: the searched settings, for boosted trees with the rounds that early stopping found."""
    kinds = {"gbt": "gbt", "gbt_lift": "gbt", "rf": "rf", "ada": "ada"}
    return {n: lambda n=n: search.FAMILIES[kinds[n]].make(found[n][0], rounds.get(n, found[n][1]), Y, f"{positive}{n}") for n in BASES}


def build(d: DataFrame, at: str, s: Settings) -> None:
    """Run the whole flow over the prepared frame ``d`` and write its tables under ``at``; ``benchmark`` comes last."""
    spark, feats = d.sparkSession, md.features_of(d)

    def put(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{at}/{name}")
        return spark.read.parquet(f"{at}/{name}")

    whole = d.where(F.col("split") == "train").drop("split")
    fifth = prep.stratified_split(whole, Y, KEY, 0.2, seed=44, names=("fit", "valid"))
    ready = cut_lineage(train.assemble(fifth, feats).select(KEY, Y, train.FEATURES, "split"))
    judge = dict(trials=s.trials, budgets=s.budgets, parallelism=s.parallelism)
    stops, rounds, boosted = [], {}, ("gbt", "gbt_lift")

    # dealt out once for all trials and for early stopping, not by every fit
    with train.kept([train.packed(ready.where("split = 'fit'")), ready.where("split = 'valid'")]) as (fit, valid):
        searches = [lambda: search.halving(fit, valid, KEY, Y, objective="f1", **judge),
                    lambda: search.halving(fit, valid, KEY, Y, objective="lift", families={"gbt": search.FAMILIES["gbt"]}, seed=43, **judge)]
        by_f1, by_lift = train.side_by_side(spark, searches, s.parallelism)
        found = put(by_f1.unionByName(by_lift), "trials")
        best = search.best_settings(found.where("objective = 'f1'"))
        best["gbt_lift"] = search.best_settings(found.where("objective = 'lift'"))["gbt"]

        # weights of positive rows, one column a base: the folds' frames carry them
        weighted = whole.withColumns({f"__pos_{n}": F.when(F.col(Y) == 1, F.lit(float(best[n][0]["positive"]))).otherwise(1.0) for n in BASES})

        def stopped(n: str):
            estimator = search.FAMILIES["gbt"].make(best[n][0], s.rounds, Y, search.WEIGHT)
            return boost.fit_stopped(estimator, search.weighted(fit, Y, best[n][0]["positive"]), search.weighted(valid, Y, 1.0), s.patience)

        frame, adaptive = train.assemble(train.packed(weighted), feats), _estimators(best, rounds, "__pos_")["ada"]
        # the searched depth first, then deeper trees, as far as they are needed for a stage
        deepened = lambda: boost.deepening(lambda k: adaptive().setParams(maxDepth=k, maxIter=1), frame, [best["ada"][0]["depth"], *DEPTHS])
        *cut, (_, depth) = train.side_by_side(spark, [*(lambda n=n: stopped(n) for n in boosted), deepened], s.parallelism)
    for n, (model, losses) in zip(boosted, cut, strict=True):
        rounds[n] = model.getNumTrees
        stops += [(n, k + 1, float(x), k + 1 == rounds[n]) for k, x in enumerate(losses)]
    put(spark.createDataFrame(stops, "model string, round int, loss double, chosen boolean"), "stops")

    bases = _estimators(best, rounds, "__pos_")
    bases["ada"] = lambda: adaptive().setParams(maxDepth=depth)
    meta = GBTClassifier(featuresCol=train.FEATURES, labelCol=Y, maxIter=s.meta_rounds, maxDepth=3, seed=42)
    models, top, held = stacking.stacked(bases, meta, weighted, feats, KEY, Y, s.folds, parallelism=s.parallelism)
    put(held, "out_of_fold")

    scored = cut_lineage(stacking.stack_scores(models, top, d, feats, [KEY, Y, "split"]))
    thr = scored.where("split = 'thr'")
    found_by = (*BASES, "stack")
    best_of = [lambda n=n: ev.best_f1_threshold(thr, y=Y, p=f"score_{n}").first() for n in found_by]
    chosen = dict(zip(found_by, train.side_by_side(spark, best_of, s.parallelism), strict=True))
    total = sum(chosen[n]["f1"] for n in BASES)
    if total == 0:
        raise ValueError("no model finds a positive on the threshold half: the ensemble has no weights")
    weights = {n: chosen[n]["f1"] / total for n in BASES}
    blended = train.ensemble_columns({f"score_{n}": w for n, w in weights.items()})
    scored = cut_lineage(scored.withColumn("score_ensemble", blended))
    chosen["ensemble"] = ev.best_f1_threshold(scored.where("split = 'thr'"), y=Y, p="score_ensemble").first()
    thresholds = {n: r["threshold"] for n, r in chosen.items()}
    names = [f"score_{n}" for n in BASES]
    version = model_store.save(spark, f"{at}/models", {**models, "stack": top}, {**{n: feats for n in BASES}, "stack": names},
                               thresholds, weights)

    test = scored.where("split = 'test'")
    rows = [lambda n=n: ev.model_metrics(test, thresholds[n], n, y=Y, p=f"score_{n}", key=KEY) for n in thresholds]
    metrics = reduce(DataFrame.unionByName, train.side_by_side(spark, rows, s.parallelism))
    logged = [(r["model"], k, v) for r in metrics.collect() for k, v in r.asDict().items() if isinstance(v, (int, float))]
    logged += [(n, "rounds", k) for n, k in rounds.items()]
    model_store.log_run(spark, f"{at}/runs", f"version-{version:06d}", logged)
    put(metrics, "benchmark")


# ------------------------------------------------------------------ registered queries

def fleet_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every trial of the searches, with the rungs it reached."""
    return tables(spark, sf_dir)("trials")


def fleet_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loss after each round of the boosted models that was fitted before they stopped, and the round that was chosen."""
    return tables(spark, sf_dir)("stops")


def fleet_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fold of every training row, as its out-of-fold scores were made."""
    return tables(spark, sf_dir)("out_of_fold").select(KEY, Y, "fold")


def fleet_out_of_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every training row by models that have not seen it."""
    return tables(spark, sf_dir)("out_of_fold")


def fleet_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test metrics of the four families, their ensemble and the stack."""
    return tables(spark, sf_dir)("benchmark")


def fleet_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every logged value of every run, beside the run before."""
    tables(spark, sf_dir)
    return model_store.compare_runs(spark, f"{home(spark, sf_dir)}/runs")


def score_stored(d: DataFrame, saved: model_store.Saved, keep: list[str]) -> DataFrame:
    """Every row of ``d`` scored by a stored version: the families, their ensemble, the stack, rank, decile and yes or
    no by the ensemble. Nothing is fitted."""
    bases = {n: m for n, m in saved.models.items() if n != "stack"}
    feats = saved.features[next(iter(bases))]
    blended = train.ensemble_columns({f"score_{n}": w for n, w in saved.weights.items()})
    full = cut_lineage(stacking.stack_scores(bases, saved.models["stack"], d, feats, keep).withColumn("score_ensemble", blended))
    edges = exact_quantiles(full, "score_ensemble", [j / 10 for j in range(1, 10)], key=KEY)
    return average_rank(full, "score_ensemble", "rank").withColumns({
        "score_decile": value_decile(F.col("score_ensemble"), edges),
        "prediction": (F.col("score_ensemble") >= F.lit(saved.thresholds["ensemble"])).cast("int")})


def fleet_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer scored by the latest stored version."""
    d = tables(spark, sf_dir)("prepared")
    return score_stored(d, model_store.load(spark, f"{home(spark, sf_dir)}/models"), [KEY, Y, "split"])


def fleet_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of any run: one row of counts over the scores, the out-of-fold scores and the run table."""
    read = tables(spark, sf_dir)
    scores = fleet_scores(spark, sf_dir)
    cut = model_store.load(spark, f"{home(spark, sf_dir)}/models").thresholds["ensemble"]
    bad = lambda cols: reduce(lambda a, b: a | b, [F.col(c).isNull() | F.isnan(c) | ~F.col(c).between(0.0, 1.0) for c in cols])
    count = lambda c: F.count(F.when(c, 1))
    names = [f"score_{n}" for n in BASES]
    one = scores.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(KEY).alias("n_keys"), F.sum(Y).cast("long").alias("n_pos"),
        *(count(F.col("split") == p).alias(f"n_{p}") for p in ("train", "thr", "test")),
        count(bad([*names, "score_ensemble", "score_stack"])).alias("bad_scores"),
        count(F.col("prediction") != (F.col("score_ensemble") >= F.lit(cut)).cast("int")).alias("bad_predictions"))
    two = read("out_of_fold").agg(F.count(F.lit(1)).alias("n_held"), F.count_distinct(KEY).alias("n_held_keys"),
                                  F.count_distinct("fold").alias("n_folds"), count(bad(names)).alias("bad_held"))
    runs = model_store.runs(spark, f"{home(spark, sf_dir)}/runs")
    three = runs.agg((F.count(F.lit(1)) - F.count_distinct("run_id", "model", "name")).alias("repeated_values"))
    row = {**one.first().asDict(), **two.first().asDict(), **three.first().asDict()}
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} long" for k in row))


QUERIES = {f.__name__: f for f in (fleet_trials, fleet_stops, fleet_folds, fleet_out_of_fold, fleet_benchmark, fleet_runs,
                                   fleet_scores, fleet_facts)}
