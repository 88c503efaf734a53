"""Hyper-parameter search over families of models, by successive halving, with trials side by side.

Each trial is a distributed fit and a distributed evaluation; the driver keeps some of them running at a time.
All trials of a family start with a small budget (trees or rounds); the better ones go on with the next budget.
Objectives are Spark ML evaluators, so they also serve its own ``CrossValidator`` and ``TrainValidationSplit``.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool
from typing import NamedTuple

from pyspark import inheritable_thread_target, keyword_only
from pyspark.ml import Estimator
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasLabelCol, HasProbabilityCol
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import evaluate as ev
from strata.operators.boost import AdaBoostClassifier, WeakStage
from strata.operators.train import FEATURES
from strata.session import passing


class RankingEvaluator(Evaluator, HasLabelCol, HasProbabilityCol):
    """``f1``: the best F1 over all thresholds; ``lift``: lift of the highest share ``k`` of the scores (ties by
    ``keyCol``); ``pr_auc``: average precision. All from global orders, nothing is collected. Larger is better; a
    frame without positives has 0."""

    objective = Param(Params._dummy(), "objective", "f1, lift or pr_auc", TypeConverters.toString)
    keyCol = Param(Params._dummy(), "keyCol", "unique key that breaks ties", TypeConverters.toString)
    k = Param(Params._dummy(), "k", "share of the rows for lift", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, labelCol="label", probabilityCol="probability", keyCol="key", objective="f1", k=ev.LIFT_K):
        super().__init__()
        self._setDefault(labelCol="label", probabilityCol="probability", keyCol="key", objective="f1", k=ev.LIFT_K)
        self._set(**self._input_kwargs)
        if self.getOrDefault("objective") not in ("f1", "lift", "pr_auc"):
            raise ValueError("the objective is f1, lift or pr_auc")

    def _evaluate(self, dataset: DataFrame) -> float:
        key, y, objective = self.getOrDefault("keyCol"), self.getLabelCol(), self.getOrDefault("objective")
        s = dataset.select(key, y, vector_to_array(self.getProbabilityCol())[1].alias("y_proba"))
        if objective == "lift":
            row = ev.lift_at_k(s, self.getOrDefault("k"), key=key, y=y).first()
            value = row["lift"] if row else None
        elif objective == "pr_auc":
            value = ev.average_precision(s, y=y).first()["pr_auc"]
        else:
            row = ev.best_f1_threshold(s, y=y).first()
            value = row["f1"] if row else None
        return float(value or 0.0)

    def isLargerBetter(self) -> bool:
        return True


class Family(NamedTuple):
    """``draw(random, ratio)`` gives a trial's settings (``ratio``: negatives for each positive), ``make(settings,
    budget, label, weight)`` the estimator. The setting ``positive`` is the weight of a positive row."""

    draw: Callable[[random.Random, float], dict]
    make: Callable[[dict, int, str, str], Estimator]


def _between(rng: random.Random, low: float, high: float) -> float:
    """Drawn evenly on the scale of logarithms."""
    return round(math.exp(rng.uniform(math.log(low), math.log(max(low, high)))), 4)


def _draw_boosted(rng: random.Random, ratio: float) -> dict:
    return {"positive": _between(rng, 1.0, ratio), "depth": rng.randint(3, 7), "step": _between(rng, 0.03, 0.3),
            "subsample": round(rng.uniform(0.6, 1.0), 2), "columns": round(rng.uniform(0.6, 1.0), 2), "leaf": rng.randint(1, 20)}


def _make_boosted(s: dict, budget: int, label: str, weight: str) -> Estimator:
    return GBTClassifier(featuresCol=FEATURES, labelCol=label, weightCol=weight, maxIter=budget, maxDepth=s["depth"], stepSize=s["step"],
                         subsamplingRate=s["subsample"], featureSubsetStrategy=str(s["columns"]), minInstancesPerNode=s["leaf"], seed=42)


def _draw_forest(rng: random.Random, ratio: float) -> dict:
    return {"positive": rng.choice([1.0, round(ratio, 4)]), "depth": rng.randint(5, 12), "leaf": rng.randint(10, 200),
            "columns": rng.choice(["sqrt", "log2", "0.5"])}


def _make_forest(s: dict, budget: int, label: str, weight: str) -> Estimator:
    return RandomForestClassifier(featuresCol=FEATURES, labelCol=label, weightCol=weight, numTrees=budget, maxDepth=s["depth"],
                                  minInstancesPerNode=s["leaf"], featureSubsetStrategy=s["columns"], seed=42)


def _draw_adaptive(rng: random.Random, ratio: float) -> dict:
    return {"positive": rng.choice([1.0, round(ratio, 4)]), "depth": rng.randint(1, 4), "step": _between(rng, 0.3, 1.0)}


def _make_adaptive(s: dict, budget: int, label: str, weight: str) -> Estimator:
    return AdaBoostClassifier(featuresCol=FEATURES, labelCol=label, weightCol=weight, maxIter=budget, maxDepth=s["depth"],
                              stepSize=s["step"])


FAMILIES = {"gbt": Family(_draw_boosted, _make_boosted), "rf": Family(_draw_forest, _make_forest),
            "ada": Family(_draw_adaptive, _make_adaptive)}
TRIALS = ("family string, trial int, rung int, budget int, settings string, objective string, value double, "
          "survived boolean, best boolean")
WEIGHT = "__trial_weight"


def weighted(df: DataFrame, y: str, positive: float) -> DataFrame:
    return df.withColumn(WEIGHT, F.when(F.col(y) == 1, F.lit(float(positive))).otherwise(1.0))


def fit_trial(family: Family, settings: dict, budget: int, train: DataFrame, y: str):
    """The model of one trial over an assembled frame."""
    return family.make(settings, budget, y, WEIGHT).fit(weighted(train, y, settings["positive"]))


def halving(train: DataFrame, valid: DataFrame, key: str, y: str, *, families: dict[str, Family] = FAMILIES, objective: str = "f1",
            trials: int = 9, budgets: Sequence[int] = (10, 30, 90), keep: float = 1 / 3, parallelism: int = 4,
            seed: int = 42) -> DataFrame:
    """A row per family, trial and rung: its settings (JSON), the objective on ``valid``, whether it survived the rung
    and whether it is its family's best (the highest value of the last rung, then the lower trial).

    ``train`` and ``valid`` are assembled and stored; each is read by every trial. Settings are drawn before anything
    is fitted and results are compared in the order of trials, so ``parallelism`` changes the time alone. A trial that
    cannot be fitted (adaptive boosting without a stage) has value 0.
    """
    count = train.agg(F.count(F.when(F.col(y) == 1, 1)), F.count(F.lit(1))).first()
    ratio = (count[1] - count[0]) / count[0] if count[0] else 1.0
    judge = RankingEvaluator(labelCol=y, keyCol=key, objective=objective)
    drawn = {}
    for name, family in families.items():
        rng = random.Random(f"{seed}-{name}")
        drawn[name] = [family.draw(rng, max(1.0, ratio)) for _ in range(trials)]

    @inheritable_thread_target(train.sparkSession)
    def run(job: tuple[str, int, int]) -> float:
        name, trial, budget = job
        try:
            model = fit_trial(families[name], drawn[name][trial], budget, train, y)
        except WeakStage:
            return 0.0
        with passing(train.sparkSession):
            return judge.evaluate(model.transform(valid))

    alive = {name: list(range(trials)) for name in families}
    rows = []
    with ThreadPool(max(1, parallelism)) as pool:
        for rung, budget in enumerate(budgets):
            jobs = [(name, t, budget) for name in families for t in alive[name]]
            values = dict(zip(jobs, pool.map(run, jobs, chunksize=1), strict=True))
            last = rung + 1 == len(budgets)
            for name in families:
                ordered = sorted(alive[name], key=lambda t: (-values[name, t, budget], t))
                stay = ordered[:1] if last else ordered[:max(1, math.ceil(len(ordered) * keep))]
                rows += [(name, t, rung, budget, json.dumps(drawn[name][t], sort_keys=True), objective, values[name, t, budget],
                          t in stay, last and t in stay) for t in alive[name]]
                alive[name] = sorted(stay)
    return train.sparkSession.createDataFrame(rows, TRIALS)


def best_settings(found: DataFrame) -> dict[str, tuple[dict, int]]:
    """(settings, budget) of each family's best trial."""
    return {r["family"]: (json.loads(r["settings"]), r["budget"]) for r in found.where("best").collect()}  # a row a family
