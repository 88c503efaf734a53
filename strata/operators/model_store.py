"""Stored models and runs.

A version of a model set is a folder: one folder a model and, written last, the table ``manifest`` with each model's
kind, features, threshold and weight. A version without a complete manifest does not exist, so scoring never sees
half of one and never refits. Runs are rows (run, model, name, value), one partition a run: writing a run again
replaces that run alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.operators.boost import AdaBoostModel
from strata.session import folders

KINDS = {k.__name__: k for k in (GBTClassificationModel, RandomForestClassificationModel, AdaBoostModel)}
MANIFEST = "model string, kind string, features array<string>, threshold double, weight double"
RUNS = "run_id string, model string, name string, value double"


class Saved(NamedTuple):
    version: int
    models: dict[str, object]
    features: dict[str, list[str]]
    thresholds: dict[str, float]
    weights: dict[str, float]


def _at(folder: str, version: int) -> str:
    return f"{folder.rstrip('/')}/v{version:06d}"


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Complete versions, in ascending order."""
    found = [n for n in folders(spark, folder) if n.startswith("v") and n[1:].isdigit()]
    return sorted(int(n[1:]) for n in found if "_SUCCESS" in folders(spark, f"{folder.rstrip('/')}/{n}/manifest"))


def save(spark: SparkSession, folder: str, models: Mapping[str, object], features: Mapping[str, Sequence[str]],
         thresholds: Mapping[str, float], weights: Mapping[str, float] | None = None) -> int:
    """Write ``models`` as the next version and return its number. ``thresholds`` may hold names that are no model
    (an ensemble); ``weights`` are those of the ensemble. One writer at a time."""
    for name, model in models.items():
        if type(model).__name__ not in KINDS:
            raise ValueError(f"{name}: models of this kind are not stored")
    taken = [int(n[1:]) for n in folders(spark, folder) if n.startswith("v") and n[1:].isdigit()]
    version = max(taken, default=0) + 1  # an incomplete version keeps its number
    at = _at(folder, version)
    for name, model in models.items():
        if isinstance(model, AdaBoostModel):
            model.save(f"{at}/{name}")
        else:
            model.write().save(f"{at}/{name}")
    weights = weights or {}
    rows = [(n, type(models[n]).__name__ if n in models else None, list(features.get(n, [])), thresholds.get(n), weights.get(n))
            for n in [*models, *(t for t in thresholds if t not in models)]]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.parquet(f"{at}/manifest")  # a row a model
    return version


def load(spark: SparkSession, folder: str, version: int | None = None) -> Saved:
    """The latest complete version, or ``version``."""
    known = versions(spark, folder)
    if not known or version is not None and version not in known:
        raise FileNotFoundError(f"no complete model version {'' if version is None else version} in {folder}")
    version = known[-1] if version is None else version
    at = _at(folder, version)
    rows = spark.read.parquet(f"{at}/manifest").collect()  # a row a model
    return Saved(version, {r["model"]: KINDS[r["kind"]].load(f"{at}/{r['model']}") for r in rows if r["kind"]},
                 {r["model"]: r["features"] for r in rows if r["kind"]},
                 {r["model"]: r["threshold"] for r in rows if r["threshold"] is not None},
                 {r["model"]: r["weight"] for r in rows if r["weight"] is not None})


# ------------------------------------------------------------- runs

def log_run(spark: SparkSession, path: str, run_id: str, rows: Sequence[tuple[str, str, float]]) -> None:
    """Write the run's rows (model, name, value): other runs stay, the same run is replaced."""
    df = spark.createDataFrame([(run_id, m, n, float(v)) for m, n, v in rows], RUNS)
    df.coalesce(1).write.partitionBy("run_id").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUNS).parquet(path)


def compare_runs(spark: SparkSession, path: str) -> DataFrame:
    """Every (model, name) of every run with the value of the run before (by run id), the change, and the rank of
    the value among all runs (1: the highest)."""
    own = Window.partitionBy("model", "name")
    return runs(spark, path).select(
        "run_id", "model", "name", "value", F.lag("value").over(own.orderBy("run_id")).alias("previous"),
        F.rank().over(own.orderBy(F.col("value").desc())).alias("position")).withColumn("change", F.col("value") - F.col("previous"))
