"""Stacking on out-of-fold scores: every training row is scored by base models that have not seen it."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.ml import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import train as tr
from strata.operators.prep import hash_order
from strata.operators.rank import class_positions, fixed_partitions
from strata.session import store

SEED = 42


def with_folds(df: DataFrame, y: str, key: str, folds: int, seed: int = SEED) -> DataFrame:
    """``df`` with ``fold``: the rows of each class in hash order are dealt out in turn, so folds differ by one row
    a class at most and do not depend on partitions."""
    placed = class_positions(df, y, [hash_order(key, seed), F.col(key)], fixed_partitions(df))
    return placed.withColumn("fold", (F.col("pos_in_class") % folds).cast("int")).drop("pos_in_class", "n_class")


def scores_of(models: dict[str, object], df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``keep`` and ``score_<name>`` of each model, in one pass. Models share no column."""
    out = tr.assemble(df.select(*dict.fromkeys([*keep, *features])), features)
    for name, m in models.items():
        m = m.copy()
        m.setProbabilityCol(f"_prob_{name}")
        if hasattr(m, "setRawPredictionCol"):
            m.setRawPredictionCol(f"_raw_{name}").setPredictionCol(f"_pred_{name}")
        out = m.transform(out)
    return out.select(*keep, *(vector_to_array(f"_prob_{n}")[1].alias(f"score_{n}") for n in models))


def out_of_fold(bases: dict[str, Callable[[], Estimator]], df: DataFrame, features: Sequence[str], key: str, y: str,
                folds: int = 5, seed: int = SEED, keep: Sequence[str] = (), parallelism: int = 4) -> DataFrame:
    """``key``, ``y``, ``fold``, ``keep`` and ``score_<name>`` of each base: one fit a fold and base, on the other folds,
    ``parallelism`` of them at a time. Stored."""
    if folds < 2:
        raise ValueError("two folds at least")
    placed = store(with_folds(df, y, key, folds, seed), "folds")
    spark = df.sparkSession
    others = tr.side_by_side(spark, [lambda f=f: tr.assemble(tr.packed(placed.where(F.col("fold") != f)), features)
                                     for f in range(folds)], parallelism)
    with tr.kept(others) as held:
        fits = [lambda make=make, own=own: make().fit(own) for own in held for make in bases.values()]
        fitted = tr.side_by_side(spark, fits, parallelism)

    def scored(f: int) -> DataFrame:
        models = dict(zip(bases, fitted[f * len(bases):(f + 1) * len(bases)], strict=True))
        # stored fold by fold: a lost executor does not bring back another fold's fits
        return store(scores_of(models, placed.where(F.col("fold") == f), features, [key, y, "fold", *keep]), "fold-scores")

    parts = tr.side_by_side(spark, [lambda f=f: scored(f) for f in range(folds)], parallelism)
    return reduce(DataFrame.unionByName, parts)


def stacked(bases: dict[str, Callable[[], Estimator]], meta: Estimator, df: DataFrame, features: Sequence[str], key: str, y: str,
            folds: int = 5, seed: int = SEED, keep: Sequence[str] = (), parallelism: int = 4):
    """(base models of all rows, meta-model, out-of-fold scores). The meta-model learns from scores that no base model
    gave to a row of its own fit; new rows are scored by base models of all rows."""
    held = out_of_fold(bases, df, features, key, y, folds, seed, keep, parallelism)
    names = [f"score_{n}" for n in bases]
    with tr.kept([tr.assemble(tr.packed(df), features)]) as (whole,):
        fits = [lambda make=make: make().fit(whole) for make in bases.values()]
        top, *own = tr.side_by_side(df.sparkSession, [lambda: meta.fit(tr.assemble(tr.packed(held), names)), *fits], parallelism)
    return dict(zip(bases, own, strict=True)), top, held


def stack_scores(models: dict[str, object], meta, df: DataFrame, features: Sequence[str], keep: Sequence[str],
                 out: str = "score_stack") -> DataFrame:
    """``keep``, the base scores and the meta-model's score of every row."""
    based = scores_of(models, df, features, keep)
    names = [f"score_{n}" for n in models]
    scored = meta.transform(tr.assemble(based, names))
    return scored.select(*keep, *names, vector_to_array("probability")[1].alias(out))
