"""Model selection and training with Spark ML (distributed fits; nothing collected to pandas).

Single-machine libraries of the notebooks are re-aimed: boosted trees and
random forests are Spark ML estimators with a class-weight column; the driver
only loops over whole distributed fits (feature elimination, random search).
"""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.operators import evaluate as ev
from strata.operators.rank import prefix_sums
from strata.session import Scratch, passing

FEATURES = "features"
SEED = 42
ROWS_A_TASK = 50_000  # rows of a fit that one task keeps and reads in every pass
VARIANTS_A_TASK = 50_000  # permuted rows (a row once for each feature) that one task scores


def feature_columns(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    """All columns but ``exclude``, which must be numeric: a column is left out by name, never by its type."""
    numeric = ("int", "bigint", "double", "float", "smallint", "tinyint", "decimal")
    features = [(c, t) for c, t in df.dtypes if c not in set(exclude)]
    odd = [c for c, t in features if t.split("(")[0] not in numeric]
    if odd:
        raise ValueError(f"columns that are not numeric: {odd}; encode them or exclude them by name")
    return [c for c, _ in features]


def assemble(df: DataFrame, features: Sequence[str], out: str = FEATURES) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


def gbt(label: str, weight: str | None = None, max_iter: int = 100, max_depth: int = 5, step: float = 0.1,
        subsample: float = 1.0, seed: int = SEED) -> GBTClassifier:
    g = GBTClassifier(featuresCol=FEATURES, labelCol=label, maxIter=max_iter, maxDepth=max_depth, stepSize=step,
                      subsamplingRate=subsample, seed=seed)
    return g.setWeightCol(weight) if weight else g


def random_forest(label: str, weight: str | None = None, trees: int = 100, max_depth: int = 8,
                  seed: int = SEED) -> RandomForestClassifier:
    r = RandomForestClassifier(featuresCol=FEATURES, labelCol=label, numTrees=trees, maxDepth=max_depth, seed=seed)
    return r.setWeightCol(weight) if weight else r


def spread(df: DataFrame, rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """``df`` over so many tasks that none has more than about ``rows_a_task`` rows. A tree fit keeps a scan's partition
    as objects, many times its size in a file, and reads it whole in every pass. Small tables stay as they are."""
    tasks = -(-df.count() // rows_a_task)
    return df.repartition(tasks) if tasks > df.rdd.getNumPartitions() else df


def packed(df: DataFrame, rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """``spread``, and a table that lies in more tasks than its rows need is put together: for searches, where trials
    run side by side, so that cores are shared by trials and a short task costs as much as its start."""
    tasks = max(1, -(-df.count() // rows_a_task))
    return spread(df, rows_a_task) if tasks >= df.rdd.getNumPartitions() else df.coalesce(tasks)


def fit(estimator, df: DataFrame, features: Sequence[str]):
    return estimator.fit(assemble(spread(df), features))


@contextmanager
def kept(frames: Sequence[DataFrame]) -> Iterator[list[DataFrame]]:
    """``frames`` persisted (in memory, on local disk as far as that is short) while several fits read them: every fit
    passes over its rows three times before its first tree. Lost blocks are made again from their plan."""
    held = [f.persist(StorageLevel.MEMORY_AND_DISK) for f in frames]
    try:
        yield held
    finally:
        for f in held:
            f.unpersist()


def side_by_side(spark: SparkSession, jobs: Sequence[Callable], parallelism: int = 4) -> list:
    """The results of some fits, ``parallelism`` of them at a time, in the order of ``jobs``."""
    run = inheritable_thread_target(spark)(lambda job: job())
    with ThreadPool(max(1, parallelism)) as pool:
        return pool.map(run, jobs, chunksize=1)


def positive(column: str) -> Column:
    """Probability of the positive class."""
    return vector_to_array(column)[1]


def score(model, df: DataFrame, features: Sequence[str], out: str = "y_proba", keep: Sequence[str] = ()) -> DataFrame:
    """Positive-class probability for every row (``model.transform``; no chunking needed)."""
    scored = model.transform(assemble(df, features))
    return scored.select(*keep, vector_to_array("probability")[1].alias(out))


def feature_importance(model, features: Sequence[str]) -> DataFrame:
    """``feature, importance, status`` (``zero`` when unused), most important first."""
    spark = SparkSession.getActiveSession()
    # one value per feature: bounded by the feature count
    imp = model.featureImportances.toArray().tolist()
    df = spark.createDataFrame([(f, float(v)) for f, v in zip(features, imp)], "feature string, importance double")
    return df.withColumn("status", F.when(F.col("importance") == 0, "zero").otherwise("kept")).orderBy(
        F.col("importance").desc(), F.col("feature"))


def prune_correlated(pairs: DataFrame, importance: DataFrame, threshold: float) -> DataFrame:
    """For each pair with |corr| > threshold, drop the less important feature (the second one is
    kept on ties). ``pairs``: feature_a, feature_b, correlation. Returns kept/dropped pairs."""
    ia = importance.select(F.col("feature").alias("feature_a"), F.col("importance").alias("imp_a"))
    ib = importance.select(F.col("feature").alias("feature_b"), F.col("importance").alias("imp_b"))
    hot = pairs.filter(F.abs("correlation") > threshold).join(ia, "feature_a").join(ib, "feature_b")
    keep_b = F.col("imp_b") >= F.col("imp_a")
    return hot.select(
        F.when(keep_b, F.col("feature_b")).otherwise(F.col("feature_a")).alias("kept"),
        F.when(keep_b, F.col("feature_a")).otherwise(F.col("feature_b")).alias("dropped"),
        "correlation",
        F.when(keep_b, F.col("imp_b")).otherwise(F.col("imp_a")).alias("imp_kept"),
        F.when(keep_b, F.col("imp_a")).otherwise(F.col("imp_b")).alias("imp_dropped"),
    )


def grouped_average_precision(df: DataFrame, group: str, y: str, p: str) -> DataFrame:
    """Average precision per group in one job: one global order (group, score desc) with prefix
    sums, minus each group's offset (one row per group, bounded)."""
    stats = df.groupBy(group, p).agg(F.count(F.lit(1)).alias("n_s"), F.sum(y).cast("long").alias("pos_s"))
    ranked = prefix_sums(stats, [F.col(group).asc(), F.col(p).desc()], {"n": "n_s", "pos": "pos_s"}, totals=False)
    # from the stored order, so the scoring is not run again
    per = ranked.groupBy(group).agg(F.sum("n_s").alias("_gn"), F.sum("pos_s").alias("_gp"))
    w = Window.orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(group, "_gp", F.coalesce(F.sum("_gn").over(w), F.lit(0)).alias("_on"),
                     F.coalesce(F.sum("_gp").over(w), F.lit(0)).alias("_op"))
    r = ranked.join(per, group)
    tp = F.col("cum_pos") - F.col("_op")
    n = F.col("cum_n") - F.col("_on")
    return r.groupBy(group).agg(F.try_divide(F.sum(F.col("pos_s") * (tp / n)), F.first("_gp")).alias("ap"))


def _permuted(df: DataFrame, features: Sequence[str], key: str, seed: int, buckets: int,
              tasks: int | None = None) -> DataFrame:
    """Long frame ``(other columns, _feature, features)``: for each feature f, every row with f
    replaced by another row's value, as a model-ready vector.

    Rows are hashed into buckets; inside a bucket every feature takes the value of the next row in one
    pseudo-random order (a random cyclic permutation). A variant changes one feature alone, so all can
    share the order: one sort of the rows a repeat. Buckets come from a hash of a unique key, so none is
    larger than about n / buckets. They are dealt out to ``tasks`` tasks: adaptive execution would go by the bytes
    before the variants are made, and score them all in a task or two. Expressions grow with k, not k^2: the variants
    are made by ``transform`` over one array of values.
    """
    bucket = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(buckets))
    d = df.withColumn("_b", bucket).repartition(tasks or buckets, "_b")
    w = Window.partitionBy("_b").orderBy(F.xxhash64(F.col(key), F.lit(seed * 1000)), F.col(key))
    wall = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    d = d.withColumns({f"_p{i}": F.coalesce(F.lead(F.col(f)).over(w), F.first(F.col(f)).over(wall)).cast("double")
                       for i, f in enumerate(features)})
    others = [c for c in df.columns if c not in set(features)]
    names = F.array(*(F.lit(f) for f in features))
    d = d.select(
        *others,
        F.array(*(F.col(f).cast("double") for f in features)).alias("_vals"),
        F.array(*(F.col(f"_p{i}") for i in range(len(features)))).alias("_perm"),
        F.explode(F.sequence(F.lit(0), F.lit(len(features) - 1))).alias("_i"),
    )
    swapped = F.transform("_vals", lambda x, j: F.when(j == F.col("_i"), F.element_at("_perm", F.col("_i") + 1))
                          .otherwise(x))
    return d.select(*others, F.element_at(names, F.col("_i") + 1).alias("_feature"),
                    array_to_vector(swapped).alias(FEATURES))


def permutation_importance(model, df: DataFrame, features: Sequence[str], key: str, y: str,
                           repeats: int = 3, seed: int = SEED, buckets: int | None = None) -> DataFrame:
    """Mean and std of the drop in average precision when one feature is permuted.

    One scoring job per repeat covers all features (long frame of features x rows); repeats run side by side."""
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    tasks = max(1, min(buckets, -(-df.count() * len(features) // VARIANTS_A_TASK)))

    def run(r: int) -> DataFrame:
        long = _permuted(df.select(key, y, *features), features, key, seed + r, buckets, tasks)
        scored = model.transform(long).select("_feature", y, vector_to_array("probability")[1].alias("y_proba"))
        return grouped_average_precision(scored, "_feature", y, "y_proba").withColumn("_rep", F.lit(r))

    whole = lambda: ev.average_precision(score(model, df, features, keep=[y]), y=y, digits=12).first()["pr_auc"]
    base, *runs = side_by_side(df.sparkSession, [whole, *(lambda r=r: run(r) for r in range(repeats))])
    allr = reduce(DataFrame.unionByName, runs).withColumn("drop", F.lit(base) - F.col("ap"))
    return allr.groupBy(F.col("_feature").alias("feature")).agg(
        F.avg("drop").alias("perm_importance"), F.stddev_pop("drop").alias("perm_std"))


def lift_of(model, df: DataFrame, features: Sequence[str], key: str, y: str, k: float = ev.LIFT_K) -> float:
    s = score(model, df, features, keep=[key, y])
    return float(ev.lift_at_k(s, k, key=key, y=y).first()["lift"])


def rfe(estimator_factory, train: DataFrame, valid: DataFrame, features: Sequence[str], key: str, y: str,
        drop_fraction: float = 0.10, min_features: int = 10) -> DataFrame:
    """Recursive elimination: fit, drop the least important 10 %, go on while at least ``min_features``
    remain; every round is scored on ``valid``, beside the fits of the rounds after it. One row per round: round, n_features, lift, capture, pr_auc,
    features and ``best`` (the highest lift, then the fewest features).

    The rows are dealt out and assembled once, for all rounds: a fit that dealt them out itself would shuffle all of them again."""
    with kept([_whole_vector(train, features)]) as (whole,):
        return _eliminate(estimator_factory, whole, valid, features, key, y, drop_fraction, min_features)


_ALL = "__all_features"


def _whole_vector(train: DataFrame, features: Sequence[str]) -> DataFrame:
    """The other columns and one vector of all features, of which a round takes its part."""
    out = assemble(spread(train), features, _ALL)
    return out.drop(*(set(features) - {_ALL}))


def _eliminate(estimator_factory, whole: DataFrame, valid: DataFrame, features: Sequence[str], key: str, y: str,
               drop_fraction: float = 0.10, min_features: int = 10) -> DataFrame:
    spark = whole.sparkSession
    current, judged, place = list(features), [], {f: i for i, f in enumerate(features)}

    def judge(model, used: list[str]) -> tuple:
        with Scratch(spark) as scratch, passing(spark):  # scored once for both measures
            s = scratch.store(score(model, valid, used, keep=[key, y]), "round")
            at_k = ev.lift_at_k(s, key=key, y=y).first()
            return at_k["lift"], at_k["capture"], ev.average_precision(s, y=y).first()["pr_auc"]

    # the next fit needs the importances alone: rounds are judged beside the fits that follow
    aside = inheritable_thread_target(spark)(judge)
    with ThreadPool(2) as pool:
        while True:
            part = VectorSlicer(inputCol=_ALL, outputCol=FEATURES, indices=[place[f] for f in current])
            model = estimator_factory().fit(part.transform(whole))
            judged.append((current, pool.apply_async(aside, (model, current))))
            # one value a feature
            imp = sorted(zip(model.featureImportances.toArray().tolist(), current), key=lambda t: (t[0], t[1]))
            dropped = {f for _, f in imp[:max(1, int(len(current) * drop_fraction))]}
            current = [f for f in current if f not in dropped]
            if len(current) < min_features:
                break
        rows = [(k, len(used), *found.get(), used) for k, (used, found) in enumerate(judged)]
    best = min(rows, key=lambda r: (-(r[2] if r[2] is not None else -1.0), r[1]))[0]
    return spark.createDataFrame(
        [(*r, r[0] == best) for r in rows],
        "round int, n_features int, lift double, capture double, pr_auc double, features array<string>, best boolean")


def eliminations(families: dict[str, Callable], train: DataFrame, valid: DataFrame, features: Sequence[str], key: str, y: str,
                 parallelism: int = 4, **options) -> dict[str, DataFrame]:
    """``rfe`` of each family, side by side, over the same kept rows."""
    with kept([_whole_vector(train, features)]) as (whole,):
        jobs = [lambda make=make: _eliminate(make, whole, valid, features, key, y, **options) for make in families.values()]
        return dict(zip(families, side_by_side(train.sparkSession, jobs, parallelism), strict=True))


def consensus(rounds: Sequence[DataFrame]) -> DataFrame:
    """Features in the best set of every elimination (one ``rfe`` result per model)."""
    sets = [r.where("best").select(F.explode("features").alias("feature")) for r in rounds]
    return reduce(DataFrame.intersect, sets)


def random_search(train: DataFrame, valid: DataFrame, features: Sequence[str], key: str, y: str, weight: str | None,
                  trials: int = 30, seed: int = SEED, rounds: Sequence[int] = range(200, 801)) -> DataFrame:
    """Random search over boosted-tree settings (``rounds``: the numbers of trees to choose from), trials side by side;
    objective = best F1 on ``valid``."""
    spark = train.sparkSession
    rng = random.Random(seed)
    drawn = [{"max_iter": rng.choice(list(rounds)), "max_depth": rng.randint(3, 7),
              "step": round(rng.uniform(0.03, 0.3), 3), "subsample": round(rng.uniform(0.6, 1.0), 2)} for _ in range(trials)]

    def run(own: DataFrame, t: int, params: dict) -> tuple:
        model = gbt(y, weight, **params).fit(own)
        with passing(spark):
            best = ev.best_f1_threshold(score(model, valid, features, keep=[key, y]), y=y).first()
        return (t, params["max_iter"], params["max_depth"], params["step"], params["subsample"],
                float(best["threshold"]), float(best["f1"]))

    # dealt out once for all trials
    with kept([assemble(spread(train), features)]) as (own,):
        rows = side_by_side(spark, [lambda t=t, p=p: run(own, t, p) for t, p in enumerate(drawn)])
    return spark.createDataFrame(
        rows, "trial int, max_iter int, max_depth int, step double, subsample double, threshold double, f1 double")


def stack(base_scores: DataFrame, score_cols: Sequence[str], y: str) -> PipelineModel:
    """Meta-model (logistic regression) over base-model scores."""
    lr = LogisticRegression(featuresCol=FEATURES, labelCol=y)
    return lr.fit(assemble(base_scores, score_cols))


def ensemble_columns(weights: dict[str, float]) -> Column:
    expr = None
    for c, w in weights.items():
        term = F.lit(float(w)) * F.col(c)
        expr = term if expr is None else expr + term
    return expr
