"""Model plans over the encoded master table (notebook sections 3-11), as Spark ML jobs.

Data: master -> unified label -> encoded features -> class weight -> exact stratified
80/20 split; the 20 % validation part is split again 50/50 into a threshold half and
a test half (thresholds are never chosen on the data they are reported on).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Estimator
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import boost, prep, profile, smote, stacking, train
from strata.operators import evaluate as ev
from strata.operators.features import LABELS
from strata.operators.rank import average_rank, exact_quantiles, value_decile
from strata.plans import gold
from strata.session import cut_lineage, scratch_path

KEY, Y, W = "RADICAL", "label_any", "weight"
CORR_THRESHOLD = 0.95
TEXT_COLS = ["BANQUE", "AGENCE"]
TUNE_TRIALS, TUNE_ROUNDS = 30, range(200, 801)  # as many as in the notebooks' searches


def model_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = gold.written_master(spark, sf_dir)  # the caps and the category counts read it too
    m = m.withColumn(Y, profile.label_any(m))
    m = prep.cap_outliers(m, prep.cap_values(m))
    enc = prep.encode_features(m)
    enc = prep.class_weight(enc, Y)
    split = prep.stratified_split(enc, Y, KEY, 0.2)
    val = prep.stratified_split(split.filter(F.col("split") == "test").drop("split"), Y, KEY, 0.5, seed=43,
                                names=("thr", "test"))
    return split.filter(F.col("split") == "train").unionByName(val)


def features_of(df: DataFrame) -> list[str]:
    # identifiers and names that stay as text are left out by name
    return train.feature_columns(df, [KEY, Y, W, "split", *LABELS, *TEXT_COLS])


def _parts(spark, sf_dir):
    # every fit re-reads its input several times: materialise the prepared frame once
    d = cut_lineage(model_data(spark, sf_dir))
    return d, features_of(d)


def _gbt_model(d, feats, max_iter=100):
    return train.fit(train.gbt(Y, W, max_iter=max_iter), d.filter(F.col("split") == "train"), feats)


def feature_importance(spark, sf_dir):
    d, feats = _parts(spark, sf_dir)
    return train.feature_importance(_gbt_model(d, feats), feats)


def _useful(spark, sf_dir):
    d, feats = _parts(spark, sf_dir)
    imp = train.feature_importance(_gbt_model(d, feats), feats)
    useful = [r["feature"] for r in imp.filter(F.col("importance") > 0).collect()]
    return d, imp, useful


def prune_correlated(spark, sf_dir):
    d, imp, useful = _useful(spark, sf_dir)
    pairs = profile.corr_pairs(d.filter(F.col("split") == "train"), useful)
    return train.prune_correlated(pairs, imp, CORR_THRESHOLD)


def _selected(spark, sf_dir):
    d, imp, useful = _useful(spark, sf_dir)
    pairs = profile.corr_pairs(d.filter(F.col("split") == "train"), useful)
    dropped = {r["dropped"] for r in train.prune_correlated(pairs, imp, CORR_THRESHOLD).collect()}
    return d, [f for f in useful if f not in dropped]


def permutation_importance(spark, sf_dir):
    d, feats = _selected(spark, sf_dir)
    model = _gbt_model(d, feats, max_iter=50)
    return train.permutation_importance(model, d.filter(F.col("split") == "test"), feats, KEY, Y, repeats=3)


def rfe(spark, sf_dir):
    d, feats = _parts(spark, sf_dir)
    return train.rfe(lambda: train.random_forest(Y, W, trees=30), d.filter(F.col("split") == "train"),
                     d.filter(F.col("split") == "thr"), feats, KEY, Y)


def _scores(model, d, feats, split):
    return train.score(model, d.filter(F.col("split") == split), feats, keep=[KEY, Y])


def train_gbt(spark, sf_dir):
    d, feats = _parts(spark, sf_dir)
    return _scores(_gbt_model(d, feats, 50), d, feats, "test")


def train_rf(spark, sf_dir):
    d, feats = _parts(spark, sf_dir)
    model = train.fit(train.random_forest(Y, W), d.filter(F.col("split") == "train"), feats)
    return _scores(model, d, feats, "test")


def tune(spark, sf_dir):
    d, feats = _parts(spark, sf_dir)
    return train.random_search(train.packed(d.filter(F.col("split") == "train")), d.filter(F.col("split") == "thr"), feats,
                               KEY, Y, W, TUNE_TRIALS, rounds=TUNE_ROUNDS)


def four_families(rounds: int, trees: int, stages: int, depth: int = 8) -> dict[str, Callable[[], Estimator]]:
    """The notebooks' four: boosted trees, a second kind of them (deeper, slower, on parts of rows and columns), a forest
    and adaptive boosting."""
    return {
        "gbt": lambda: train.gbt(Y, W, max_iter=rounds),
        "gbt_deep": lambda: train.gbt(Y, W, max_iter=rounds, max_depth=6, step=0.05, subsample=0.8).setFeatureSubsetStrategy("0.8"),
        "rf": lambda: train.random_forest(Y, W, trees=trees, max_depth=depth),
        "ada": lambda: boost.AdaBoostClassifier(labelCol=Y, weightCol=W, maxIter=stages, maxDepth=3, stepSize=0.1)}


def _base_models(d, feats):
    tr = d.filter(F.col("split") == "train")
    jobs = [lambda: train.fit(train.gbt(Y, W, max_iter=50), tr, feats), lambda: train.fit(train.random_forest(Y, W), tr, feats)]
    return dict(zip(("gbt", "rf"), train.side_by_side(d.sparkSession, jobs), strict=True))


def _multi_score(models, df, feats, keep=()):
    """Scores of all models for every row, one pass: the models' columns have names of their own."""
    out = train.assemble(df.select(KEY, Y, *keep, *feats), feats)
    for name, m in models.items():
        m = m.copy()
        m.setProbabilityCol(f"_prob_{name}").setRawPredictionCol(f"_raw_{name}").setPredictionCol(f"_pred_{name}")
        out = m.transform(out)
    return out.select(KEY, Y, *keep, *(train.positive(f"_prob_{n}").alias(f"score_{n}") for n in models))


def stack_of_four(d: DataFrame, feats: list[str], rounds: int = 50, trees: int = 100, stages: int = 50, meta_rounds: int = 200,
                  folds: int = 3) -> DataFrame:
    """Stacked scores of the test rows: the boosted meta-model learns from four families' out-of-fold scores of the training rows."""
    meta = GBTClassifier(featuresCol=train.FEATURES, labelCol=Y, maxIter=meta_rounds, maxDepth=4, stepSize=0.05, seed=train.SEED)
    models, top, _ = stacking.stacked(four_families(rounds, trees, stages), meta, d.filter(F.col("split") == "train"), feats, KEY, Y, folds)
    test = d.filter(F.col("split") == "test")
    return stacking.stack_scores(models, top, test, feats, [KEY, Y], "y_proba_stack").select(KEY, Y, "y_proba_stack")


def ensemble_stack(spark, sf_dir):
    return stack_of_four(*_parts(spark, sf_dir))


def consensus_of_four(d: DataFrame, feats: list[str], rounds: int = 300, trees: int = 100, stages: int = 100) -> DataFrame:
    """Features that the eliminations of all four families, side by side, keep in their best round. Budgets of each fit are the notebooks'."""
    tr, thr = train.packed(d.filter(F.col("split") == "train")), d.filter(F.col("split") == "thr")
    families = four_families(rounds, trees, stages, depth=10)
    return train.consensus(list(train.eliminations(families, tr, thr, feats, KEY, Y).values()))


def feature_consensus(spark, sf_dir):
    return consensus_of_four(*_parts(spark, sf_dir))


def score_base(spark, sf_dir):
    """Full-base scoring: both models on every customer, F1-weighted ensemble, rank, decile, yes/no."""
    d, feats = _parts(spark, sf_dir)
    models = _base_models(d, feats)
    # weights and the threshold come from the threshold half: the test half stays unseen
    thr = cut_lineage(_multi_score(models, d.filter(F.col("split") == "thr"), feats))
    f1 = {n: float(ev.best_f1_threshold(thr, y=Y, p=f"score_{n}").first()["f1"]) for n in models}
    total = sum(f1.values())
    if total == 0:
        raise ValueError("no model finds a positive on the threshold half: the ensemble has no weights")
    weights = {f"score_{n}": v / total for n, v in f1.items()}
    ens_thr = thr.withColumn("score_ensemble", train.ensemble_columns(weights))
    cut = float(ev.best_f1_threshold(ens_thr, y=Y, p="score_ensemble").first()["threshold"])
    # stored once: the quantiles, the ranks and the output read it
    full = cut_lineage(_multi_score(models, d, feats).withColumn("score_ensemble", train.ensemble_columns(weights)))
    edges = exact_quantiles(full, "score_ensemble", [j / 10 for j in range(1, 10)], key=KEY)
    ranked = average_rank(full, "score_ensemble", "rank")
    return ranked.select(
        KEY, Y, *(f"score_{n}" for n in models), "score_ensemble", "rank",
        value_decile(F.col("score_ensemble"), edges).alias("score_decile"),
        (F.col("score_ensemble") >= F.lit(cut)).cast("int").alias("prediction"),
    ).orderBy(F.col("score_ensemble").desc(), F.col(KEY))


def log_run(spark: SparkSession, path: str, run_id: str, model: str, values: dict[str, float]) -> None:
    """Append (run_id, model, name, value) rows to a run-tracking table."""
    rows = [(run_id, model, k, float(v)) for k, v in values.items()]
    spark.createDataFrame(rows, "run_id string, model string, name string, value double") \
        .write.mode("append").parquet(path)


def run_log(spark, sf_dir):
    d, feats = _parts(spark, sf_dir)
    model = _gbt_model(d, feats, 20)
    s = _scores(model, d, feats, "test")
    metrics = ev.model_metrics(s, 0.5, "gbt", key=KEY, y=Y, p="y_proba").first().asDict()
    path = scratch_path(spark, "runs")
    log_run(spark, path, "run-0", "gbt", {"max_iter": 20, **{k: v for k, v in metrics.items()
                                                             if isinstance(v, float)}})
    return spark.read.parquet(path)


QUERIES = {
    "feature_importance": feature_importance,
    "prune_correlated": prune_correlated,
    "permutation_importance": permutation_importance,
    "rfe": rfe,
    "train_gbt": train_gbt,
    "train_rf": train_rf,
    "tune": tune,
    "ensemble_stack": ensemble_stack,
    "feature_consensus": feature_consensus,
    "score_base": score_base,
    "run_log": run_log,
}


def top_features(spark, sf_dir):
    """The 20 most important features (a top-k report)."""
    return feature_importance(spark, sf_dir).limit(20)


def downcast_features(spark, sf_dir):
    """Model features as 32-bit floats (key and label kept)."""
    d, feats = _parts(spark, sf_dir)
    return d.select(KEY, Y, *(F.col(c).cast("float").alias(c) for c in feats))


def model_split(spark, sf_dir):
    """Every customer's label, class weight and part (train, thr, test) in the model data."""
    return model_data(spark, sf_dir).select(KEY, Y, W, "split")


QUERIES.update({"top_features": top_features, "downcast_features": downcast_features, "model_split": model_split})


def oversampled(spark, sf_dir):
    """The training rows and as many new positives at the border as there are positives."""
    d, feats = _parts(spark, sf_dir)
    tr = d.filter(F.col("split") == "train")
    return smote.oversample(tr, KEY, Y, feats, 2 * tr.filter(F.col(Y) == 1).count())


def border_oversample(spark, sf_dir):
    """Rows of each class before and after border over-sampling, and how many new rows lie off their parents' range."""
    d, feats = _parts(spark, sf_dir)
    tr = d.filter(F.col("split") == "train")
    out = cut_lineage(smote.oversample(tr, KEY, Y, feats, 2 * tr.filter(F.col(Y) == 1).count()))
    real = out.filter(~F.col("synthetic"))
    # by its own estimate Spark would broadcast these arrays of all rows
    ends = [real.select(F.col(KEY).alias(c), F.array(*feats).alias(f"_{c}")).hint("merge") for c in ("parent", "neighbour")]
    both = out.filter("synthetic").join(ends[0], "parent").join(ends[1], "neighbour")
    off = F.exists(F.zip_with(F.array(*feats), F.zip_with("_parent", "_neighbour", lambda a, b: F.struct(a.alias("a"), b.alias("b"))),
                              lambda v, e: (v < F.least(e["a"], e["b"]) - 1e-6) | (v > F.greatest(e["a"], e["b"]) + 1e-6)), lambda x: x)
    new = both.groupBy(Y).agg(F.count(F.lit(1)).alias("n"), F.count(F.when(off, 1)).alias("n_off")).withColumn("synthetic", F.lit(True))
    old = real.groupBy(Y).agg(F.count(F.lit(1)).alias("n")).withColumns({"n_off": F.lit(0).cast("long"), "synthetic": F.lit(False)})
    return old.select("synthetic", Y, "n", "n_off").unionByName(new.select("synthetic", Y, "n", "n_off"))


QUERIES.update({"oversampled": oversampled, "border_oversample": border_oversample})
