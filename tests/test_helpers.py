import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strata.operators import prep, profile, train
from strata.sources import scan


def test_grouped_average_precision_matches_per_group(spark):
    rows = [(g, k, int((k * 7 + g) % 3 == 0), round(((k * 13 + g * 5) % 17) / 17, 3)) for g in range(3) for k in range(80)]
    df = spark.createDataFrame(rows, "g int, k int, y int, p double")
    got = {r.g: r.ap for r in train.grouped_average_precision(df, "g", "y", "p").collect()}
    pdf = pd.DataFrame(rows, columns=["g", "k", "y", "p"])
    for g, part in pdf.groupby("g"):
        y, p = part["y"].to_numpy(), part["p"].to_numpy()
        ap = sum((y[p == t].sum() / y.sum()) * (y[p >= t].sum() / (p >= t).sum()) for t in set(p))
        assert got[g] == pytest.approx(ap, abs=1e-12)


def test_permuted_keeps_each_feature_multiset(spark):
    df = spark.range(200).select(F.col("id").alias("k"), (F.col("id") % 3).cast("int").alias("y"),
                                 (F.col("id") * 2.0).alias("a"), (F.col("id") % 11 * 1.0).alias("b"))
    from pyspark.ml.functions import vector_to_array

    long = train._permuted(df, ["a", "b"], "k", seed=3, buckets=4)
    v = vector_to_array("features")
    long = long.select("k", "_feature", v[0].alias("a"), v[1].alias("b")).toPandas()
    base = df.toPandas()
    for f, other in (("a", "b"), ("b", "a")):
        part = long[long["_feature"] == f].sort_values("k")
        assert sorted(part[f]) == sorted(base[f])              # a permutation of the column
        assert list(part[other]) == list(base.sort_values("k")[other])  # other features untouched
        assert (part[f].to_numpy() != base.sort_values("k")[f].to_numpy()).mean() > 0.5


def test_list_tables_and_layouts(spark, tmp_path):
    root = str(tmp_path / "bronze")
    spark.range(5).write.parquet(f"{root}/flat_t")
    spark.range(7).write.parquet(f"{root}/ice_t/data")
    spark.createDataFrame([("m",)], "v string").write.text(f"{root}/ice_t/metadata")
    got = {r.table: (r.layout, r.n_files > 0) for r in scan.list_tables(spark, root).collect()}
    assert got == {"flat_t": ("flat", True), "ice_t": ("data_subdir", True)}
    assert scan.detect_layout(spark, f"{root}/ice_t").endswith("ice_t/data")
    assert scan.detect_layout(spark, f"{root}/flat_t").endswith("flat_t")
    assert scan.scan_parquet(spark, scan.detect_layout(spark, f"{root}/ice_t")).count() == 7


def test_scan_tolerant_skips_only_missing(spark, tmp_path):
    good = str(tmp_path / "good")
    spark.range(3).write.parquet(good)
    assert scan.scan_tolerant(spark, [str(tmp_path / "nope"), good]).count() == 3
    with pytest.raises(FileNotFoundError):
        scan.scan_tolerant(spark, [str(tmp_path / "nope")])
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "x.parquet").write_text("not parquet")
    with pytest.raises(Exception) as err:
        scan.scan_tolerant(spark, [str(bad), good]).count()
    assert not isinstance(err.value, FileNotFoundError)


def test_exact_percentiles_many_columns(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"a": rng.normal(size=301), "b": rng.integers(0, 5, size=301).astype(float)})
    df = spark.createDataFrame(pdf)
    qs = [0.5, 0.75, 0.95, 0.99, 1.0]
    got = profile.exact_percentiles(df, ["a", "b"], qs).toPandas().set_index("column")
    for c in ["a", "b"]:
        exp = np.percentile(pdf[c], [q * 100 for q in qs])
        assert np.allclose(got.loc[c, [f"q{i}" for i in range(5)]].to_numpy(dtype=float), exp, atol=1e-12)


def test_split_sample_undersample_weights(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), F.when(F.col("id") % 10 == 0, 1).otherwise(0).alias("y"))
    split = prep.stratified_split(df, "y", "k", 0.2)
    counts = {(r.y, r.split): r["count"] for r in split.groupBy("y", "split").count().collect()}
    assert counts == {(0, "test"): 180, (0, "train"): 720, (1, "test"): 20, (1, "train"): 80}
    s1 = sorted(r.k for r in prep.sample_n(df, 37, "k").collect())
    assert len(s1) == 37 and s1 == sorted(r.k for r in prep.sample_n(df, 37, "k").collect())
    us = {r.y: r["count"] for r in prep.undersample(df, "y", "k", {0: 300}).groupBy("y").count().collect()}
    assert us == {0: 300, 1: 100}
    w = {r.y: r.weight for r in prep.class_weight(df, "y").select("y", "weight").distinct().collect()}
    assert w == {0: 1.0, 1: 9.0}
    wb = {r.y: r.weight for r in prep.class_weight(df, "y", "balanced").select("y", "weight").distinct().collect()}
    assert wb[1] == pytest.approx(1000 / (2 * 100)) and wb[0] == pytest.approx(1000 / (2 * 900))


def test_checkpoint_dir_from_session(spark):
    from strata.session import checkpoint_dir, scratch_path

    d = checkpoint_dir(spark)
    assert d and scratch_path(spark, "x").startswith(d.rstrip("/"))


def test_selection_with_loose_sketches_is_exact(spark):
    """Hot values, ties, nulls, tiny columns and a sketch that is off by a tenth of the rows: always the exact value."""
    from strata.operators import selection

    rnd = np.random.default_rng(4)
    n = 3000
    pdf = pd.DataFrame({"a": rnd.normal(size=n), "b": np.where(rnd.random(n) < 0.9, 0.0, rnd.exponential(size=n)),
                        "c": rnd.integers(0, 5, n).astype(float)})
    pdf.loc[::7, "a"] = np.nan
    df = spark.createDataFrame([tuple(None if x != x else float(x) for x in r) for r in pdf.itertuples(index=False)],
                               "a double, b double, c double").repartition(5)
    df = df.withColumn("one", F.when(F.col("a") == float(np.nanmax(pdf["a"])), 3.5)).withColumn("none", F.lit(None).cast("double"))
    qs = [0.0, 0.013, 0.5, 0.9, 0.95, 0.999, 1.0]
    for accuracy in (10, 100, 10_000):
        got = selection.values_at(df, {c: qs for c in ("a", "b", "c", "one", "none")}, accuracy)
        for c in "abc":
            assert [got[c][q] for q in qs] == pytest.approx(np.nanpercentile(pdf[c], [q * 100 for q in qs]).tolist())
        assert set(got["one"].values()) == {3.5} and set(got["none"].values()) == {None}


def test_positions_outside_their_bounds_are_found(spark, monkeypatch):
    """Bounds that do not hold are noticed by the counts."""
    from strata.operators import selection

    monkeypatch.setattr(selection, "_bounds", lambda narrow, wanted, size, accuracy: {
        (c, p): (900.0, 950.0) for c, ps in wanted.items() for p in ps})
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    assert selection.values_at(df, {"x": [0.1, 0.92]})["x"] == pytest.approx({0.1: 99.9, 0.92: 919.08})
