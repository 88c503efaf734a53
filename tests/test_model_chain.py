"""The model chain on the smallest tables with small budgets: each step uses the one before it."""

import duckdb
import pytest
from pyspark.sql import functions as F

from strata.plans import model_chain as mc
from strata.plans import modeling as md
from strata.plans import registry
from sf_paths import SF_SMALL


@pytest.fixture(scope="module")
def chain(spark):
    d, feats = md._parts(spark, SF_SMALL)
    return d, feats, mc.run(d, feats, mc.Settings(rounds=3, trees=5, repeats=1, trials=2, search_rounds=(2, 3)))


def test_every_feature_has_a_status(chain):
    _, feats, out = chain
    rows = {r["feature"]: r for r in out["features"].collect()}
    assert set(rows) == set(feats)
    assert all((r["importance"] > 0) == (r["status"] != "unused") for r in rows.values())
    tried = {f for f, r in rows.items() if r["status"] in ("final", "no_gain")}
    assert {f for f, r in rows.items() if r["perm_importance"] is not None} <= tried
    assert any(r["status"] == "final" for r in rows.values())


def test_scores_cover_every_customer_once(spark, chain):
    d, _, out = chain
    scores = out["scores"]
    assert scores.count() == d.count() == scores.select(md.KEY).distinct().count()
    assert scores.join(d.select(md.KEY, md.Y, "split"), [md.KEY, md.Y, "split"]).count() == d.count()
    got = scores.orderBy(F.col("score_ensemble").desc()).select("score_ensemble", "rank", "score_decile").collect()
    at = {}
    for i, r in enumerate(got, 1):
        at.setdefault(r["score_ensemble"], []).append(i)
    assert all(r["rank"] == int(sum(at[r["score_ensemble"]]) / len(at[r["score_ensemble"]])) for r in got)
    deciles = [r["score_decile"] for r in got]
    assert deciles == sorted(deciles, reverse=True)


def test_benchmark_is_of_the_test_part(chain):
    _, _, out = chain
    rows = out["benchmark"].orderBy("position").collect()
    assert {r["model"] for r in rows} == {"gbt", "rf", "ensemble"} and [r["position"] for r in rows] == [1, 2, 3]
    test = out["scores"].where("split = 'test'").toPandas()
    for r in rows:
        said, y = test[f"score_{r['model']}"] >= r["exact_threshold"], test[md.Y] == 1
        tp = int((said & y).sum())
        want = 2 * tp / (int(said.sum()) + int(y.sum())) if tp else 0.0
        assert r["f1"] == pytest.approx(want, abs=1e-4)


def test_facts_equal_the_oracle(chain):
    _, _, out = chain
    got = mc.facts(out["scores"], out["benchmark"]).first().asDict()
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    cur = con.execute(registry.oracle_sql()["trained_facts"])
    assert got == dict(zip([c[0] for c in cur.description], cur.fetchone(), strict=True))
