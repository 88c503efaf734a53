"""Every registered query with an oracle: Spark vs DuckDB at sf0.001 (exact after sorting)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF).toPandas()
    odf = con.execute(entry.oracle_sql()[name]).df()
    r = compare(sdf, odf)
    assert r["cols_ok"], r
    assert r["rows"][0] == r["rows"][1], r
    assert r.get("near"), r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 86
    assert df.count() > 0


def test_every_query_has_a_callable():
    qs = entry.queries()
    assert set(entry.oracle_sql()) <= set(qs)
