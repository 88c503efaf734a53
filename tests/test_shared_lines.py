"""Bronze sources made of order lines share one stored join."""

import datetime as dt

from strata.plans import entities
from strata.plans import fixtures as fx
from strata.plans.lake import LakePaths
from strata.session import checkpoint_dir, folders

LINE = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
        "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")


def _tables(spark, at):
    day = lambda n: dt.datetime(1995, 1, 1) + dt.timedelta(days=n)
    lines = [(i // 9 if i % 10 else None, i % 4, 0, i % 9, 1.0, 10.0 + i, 0.1 * (i % 3), 0.0, "ARN"[i % 3], "OF"[i % 2], day(i)) for i in range(90)]
    lines += lines[:20] + [(3, None, 0, 1, None, None, None, None, None, None, None)]  # rows that come twice, nulls
    orders = [(k, k % 4 or None, "OFP"[k % 3], 5.0 * k, day(k), "1-URGENT") for k in (*range(9), 3)]  # a key that comes twice
    orders.append((None, 1, "O", 1.0, day(0), "1-URGENT"))
    spark.createDataFrame(lines, LINE).write.parquet(f"{at}/lineitem.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
                                  "o_orderpriority string").write.parquet(f"{at}/orders.parquet")
    spark.createDataFrame([(k, "p", f"B{k}", "PROMO", 1, 1.0) for k in (0, 1, 2, 2)], "p_partkey long, p_name string, p_brand string, "
                          "p_type string, p_size int, p_retailprice double").write.parquet(f"{at}/part.parquet")


def test_order_lines_are_joined_once(spark, tmp_path, monkeypatch):
    at, paths = str(tmp_path / "in"), LakePaths(str(tmp_path / "lake"))
    _tables(spark, at)
    stored = lambda: {n for n in folders(spark, checkpoint_dir(spark)) if n.startswith("strata-lines")}
    read, seen, before = fx.read, [], stored()
    monkeypatch.setattr(fx, "read", lambda s, d, name: seen.append(name) or read(s, d, name))
    source = entities.land(spark, at, paths, list(fx.OF_LINES), defects=True)
    assert seen.count("lineitem") == 1 and seen.count("orders") == 1  # eleven sources
    assert stored() == before
    rows = lambda df: sorted(map(repr, df.collect()))
    for name in fx.OF_LINES:
        for s in entities.SPECS[name].sources:
            if s not in entities.ABSENT:
                got, own = source(s), entities.bronze(spark, at, s, True)  # with a join of its own
                assert got.dtypes == own.dtypes and rows(got) == rows(own), s
                assert own.count() > 0


def test_one_entity_reads_its_own_lines(spark, tmp_path, monkeypatch):
    at, paths = str(tmp_path / "in"), LakePaths(str(tmp_path / "lake"))
    _tables(spark, at)
    monkeypatch.setattr(fx, "order_lines", lambda *_: 1 / 0)  # the lines of all numbers are not stored for one of them
    assert entities.land(spark, at, paths, ["mad"], defects=False)("mad").count() > 0
