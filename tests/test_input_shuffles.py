"""Inputs and kept bitmaps at size: lines are dealt no more often than needed, and odd keys give the same rows."""

from __future__ import annotations

import datetime as dt
import re
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rivalry.sources import fixtures as fx


@pytest.fixture
def shuffled_joins(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k in keys:
        spark.conf.unset(k)


@pytest.fixture
def odd_dir(spark, tmp_path):
    """Orders, lines and parts with repeated and null keys."""
    day = [dt.datetime(2001, 7, 1), dt.datetime(2001, 7, 2), None]
    tables = {
        "orders": ([(1, day[0]), (1, day[1]), (2, day[0]), (2, day[0]), (19, day[1]), (23, day[2]), (None, day[0])],
                   "o_orderkey bigint, o_orderdate timestamp"),
        "lineitem": ([(o, p, price, 0.05, q) for o in (1, 2, 19, 23, None) for p, price, q in (
            (10, 7.5, 2.0), (10, 7.5, 2.0), (11, 3.25, 1.0), (12, None, None), (None, 1.0, 1.0))],
            "l_orderkey bigint, l_partkey bigint, l_extendedprice double, l_discount double, l_quantity double"),
        "part": ([(10, "red x", "SMALL", "Brand#1"), (10, "red x", "SMALL", "Brand#1"), (11, "red x", "SMALL", "Brand#2"),
                  (11, "red x", "LARGE", "Brand#2"), (12, None, None, "Brand#3"), (None, "red x", "SMALL", "Brand#4")],
                 "p_partkey bigint, p_name string, p_type string, p_brand string")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def _rows(df):
    return Counter(map(tuple, df.collect()))


def _dealt(df):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", df._jdf.queryExecution().executedPlan().toString())


def test_switching_pairs_of_odd_keys(spark, odd_dir):
    """Counted by hand from the order lines, a year and an order at a time."""
    k = Counter((r.dt.year, r.okey, r.cid3, r.sku_id) for r in fx.derive_order_det(spark, odd_dir).collect() if r.dt and r.cid3)
    n, total = Counter(), Counter()
    for (*basket, a), x in k.items():
        for (*other, b), y in k.items():
            if basket == other:
                n[basket[2], a, b] += x * y
                total[basket[2], a] += x * y
    want = {(c, a, b): Decimal(v * 10**6 // total[c, a]) / 10**6 for (c, a, b), v in n.items()}
    found = fx.derive_sku_switch(spark, odd_dir).collect()
    assert want and len(found) == len(want)
    assert {(r.cid3, r.src_item_id, r.dst_item_id): r.switching_prob for r in found} == want


def test_order_lines_are_paired_without_a_join(spark, small_dir, shuffled_joins):
    fx.order_det(spark, small_dir)
    df = fx.derive_sku_switch(spark, small_dir)
    assert "Join" not in df._jdf.queryExecution().executedPlan().toString()
    assert len(_dealt(df)) == 2


def test_a_large_day_is_stored_by_several_tasks(spark, tmp_path):
    key, size = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k"
    derive = lambda s, d: s.range(0, 60000, 1, 16).select(F.xxhash64("id").alias("x"), F.lit(dt.date(2001, 7, 1)).alias("dt"))
    spark.conf.set(key, size)
    try:
        df = fx._stored("large_day", derive, by_day=True)(spark, str(tmp_path))
    finally:
        spark.conf.unset(key)
    assert df.count() == 60000 and len(df.inputFiles()) > 1


def test_kept_bitmaps_are_small_and_exact(spark, tmp_path):
    from rivalry.operators import distinct

    end, ids = dt.date(2001, 7, 31), [-65, -64, -1, 0, 1, 63, 64, 127, 32768, 2**62, -(2**63), 2**63 - 1]
    rows = [(c, "b", i, 1.0, d) for c in ("x", None) for i in ids for d in (end, end, end - dt.timedelta(1))]
    rows += [("x", "b", None, 1.0, end), ("x", "b", 7, 0.0, end), ("x", "b", 8, None, end)]
    sales = spark.createDataFrame(rows, "cid3 string, brand_code string, sku_id bigint, sale_qtty double, dt date")
    distinct.store_sold(sales, out := str(tmp_path / "maps"))
    daily = spark.read.schema("dt date, cid3 string, brand_code string, bucket bigint, bits binary, month string").parquet(out)
    assert {r[0] for r in daily.select(F.octet_length("bits")).distinct().collect()} == {8}
    for days in (0, 1):
        found = distinct.sold_in_window(daily, end=end, days=days).collect()
        assert {r.cid3: r.sku_num for r in found} == {"x": len(ids), None: len(ids)}


def test_matched_lines_are_dealt_once_for_both_sides(spark, small_dir, odd_dir, shuffled_joins):
    found = {(r.main_sku_id1, r.main_sku_id2) for r in fx.derive_sku_match(spark, odd_dir).collect()}
    assert found == {(10, 11)}
    assert not [k for k in _dealt(fx.derive_sku_match(spark, small_dir)) if k.startswith("l_orderkey") and "l_partkey" in k]


def test_daily_sales_equal_the_sums_of_the_order_lines(spark, small_dir, odd_dir):
    for folder in (small_dir, odd_dir):
        total = F.when(F.col("sku_id") % 10 == 0, F.lit(500).cast("decimal(22,4)")).otherwise(F.col("total"))
        returns = (F.col("brand_code") == "Brand#1") & (F.length("cid3") == 5)
        want = (fx.derive_order_det(spark, folder).groupBy("cid3", "brand_code", "sku_id", "dt")
                .agg(F.sum("amount").cast("decimal(22,4)").alias("total"), F.sum("qty").alias("sale_qtty"))
                .select("cid3", "brand_code", "sku_id", "dt",
                        F.when(returns, -F.abs(total)).otherwise(total).cast("decimal(22,4)").alias("gmv"), "sale_qtty"))
        found = fx.derive_sku_sales(spark, folder)
        assert found.schema.simpleString() == want.schema.simpleString()
        assert _rows(found) == _rows(want) and want.count()


def test_sales_lines_are_dealt_by_order_and_by_sku_only(spark, small_dir, shuffled_joins):
    keys = [k for k in _dealt(fx.derive_sku_sales(spark, small_dir)) if k.startswith("l_")]
    assert len(keys) == 2 and keys[0].startswith("l_partkey") != keys[1].startswith("l_partkey")
