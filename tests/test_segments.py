"""Snapshots, windows, GMV and labels."""

import datetime as dt
from decimal import Decimal

from rivalry.functions.dates import latest_snapshot, trailing
from rivalry.functions.joins import checked_broadcast
from rivalry.operators.segments import brand_labels, market_labels, sku_gmv
from rivalry.sources.sinks import overwrite_partitions

D = dt.date


def test_latest_snapshot_whole_table_and_per_group(spark):
    df = spark.createDataFrame([("a", D(2001, 1, 1)), ("a", D(2001, 2, 1)), ("b", D(2001, 1, 1))],
                               "cid3 string, dt date")
    assert [tuple(r) for r in latest_snapshot(df, "dt").collect()] == [("a", D(2001, 2, 1))]
    per = sorted(tuple(r) for r in latest_snapshot(df, "dt", by=["cid3"]).collect())
    assert per == [("a", D(2001, 2, 1)), ("b", D(2001, 1, 1))]


def test_trailing_window_bounds(spark):
    df = spark.createDataFrame([(D(2001, 1, 1),), (D(2001, 1, 2),), (D(2001, 1, 11),), (D(2001, 1, 12),)], "dt date")
    inc = sorted(r.dt for r in trailing(df, "dt", D(2001, 1, 11), 10).collect())
    exc = sorted(r.dt for r in trailing(df, "dt", D(2001, 1, 11), 10, end_inclusive=False).collect())
    assert inc == [D(2001, 1, 1), D(2001, 1, 2), D(2001, 1, 11)]
    assert exc == [D(2001, 1, 1), D(2001, 1, 2)]


ORD = "sku_id bigint, cid3 string, dt date, amount decimal(18,4)"


def test_sku_gmv_per_category_window_and_positive_lines(spark):
    od = spark.createDataFrame([
        (1, "a", D(2001, 8, 1), Decimal("10")), (1, "a", D(2000, 8, 1), Decimal("1")),
        (1, "a", D(2000, 7, 31), Decimal("100")), (1, "a", D(2001, 5, 1), Decimal("-3")),
        (2, "b", D(2001, 1, 1), Decimal("7")), (2, "b", D(2000, 1, 2), Decimal("5")), (2, "b", D(2000, 1, 1), Decimal("50")),
        (3, "z", D(2001, 1, 1), Decimal("9"))], ORD)
    ends = spark.createDataFrame([("a", D(2001, 8, 1)), ("b", D(2001, 1, 1))], "cid3 string, dt date")
    got = {(r.cid3, r.sku_id): float(r.gmv) for r in sku_gmv(od, end=ends).collect()}
    assert got == {("a", 1): 11.0, ("b", 2): 12.0}
    fixed = {(r.cid3, r.sku_id): float(r.gmv) for r in sku_gmv(od, end=D(2001, 1, 1)).collect()}
    assert fixed == {("a", 1): 101.0, ("b", 2): 12.0, ("z", 3): 9.0}


DIM = "sku_id bigint, cid3 string, brand_code string, brand_name string, valid_flag int"


def test_brand_labels_max_code_per_name_and_fan_out(spark):
    dim = spark.createDataFrame([
        (1, "c", "10", "X", 1), (1, "c", "11", "X", 1),   # one name, two codes → max
        (2, "c", "20", "Y", 1), (2, "c", "21", "Z", 1),   # two names → two codes
        (3, "c", "30", "W", 0)], DIM)                      # invalid
    labels, names = brand_labels(dim)
    assert sorted((r.sku_id, r.brand_code) for r in labels.collect()) == [(1, "11"), (2, "20"), (2, "21")]
    assert sorted((r.brand_code, r.brand_name) for r in names.collect()) == [("11", "X"), ("20", "Y"), ("21", "Z")]


def test_market_labels_web_id_and_definitions(spark):
    attrs = spark.createDataFrame([
        (1, "c", "color", "red", 0), (1, "c", "color", "blue", 0), (2, "c", "color", "red", 1),
        (3, "c", "color", "green", 0), (4, "c", "shape", "bolt", 0)],
        "sku_id bigint, cid3 string, attr_name string, attr_value string, web_id int")
    defs = spark.createDataFrame([("c", "color", "red"), ("c", "color", "blue"), ("c", "shape", "bolt")],
                                 "cid3 string, attr_name string, attr_value string")
    got = sorted(tuple(r) for r in market_labels(attrs, defs).collect())
    assert got == [("c", "color", 1, "red"), ("c", "shape", 4, "bolt")]


def test_checked_broadcast_hints_only_under_the_bound(spark):
    over = checked_broadcast(spark.range(10).select("id"), max_bytes=5)
    assert "broadcast" not in _analyzed(over).lower()
    under = checked_broadcast(spark.range(10).select("id"), max_bytes=1000)
    assert "broadcast" in _analyzed(under).lower()
    assert "BroadcastHashJoin" in spark.range(1000).join(under, "id")._jdf.queryExecution().executedPlan().toString()


def test_checked_broadcast_lets_errors_rise(spark):
    import pytest
    from pyspark.sql import functions as F
    bad = spark.range(3).select(F.raise_error(F.lit("broken input")).alias("id"))
    with pytest.raises(Exception, match="broken input"):
        checked_broadcast(bad)


def test_stored_inputs_let_errors_rise(spark, tmp_path):
    import pytest
    from rivalry.sources import fixtures as fx
    spark.createDataFrame([("x",)], "p_partkey string").write.parquet(str(tmp_path / "part.parquet"))
    with pytest.raises(Exception, match="(?i)unresolved|cannot resolve"):
        fx.sku_dim(spark, str(tmp_path))


def test_no_job_without_a_checkpoint_folder(spark, monkeypatch):
    import rivalry.functions.joins as joins
    monkeypatch.setattr(joins, "checkpoint_folder", lambda s: None)
    df = spark.range(3)
    assert checked_broadcast(df) is df


def _analyzed(df):
    return df._jdf.queryExecution().analyzed().toString()


def test_overwrite_partitions_keeps_other_dates(spark, tmp_path):
    path = str(tmp_path / "out")
    first = spark.createDataFrame([(1, D(2001, 1, 1)), (2, D(2001, 1, 2))], "v int, dt date")
    overwrite_partitions(first, path)
    overwrite_partitions(spark.createDataFrame([(9, D(2001, 1, 2))], "v int, dt date"), path)
    got = sorted((r.v, r.dt) for r in spark.read.parquet(path).collect())
    assert got == [(1, D(2001, 1, 1)), (9, D(2001, 1, 2))]


def test_overwrite_clears_partitions_that_the_rerun_lacks(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = [(1, "a b/c", "2001-01-01"), (2, "d", "2001-01-01"), (3, "d", "2001-01-02")]
    first = spark.createDataFrame(rows, "v int, cid3 string, dt string")
    overwrite_partitions(first, path, ("dt", "cid3"), fmt="orc")
    overwrite_partitions(first.filter("v = 2"), path, ("dt", "cid3"), fmt="orc", clear=[{"dt": "2001-01-01", "cid3": "a b/c"}])
    read = lambda: sorted(tuple(r) for r in spark.read.orc(path).selectExpr("v", "cid3", "string(dt)").collect())
    assert read() == rows[1:]
    overwrite_partitions(first.limit(0), path, ("dt", "cid3"), fmt="orc", clear=[{"dt": "2001-01-01"}])
    assert read() == rows[2:]


def test_overwrite_of_a_catalog_table(spark):
    import uuid
    name = f"t_{uuid.uuid4().hex[:8]}"
    rows = [(1, "it's", "2001-01-01"), (2, "d", "2001-01-01"), (3, "d", "2001-01-02")]
    first = spark.createDataFrame(rows, "v int, cid3 string, dt string")
    overwrite_partitions(first, f"table:{name}", ("dt", "cid3"))
    overwrite_partitions(first.filter("v = 2").withColumn("v", first.v * 10), f"table:{name}", ("dt", "cid3"))
    read = lambda: sorted(tuple(r) for r in spark.table(name).select("v", "cid3", "dt").collect())
    assert read() == [rows[0], rows[2], (20, "d", "2001-01-01")]
    overwrite_partitions(first.limit(0), f"table:{name}", ("dt", "cid3"), clear=[{"dt": "2001-01-01"}])
    assert read() == [rows[2]]
    spark.sql(f"DROP TABLE {name}")


def test_results_unchanged_when_nothing_may_be_broadcast(spark, small_dir, monkeypatch):
    # Beyond the bound the small frames are joined by shuffle; results must not change.
    import rivalry.functions.joins as joins
    from rivalry.plans.registry import QUERIES
    names = ["brand_profile", "coview_by_category", "sku_gmv"]
    want = {n: sorted(tuple(r) for r in QUERIES[n](spark, small_dir).collect()) for n in names}
    monkeypatch.setattr(joins.checked_broadcast, "__defaults__", (0,))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        for n in names:
            df = QUERIES[n](spark, small_dir)
            assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()
            assert sorted(tuple(r) for r in df.collect()) == want[n]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
