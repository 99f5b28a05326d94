"""Physical-plan checks: no Cartesian products, no Python evaluation, pruned scans."""

import re

import pytest

from rivalry.plans.registry import QUERIES

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_cartesian_or_python(spark, small_dir, name):
    plan = _plan(QUERIES[name](spark, small_dir))
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"


def test_scans_read_only_needed_columns(spark, small_dir):
    plan = _plan(QUERIES["brand_profile"](spark, small_dir))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas
    for s in schemas:
        cols = {c.split(":")[0] for c in s.split(",")}
        # lineitem has 11 columns; the jobs need at most five of them.
        assert "l_comment" not in cols and "l_shipdate" not in cols and "l_tax" not in cols


def test_click_window_filter_reaches_the_scan(spark, small_dir):
    plan = _plan(QUERIES["coview_by_category"](spark, small_dir))
    scan = [line for line in plan.splitlines() if "FileScan" in line and "request_dt" in line]
    # The stored log is partitioned by day, so the window picks partitions.
    assert scan and all(re.search(r"PartitionFilters: \[[^\]]*dt#\d+ >= 2023-10-31", line) for line in scan)


def test_click_window_over_raw_events_reaches_their_scan(spark, small_dir):
    from pyspark.sql import functions as F

    from rivalry.operators.coview import coview_switch
    from rivalry.sources import fixtures as fx
    from rivalry.sources.tables import read_table
    log = read_table(spark, small_dir, "events").select(
        F.col("user_id").alias("session_id"), F.lit("1").alias("bs"), F.to_date("ts").alias("request_dt"),
        F.to_date("ts").alias("dt"), F.lit("c").alias("cid3"), F.col("event_type").alias("brand_code"))
    df = coview_switch(log, log.select("brand_code"), end=fx.CLICK_RUN_DATE)
    scan = [line for line in _plan(df).splitlines() if "events.parquet" in line]
    # dt = to_date(ts) in [end - 91, end] becomes a range on ts inside the scan.
    assert scan and any("GreaterThanOrEqual(ts," in line and "LessThan(ts," in line for line in scan)


@pytest.mark.parametrize("name", ["coview_by_category", "coview_pooled", "latest_snapshot"])
def test_days_prune_the_partitions_of_stored_inputs(spark, small_dir, name):
    plan = _plan(QUERIES[name](spark, small_dir))
    found = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert any("dt" in f for f in found)


def test_days_prune_partitioned_orders_and_sales(spark, small_dir, tmp_path):
    from rivalry.operators.segments import sku_gmv
    from rivalry.operators.volume import volume_rank
    from rivalry.plans.profiles import latest_switching
    from rivalry.sources import fixtures as fx

    def by_day(name, first):
        df = getattr(fx, name)(spark, small_dir).filter(f"dt >= DATE '{first}'")
        path = str(tmp_path / name)
        df.repartition("dt").write.partitionBy("dt").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    orders, sales = by_day("order_det", "2001-07-01"), by_day("sku_sales", "2001-07-01")
    _, ends = latest_switching(fx.sku_switch(spark, small_dir))
    for df in (sku_gmv(orders, end=ends), volume_rank(sales, end=fx.SIMILARITY_RUN_DATE)):
        found = re.findall(r"PartitionFilters: \[([^\]]*)\]", _plan(df))
        assert any("dt" in f for f in found)


@pytest.fixture
def no_automatic_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k in keys:
        spark.conf.unset(k)


@pytest.mark.parametrize("name", ["strong_coview", "strong_overlap"])
def test_pairs_are_not_shuffled_on_the_category_alone(spark, small_dir, no_automatic_broadcast, name):
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", _plan(QUERIES[name](spark, small_dir)))
    assert keys and all("," in k.rsplit(",", 1)[0] for k in keys)


def test_attributes_are_not_shuffled_on_their_values(spark, small_dir, no_automatic_broadcast):
    plan = _plan(QUERIES["market_labels"](spark, small_dir))
    assert "BroadcastHashJoin" in plan
    assert not [k for k in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan) if "attr_value" in k]


def test_order_lines_are_never_shuffled(spark, small_dir):
    # At scale Spark would not broadcast large tables; with its automatic
    # broadcasts off, the only shuffle left in sku_gmv carries the per-SKU
    # partial sums (the per-category window ends are a checked broadcast).
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(QUERIES["sku_gmv"](spark, small_dir))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 1 and "BroadcastHashJoin" in plan


def test_brand_labels_take_one_shuffle(spark, small_dir):
    plan = _plan(QUERIES["brand_labels"](spark, small_dir))
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 1 and "cid3" in shuffles[0] and "sku_id" in shuffles[0]
