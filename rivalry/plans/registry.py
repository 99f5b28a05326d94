"""Named queries over a test-data directory.

Each entry takes ``(spark, data_dir)`` and returns a lazy DataFrame built
from the fixture inputs of ``rivalry.sources.fixtures`` — i.e. from the whole
given tables.  Output columns are final (money as rounded DOUBLE, counts as
BIGINT) and match the DuckDB oracles in ``rivalry.oracle`` by name.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivalry.functions.dates import dt_value, latest_snapshot, trailing
from rivalry.functions.numeric import money_out
from rivalry.operators import flow as flow_ops
from rivalry.operators.distinct import store_sold
from rivalry.operators.overlap import sku_overlap, sku_overlap_pooled, symmetric_matches
from rivalry.operators.segments import brand_labels, category_list, market_labels, sku_gmv
from rivalry.operators.similarity import declared_rivals, strong_coview, strong_overlap
from rivalry.operators.volume import volume_rank
from rivalry.params import GMV_DAYS
from rivalry.plans import layout, profiles, similarity, sliding
from rivalry.session import ensure_checkpoint_dir
from rivalry.sources import fixtures as fx
from rivalry.sources.sinks import overwrite_partitions

# The category list of the queries that take one.
CATEGORIES = ("ECONOMY", "SMALL", "STANDARD")
# Ranges of the distributed rank: more than categories, so that some category spans several.
RANGES = 24
# Buckets of the stored flow inputs.
BUCKETS = 8

Query = Callable[[SparkSession, str], DataFrame]


def q_coview_by_category(spark, d):
    return similarity.coview_by_category(fx.clicks(spark, d), fx.sku_dim(spark, d), end=fx.CLICK_RUN_DATE)


def q_coview_pooled(spark, d):
    return similarity.coview_pooled(fx.clicks(spark, d), fx.sku_dim(spark, d), end=fx.CLICK_RUN_DATE)


def q_sku_gmv(spark, d):
    _, ends = profiles.latest_switching(fx.sku_switch(spark, d))
    g = sku_gmv(fx.order_det(spark, d), end=ends)
    return g.select("cid3", "sku_id", money_out("gmv").alias("gmv"))


def q_brand_labels(spark, d):
    labels, _ = brand_labels(latest_snapshot(fx.sku_dim(spark, d), "dt"))
    return labels


def _brand_flow(spark, d):
    flow, names, _ = profiles.brand_flow_inputs(fx.sku_dim(spark, d), fx.sku_switch(spark, d),
                                                fx.order_det(spark, d))
    return flow, names


def q_brand_spend_flow(spark, d):
    flow, _ = _brand_flow(spark, d)
    return flow.select("cid3", "src_brand_code", "dst_brand_code", money_out("spend_switch").alias("spend_switch"))


def q_loyalty(spark, d):
    return flow_ops.loyalty(_brand_flow(spark, d)[0])


def q_switch_in(spark, d):
    return flow_ops.switch_in(_brand_flow(spark, d)[0])


def q_net_erosion(spark, d):
    return flow_ops.net_erosion(_brand_flow(spark, d)[0])


def q_erosion_pairs(spark, d):
    flow, names = _brand_flow(spark, d)
    return flow_ops.erosion_pairs(flow, names, run_date=fx.ORDER_RUN_DATE)


def q_brand_profile(spark, d):
    return profiles.brand_profile(fx.sku_dim(spark, d), fx.sku_switch(spark, d), fx.order_det(spark, d),
                                  run_date=fx.ORDER_RUN_DATE)


def q_market_labels(spark, d):
    return market_labels(fx.sku_attrs(spark, d), profiles.definitions_snapshot(fx.market_defs(spark, d)))


def q_market_profile(spark, d):
    return profiles.market_profile(fx.sku_attrs(spark, d), fx.market_defs(spark, d), fx.sku_switch(spark, d),
                                   fx.order_det(spark, d), run_date=fx.ORDER_RUN_DATE)


def q_market_spend_flow(spark, d):
    flow = profiles.market_flow(fx.sku_attrs(spark, d), fx.market_defs(spark, d), fx.sku_switch(spark, d),
                                fx.order_det(spark, d))
    return flow.select("cid3", "market", "src_attr_value", "dst_attr_value",
                       money_out("spend_switch").alias("spend_switch"))


def q_brand_names(spark, d):
    _, names = brand_labels(latest_snapshot(fx.sku_dim(spark, d), "dt"))
    return names


def q_category_list(spark, d):
    return category_list(latest_snapshot(fx.sku_dim(spark, d), "dt"))


def q_market_list(spark, d):
    defs = profiles.definitions_snapshot(fx.market_defs(spark, d))
    return category_list(defs, cols=("cid3", "cid3_name", "attr_name"))


def q_scaled_loyalty(spark, d):
    scaled = flow_ops.scale_0_100(q_loyalty(spark, d), ["loyalty"])
    return scaled.select("cid3", "brand_code", "loyalty", "loyalty_p")


def q_brand_profile_of_categories(spark, d):
    return profiles.brand_profile(fx.sku_dim(spark, d), fx.sku_switch(spark, d), fx.order_det(spark, d),
                                  run_date=fx.ORDER_RUN_DATE, categories=CATEGORIES)


def q_market_profile_of_categories(spark, d):
    return profiles.market_profile(fx.sku_attrs(spark, d), fx.market_defs(spark, d), fx.sku_switch(spark, d),
                                   fx.order_det(spark, d), run_date=fx.ORDER_RUN_DATE, categories=CATEGORIES)


def q_similar_brands_of_categories(spark, d):
    return similarity.similar_brands(fx.clicks(spark, d), fx.sku_dim(spark, d), fx.sku_match(spark, d),
                                     fx.sku_sales(spark, d), click_end=fx.CLICK_RUN_DATE,
                                     sales_end=fx.SIMILARITY_RUN_DATE, categories=CATEGORIES)


def _overwritten(spark, d, clear, table=False):
    """Brands per category written for two days, the second day rerun for some categories, read back."""
    labels = q_brand_labels(spark, d)
    n = labels.groupBy("cid3").agg(F.count_distinct("brand_code").alias("n"))
    days = [dt_value(x) for x in (fx.SIMILARITY_RUN_DATE, fx.ORDER_RUN_DATE)]
    number = uuid.uuid4().hex
    folder = target = f"{ensure_checkpoint_dir(spark).rstrip('/')}/rivalry-overwrite/{number}"
    if table:
        target = f"table:rivalry_overwrite_{number}"
        spark.sql(f"CREATE TABLE rivalry_overwrite_{number} (n BIGINT, dt STRING, cid3 STRING) USING parquet "
                  f"PARTITIONED BY (dt, cid3) LOCATION '{folder}'")
    overwrite_partitions(n.withColumn("dt", F.explode(F.array(*days))), target, ("dt", "cid3"))
    rerun = n.filter(F.length("cid3") % 2 == 0).withColumn("n", F.col("n") * 10).withColumn("dt", days[1])
    overwrite_partitions(rerun, target, ("dt", "cid3"), clear=clear)
    if table:
        return spark.table(f"rivalry_overwrite_{number}")
    return spark.read.schema("n bigint, dt string, cid3 string").parquet(target)


def q_partition_overwrite_dynamic(spark, d):
    return _overwritten(spark, d, [])


def q_partition_overwrite_static(spark, d):
    return _overwritten(spark, d, [{"dt": fx.ORDER_RUN_DATE.isoformat()}])


def q_partition_overwrite_table(spark, d):
    return _overwritten(spark, d, [{"dt": fx.ORDER_RUN_DATE.isoformat()}], table=True)


def q_symmetric_matches(spark, d):
    return symmetric_matches(latest_snapshot(fx.sku_match(spark, d), "dt"))


def q_overlap_by_category(spark, d):
    return similarity.overlap_by_category(fx.sku_match(spark, d), fx.sku_sales(spark, d),
                                          end=fx.SIMILARITY_RUN_DATE)


def q_overlap_pooled(spark, d):
    return similarity.overlap_pooled(fx.sku_match(spark, d))


def q_overlap_by_category_bitmaps(spark, d):
    """D17 from daily bitmaps that are kept."""
    sales = fx.sku_sales(spark, d)
    target = f"{ensure_checkpoint_dir(spark).rstrip('/')}/rivalry-sold/{uuid.uuid4().hex}"
    store_sold(sales, target)
    daily = spark.read.schema("dt date, cid3 string, brand_code string, bucket bigint, bits binary, month string").parquet(target)
    sym = symmetric_matches(latest_snapshot(fx.sku_match(spark, d), "dt"))
    return sku_overlap(sym, sales, end=fx.SIMILARITY_RUN_DATE, sold_daily=daily)


def q_overlap_pooled_bitmaps(spark, d):
    sym = symmetric_matches(latest_snapshot(fx.sku_match(spark, d), "dt"), by_category=False)
    return sku_overlap_pooled(sym, by_bitmaps=True)


def q_sku_gmv_sliding(spark, d):
    """The year's SKU GMV at the run date: a state of two weeks before, advanced by days and by late lines."""
    lines, target = fx.order_det(spark, d), f"{ensure_checkpoint_dir(spark).rstrip('/')}/rivalry-sums/{uuid.uuid4().hex}"
    late = F.col("okey") % 7 == 0
    before = fx.ORDER_RUN_DATE - dt.timedelta(14)
    sliding.store_batch(lines.filter(~late), target, 1)
    sliding.store_batch(lines.filter(late), target, 2)
    sums = spark.read.schema("dt date, cid3 string, sku_id bigint, amount decimal(22,4), n bigint, batch int").parquet(target)
    state = sliding.window_state(sums, end=before, batch=1)
    now = sliding.advance(state, sums, end=before, batch=1, to_end=fx.ORDER_RUN_DATE, to_batch=2)
    return sliding.sku_gmv(now).select("cid3", "sku_id", money_out("gmv").alias("gmv"))


def q_brand_spend_flow_stored(spark, d):
    """D6 of inputs stored in buckets by (category, SKU)."""
    dim = latest_snapshot(fx.sku_dim(spark, d), "dt")
    sw, ends = profiles.latest_switching(fx.sku_switch(spark, d))
    inputs = {"switch": sw, "gmv": sku_gmv(fx.order_det(spark, d), end=ends), "labels": brand_labels(dim)[0]}
    number = uuid.uuid4().hex
    tables = layout.store_bucketed(inputs, f"rivalry_{number}", BUCKETS,
                                   f"{ensure_checkpoint_dir(spark).rstrip('/')}/rivalry-buckets")
    return layout.flow_of(tables).select("cid3", "src_brand_code", "dst_brand_code",
                                         money_out("spend_switch").alias("spend_switch"))


def q_volume_rank(spark, d):
    r = volume_rank(fx.sku_sales(spark, d), end=fx.SIMILARITY_RUN_DATE)
    return r.select("cid3", "brand_code", money_out("brand_gmv").alias("brand_gmv"), "gmv_rank")


def q_volume_rank_by_ranges(spark, d):
    r = volume_rank(fx.sku_sales(spark, d), end=fx.SIMILARITY_RUN_DATE, ranges=RANGES)
    return r.select("cid3", "brand_code", money_out("brand_gmv").alias("brand_gmv"), "gmv_rank")


def q_volume_neighbours(spark, d):
    return similarity.neighbours(fx.sku_sales(spark, d), end=fx.SIMILARITY_RUN_DATE)


def q_strong_coview(spark, d):
    return strong_coview(q_coview_by_category(spark, d))


def q_strong_overlap(spark, d):
    return strong_overlap(q_overlap_by_category(spark, d))


def q_similar_brands(spark, d):
    return similarity.similar_brands(fx.clicks(spark, d), fx.sku_dim(spark, d), fx.sku_match(spark, d),
                                     fx.sku_sales(spark, d), click_end=fx.CLICK_RUN_DATE,
                                     sales_end=fx.SIMILARITY_RUN_DATE)


def q_declared_rivals(spark, d):
    return declared_rivals(fx.declared_links(spark, d), fx.vendor_shops(spark, d),
                           shops_date=fx.SIMILARITY_RUN_DATE)


def q_latest_snapshot(spark, d):
    sw, _ = profiles.latest_switching(fx.sku_switch(spark, d))
    return sw.select("cid3", "src_item_id", "dst_item_id",
                     F.col("switching_prob").cast("double").alias("switching_prob"), dt_value(F.col("dt")).alias("dt"))


def q_trailing_orders(spark, d):
    od = trailing(fx.order_det(spark, d), "dt", fx.ORDER_RUN_DATE, GMV_DAYS)
    return od.select("sku_id", "cid3", "brand_code", "okey", dt_value(F.col("dt")).alias("dt"),
                     money_out("amount").alias("amount"), "qty")


QUERIES: dict[str, Query] = {
    "coview_by_category": q_coview_by_category,
    "coview_pooled": q_coview_pooled,
    "sku_gmv": q_sku_gmv,
    "brand_labels": q_brand_labels,
    "brand_names": q_brand_names,
    "brand_spend_flow": q_brand_spend_flow,
    "loyalty": q_loyalty,
    "switch_in": q_switch_in,
    "net_erosion": q_net_erosion,
    "erosion_pairs": q_erosion_pairs,
    "brand_profile": q_brand_profile,
    "market_labels": q_market_labels,
    "market_spend_flow": q_market_spend_flow,
    "market_profile": q_market_profile,
    "category_list": q_category_list,
    "market_list": q_market_list,
    "scaled_loyalty": q_scaled_loyalty,
    "brand_profile_of_categories": q_brand_profile_of_categories,
    "market_profile_of_categories": q_market_profile_of_categories,
    "similar_brands_of_categories": q_similar_brands_of_categories,
    "partition_overwrite_dynamic": q_partition_overwrite_dynamic,
    "partition_overwrite_static": q_partition_overwrite_static,
    "partition_overwrite_table": q_partition_overwrite_table,
    "symmetric_matches": q_symmetric_matches,
    "overlap_by_category": q_overlap_by_category,
    "overlap_pooled": q_overlap_pooled,
    "overlap_by_category_bitmaps": q_overlap_by_category_bitmaps,
    "overlap_pooled_bitmaps": q_overlap_pooled_bitmaps,
    "sku_gmv_sliding": q_sku_gmv_sliding,
    "brand_spend_flow_stored": q_brand_spend_flow_stored,
    "volume_rank": q_volume_rank,
    "volume_rank_by_ranges": q_volume_rank_by_ranges,
    "volume_neighbours": q_volume_neighbours,
    "strong_coview": q_strong_coview,
    "strong_overlap": q_strong_overlap,
    "similar_brands": q_similar_brands,
    "declared_rivals": q_declared_rivals,
    "latest_snapshot": q_latest_snapshot,
    "trailing_orders": q_trailing_orders,
}
