"""Incremental co-view (daily pair counts via Structured Streaming) equals the batch operator."""

import datetime as dt

from pyspark.sql import functions as F

from rivalry.operators.coview import coview_switch
from rivalry.sources import fixtures as fx
from rivalry.streaming.coview_daily import coview_from_daily, start_daily_pairs

END = fx.CLICK_RUN_DATE


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_daily_stream_matches_batch_coview(spark, small_dir, tmp_path):
    clicks = fx.clicks(spark, small_dir)
    dim = fx.sku_dim(spark, small_dir)
    log_path, out_path, ckpt = (str(tmp_path / n) for n in ("log", "daily", "ckpt"))
    schema = clicks.schema
    days = sorted(r.dt for r in clicks.select("dt").distinct().collect())
    first, later = days[: len(days) // 2], days[len(days) // 2:]
    cut = F.col("dt").isin(*first)

    # First run: half of the days have arrived.
    clicks.filter(cut).write.partitionBy("dt").parquet(log_path)
    start_daily_pairs(spark, log_path, schema, out_path, ckpt).awaitTermination()
    # Second run: the remaining days arrive, plus a late file for an already processed day.
    rest = clicks.filter(~cut)
    rest.write.mode("append").partitionBy("dt").parquet(log_path)
    late_day = first[-1]
    late = clicks.filter(F.col("dt") == late_day).withColumn("session_id", F.col("session_id") + 1_000_000)
    late.write.mode("append").partitionBy("dt").parquet(log_path)
    start_daily_pairs(spark, log_path, schema, out_path, ckpt).awaitTermination()

    full_log = spark.read.schema(schema).parquet(log_path)
    daily = spark.read.parquet(out_path)
    cols = ["cid3", "from_brand_code", "to_brand_code", "page_views_switch", "from_brand_total_switch",
            "switch_prob"]
    want = _rows(coview_switch(full_log, dim.select("brand_code"), end=END), cols)
    got = _rows(coview_from_daily(daily, dim, end=END), cols)
    assert want and got == want

    pcols = ["from_brand_code", "to_brand_code", "page_views_switch", "from_shop_total_switch", "switch_prob"]
    want_p = _rows(coview_switch(full_log, dim.select("brand_code"), end=END, by_category=False), pcols)
    got_p = _rows(coview_from_daily(daily, dim, end=END, by_category=False), pcols)
    assert got_p == want_p
