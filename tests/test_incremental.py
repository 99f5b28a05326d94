"""Window sums that are advanced, and distinct counts from kept bitmaps, equal the scans."""

import datetime as dt
import random
import re
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rivalry.operators import distinct
from rivalry.operators.flow import spend_flow
from rivalry.operators.overlap import sku_overlap, sku_overlap_pooled, symmetric_matches
from rivalry.operators.segments import sku_gmv
from rivalry.plans import layout, sliding
from rivalry.sources import fixtures as fx

DAY = dt.timedelta(1)
START = dt.date(2001, 1, 1)
PREFIX = f"buckets_{uuid.uuid4().hex}"


def lines(spark, seed, n, last):
    rng = random.Random(seed)
    rows = [(rng.choice("ab"), rng.randint(1, 12), START + rng.randint(0, last) * DAY, Decimal(rng.randint(-300, 900)) / 100)
            for _ in range(n)]
    return spark.createDataFrame(rows, "cid3 string, sku_id bigint, dt date, amount decimal(18,4)")


def rows(df):
    return sorted(map(tuple, df.select("cid3", "sku_id", "gmv").collect()))


SUMS = "dt date, cid3 string, sku_id bigint, amount decimal(22,4), n bigint, batch int"


def test_an_advanced_window_equals_the_scan(spark, tmp_path):
    """Batches with lines of old days, ends that move by nothing, a little, or more than the window."""
    out, every, state, at = str(tmp_path / "sums"), None, None, None
    for batch, (n, last, move) in enumerate([(200, 20, 0), (60, 25, 5), (60, 25, 0), (50, 70, 40), (80, 70, 3)], 1):
        more = lines(spark, batch, n, last)
        every = more if every is None else every.unionByName(more)
        sliding.store_batch(more, out, batch)
        sums = spark.read.schema(SUMS).parquet(out)
        end = START + 20 * DAY if at is None else at[0] + move * DAY
        if state is None:
            state = sliding.window_state(sums, end=end, batch=batch, days=9)
        else:
            state = sliding.advance(state, sums, end=at[0], batch=at[1], to_end=end, to_batch=batch, days=9)
        state.write.parquet(str(tmp_path / f"state{batch}"))
        state, at = spark.read.parquet(str(tmp_path / f"state{batch}")), (end, batch)
        want = rows(sku_gmv(every, end=end, days=9))
        assert want and rows(sliding.sku_gmv(state)) == want
        assert rows(sliding.sku_gmv(sliding.window_state(sums, end=end, batch=batch, days=9))) == want
    sliding.store_batch(more, out, batch)  # stored twice, counted once
    assert rows(sliding.sku_gmv(sliding.window_state(spark.read.schema(SUMS).parquet(out), end=end, batch=batch, days=9))) == want
    with pytest.raises(ValueError, match="later"):
        sliding.advance(state, sums, end=end, batch=batch, to_end=end - DAY, to_batch=batch)


def test_a_sku_leaves_with_its_last_line(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, START, Decimal("2.5")), ("a", 2, START + DAY, Decimal("2.5"))],
                               "cid3 string, sku_id bigint, dt date, amount decimal(18,4)")
    sliding.store_batch(df, str(tmp_path / "s"), 1)
    sums = spark.read.schema(SUMS).parquet(str(tmp_path / "s"))
    state = sliding.window_state(sums, end=START + DAY, batch=1, days=1)
    moved = sliding.advance(state, sums, end=START + DAY, batch=1, to_end=START + 2 * DAY, to_batch=1, days=1)
    assert rows(sliding.sku_gmv(state, ["a"])) == [("a", 1, Decimal("2.5")), ("a", 2, Decimal("2.5"))]
    assert rows(sliding.sku_gmv(moved)) == [("a", 2, Decimal("2.5"))]


MAPS = "dt date, cid3 string, brand_code string, bucket bigint, bits binary, month string"


def test_kept_bitmaps_equal_distinct_counts(spark, small_dir, tmp_path):
    """Also after late rows, a month that lost its sales, and SKU numbers in several buckets."""
    out, end = str(tmp_path / "maps"), fx.SIMILARITY_RUN_DATE
    sym = symmetric_matches(fx.sku_match(spark, small_dir)).withColumn("main_sku_id1", F.col("main_sku_id1") * 1009)
    sales = fx.sku_sales(spark, small_dir).withColumn("sku_id", F.col("sku_id") * 1009)
    key = lambda r: str(tuple(r))
    first = sales.filter("NOT (sku_id % 3 = 0 AND dt BETWEEN DATE '2001-06-10' AND DATE '2001-07-05')")
    distinct.store_sold(first, out)
    for now, days in ((first, None), (sales, [dt.date(2001, 6, 11), dt.date(2001, 7, 1)]),
                      (sales.filter("month(dt) <> 7 OR year(dt) <> 2001"), [dt.date(2001, 7, 31)])):
        if days:
            distinct.store_sold(now, out, days)
        daily = spark.read.schema(MAPS).parquet(out)
        want = sorted(sku_overlap(sym, now, end=end).collect(), key=key)
        assert want and sorted(sku_overlap(sym, now, end=end, sold_daily=daily).collect(), key=key) == want
    pooled = symmetric_matches(fx.sku_match(spark, small_dir), by_category=False)
    assert (sorted(sku_overlap_pooled(pooled, by_bitmaps=True).collect(), key=key)
            == sorted(sku_overlap_pooled(pooled).collect(), key=key))


def test_no_sku_rows_are_shuffled(spark, small_dir):
    sold = distinct.sold_by_day(fx.sku_sales(spark, small_dir))
    df = sku_overlap(symmetric_matches(fx.sku_match(spark, small_dir)), None, end=fx.SIMILARITY_RUN_DATE, sold_daily=sold)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line:
            # The symmetric matches are made distinct by their own rows; every other exchange carries bitmaps.
            assert "sku_id#" not in line and ("main_sku_id1" not in line or "main_sku_id2" in line)


def test_bucketed_inputs_meet_without_a_shuffle(spark, tmp_path):
    rng = random.Random(2)
    sw = spark.createDataFrame([("c", rng.choice([1, 1, 1, rng.randint(1, 60)]), rng.randint(1, 60), Decimal(rng.randint(1, 99)) / 100)
                                for _ in range(500)], "cid3 string, src_item_id bigint, dst_item_id bigint, switching_prob decimal(8,6)")
    labels = spark.createDataFrame([("c", i, f"b{i % 7}") for i in range(1, 55)], "cid3 string, sku_id bigint, brand_code string")
    gmv = spark.createDataFrame([("c", i, Decimal(i)) for i in range(3, 61)] + [("c", 1, Decimal(7))], "cid3 string, sku_id bigint, gmv decimal(22,4)")
    want = sorted(map(tuple, spend_flow(sw, labels, gmv).collect()))
    # A hot source SKU is taken out of the join, with the same result.
    assert want and sorted(map(tuple, spend_flow(sw, labels, gmv, hot_rows=100).collect())) == want
    tables = layout.store_bucketed({"switch": sw, "labels": labels, "gmv": gmv}, PREFIX, 4, str(tmp_path))
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        df = layout.flow_of(tables)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, df.collect())) == want
    finally:
        for k in keys:
            spark.conf.unset(k)
    shuffled = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert shuffled and not [s for s in shuffled if "src_item_id" in s]
    for name in tables:
        spark.sql(f"DROP TABLE {PREFIX}_{name}")
