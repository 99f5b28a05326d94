"""The distributed rank equals ``rank()``, whatever the ranges cut."""

import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rivalry.operators.volume import rank_by_ranges, volume_rank
from rivalry.sources import fixtures as fx


@pytest.mark.parametrize("ranges", [1, 5, 60])
def test_equals_the_window(spark, ranges):
    """One group with most rows, ties that cover several ranges, a group of one row."""
    rng = random.Random(ranges)
    rows = [(rng.choice("aaab"), f"k{i}", rng.choice([1, 1, 1, 5, 5, 9, rng.randint(0, 50)])) for i in range(500)]
    rows += [("z", "only", 3), ("a", "null", None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "g string, k string, s int, __x string")
    want = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(F.desc("s"))))
    got = rank_by_ranges(df, "g", "s", "k", "r", ranges)
    assert got.columns == want.columns
    key = lambda r: str(tuple(r))
    kept = [r for r in want.collect() if r.s is not None]
    assert sorted((r for r in got.collect() if r.s is not None), key=key) == sorted(kept, key=key)


def test_volume_rank_by_ranges(spark, small_dir):
    sales = fx.sku_sales(spark, small_dir)
    one, by = (volume_rank(sales, end=fx.SIMILARITY_RUN_DATE, ranges=n) for n in (None, 9))
    assert sorted(map(tuple, by.collect())) == sorted(map(tuple, one.collect()))


def test_no_task_holds_a_category(spark, small_dir):
    """Windows over brand rows are keyed by range and category; the only one by category is over one row per range."""
    df = volume_rank(fx.sku_sales(spark, small_dir), end=fx.SIMILARITY_RUN_DATE, ranges=9)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    windows = [w for w in plan.splitlines() if re.search(r"\bWindow \[", w)]
    assert windows and all("__part" in w for w in windows)
