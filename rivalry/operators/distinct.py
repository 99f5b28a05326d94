"""Exact distinct counts of SKU numbers as mergeable bitmaps.

A bitmap holds one bucket of 64 consecutive numbers as the bits of a long, so
a group that holds few numbers stays small and the sums are Spark's hash
aggregates, which hold no large buffers.  Bitmaps are OR-ed after the shuffle;
and a day's bitmaps can be kept and OR-ed over any window, where a distinct
count of each day could not be added up.  The SKU column must be a number; a
group has at most as many bitmaps as distinct numbers, and one for 64 numbers
where they are dense.  Kept bitmaps are eight bytes each.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivalry.functions.dates import trailing
from rivalry.sources.sinks import overwrite_partitions

DAY_COLS = ("cid3", "brand_code")
#: 2 ** BITS numbers are a bucket: the bits of a long.
BITS = 6


def bitmaps(df: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """``(*keys, bucket, bits)``: the distinct numbers of each group."""
    n = F.col(number).cast("long")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), n.bitwiseAND(F.lit(63).cast("long")).cast("int"))
    return (df.filter(F.col(number).isNotNull())
              .select(*keys, F.shiftright(n, BITS).alias("bucket"), bit.alias("bits"))
              .groupBy(*keys, "bucket").agg(F.bit_or("bits").alias("bits")))


def counts(maps: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``(*keys, name)``: how many numbers the bitmaps of a group hold together."""
    merged = maps.groupBy(*keys, "bucket").agg(F.bit_or("bits").alias("bits"))
    return merged.groupBy(*keys).agg(F.sum(F.bit_count("bits")).alias(name))


def count_distinct(df: DataFrame, keys: Sequence[str], number: str, name: str) -> DataFrame:
    """``(*keys, name)``: exact distinct numbers per group."""
    maps = bitmaps(df, keys, number)
    return maps.groupBy(*keys).agg(F.sum(F.bit_count("bits")).alias(name))


def sold_by_day(sku_sales: DataFrame) -> DataFrame:
    """``(dt, cid3, brand_code, bucket, bits)``: the SKUs that each brand sold on each day."""
    maps = bitmaps(sku_sales.filter(F.col("sale_qtty") > 0), ["dt", *DAY_COLS], "sku_id")
    return maps.withColumn("bits", F.unhex(F.lpad(F.hex("bits"), 16, "0")))


def store_sold(sku_sales: DataFrame, out: str, days: Sequence | None = None) -> None:
    """Store the daily bitmaps of the sales table, by month; with ``days`` only the months that hold one of them are
    computed anew, and a month without sales is emptied.

    A month's files are sorted by day, so a window skips the days outside it by their footers.  The sales are dealt by
    ranges of (day, category, brand) before the bitmaps are made: the same shuffle serves the bitmaps and the files.
    """
    month, clear = F.date_format("dt", "yyyy-MM"), ()
    if days is not None:
        touched = sorted({f"{d:%Y-%m}" for d in days})
        # Whole days of these months; the bounds on dt prune the sales table's own partitions.
        first = [_dt.date.fromisoformat(f"{m}-01") for m in touched]
        inside = [(F.col("dt") >= a) & (F.col("dt") < (a + _dt.timedelta(31)).replace(day=1)) for a in first]
        sku_sales = sku_sales.filter(reduce(or_, inside, F.lit(False)))
        clear = [{"month": m} for m in touched]
    by = ["dt", *DAY_COLS]
    dealt = sku_sales.select(*by, "sku_id", "sale_qtty").filter("sale_qtty > 0 AND sku_id IS NOT NULL").repartitionByRange(*by)
    maps = sold_by_day(dealt).withColumn("month", month)
    overwrite_partitions(maps.sortWithinPartitions("month", *by), out, ("month",), clear=clear)


def sold_in_window(daily: DataFrame, *, end, days: int, categories: Sequence[str] | None = None) -> DataFrame:
    """``(cid3, brand_code, sku_num)``: distinct SKUs sold in the window, from daily bitmaps."""
    w = trailing(daily, "dt", end, days)
    if categories is not None:
        w = w.filter(F.col("cid3").isin(*categories))
    signed = F.conv(F.hex("bits"), 16, -10).cast("long")
    return counts(w.withColumn("bits", signed), DAY_COLS, "sku_num")
