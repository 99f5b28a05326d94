"""SKU GMV over a trailing window, kept up to date instead of scanned anew.

A batch of order lines becomes *sums*: amount and number of positive lines
per day, category and SKU, stored under the batch's number.  Lines are never
changed, so a late line is only one more sum of an old day.  The *state* of a
window is its SKU sums at an end date, up to a batch.  To advance it, a run
reads the sums of the days that come in, of the days that go out, and of the
batches since (on the days that stay); it never reads the lines again, nor
the year between.

Money is DECIMAL, so adding and taking away is exact: the advanced state
equals the scan of the whole window.  A SKU leaves when its last line does
(the number of its lines is 0), whatever its amount.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivalry.functions.numeric import GMV_TYPE
from rivalry.params import GMV_DAYS
from rivalry.sources.sinks import overwrite_partitions

KEYS = ["cid3", "sku_id"]


def batch_sums(lines: DataFrame) -> DataFrame:
    """``(dt, cid3, sku_id, amount, n)`` of the positive order lines of a batch."""
    return (lines.filter(F.col("amount") > 0).groupBy("dt", *KEYS)
                 .agg(F.sum("amount").cast(GMV_TYPE).alias("amount"), F.count(F.lit(1)).alias("n")))


def store_batch(lines: DataFrame, out: str, batch: int) -> None:
    """Store a batch's sums under its number; storing it again replaces it.

    A batch's files are sorted by day, so a run skips those of other days by their footers.
    """
    overwrite_partitions(batch_sums(lines).withColumn("batch", F.lit(batch)), out, ("batch",),
                         clear=[{"batch": str(batch)}], cluster=("dt", *KEYS))


def _summed(rows: DataFrame) -> DataFrame:
    out = rows.groupBy(*KEYS).agg(F.sum("amount").cast(GMV_TYPE).alias("amount"), F.sum("n").alias("n"))
    return out.filter(F.col("n") != 0)


def window_state(sums: DataFrame, *, end: _dt.date, batch: int, days: int = GMV_DAYS) -> DataFrame:
    """The state of the window ``[end - days, end]`` up to a batch, from all of its sums: ``(cid3, sku_id, amount, n)``."""
    inside = (F.col("dt") >= end - _dt.timedelta(days)) & (F.col("dt") <= end)
    return _summed(sums.filter(inside & (F.col("batch") <= batch)))


def advance(state: DataFrame, sums: DataFrame, *, end: _dt.date, batch: int, to_end: _dt.date, to_batch: int,
            days: int = GMV_DAYS) -> DataFrame:
    """The state at ``(to_end, to_batch)`` from that at ``(end, batch)``, neither of them earlier.

    Of the sums, only the days and batches that make the difference are read.
    """
    if to_end < end or to_batch < batch:
        raise ValueError("a state is advanced to a later end and batch")
    first, to_first = (e - _dt.timedelta(days) for e in (end, to_end))
    dt, b = F.col("dt"), F.col("batch")
    coming = (b <= batch) & (dt > end) & (dt >= to_first) & (dt <= to_end)
    going = (b <= batch) & (dt >= first) & (dt <= end) & (dt < to_first)
    late = (b > batch) & (b <= to_batch) & (dt >= to_first) & (dt <= to_end)
    sign = F.when(going, -1).otherwise(1)
    change = sums.filter(coming | going | late).select(
        *KEYS, (F.col("amount") * sign).cast(GMV_TYPE).alias("amount"), (F.col("n") * sign).alias("n"))
    return _summed(state.select(*KEYS, "amount", "n").unionByName(change))


def sku_gmv(state: DataFrame, categories: Sequence[str] | None = None) -> DataFrame:
    """``(cid3, sku_id, gmv)`` of a state, as D3 gives it."""
    if categories is not None:
        state = state.filter(F.col("cid3").isin(*categories))
    return state.select(*KEYS, F.col("amount").alias("gmv"))
