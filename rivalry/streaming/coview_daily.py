"""Incremental co-view switching: daily pair counts kept up to date by a stream.

The co-view jobs (D14, D15) pair clicks within (session, channel, day,
category), so no pair spans two days and the pair count over a window is
the sum of per-day pair counts.  Instead of re-reading and re-joining the
whole 91-day log on every run, a Structured Streaming query over the click
log keeps a table of daily pair counts, and a run sums the days of its
window.

Exactness: a day's pairs need all of that day's clicks, but a micro-batch
may hold only some files of a day (late files).  So each micro-batch only
tells *which* days changed; those days are recomputed in full from the log
(the semi-join on ``dt`` prunes the log to those partitions) and their
partitions of the daily table are overwritten.  Requires the log partition
``dt`` to be the request date (``to_date(request_tm)``), as session groups are
per request date.  Brand and category filters are applied when summing, so
the daily table serves every brand list and both co-view forms.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from rivalry.functions.dates import trailing
from rivalry.functions.joins import checked_broadcast
from rivalry.operators.coview import GROUP_KEYS, HOT_GROUP_BRANDS, _brand_pairs, switch_table
from rivalry.params import CHANNELS, SESSION_DAYS
from rivalry.sources.sinks import overwrite_partitions

DAY_KEYS = ["dt", *GROUP_KEYS]


def daily_pairs(clicks: DataFrame, *, channels: Sequence[str] = CHANNELS,
                hot_brands: int = HOT_GROUP_BRANDS) -> DataFrame:
    """Pair counts per (dt, cid3, from_brand_code, to_brand_code) of complete log days."""
    log = clicks.filter(F.col("session_id").isNotNull() & F.col("bs").isin(*channels))
    counts = log.groupBy(*DAY_KEYS, "brand_code").agg(F.count(F.lit(1)).alias("k"))
    pairs = _brand_pairs(counts, hot_brands, group_keys=DAY_KEYS)
    return (pairs.groupBy("dt", "cid3", "from_brand_code", "to_brand_code")
                 .agg(F.sum(F.col("ka") * F.col("kb")).alias("page_views_switch")))


def refresh_days(log: DataFrame, days: DataFrame, out_path: str, **kw) -> None:
    """Recompute the daily pair counts of ``days`` (frame with ``dt``) from the whole log.

    A day whose pairs are gone (all of its clicks were withdrawn, or are of
    other channels now) is emptied, too.
    """
    touched = sorted(r.dt for r in days.select("dt").distinct().collect() if r.dt is not None)  # days of one micro-batch
    full_days = log.filter(F.col("dt").isin(touched))  # constants prune the log's partitions
    overwrite_partitions(daily_pairs(full_days, **kw), out_path, ("dt",), clear=[{"dt": d.isoformat()} for d in touched])


def start_daily_pairs(spark: SparkSession, log_path: str, schema: StructType, out_path: str,
                      checkpoint_location: str, *, available_now: bool = True,
                      processing_time: str | None = None, **kw) -> StreamingQuery:
    """Stream new log files into the daily pair-count table at ``out_path``.

    ``available_now`` processes everything that has arrived and stops (a
    scheduled catch-up run); otherwise it runs continuously every
    ``processing_time``.  Progress (which files are done) lives in
    ``checkpoint_location``, so a restarted or failed run resumes exactly.
    """
    stream = spark.readStream.schema(schema).parquet(log_path)

    def each_batch(batch: DataFrame, _epoch: int) -> None:
        refresh_days(spark.read.schema(schema).parquet(log_path), batch, out_path, **kw)

    writer = stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime=processing_time or "10 minutes")
    return writer.start()


def coview_from_daily(daily: DataFrame, brands: DataFrame, *, end, days: int = SESSION_DAYS,
                      categories: Sequence[str] | None = None, by_category: bool = True,
                      end_inclusive: bool | None = None) -> DataFrame:
    """D14 / D15 from the daily pair counts: sum the window's days, then shares.

    A pair counts when both brands are known, the same as dropping clicks of
    unknown brands before pairing.
    """
    if end_inclusive is None:
        end_inclusive = by_category
    w = trailing(daily, "dt", end, days, end_inclusive)
    if categories is not None:
        w = w.filter(F.col("cid3").isin(*categories))
    known = checked_broadcast(brands.select("brand_code").distinct())
    w = (w.join(known.select(F.col("brand_code").alias("from_brand_code")), "from_brand_code", "left_semi")
          .join(known.select(F.col("brand_code").alias("to_brand_code")), "to_brand_code", "left_semi"))
    keys = ["cid3"] if by_category else []
    pv = (w.groupBy(*keys, "from_brand_code", "to_brand_code")
           .agg(F.sum("page_views_switch").alias("page_views_switch")))
    return switch_table(pv, by_category)
