"""GMV rank neighbours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivalry.functions.dates import trailing
from rivalry.functions.joins import checked_broadcast
from rivalry.functions.numeric import money_out
from rivalry.params import RANK_BAND, VOLUME_DAYS
from rivalry.session import ensure_checkpoint_dir


def volume_rank(sku_sales: DataFrame, *, end, days: int = VOLUME_DAYS,
                categories: Sequence[str] | None = None, dedupe_rows: bool = True,
                ranges: int | None = None) -> DataFrame:
    """Brand GMV and its rank within the category.

    Rows of ``(cid3, brand_code, gmv)`` in the window are made distinct
    before summing when ``dedupe_rows`` (the original job's behaviour: two
    SKU-days of a brand with equal GMV count once); non-positive brand GMV is
    dropped; ``rank()`` by GMV descending, ties share a rank.  Without
    ``ranges`` a window sorts one category's brands in one task — bounded by
    the brand count, not by the sales volume; with it the rank is computed
    over that many ranges (``rank_by_ranges``) and no task holds a category.
    Returns ``(cid3, brand_code, brand_gmv, gmv_rank)`` with ``brand_gmv``
    exact (DECIMAL).
    """
    s = trailing(sku_sales, "dt", end, days)
    if categories is not None:
        s = s.filter(F.col("cid3").isin(*categories))
    s = s.select("cid3", "brand_code", "gmv")
    if dedupe_rows:
        s = s.distinct()
    b = (s.groupBy("cid3", "brand_code").agg(F.sum("gmv").alias("brand_gmv"))
          .filter(F.col("brand_gmv") > 0))
    if ranges is not None:
        return rank_by_ranges(b, "cid3", "brand_gmv", "brand_code", "gmv_rank", ranges)
    w = Window.partitionBy("cid3").orderBy(F.col("brand_gmv").desc())
    return b.withColumn("gmv_rank", F.rank().over(w).cast("int"))


def rank_by_ranges(df: DataFrame, group: str, score: str, key: str, name: str, ranges: int) -> DataFrame:
    """``df`` with ``name``: ``rank()`` by ``score`` descending within ``group``, computed over ranges.

    The rows are range-partitioned by (group, score descending, key), so a
    large group spans many ranges, and stored with their range's number (a
    range is what one run of the shuffle made it, so it must not be made
    twice).  A row's rank is its rank within its part of the group plus the
    rows of the group in earlier ranges: a prefix sum over one row per group
    and range.  A tie that crosses a border is ranked by the first range that
    holds it: of the scores at either end of the parts, the least rank counts.
    """
    ensure_checkpoint_dir(df.sparkSession)
    by = [F.col(group), F.col(score).desc(), F.col(key)]
    # Sampling for the ranges must not compute the sums twice: they are stored first.
    spread = df.checkpoint().repartitionByRange(ranges, *by)
    held = spread.withColumn("__part", F.spark_partition_id()).checkpoint()
    part = Window.partitionBy("__part", group)
    own = held.withColumn("__own", F.rank().over(part.orderBy(F.col(score).desc())))
    # One row per group and range that holds some of it: at most groups + ranges.
    totals = held.groupBy("__part", group).agg(F.count(F.lit(1)).alias("__n"), F.max(score).alias("__first"),
                                               F.min(score).alias("__last"))
    before = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    totals = checked_broadcast(totals.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))))
    ranked = own.join(totals, ["__part", group]).withColumn("__rank", F.col("__own") + F.col("__before"))
    at_border = (F.col(score) == F.col("__first")) | (F.col(score) == F.col("__last"))
    ties = checked_broadcast(ranked.filter(at_border).groupBy(group, score).agg(F.min("__rank").alias("__tied")))
    return (ranked.join(ties, [group, score], "left")
                  .select(*df.columns, F.coalesce("__tied", "__rank").cast("int").alias(name)))


def volume_neighbours(ranked: DataFrame, band: int = RANK_BAND) -> DataFrame:
    """Brand pairs of a category whose ranks differ by 1..band.

    A band join inside a category is quadratic in its brands.  Instead each
    brand emits the 2·band ranks it may pair with, and those are equi-joined
    on (cid3, rank): linear in brands, and the join key spreads one category
    over many tasks.  Brands sharing a rank are never paired.
    """
    offsets = F.array(*[F.lit(d) for d in range(-band, band + 1) if d != 0])
    probe = (ranked.select("cid3", "brand_code", "brand_gmv", "gmv_rank",
                           F.explode(offsets).alias("offset"))
                   .withColumn("similar_gmv_rank", F.col("gmv_rank") + F.col("offset")))
    other = ranked.select("cid3", F.col("brand_code").alias("similar_brand_code"),
                          F.col("brand_gmv").alias("similar_brand_gmv"),
                          F.col("gmv_rank").alias("similar_gmv_rank"))
    pairs = probe.join(other, ["cid3", "similar_gmv_rank"])
    return pairs.select("cid3", "brand_code", money_out("brand_gmv").alias("brand_gmv"), "gmv_rank",
                        "similar_brand_code", money_out("similar_brand_gmv").alias("similar_brand_gmv"),
                        "similar_gmv_rank")
