"""Session co-view switching between brands.

Two clicks form an ordered pair when they share session, channel, day and
category.  ``page_views_switch(A→B)`` counts such pairs (a click also pairs
with itself), and ``switch_prob = page_views_switch / Σ_B page_views_switch``.

The naive form self-joins raw clicks, which is quadratic in the clicks of a
session.  Here clicks are first counted per (session, channel, day,
category, brand) — a map-side-combined aggregate — and the counts are
self-joined, contributing ``k_A · k_B`` per group.  The join then emits one
row per brand pair of a session, the least the result needs.

A hot group (a bot session clicking through a whole category) is small in
bytes after the count but emits brands² pairs, which AQE cannot see as skew.
Groups with more than ``hot_brands`` brands are therefore split into a grid:
with ``b = ceil(brands / hot_brands)`` both sides hash their brands into b
buckets, and cell (i, j) joins left bucket i with right bucket j.  Each pair
is formed exactly once, and a cell forms about ``hot_brands``² of them however
large the group is.  Other groups self-join directly on the group keys (see
``_brand_pairs``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivalry.functions.dates import trailing
from rivalry.functions.joins import checked_broadcast
from rivalry.functions.numeric import ratio
from rivalry.params import CHANNELS, SESSION_DAYS

GROUP_KEYS = ["session_id", "bs", "request_dt", "cid3"]
# Brands of a group that one task pairs; larger groups become a grid of such cells.
HOT_GROUP_BRANDS = 2_000


def brand_counts(clicks: DataFrame, brands: DataFrame, *, end, days: int = SESSION_DAYS,
                 end_inclusive: bool = True, channels: Sequence[str] = CHANNELS,
                 categories: Sequence[str] | None = None) -> DataFrame:
    """Clicks per (session, channel, day, category, brand) in the window."""
    log = trailing(clicks, "dt", end, days, end_inclusive)
    log = log.filter(F.col("session_id").isNotNull() & F.col("bs").isin(*channels))
    if categories is not None:
        log = log.filter(F.col("cid3").isin(*categories))
    counts = log.groupBy(*GROUP_KEYS, "brand_code").agg(F.count(F.lit(1)).alias("k"))
    # The known-brand list is a dimension (one row per brand): broadcast
    # after a size check.  Catalyst pushes this semi-join below the count.
    known = checked_broadcast(brands.select("brand_code").distinct())
    return counts.join(known, "brand_code", "left_semi")


def _brand_pairs(counts: DataFrame, hot_brands: int, group_keys: Sequence[str] = GROUP_KEYS) -> DataFrame:
    """(group keys, from_brand_code, ka, to_brand_code, kb) for every brand pair of a group.

    The brand count per group is a window partitioned by the group keys;
    cold groups then self-join on those same keys, so that join reuses the
    window's partitioning and adds no shuffle.  Only rows of hot groups take
    the grid (each side bucketed by brand hash and replicated to the buckets
    of the other), whose size follows the group's brand count.
    """
    gk = list(group_keys)
    sized = counts.withColumn("n_brands", F.count(F.lit(1)).over(Window.partitionBy(*gk)))

    def sides(df, bucket_left, bucket_right):
        a = df.select(*gk, F.col("brand_code").alias("from_brand_code"), F.col("k").alias("ka"),
                      *bucket_left)
        b = df.select(*gk, F.col("brand_code").alias("to_brand_code"), F.col("k").alias("kb"),
                      *bucket_right)
        return a, b

    cold_a, cold_b = sides(sized.filter(F.col("n_brands") <= hot_brands), [], [])
    cold = cold_a.join(cold_b, gk)
    hot = sized.filter(F.col("n_brands") > hot_brands)
    buckets = F.ceil(F.col("n_brands") / hot_brands)
    own, others = F.pmod(F.xxhash64("brand_code"), buckets), F.sequence(F.lit(0).cast("long"), buckets - 1)
    hot_a, hot_b = sides(
        hot,
        [own.alias("i"), F.explode(others).alias("j")],
        [F.explode(others).alias("i"), own.alias("j")])
    grid = hot_a.join(hot_b, [*gk, "i", "j"]).drop("i", "j")
    return cold.unionByName(grid)


def coview_switch(clicks: DataFrame, brands: DataFrame, *, end, days: int = SESSION_DAYS,
                  channels: Sequence[str] = CHANNELS, categories: Sequence[str] | None = None,
                  by_category: bool = True, end_inclusive: bool | None = None,
                  hot_brands: int = HOT_GROUP_BRANDS) -> DataFrame:
    """Brand→brand co-view switching.

    ``by_category=True`` (D14): window end inclusive, output per category
    ``(cid3, from_brand_code, to_brand_code, page_views_switch,
    from_brand_total_switch, switch_prob)``.

    ``by_category=False`` (D15): pairs are still same-category, but counts are
    pooled over categories; window end exclusive; output ``(from_brand_code,
    to_brand_code, page_views_switch, from_shop_total_switch, switch_prob)``.

    ``brands`` is the list of known brand codes (any frame with
    ``brand_code``); clicks of other brands are ignored.
    """
    if end_inclusive is None:
        end_inclusive = by_category
    counts = brand_counts(clicks, brands, end=end, days=days, end_inclusive=end_inclusive,
                          channels=channels, categories=categories)
    pairs = _brand_pairs(counts, hot_brands)
    keys = ["cid3"] if by_category else []
    pv = (pairs.groupBy(*keys, "from_brand_code", "to_brand_code")
           .agg(F.sum(F.col("ka") * F.col("kb")).alias("page_views_switch")))
    return switch_table(pv, by_category)


def switch_table(pv: DataFrame, by_category: bool) -> DataFrame:
    """Add the origin total and ``switch_prob`` to pair counts ``page_views_switch``."""
    keys = ["cid3"] if by_category else []
    total_name = "from_brand_total_switch" if by_category else "from_shop_total_switch"
    # One origin brand's partners are bounded by the number of brands.
    per_origin = Window.partitionBy(*keys, "from_brand_code")
    out = pv.withColumn(total_name, F.sum("page_views_switch").over(per_origin))
    return out.select(*keys, "from_brand_code", "to_brand_code", "page_views_switch", total_name,
                      ratio("page_views_switch", total_name).alias("switch_prob"))
