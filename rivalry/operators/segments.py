"""SKU GMV and segment labels.

A *segment* is what a SKU is grouped into: its brand (brand profile,
erosion list) or one attribute value of a market (market profile).  Label
frames share one shape, ``(*keys, sku_id, <segment column>)``, with ``keys``
``("cid3",)`` for brands and ``("cid3", "market")`` for markets, so the flow
operators serve both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivalry.functions.dates import window_predicate
from rivalry.functions.joins import checked_broadcast
from rivalry.functions.numeric import GMV_TYPE
from rivalry.params import GMV_DAYS


def sku_gmv(order_det: DataFrame, *, end, days: int = GMV_DAYS,
            categories: Sequence[str] | None = None) -> DataFrame:
    """Σ amount of positive order lines per (cid3, sku_id) in ``[end - days, end]`` (D3).

    ``end`` is a date (the same window for every category) or a frame
    ``(cid3, dt)`` giving each category its own window end (the latest
    switching snapshot of that category).  In the second case the ends are a
    size-checked broadcast: the overall bounds (two scalar subqueries over
    it) filter the order scan and prune its ``dt`` partitions, and each line
    is matched to its category's end by a broadcast hash join.  Order lines
    are never shuffled; the only shuffle is the partially aggregated SKU sums.
    """
    od = order_det.filter(F.col("amount") > 0)
    if categories is not None:
        od = od.filter(F.col("cid3").isin(*categories))
    if isinstance(end, DataFrame):
        ends = checked_broadcast(end).select("cid3", F.col("dt").alias("end_dt"))
        lo = ends.agg(F.min("end_dt")).scalar()
        hi = ends.agg(F.max("end_dt")).scalar()
        od = (od.filter((F.col("dt") >= F.date_sub(lo, days)) & (F.col("dt") <= hi))
                .join(ends, "cid3")
                .filter(window_predicate(F.col("dt"), F.col("end_dt"), days)))
    else:
        od = od.filter(window_predicate(F.col("dt"), end, days))
    return od.groupBy("cid3", "sku_id").agg(F.sum("amount").cast(GMV_TYPE).alias("gmv"))


def brand_labels(sku_dim: DataFrame, categories: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Brand of each valid SKU (D4) and brand names.

    Per (category, SKU, brand name) the largest brand code is kept; a SKU
    listed under several names can therefore carry several codes, and a code
    can carry several names.  That fan-out is part of the result.

    Returns ``(labels (cid3, sku_id, brand_code), names (cid3, brand_code, brand_name))``.
    """
    dim = sku_dim.filter(F.col("valid_flag") == 1)
    if categories is not None:
        dim = dim.filter(F.col("cid3").isin(*categories))
    # A snapshot has about one row per SKU, so a map-side combine gains
    # nothing; one shuffle by (cid3, sku_id) serves the per-name maximum,
    # the distinct labels and the later joins on the SKU.
    dim = dim.repartition("cid3", "sku_id")
    picked = dim.groupBy("cid3", "sku_id", "brand_name").agg(F.max("brand_code").alias("brand_code"))
    labels = picked.select("cid3", "sku_id", "brand_code").distinct()
    names = picked.select("cid3", "brand_code", "brand_name").distinct()
    return labels, names


def market_labels(sku_attrs: DataFrame, market_defs: DataFrame,
                  categories: Sequence[str] | None = None) -> DataFrame:
    """One attribute value per (category, market, SKU).

    Only site-wide attributes (``web_id = 0``) whose (category, attribute,
    value) is a defined market segment count; of several, the largest value
    is kept.  The definitions are a size-checked broadcast: their few triples
    would be hot shuffle keys for the attributes.  Returns ``(cid3, market, sku_id, attr_value)``.
    """
    attrs = sku_attrs.filter(F.col("web_id") == 0)
    defs = market_defs.select("cid3", "attr_name", "attr_value")
    if categories is not None:
        attrs = attrs.filter(F.col("cid3").isin(*categories))
        defs = defs.filter(F.col("cid3").isin(*categories))
    defs = checked_broadcast(defs.distinct())
    attrs = attrs.join(defs, ["cid3", "attr_name", "attr_value"], "left_semi")
    return (attrs.groupBy("cid3", F.col("attr_name").alias("market"), "sku_id")
                 .agg(F.max("attr_value").alias("attr_value")))


def category_list(df: DataFrame, cols: Sequence[str] = ("cid3", "cid3_name"),
                  categories: Sequence[str] | None = None) -> DataFrame:
    """Distinct categories (or category × attribute) a run covers.

    The reference loops over these on the driver; here they are grouping
    keys of one job, and this frame only supplies names.
    """
    if categories is not None:
        df = df.filter(F.col("cid3").isin(*categories))
    return df.select(*cols).distinct()
