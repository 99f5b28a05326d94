"""Matched-SKU overlap between brands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivalry.functions.dates import trailing
from rivalry.functions.numeric import ratio
from rivalry.operators import distinct
from rivalry.params import SOLD_DAYS

SIDE = ("cid3_{}", "main_sku_id{}", "brand_code{}", "brand_name{}")


def symmetric_matches(matches: DataFrame, *, categories: Sequence[str] | None = None,
                      by_category: bool = True) -> DataFrame:
    """Matched pairs in both directions, distinct.

    One scan emits each pair as (1, 2) and (2, 1) through ``inline`` of a
    two-element array, instead of scanning the table twice for a union.
    ``by_category`` keeps same-category pairs with their category columns;
    otherwise the category columns are dropped (pooled form).
    """
    m = matches
    if categories is not None:
        m = m.filter(F.col("cid3_1").isin(*categories) & F.col("cid3_2").isin(*categories))
    names = [c.format(i) for i in (1, 2) for c in SIDE]
    fwd = F.struct(*[F.col(c) for c in names])
    rev = F.struct(*[F.col(c.format(j)).alias(c.format(i)) for i, j in ((1, 2), (2, 1)) for c in SIDE])
    both = m.select(F.inline(F.array(fwd, rev)))
    if by_category:
        both = both.filter(F.col("cid3_1") == F.col("cid3_2"))
    else:
        both = both.drop("cid3_1", "cid3_2")
    return both.distinct()


def sku_overlap(sym: DataFrame, sku_sales: DataFrame, *, end, days: int = SOLD_DAYS,
                categories: Sequence[str] | None = None, sold_daily: DataFrame | None = None) -> DataFrame:
    """Overlap of brand1 with brand2 per category.

    ``match_sku_num`` = distinct brand1 SKUs matched to brand2;
    ``sku_num`` = distinct brand1 SKUs sold (quantity > 0) in the window.
    The two count different SKU universes, so the ratio can exceed 1.
    With ``sold_daily`` (``distinct.sold_by_day``, kept by day) the sold SKUs
    are the OR of the window's daily bitmaps instead of a scan of its sales,
    and the matched ones are counted by bitmaps, too: no SKU row is shuffled.
    """
    if sold_daily is not None:
        keys = ["cid3", "brand_code1", "brand_name1", "brand_code2", "brand_name2"]
        num = distinct.count_distinct(sym.withColumnRenamed("cid3_1", "cid3"), keys, "main_sku_id1", "match_sku_num")
        den = distinct.sold_in_window(sold_daily, end=end, days=days, categories=categories)
        return _overlap(num, den.withColumnRenamed("brand_code", "brand_code1"))
    num = (sym.groupBy(F.col("cid3_1").alias("cid3"), "brand_code1", "brand_name1",
                       "brand_code2", "brand_name2")
              .agg(F.count_distinct("main_sku_id1").alias("match_sku_num")))
    sold = trailing(sku_sales, "dt", end, days).filter(F.col("sale_qtty") > 0)
    if categories is not None:
        sold = sold.filter(F.col("cid3").isin(*categories))
    den = (sold.groupBy("cid3", F.col("brand_code").alias("brand_code1"))
               .agg(F.count_distinct("sku_id").alias("sku_num")))
    return _overlap(num, den)


def _overlap(num: DataFrame, den: DataFrame) -> DataFrame:
    return (num.join(den, ["cid3", "brand_code1"])
               .select("cid3", "brand_code1", "brand_name1", "brand_code2", "brand_name2",
                       "match_sku_num", "sku_num",
                       ratio("match_sku_num", "sku_num").alias("overlap_ratio")))


def sku_overlap_pooled(sym: DataFrame, by_bitmaps: bool = False) -> DataFrame:
    """Overlap over all categories; denominator = distinct matched SKUs of brand1.

    With ``by_bitmaps`` the SKU numbers are counted as bitmaps (``distinct``):
    brand1's are the OR of those of its pairs, so the matches are read once.
    """
    if by_bitmaps:
        keys = ["brand_code1", "brand_name1", "brand_code2", "brand_name2"]
        maps = distinct.bitmaps(sym, keys, "main_sku_id1")
        num = maps.groupBy(*keys).agg(F.sum(F.bit_count("bits")).alias("match_sku_num"))
        den = distinct.counts(maps, ["brand_code1"], "sku_num")
        return _pooled(num, den)
    num = (sym.groupBy("brand_code1", "brand_name1", "brand_code2", "brand_name2")
              .agg(F.count_distinct("main_sku_id1").alias("match_sku_num")))
    den = sym.groupBy("brand_code1").agg(F.count_distinct("main_sku_id1").alias("sku_num"))
    return _pooled(num, den)


def _pooled(num: DataFrame, den: DataFrame) -> DataFrame:
    return (num.join(den, "brand_code1")
               .select("brand_code1", "brand_name1", "brand_code2", "brand_name2",
                       "match_sku_num", "sku_num",
                       ratio("match_sku_num", "sku_num").alias("overlap_ratio")))
