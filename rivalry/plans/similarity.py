"""Brand similarity from co-views, SKU overlap and GMV rank (D14–D23 composed)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivalry.functions.dates import latest_snapshot
from rivalry.operators.coview import coview_switch
from rivalry.operators.overlap import sku_overlap, sku_overlap_pooled, symmetric_matches
from rivalry.operators.similarity import merge_similarity, strong_coview, strong_overlap, volume_similar
from rivalry.operators.volume import volume_neighbours, volume_rank
from rivalry.params import SESSION_DAYS, SOLD_DAYS, VOLUME_DAYS


def coview_by_category(clicks: DataFrame, sku_dim: DataFrame, *, end, days: int = SESSION_DAYS,
                       categories: Sequence[str] | None = None) -> DataFrame:
    """Brand list = every brand code of the SKU dimension (all snapshots)."""
    return coview_switch(clicks, sku_dim.select("brand_code"), end=end, days=days,
                         categories=categories, by_category=True)


def coview_pooled(clicks: DataFrame, sku_dim: DataFrame, *, end, days: int = SESSION_DAYS,
                  categories: Sequence[str] | None = None) -> DataFrame:
    """Brand list restricted to the categories; the log itself is not."""
    dim = sku_dim if categories is None else sku_dim.filter(F.col("cid3").isin(*categories))
    return coview_switch(clicks, dim.select("brand_code"), end=end, days=days,
                         categories=None, by_category=False)


def overlap_by_category(sku_match: DataFrame, sku_sales: DataFrame, *, end, days: int = SOLD_DAYS,
                        categories: Sequence[str] | None = None) -> DataFrame:
    """D16 → D17 on the latest matching snapshot."""
    sym = symmetric_matches(latest_snapshot(sku_match, "dt"), categories=categories)
    return sku_overlap(sym, sku_sales, end=end, days=days, categories=categories)


def overlap_pooled(sku_match: DataFrame, *, categories: Sequence[str] | None = None) -> DataFrame:
    """D16 → D18 on the latest matching snapshot."""
    sym = symmetric_matches(latest_snapshot(sku_match, "dt"), categories=categories, by_category=False)
    return sku_overlap_pooled(sym)


def neighbours(sku_sales: DataFrame, *, end, days: int = VOLUME_DAYS,
               categories: Sequence[str] | None = None) -> DataFrame:
    """D19 → D20."""
    return volume_neighbours(volume_rank(sku_sales, end=end, days=days, categories=categories))


def similar_brands(clicks: DataFrame, sku_dim: DataFrame, sku_match: DataFrame, sku_sales: DataFrame, *,
                   click_end, sales_end, categories: Sequence[str] | None = None) -> DataFrame:
    """The merged, typed similar-brand list (D23): volume (3) ∪ co-view (1) ∪ overlap (2)."""
    co = coview_by_category(clicks, sku_dim, end=click_end, categories=categories)
    ov = overlap_by_category(sku_match, sku_sales, end=sales_end, categories=categories)
    vol = neighbours(sku_sales, end=sales_end, categories=categories)
    return merge_similarity(volume_similar(vol), strong_coview(co), strong_overlap(ov))


def merge_latest_outputs(coview_out: DataFrame, overlap_out: DataFrame, volume_out: DataFrame) -> DataFrame:
    """D23 from written outputs: the latest ``dt`` partition of each table, selected and merged.

    The inputs are the co-view (per category), overlap (per category) and
    volume-neighbour tables as the jobs write them; each is reduced to its
    newest partition (a scalar-subquery filter that prunes the others).
    """
    co = latest_snapshot(coview_out, "dt")
    ov = latest_snapshot(overlap_out, "dt")
    vol = latest_snapshot(volume_out, "dt")
    return merge_similarity(volume_similar(vol), strong_coview(co), strong_overlap(ov))
