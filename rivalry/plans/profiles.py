"""Competition profiles of brands (D12) and market segments.

Each is one Spark job over every category (and every market attribute) at
once: the reference's per-category driver loop becomes grouping keys, its
scalar ``collect()`` calls become aggregates inside the plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivalry.functions.dates import as_date, dt_value, group_max, latest_snapshot
from rivalry.operators.flow import competition_measures, scale_0_100, spend_flow
from rivalry.operators.segments import brand_labels, category_list, market_labels, sku_gmv
from rivalry.params import BRAND_DOMAIN, GMV_DAYS


def latest_switching(switch: DataFrame, categories: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Latest switching snapshot of each category and the snapshot dates.

    Returns ``(rows of each category's latest dt, (cid3, dt) per category)``.
    """
    if categories is not None:
        switch = switch.filter(F.col("cid3").isin(*categories))
    ends = group_max(switch, "dt", ["cid3"])
    # The oldest and newest of these dates prune the other snapshots' partitions.
    lo, hi = ends.agg(F.min("dt")).scalar(), ends.agg(F.max("dt")).scalar()
    recent = switch.filter((F.col("dt") >= lo) & (F.col("dt") <= hi))
    return recent.join(ends, ["cid3", "dt"], "left_semi"), ends


def brand_flow_inputs(sku_dim: DataFrame, switch: DataFrame, order_det: DataFrame, *,
                      categories: Sequence[str] | None = None, gmv_days: int = GMV_DAYS):
    """(flow, names, dim) for the brand jobs: D1 → D4 → D3 → D6."""
    dim = latest_snapshot(sku_dim, "dt")
    labels, names = brand_labels(dim, categories)
    sw, ends = latest_switching(switch, categories)
    gmv = sku_gmv(order_det, end=ends, days=gmv_days, categories=categories)
    return spend_flow(sw, labels, gmv), names, dim


def brand_profile(sku_dim: DataFrame, switch: DataFrame, order_det: DataFrame, *, run_date,
                  categories: Sequence[str] | None = None, gmv_days: int = GMV_DAYS) -> DataFrame:
    """Brand switch-in / switch-out / loyalty scaled to 0..100 per category, and net erosion.

    Columns: cid3_name, domain, brand_code, brand_name, switch_in_p,
    switch_out_p, loyalty_p, erode_amount, dt, cid3.  A brand needs self
    flow and inbound flow from another brand to appear; a brand with k names
    appears k times.
    """
    flow, names, dim = brand_flow_inputs(sku_dim, switch, order_det, categories=categories,
                                         gmv_days=gmv_days)
    return profile_of_flow(flow, names, category_list(dim, categories=categories), run_date=run_date)


def profile_of_flow(flow: DataFrame, names: DataFrame, cats: DataFrame, *, run_date) -> DataFrame:
    """The brand profile (D12) of a spend flow, brand names and category names."""
    m = competition_measures(flow).join(names, ["cid3", "brand_code"], "left")
    scaled = scale_0_100(m, ["switch_in_prob", "switch_out_prob", "loyalty"])
    return (scaled.join(cats, "cid3", "left")
                  .select("cid3_name", F.lit(BRAND_DOMAIN).alias("domain"), "brand_code", "brand_name",
                          "switch_in_prob_p", "switch_out_prob_p", "loyalty_p", "erode_amount",
                          dt_value(run_date).alias("dt"), "cid3")
                  .withColumnsRenamed({"switch_in_prob_p": "switch_in_p",
                                       "switch_out_prob_p": "switch_out_p"}))


def definitions_snapshot(market_defs: DataFrame, defs_date=None) -> DataFrame:
    """One snapshot of the market definitions: ``defs_date`` if given, else the latest."""
    if defs_date is not None:
        return market_defs.filter(F.col("dt") == as_date(defs_date))
    return latest_snapshot(market_defs, "dt")


def market_flow(sku_attrs: DataFrame, market_defs: DataFrame, switch: DataFrame, order_det: DataFrame, *,
                categories: Sequence[str] | None = None, gmv_days: int = GMV_DAYS, defs_date=None) -> DataFrame:
    """Spend flow between attribute-value segments, per (cid3, market)."""
    defs = definitions_snapshot(market_defs, defs_date)
    return _market_flow(sku_attrs, defs, switch, order_det, categories, gmv_days)


def _market_flow(sku_attrs, defs, switch, order_det, categories, gmv_days):
    labels = market_labels(sku_attrs, defs, categories)
    sw, ends = latest_switching(switch, categories)
    gmv = sku_gmv(order_det, end=ends, days=gmv_days, categories=categories)
    return spend_flow(sw, labels, gmv, keys=("cid3", "market"), segment="attr_value")


def market_profile(sku_attrs: DataFrame, market_defs: DataFrame, switch: DataFrame, order_det: DataFrame, *,
                   run_date, categories: Sequence[str] | None = None, gmv_days: int = GMV_DAYS,
                   defs_date=None) -> DataFrame:
    """Segment switch-in / switch-out for every (category, market attribute).

    ``market_defs`` are read at ``defs_date`` (default: latest).  Columns: cid3_name,
    market, seg_market, switch_in_prob, switch_out_prob, dt, cid3 — one
    output for all attributes of a category (the original overwrote the
    category's partition once per attribute, keeping only the last).
    """
    defs = definitions_snapshot(market_defs, defs_date)
    flow = _market_flow(sku_attrs, defs, switch, order_det, categories, gmv_days)
    m = competition_measures(flow, keys=("cid3", "market"), segment="attr_value")
    markets = category_list(defs.withColumnRenamed("attr_name", "market"),
                            cols=("cid3", "cid3_name", "market"), categories=categories)
    return (m.join(markets, ["cid3", "market"])
             .select("cid3_name", "market", F.col("attr_value").alias("seg_market"),
                     "switch_in_prob", "switch_out_prob",
                     dt_value(run_date).alias("dt"), "cid3"))
