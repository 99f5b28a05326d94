"""Output jobs: compute one output table and write it partitioned by date.

Each job takes its logical inputs as DataFrames (from tables, parquet paths
or the test fixtures), a run date, and an optional category list, and
overwrites only its own partitions.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame

from rivalry.functions.dates import dt_value
from rivalry.operators import similarity as similarity_ops
from rivalry.operators.flow import erosion_pairs
from rivalry.plans import profiles, shared, similarity
from rivalry.sources.sinks import overwrite_partitions


def _with_dt(df: DataFrame, run_date) -> DataFrame:
    return df.withColumn("dt", dt_value(run_date)) if "dt" not in df.columns else df


def brand_profile(i, run_date, categories):
    return profiles.brand_profile(i["sku_dim"], i["sku_switch"], i["order_det"], run_date=run_date,
                                  categories=categories), ("dt", "cid3")


def erosion_list(i, run_date, categories):
    flow, names, _ = profiles.brand_flow_inputs(i["sku_dim"], i["sku_switch"], i["order_det"],
                                                categories=categories)
    return erosion_pairs(flow, names, run_date=run_date), ("dt",)


def market_profile(i, run_date, categories, defs_date=None):
    return profiles.market_profile(i["sku_attrs"], i["market_defs"], i["sku_switch"], i["order_det"],
                                   run_date=run_date, categories=categories, defs_date=defs_date), ("dt", "cid3")


def coview(i, run_date, categories):
    return similarity.coview_by_category(i["clicks"], i["sku_dim"], end=run_date, categories=categories), ("dt",)


def coview_pooled(i, run_date, categories):
    return similarity.coview_pooled(i["clicks"], i["sku_dim"], end=run_date, categories=categories), ("dt",)


def overlap(i, run_date, categories):
    return similarity.overlap_by_category(i["sku_match"], i["sku_sales"], end=run_date,
                                          categories=categories), ("dt",)


def overlap_pooled(i, run_date, categories):
    return similarity.overlap_pooled(i["sku_match"], categories=categories), ("dt",)


def volume(i, run_date, categories):
    return similarity.neighbours(i["sku_sales"], end=run_date, categories=categories), ("dt",)


def similar_brands(i, run_date, categories):
    return similarity.similar_brands(i["clicks"], i["sku_dim"], i["sku_match"], i["sku_sales"],
                                     click_end=run_date, sales_end=run_date, categories=categories), ("dt",)


def similarity_merge(i, run_date, categories):
    """Merge from the written outputs (inputs ``coview_out``, ``overlap_out``, ``volume_out``)."""
    return similarity.merge_latest_outputs(i["coview_out"], i["overlap_out"], i["volume_out"]), ("dt",)


def declared_rivals(i, run_date, categories):
    return similarity_ops.declared_rivals(i["declared_links"], i["vendor_shops"], shops_date=run_date), ("dt",)


JOBS: dict[str, Callable] = {
    "brand_profile": brand_profile,
    "erosion_list": erosion_list,
    "market_profile": market_profile,
    "coview": coview,
    "coview_pooled": coview_pooled,
    "overlap": overlap,
    "overlap_pooled": overlap_pooled,
    "volume": volume,
    "similar_brands": similar_brands,
    "similarity_merge": similarity_merge,
    "declared_rivals": declared_rivals,
}


#: Columns that each output's rows are sorted by within its partitions.
CLUSTER: dict[str, tuple[str, ...]] = {
    "brand_profile": ("brand_code",),
    "erosion_list": ("cid3", "src_brand_code"),
    "market_profile": ("market", "seg_market"),
    "coview": ("cid3", "from_brand_code"),
    "coview_pooled": ("from_brand_code",),
    "overlap": ("cid3", "brand_code1"),
    "overlap_pooled": ("brand_code1",),
    "volume": ("cid3", "brand_code"),
    "similar_brands": ("cid3", "brand_code_origin"),
    "similarity_merge": ("cid3", "brand_code_origin"),
    "declared_rivals": ("pop_id_origin",),
}

#: Outputs of one spend flow: (frame of the staged flow, its partition columns).
OF_FLOW: dict[str, Callable] = {
    "brand_profile": lambda f, run_date: (profiles.profile_of_flow(f["flow"], f["names"], f["cats"], run_date=run_date),
                                          ("dt", "cid3")),
    "erosion_list": lambda f, run_date: (erosion_pairs(f["flow"], f["names"], run_date=run_date), ("dt",)),
}


def run_shared(outs: Mapping[str, str], inputs: Mapping[str, DataFrame], run_date: _dt.date,
               categories: Sequence[str] | None = None, fmt: str = "parquet") -> None:
    """Compute one spend flow and write each output of ``outs`` ({job: target}, jobs of ``OF_FLOW``) from it."""
    if unknown := set(outs) - set(OF_FLOW):
        raise ValueError(f"{sorted(unknown)} are not outputs of a spend flow: {sorted(OF_FLOW)}")
    staged = shared.staged_brand_flow(inputs["sku_dim"], inputs["sku_switch"], inputs["order_det"], categories=categories)
    for name, out in outs.items():
        _write(*OF_FLOW[name](staged, run_date), out, run_date, categories, fmt, CLUSTER[name])


def run_job(name: str, inputs: dict[str, DataFrame], out: str, run_date: _dt.date,
            categories: Sequence[str] | None = None, fmt: str = "parquet", **options) -> None:
    """Compute job ``name`` and overwrite its partitions in ``out``, a path or ``table:name``.

    The run owns its ``dt`` (of its categories, where the output is
    partitioned by them): what an earlier run left there goes, even if this
    one has no rows for it.  ``options`` are job-specific (``defs_date`` for
    ``market_profile``).
    """
    df, partition_cols = JOBS[name](inputs, run_date, categories, **options)
    _write(df, partition_cols, out, run_date, categories, fmt, CLUSTER[name])


def _write(df: DataFrame, partition_cols: Sequence[str], out: str, run_date: _dt.date,
           categories: Sequence[str] | None, fmt: str, cluster: Sequence[str]) -> None:
    day = {"dt": run_date.isoformat()}
    by_category = "cid3" in partition_cols and categories is not None
    clear = [{**day, "cid3": c} for c in categories] if by_category else [day]
    overwrite_partitions(_with_dt(df, run_date), out, partition_cols, fmt, clear, cluster=cluster)


__all__ = ["JOBS", "OF_FLOW", "run_job", "run_shared"]
