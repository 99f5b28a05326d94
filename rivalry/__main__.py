"""Command line: ``python -m rivalry <job> --out PATH --run-date YYYY-MM-DD [...]``.

``<job>`` may name several outputs of one spend flow (``brand_profile,erosion_list``,
with one ``--out`` each): the flow is computed once.  ``recover`` finishes
publications of ``--out`` that died on the way and removes what others left;
no other run may be writing there.

Inputs are the fixture tables derived from ``--data-dir`` unless overridden
with ``--input name=parquet_path`` (or ``name=table:db.table`` for a
catalog table).  Logical inputs: sku_dim, sku_switch, order_det, sku_attrs,
market_defs, clicks, sku_match, sku_sales, declared_links, vendor_shops; the
similarity_merge job reads written outputs: coview_out, overlap_out, volume_out.
"""

from __future__ import annotations

import argparse
import datetime as dt

from rivalry.plans.jobs import JOBS, OF_FLOW, run_job, run_shared
from rivalry.session import CLUSTER_CONF, build_session
from rivalry.sources import fixtures
from rivalry.sources.publish import recover

INPUTS = ["sku_dim", "sku_switch", "order_det", "sku_attrs", "market_defs", "clicks", "sku_match",
          "sku_sales", "declared_links", "vendor_shops",
          # written outputs, read by the similarity_merge job
          "coview_out", "overlap_out", "volume_out"]


class LazyInputs(dict):
    """Resolve an input on first use, so a job reads only what it needs."""

    def __init__(self, spark, data_dir, overrides):
        super().__init__()
        self.spark, self.data_dir, self.overrides = spark, data_dir, overrides

    def __missing__(self, key):
        src = self.overrides.get(key)
        if src is None:
            if self.data_dir is None:
                raise SystemExit(f"input {key} is missing: give --input {key}=PATH (or table:NAME), or --data-dir")
            df = getattr(fixtures, key)(self.spark, self.data_dir)
        elif src.startswith("table:"):
            df = self.spark.table(src[len("table:"):])
        else:
            df = self.spark.read.parquet(src)
        self[key] = df
        return df


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="rivalry")
    p.add_argument("job", help=f"{', '.join(sorted(JOBS))}; several of {', '.join(OF_FLOW)}; or recover")
    p.add_argument("--out", required=True, action="append", help="path, or table:db.table; one for each job")
    p.add_argument("--format", default="parquet", choices=("parquet", "orc"), help="of the output files")
    p.add_argument("--run-date", type=dt.date.fromisoformat, help="required but for recover")
    p.add_argument("--data-dir", default=None)
    p.add_argument("--input", action="append", default=[], help="name=path or name=table:db.table")
    p.add_argument("--categories", default=None, help="comma-separated category ids")
    p.add_argument("--defs-date", default=None, type=dt.date.fromisoformat,
                   help="market_profile: snapshot day of the market definitions (default: latest)")
    p.add_argument("--master", default=None)
    p.add_argument("--profile", choices=("default", "cluster"), default="default",
                   help="cluster: partition sizing for very large inputs (session.CLUSTER_CONF)")
    a = p.parse_args(argv)
    jobs = a.job.split(",")
    if a.job != "recover":
        if unknown := set(jobs) - set(OF_FLOW if len(jobs) > 1 else JOBS):
            p.error(f"unknown jobs, or not outputs of one flow: {sorted(unknown)}")
        if a.run_date is None:
            p.error("--run-date is required")
        if len(a.out) != len(jobs) or len(set(jobs)) != len(jobs):
            p.error("one --out for each job")
    overrides = dict(s.split("=", 1) for s in a.input)
    unknown = set(overrides) - set(INPUTS)
    if unknown:
        p.error(f"unknown inputs: {sorted(unknown)}")
    extra = CLUSTER_CONF if a.profile == "cluster" else None
    spark = build_session(a.master, app_name=f"rivalry-{a.job}", extra=extra)
    cats = a.categories.split(",") if a.categories else None
    options = {"defs_date": a.defs_date} if a.defs_date else {}
    if options and a.job != "market_profile":
        p.error("--defs-date applies to market_profile only")
    inputs = LazyInputs(spark, a.data_dir, overrides)
    if a.job == "recover":
        for out in a.out:
            recover(spark, out, abandoned=True)
    elif len(jobs) > 1:
        run_shared(dict(zip(jobs, a.out)), inputs, a.run_date, cats, a.format)
    else:
        run_job(a.job, inputs, a.out[0], a.run_date, cats, a.format, **options)
    spark.stop()


if __name__ == "__main__":
    main()
