"""One spend flow for several outputs (D6 shared by D10 and D12).

The brand profile and the erosion list are two views of the same flow.  Run
one by one, each scans order lines and switching pairs and joins them anew; a
shared run computes the flow once, stores it with the names that both need,
and feeds each output from there.  The stored flow lies in the shared folder
of ``spark.checkpoint.dir`` under a key of its inputs (the files that each
input reads, the plan over them, the parameters), so a run that dies between
its outputs continues from it.  It is written beside its place and renamed
when it is whole.  Files are taken to be immutable, as Spark writes them.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from rivalry.operators.segments import category_list
from rivalry.params import GMV_DAYS
from rivalry.plans import profiles
from rivalry.session import ensure_checkpoint_dir
from rivalry.sources.publish import Folders

FOLDER = "rivalry-flow"
PARTS = ("flow", "names", "cats")


def input_key(inputs: Mapping[str, DataFrame], **parameters) -> str:
    """Digest of what the inputs read and of the parameters; unique if an input doesn't read files."""
    about = {"parameters": {k: v if v is None else str(v) for k, v in sorted(parameters.items())}}
    for name, df in sorted(inputs.items()):
        files = sorted(df.inputFiles())
        plan = df._jdf.queryExecution().analyzed().canonicalized().toString()
        about[name] = [files, plan] if files else uuid.uuid4().hex
    return hashlib.sha256(json.dumps(about).encode()).hexdigest()[:32]


def staged_brand_flow(sku_dim: DataFrame, switch: DataFrame, order_det: DataFrame, *,
                      categories: Sequence[str] | None = None, gmv_days: int = GMV_DAYS) -> dict[str, DataFrame]:
    """``flow`` (D6), ``names`` (D25) and ``cats`` (D24) of the brand jobs, computed once and read from their table."""
    spark = switch.sparkSession
    key = input_key({"sku_dim": sku_dim, "switch": switch, "order_det": order_det},
                    categories=None if categories is None else sorted(categories), gmv_days=gmv_days)
    place = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{FOLDER}/{key}"
    folders = Folders(spark, place)
    if not folders.exists(place):
        flow, names, dim = profiles.brand_flow_inputs(sku_dim, switch, order_det, categories=categories, gmv_days=gmv_days)
        made, run = dict(zip(PARTS, (flow, names, category_list(dim, categories=categories)))), f"{place}.{uuid.uuid4().hex}"
        for part, df in made.items():
            df.write.parquet(f"{run}/{part}")
        try:
            folders.move(run, place)
        except OSError:  # another run was faster; its tables are the same
            if not folders.exists(f"{place}/{PARTS[-1]}"):
                raise
    return {part: spark.read.parquet(f"{place}/{part}") for part in PARTS}
