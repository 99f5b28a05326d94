"""Stored layout of the flow's inputs: buckets by (category, SKU), so that they meet where they lie.

The switching pairs are the largest input, and every run joins them with GMV
and labels on the source SKU.  Stored once in as many buckets as the other
two, by the same key, each task joins one bucket of each, and no pair is
shuffled before the products are summed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from rivalry.operators.flow import spend_flow

#: Key columns of each input, the category first.
KEYS = {"switch": ("cid3", "src_item_id"), "gmv": ("cid3", "sku_id"), "labels": ("cid3", "sku_id")}


def store_bucketed(inputs: dict[str, DataFrame], prefix: str, buckets: int, path: str | None = None) -> dict[str, DataFrame]:
    """Store ``switch``, ``gmv`` and ``labels`` as bucketed tables ``{prefix}_{name}`` and return them.

    ``buckets`` follows the switching pairs (some 256 MB each).  ``path`` is the tables' folder (default: the warehouse).
    Rows are sorted by the key within a bucket; one file per bucket, as each is written by one task.
    """
    out = {}
    for name, df in inputs.items():
        keys, table = KEYS[name], f"{prefix}_{name}"
        writer = (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet")
                    .bucketBy(buckets, *keys).sortBy(*keys))
        if path is not None:
            writer = writer.option("path", f"{path}/{table}")
        writer.saveAsTable(table)
        out[name] = df.sparkSession.table(table)
    return out


def flow_of(tables: dict[str, DataFrame]) -> DataFrame:
    """The brands' spend flow (D6) of bucketed tables."""
    return spend_flow(tables["switch"], tables["labels"], tables["gmv"])
