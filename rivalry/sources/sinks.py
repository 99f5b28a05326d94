"""Partitioned overwrite (D26) of paths and catalog tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame

from rivalry.sources.publish import TABLE, Step, _no_step, publish_path, publish_table


def overwrite_partitions(df: DataFrame, target: str, partition_cols: Sequence[str] = ("dt",), fmt: str = "parquet",
                         clear: Iterable[Mapping[str, str]] = (), step: Step = _no_step,
                         cluster: Sequence[str] = ()) -> None:
    """Replace the partitions present in ``df`` and those of ``clear``; leave the others intact.

    ``target`` is a path, or ``table:name`` for a catalog table (created if it
    is missing).  A run for one ``dt`` (or one ``dt``/``cid3``) never wipes
    earlier runs.  ``clear`` gives partition values of the run, e.g.
    ``[{"dt": "2001-08-01"}]``: whatever lies under them is replaced as a
    whole, so a rerun whose result lacks a partition, or is empty, leaves no
    stale rows there (the static form).  Columns are written by name,
    partition columns last.  The new partitions are written and checked before
    any old one goes (see ``publish``).  With ``cluster`` each partition's rows
    are sorted by these columns over its files, so that lookups by them skip
    files.
    """
    spark = df.sparkSession
    df = df.select(*(c for c in df.columns if c not in partition_cols), *partition_cols)
    if not target.startswith(TABLE):
        publish_path(df, target, partition_cols, fmt, clear, step, cluster)
        return
    name = target[len(TABLE):]
    if not spark.catalog.tableExists(name):
        df.limit(0).write.partitionBy(*partition_cols).format(fmt).saveAsTable(name)
    publish_table(df, name, clear, step, cluster)
