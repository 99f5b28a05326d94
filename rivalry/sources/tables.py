"""Readers for the parquet tables of a data directory."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from rivalry.session import checkpoint_folder

_CACHE_ATTR = "_rivalry_tables"


def read_table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """``{data_dir}/{name}.parquet`` (a file or a folder of parts).

    Projection and filters applied later are pushed into this scan by
    Catalyst, so callers select only the columns they need.  The relation
    (file listing and footer schema) is resolved once per session and path;
    the returned DataFrame is an immutable plan, shared by every query that
    reads the table.
    """
    path = f"{str(data_dir).rstrip('/')}/{name}.parquet"
    cache = getattr(spark, _CACHE_ATTR, None)
    if cache is None:
        cache = {}
        setattr(spark, _CACHE_ATTR, cache)
    if path not in cache:
        cache[path] = spark.read.parquet(path)
    return cache[path]


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once, as a table in the shared folder of ``spark.checkpoint.dir``; ``df`` itself where the session
    names no such folder."""
    folder = checkpoint_folder(df.sparkSession)
    if folder is None:
        return df
    path = f"{folder.rstrip('/')}/rivalry-{name}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
