"""Files and tables in the shared folder that the session names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import functools
import os
import uuid
from pathlib import Path
from urllib.parse import urlparse

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession

from rivalry.session import ensure_checkpoint_dir


#: Rows of an Arrow batch: texts may be long, and a batch is held on both sides of the pipe to a worker.
BATCH_ROWS, _ROWS_KEY = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def located(query):
    """``query(spark, ...)`` whose Python workers find this package where the driver found it, and get batches of
    ``BATCH_ROWS`` rows at most (a setting of the session, lowered if it is higher).

    A worker looks in its own path; a driver that put the repository on its path by other means than ``PYTHONPATH`` has
    to say so.  On a cluster whose executors have no such folder the package is installed or shipped as usual.
    """

    @functools.wraps(query)
    def run(spark: SparkSession, *args):
        root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
        paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
        if root not in paths:
            env["PYTHONPATH"] = os.pathsep.join([*paths, root])
        if int(spark.conf.get(_ROWS_KEY)) > BATCH_ROWS:
            spark.conf.set(_ROWS_KEY, BATCH_ROWS)
        return query(spark, *args)

    return run


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores before those that ``df`` has columns of (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder (unique per call)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a shared folder's URI (``file:``, ``hdfs:``, ``s3:`` ... or a plain path)."""
    if not urlparse(uri).scheme:
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), urlparse(uri).path
    return pafs.FileSystem.from_uri(uri)


def write_file(uri: str, writer) -> int:
    """Write one file by ``writer(stream)`` under a temporary name, then rename it: a retried task
    replaces the file by the same bytes, and a half-written file is never visible.  Returns its size."""
    fs, path = filesystem(uri)
    fs.create_dir(os.path.dirname(path), recursive=True)
    temp = f"{path}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(temp) as out:
        writer(out)
    fs.move(temp, path)
    return fs.get_file_info(path).size


def map_file(uri: str):
    """A buffer over a whole file: memory-mapped where the store is a file system, else read."""
    import pyarrow as pa

    fs, path = filesystem(uri)
    if isinstance(fs, pafs.LocalFileSystem):
        with pa.memory_map(path) as f:
            return f.read_buffer()
    with fs.open_input_file(path) as f:
        return f.read_buffer()
