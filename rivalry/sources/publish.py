"""Two-phase publication of partitions (D26): readers find the old or the new partition, never a half-written one.

*Prepare*: the frame is written to a folder of the run beside the published
partitions, read back and its rows counted against what the write saw; then a
manifest names each partition that the run replaces or removes.  Writing the
manifest (to a temporary name, then renamed) is the commit point: before it,
nothing published has changed, and a run that dies leaves only a folder that
readers skip.

*Swap*: path by path of the manifest.  A path's old folder is renamed aside
and the new one renamed into its place; a table's partition is pointed to its
new folder by one change in the catalog.  Old folders are deleted when every
partition has been swapped, the manifest last.

*Recovery*: every step of the swap can be repeated, so ``recover`` (which each
publication of the same target does first) finishes the runs whose manifest
exists.  ``recover(..., abandoned=True)`` also removes folders of runs that
died before; it must not be called while another run writes to the target.
Runs that write different partitions of a target at the same time don't
disturb each other; one partition has one writer at a time.

A frame may read the target that it is published to: it is written in full
before anything is moved.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from urllib.parse import urlparse

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

TABLE = "table:"
#: Folder of the runs beside the partitions; Spark's readers skip names that start with an underscore.
RUNS = "_publish"
DATA, OLD, MANIFEST = "data", "old", "manifest.json"
#: Folder of a table's partition versions.
VERSIONS = "_versions"
#: Rows of one file at most.
FILE_ROWS = 20_000_000

#: Called with the name of each step before it is taken; tests raise from it.
Step = Callable[[str], None]


def _no_step(_: str) -> None:
    pass


class Folders:
    """The few file operations of a publication, on any file system that Spark writes to."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.fs = self.path(root).getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def names(self, folder: str) -> list[str]:
        """Names of the folders within a folder."""
        if not self.exists(folder):
            return []
        return sorted(f.getPath().getName() for f in self.fs.listStatus(self.path(folder)) if f.isDirectory())

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def move(self, name: str, to: str) -> None:
        self.fs.mkdirs(self.path(to).getParent())
        if not self.fs.rename(self.path(name), self.path(to)):
            raise OSError(f"{name} could not be renamed to {to}")

    def write(self, name: str, text: str) -> None:
        """Write a small file at once: it exists whole or not at all."""
        temp = f"{name}.{uuid.uuid4().hex}"
        out = self.fs.create(self.path(temp), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self.move(temp, name)

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()


def _utils(spark: SparkSession):
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils


def _folder_of(spark: SparkSession, cols: Sequence[str], values: Mapping[str, str]) -> str:
    """Relative folder of partition values, which name the first partition columns."""
    first = list(cols)[:len(values)]
    if set(first) != set(values):
        raise ValueError(f"the values {dict(values)} must be of the first partition columns {first}")
    escape = _utils(spark).escapePathName
    return "/".join(f"{escape(c)}={escape(str(values[c]))}" for c in first)


def _leaves(folders: Folders, root: str, depth: int, under: str = "") -> list[str]:
    """Relative folders of the partitions at ``depth`` levels within a folder."""
    if depth == 0:
        return [under]
    at = f"{root}/{under}" if under else root
    found = []
    for name in folders.names(at):
        if "=" in name:
            found += _leaves(folders, root, depth - 1, f"{under}/{name}" if under else name)
    return found


def clustered(df: DataFrame, partition_cols: Sequence[str], cluster: Sequence[str]) -> DataFrame:
    """``df`` over ranges of (partition, cluster columns) and sorted by them within each.

    A partition's files then hold disjoint ranges of the cluster columns, so a
    lookup skips most of them by their footers.  The number of ranges is
    Spark's: its adaptive execution merges small ones.
    """
    by = [*partition_cols, *cluster]
    return df.repartitionByRange(*by).sortWithinPartitions(*by) if cluster else df


def _stage(df: DataFrame, folder: str, partition_cols: Sequence[str], fmt: str, cluster: Sequence[str] = ()) -> None:
    """Write a frame to a run's folder and count its rows there."""
    seen = Observation()
    # Seen after the ranges are made: sampling for them would count the rows a second time.
    watched = clustered(df, partition_cols, cluster).observe(seen, F.count(F.lit(1)).alias("rows"))
    watched.write.option("maxRecordsPerFile", FILE_ROWS).partitionBy(*partition_cols).format(fmt).save(folder)
    found = df.sparkSession.read.format(fmt).schema(df.schema).load(folder).count()
    if found != (rows := seen.get["rows"]):
        raise OSError(f"{rows} rows were written to {folder}, {found} are there")


# --- paths ----------------------------------------------------------------------------------------------------------

def publish_path(df: DataFrame, target: str, partition_cols: Sequence[str], fmt: str = "parquet",
                 clear: Iterable[Mapping[str, str]] = (), step: Step = _no_step, cluster: Sequence[str] = ()) -> None:
    """Replace the partitions present in ``df``, and everything under the values of ``clear``, in a folder."""
    spark, target = df.sparkSession, target.rstrip("/")
    folders, run = Folders(spark, target), f"{target}/{RUNS}/{uuid.uuid4().hex}"
    whole = [_folder_of(spark, partition_cols, values) for values in clear]
    recover(spark, target)
    step("stage")
    _stage(df, f"{run}/{DATA}", partition_cols, fmt, cluster)
    own = [p for p in _leaves(folders, f"{run}/{DATA}", len(partition_cols))
           if not any(p == w or p.startswith(f"{w}/") for w in whole)]
    swaps = [{"part": p, "new": folders.exists(f"{run}/{DATA}/{p}")} for p in whole + own]
    step("manifest")
    folders.write(f"{run}/{MANIFEST}", json.dumps(swaps))
    _swap_path(folders, target, run, step)


def _swap_path(folders: Folders, target: str, run: str, step: Step = _no_step) -> None:
    for swap in json.loads(folders.read(f"{run}/{MANIFEST}")):
        new, old, at = (f"{x}/{swap['part']}" for x in (f"{run}/{DATA}", f"{run}/{OLD}", target))
        if swap["new"] and not folders.exists(new):
            continue  # it is in its place
        if folders.exists(at):
            step(f"aside {swap['part']}")
            folders.move(at, old)
        if swap["new"]:
            step(f"into place {swap['part']}")
            folders.move(new, at)
    step("clean")
    for name in (f"{run}/{DATA}", f"{run}/{OLD}", run):
        folders.delete(name)


# --- catalog tables -------------------------------------------------------------------------------------------------

def publish_table(df: DataFrame, name: str, clear: Iterable[Mapping[str, str]] = (), step: Step = _no_step,
                  cluster: Sequence[str] = ()) -> None:
    """The same for a partitioned catalog table; each partition's new folder is a version of the run."""
    spark, about = df.sparkSession, _described(df.sparkSession, name)
    folders, number = Folders(spark, about["Location"]), uuid.uuid4().hex
    run, version = f"{about['Location']}/{RUNS}/{number}", f"{about['Location']}/{VERSIONS}/{number}"
    cols = spark.catalog.listColumns(name)
    partition_cols, clear = [c.name for c in cols if c.isPartition], list(clear)
    for values in clear:
        _folder_of(spark, partition_cols, values)
    recover(spark, TABLE + name)
    step("stage")
    typed = df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in spark.table(name).schema))
    _stage(typed, version, partition_cols, about["Provider"], cluster)
    new = _leaves(folders, version, len(partition_cols))
    swaps = [{"part": p, "new": f"{version}/{p}", "old": _location(spark, name, p)} for p in new]
    for values in clear:
        gone = spark.sql(f"SHOW PARTITIONS {name} PARTITION ({_spec(values.items())})").collect()  # partitions of one run
        swaps += [{"part": p, "new": None} for (p,) in gone if p not in new]
    step("manifest")
    folders.write(f"{run}/{MANIFEST}", json.dumps(swaps))
    _swap_table(spark, name, folders, run, step)


def _swap_table(spark: SparkSession, name: str, folders: Folders, run: str, step: Step = _no_step) -> None:
    swaps = json.loads(folders.read(f"{run}/{MANIFEST}"))
    for swap in swaps:
        spec = _spec(_values(spark, swap["part"]))
        step(f"switch {swap['part']}")
        if not swap["new"]:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec})")
            continue
        place = f"LOCATION {_literal(swap['new'])}"
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({spec}) {place}")
        spark.sql(f"ALTER TABLE {name} PARTITION ({spec}) SET {place}")
    spark.catalog.refreshTable(name)
    step("clean")
    for swap in swaps:
        if swap["new"] and swap["old"] and _local(swap["old"]) != _local(swap["new"]):
            folders.delete(swap["old"])
    folders.delete(run)


def _described(spark: SparkSession, name: str, spec: str = "") -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name} {f'PARTITION ({spec})' if spec else ''}").collect()
    return {r.col_name: r.data_type for r in reversed(rows)}  # a partition's own lines come before its table's


def _location(spark: SparkSession, name: str, part: str) -> str | None:
    """Folder of a partition, None if the table doesn't have it."""
    spec = _spec(_values(spark, part))
    if not spark.sql(f"SHOW PARTITIONS {name} PARTITION ({spec})").collect():
        return None
    return _described(spark, name, spec)["Location"]


def _values(spark: SparkSession, part: str) -> list[tuple[str, str | None]]:
    """Columns and values of a partition's folder name."""
    utils, pairs = _utils(spark), [x.split("=", 1) for x in part.split("/")]
    none = utils.DEFAULT_PARTITION_NAME()
    return [(utils.unescapePathName(c), None if v == none else utils.unescapePathName(v)) for c, v in pairs]


def _literal(value: str | None) -> str:
    return "NULL" if value is None else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spec(values) -> str:
    return ", ".join(f"`{c}` = {_literal(v)}" for c, v in values)


def _local(uri: str) -> str:
    return urlparse(uri).path.rstrip("/")


# --- recovery -------------------------------------------------------------------------------------------------------

def recover(spark: SparkSession, target: str, abandoned: bool = False) -> list[str]:
    """Finish the publications of a target that died after their manifest; their run numbers are returned.

    With ``abandoned`` the folders of runs that died before it go, too.
    """
    table = target[len(TABLE):] if target.startswith(TABLE) else None
    if table and not spark.catalog.tableExists(table):
        return []
    root = _described(spark, table)["Location"] if table else target.rstrip("/")
    folders, finished = Folders(spark, root), []
    for number in folders.names(f"{root}/{RUNS}"):
        run = f"{root}/{RUNS}/{number}"
        if folders.exists(f"{run}/{MANIFEST}"):
            finished.append(number)
            if table:
                _swap_table(spark, table, folders, run)
            else:
                _swap_path(folders, root, run)
        elif abandoned:
            folders.delete(run)
    if abandoned and table:  # versions that no partition points to
        live = {_local(_location(spark, table, p)).split(f"/{VERSIONS}/")[-1].split("/")[0]
                for (p,) in spark.sql(f"SHOW PARTITIONS {table}").collect()}
        for number in folders.names(f"{root}/{VERSIONS}"):
            if number not in live:
                folders.delete(f"{root}/{VERSIONS}/{number}")
    return finished
