"""Partition values of a stored table, from its folders or its catalog: no data is read for them."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame


def partition_values(df: DataFrame, cols: Sequence[str]) -> list[tuple[str | None, ...]] | None:
    """Distinct values (as text) of partition columns of a stored table that ``df`` reads as it is.

    None if ``df`` is more than a scan (a filter may leave partitions out), or
    one of ``cols`` is no partition column: then the data have to tell.  A
    partition counts if it has a file.
    """
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("SubqueryAlias", "View"):
        plan = plan.child()
    if plan.nodeName() != "LogicalRelation":
        return None
    relation = plan.relation()
    if relation.getClass().getSimpleName() != "HadoopFsRelation" or not set(cols) <= set(relation.partitionSchema().fieldNames()):
        return None
    if plan.catalogTable().isDefined():
        name = plan.catalogTable().get().identifier().quotedString()
        found = [r.partition for r in df.sparkSession.sql(f"SHOW PARTITIONS {name}").collect()]  # a row per partition
    else:
        parts = relation.location().partitionSpec().partitions()
        found = [parts.apply(i).path().toString() for i in range(parts.size())]
    out = set()
    for path in found:
        values = dict(x.split("=", 1) for x in path.split("/") if "=" in x)
        out.add(tuple(None if (v := values[c]) == "__HIVE_DEFAULT_PARTITION__" else unquote(v) for c in cols))
    return sorted(out, key=str)
