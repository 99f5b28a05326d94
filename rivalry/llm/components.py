"""Connected components of a graph of links, by local contraction, joins and grouped minima."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivalry.llm.store import staged

#: Links that one task contracts.
TASK_LINKS = 500_000


def components(links: DataFrame, task_links: int | None = None) -> DataFrame:
    """(node, root): each node of ``links`` (a long, b long) with the smallest node that it is connected to.

    The links are dealt to tasks of about ``TASK_LINKS`` each, which replace
    theirs by stars around the least node of what they connect.  As long as
    more than one task is needed, rounds follow that point each node to the
    least of its neighbours and itself, first through larger, then through
    smaller neighbours, so that paths shorten by about half.  Minima are
    aggregated before the shuffle and joined back, so a node with very many
    links is no group in one task.  Each round is a table in the shared folder.
    """
    task_links = task_links or TASK_LINKS
    edges = staged(links.selectExpr("greatest(a, b) AS u", "least(a, b) AS v").filter("u > v").distinct(), "links")
    before = None
    while True:
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        parts = -(-now.n // task_links)
        if parts <= 1:
            edges = staged(edges.coalesce(1).mapInArrow(_contract, "u long, v long"), "links")
        elif now != before:
            before = now
            dealt = staged(edges.repartition(parts, "u").mapInArrow(_contract, "u long, v long").distinct(), "links")
            edges = staged(_small_star(_large_star(dealt)), "links")
            continue
        return edges.selectExpr("u AS node", "v AS root").unionByName(
            edges.selectExpr("v AS node", "v AS root").distinct())


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars (u, v) around the least node of each component of a task's links."""
    held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
    if not held:
        return
    nodes, ends = np.unique(np.concatenate([x for pair in zip(*held) for x in pair]), return_inverse=True)
    a, b = ends[:len(ends) // 2], ends[len(ends) // 2:]
    root = np.arange(len(nodes))
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            break
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root != root[root]).any():
            root = root[root]
    own = root != np.arange(len(nodes))
    yield pa.RecordBatch.from_arrays([pa.array(nodes[own]), pa.array(nodes[root[own]])], ["u", "v"])


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node link to the least of its neighbours and itself."""
    both = edges.unionByName(edges.selectExpr("v AS u", "u AS v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").selectExpr("v AS u", "m AS v").filter("u > v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and the node, link to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    return (joined.selectExpr("v AS u", "m AS v").unionByName(least.selectExpr("u", "m AS v"))
            .filter("u > v").distinct())
