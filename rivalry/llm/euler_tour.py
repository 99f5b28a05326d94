"""Ranks of a linked list by local contraction, and sums along it.

The list's elements are arcs of an Euler tour, named by two longs (``m``,
``x``), each with its successor (``nm``, ``nx``; null at the end) and a
length.  A round deals the elements to tasks of bounded size; a task joins
every run of elements that it holds whole, so that the run's head stands for
all of it, and notes each element's distance from its head.  Rounds follow on
the heads until they fit one task; going back, an element's rank is its head's
rank and its distance.  The first round deals by the caller's key, which keeps
most neighbours together.  Later rounds take turns: by coarser and coarser
ranges of ``m``; and by coin, where an element whose coin shows tails goes
where its successor is, if that one's shows heads, so that a round removes a
quarter of any list on average, however it lies.

Each round is a table in the shared folder, so a lost executor costs a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivalry.llm.store import staged

#: Elements that one task joins on average, and on which the last round works alone.
TASK_ARCS = 500_000
#: Ranks whose sums are one group, at least; there are ``MAX_BLOCKS`` groups at most.
BLOCK, MAX_BLOCKS = 1 << 16, 4096
_OUT = "m long, x long, nm long, nx long, len long, hm long, hx long, off long"
_NAMES = ["m", "x", "nm", "nx", "len", "hm", "hx", "off"]


def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The elements with head (``hm``, ``hx``) and distance ``off``; a head's successor and length are its run's."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    m, x, length = (np.concatenate([b.column(c).to_numpy() for b in held]) for c in (0, 1, 4))
    nm, nx = (pa.chunked_array([b.column(c) for b in held]) for c in (2, 3))
    end = nm.is_null().to_numpy()
    nm, nx = nm.fill_null(0).to_numpy(), nx.fill_null(0).to_numpy()
    n, every = len(m), np.arange(len(m))
    # One number per name: the rank of m times the width of x, plus x.
    place = np.unique(np.concatenate((m, nm)), return_inverse=True)[1]
    width = max(int(x.max()), int(nx.max())) + 1
    own, after = place[:n] * width + x, place[n:] * width + nx
    order = np.argsort(own)
    at = np.minimum(np.searchsorted(own, after, sorter=order), n - 1)
    here = (own[order[at]] == after) & ~end  # the successor is in this task
    before = every.copy()  # an element without a predecessor here is its run's head
    before[order[at[here]]] = every[here]
    off = np.where(before == every, 0, length[before])
    while True:  # distances double each time
        further = before[before]
        if (further == before).all():
            break
        off, before = off + np.where(before == every, 0, off[before]), further
    tail = every[~here]  # each run ends where the successor is elsewhere
    total, last = np.zeros(n, np.int64), every.copy()
    total[before[tail]], last[before[tail]] = off[tail] + length[tail], tail
    for lo in range(0, n, 1 << 16):
        s = slice(lo, lo + (1 << 16))
        t = last[s]
        cols = [pa.array(m[s]), pa.array(x[s]), pa.array(nm[t], mask=end[t]), pa.array(nx[t], mask=end[t]),
                pa.array(total[s]), pa.array(m[before[s]]), pa.array(x[before[s]]), pa.array(off[s])]
        yield pa.RecordBatch.from_arrays(cols, _NAMES)


def ranks(arcs: DataFrame, near: Column, task_arcs: int | None = None) -> DataFrame:
    """(m, x, rank): the place of each element of ``arcs`` (m, x, nm, nx) in its list, from 0; ``near`` deals the first round."""
    limit = task_arcs or TASK_ARCS
    now, levels = staged(arcs.withColumn("len", F.lit(1).cast("long")), "arcs"), []
    size = now.count()
    while size > limit:
        parts, level = -(-size // limit), len(levels)
        coins = [F.pmod(F.xxhash64(F.lit(level), *pair), F.lit(2)) for pair in (("m", "x"), ("nm", "nx"))]
        joins = F.col("nm").isNotNull() & (coins[0] == 0) & (coins[1] == 1)
        if level == 0:
            key = [near]
        elif level % 2:
            key = [F.floor(F.col("m") / F.lit(16 ** ((level + 3) // 2))), F.floor(F.col("x") / F.lit(1 << 14))]
        else:
            key = [F.when(joins, F.col("nm")).otherwise(F.col("m")), F.when(joins, F.col("nx")).otherwise(F.col("x"))]
        done = staged(now.repartition(parts, *key).mapInArrow(contract, _OUT), "tour")
        levels.append(done)
        now = done.filter("m = hm AND x = hx").select("m", "x", "nm", "nx", "len")
        size = now.count()
    out = now.coalesce(1).mapInArrow(contract, _OUT).selectExpr("m", "x", "off AS rank")
    for done in reversed(levels):
        heads = out.selectExpr("m AS hm", "x AS hx", "rank")
        out = done.join(heads, ["hm", "hx"]).selectExpr("m", "x", "rank + off AS rank")
    return out


def sums_before(ranked: DataFrame, columns: list[str]) -> DataFrame:
    """``ranked`` (rank 0..n-1, ...) with each of ``columns`` replaced by its sum over the rows of smaller rank.

    Blocks of ranks are summed each, and the bases of the blocks are prefix sums over ``MAX_BLOCKS`` rows at most.
    """
    from pyspark.sql import Window

    held = staged(ranked, "ranked")
    size = held.count()
    block = max(BLOCK, -(-size // MAX_BLOCKS))
    own = held.withColumn("block", F.floor(F.col("rank") / F.lit(block)).cast("long"))
    rows, base = own.groupBy("block").agg(*(F.sum(c).alias(c) for c in columns)).orderBy("block").collect(), []
    total = [0] * len(columns)
    for r in rows:  # MAX_BLOCKS rows at most
        base.append((r.block, *total))
        total = [t + r[c] for t, c in zip(total, columns)]
    bases = held.sparkSession.createDataFrame(base, "block long, " + ", ".join(f"`base_{c}` long" for c in columns))
    w = Window.partitionBy("block").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    within = own.select(*(c for c in own.columns if c not in columns),
                        *(F.coalesce(F.sum(c).over(w), F.lit(0)).alias(c) for c in columns))
    joined = within.join(F.broadcast(bases), "block")
    return joined.select(*(c for c in held.columns if c not in columns),
                         *((F.col(c) + F.col(f"base_{c}")).alias(c) for c in columns))
