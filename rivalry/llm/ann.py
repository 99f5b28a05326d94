"""Approximate nearest neighbours: a navigable small-world graph per shard, shard results merged.

Index: the distinct vectors, dealt by their norm's power of the square root of
two, then by hash, into shards of up to about ``SHARD_SIZE``.  Each shard
holds a hierarchical navigable small-world graph, written as flat arrays into
the shared folder (vectors, and per level the neighbours in rows of fixed
width), so that a search task maps only the shards it visits.  Norms within a
shard are alike, so that large inner products are small angles, whatever the
norms of the others are.  A node links to diverse near nodes among those
before it and gets links back, as in insertion one by one; candidates come
from a blocked scan of the shard, whose size is bounded, instead of a search.

Search: a block of queries meets a group of shards in one row of work, those
of the longest vectors first.  A query leaves out a shard whose norms can't
reach its ``top``-th score so far.  Within a shard the whole block walks the
graph together: in each step every query opens its best unopened nodes, and
the array operations are shared.  The best ``top`` of each (query, group) are
merged by a ranked window whose limit is pushed before the shuffle.  Scores
are inner products in double precision, summed from the first component to
the last.

Vectors that are equal form one node with the smallest ``top + 1`` ids of its
rows (more can't be among the first ``top``, ties going to smaller ids), so a
vector that a third of the rows share stays one node.

Vectors that are null, empty, zero or hold a null or non-finite component
take no part, nor do rows without an id; a row that repeats an id and a
vector counts once; vectors of different length are never compared; with
fewer candidates than ``top`` all are returned; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rivalry.functions.joins import checked_broadcast
from rivalry.llm import memory
from rivalry.llm.packed import by_key
from rivalry.llm.store import map_file, scratch, staged, write_file
from rivalry.llm.textarrays import flat_ranges

TOP = 20
#: Distinct vectors of a shard on average; bounds a build task's memory and time.
SHARD_SIZE = 8192
#: Links per node above level 0 (twice as many on it), candidates on building, and nodes kept on searching.
LINKS, BUILD, SEARCH = 16, 64, 128
#: Nodes kept on searching, per component: longer vectors need more of them for the same recall.
SEARCH_PER_COMPONENT = 2.5
#: Nodes that a query opens in one step, and nodes kept on the upper levels, which the search below starts from.
OPEN, SEEDS = 8, 16
#: Queries and shards of one row of work.
QUERY_BLOCK, SHARDS = 128, 16


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vec array<double>) of the rows that take part."""
    v = F.col("embedding")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    some = F.exists(v, lambda x: x != 0)
    return (vectors.filter(F.col("vec_id").isNotNull() & v.isNotNull()).filter(F.coalesce(fine & some, F.lit(False)))
            .select("vec_id", v.cast("array<double>").alias("vec")).distinct())


def nodes(rows: DataFrame, top: int = TOP) -> DataFrame:
    """(vec, ids): distinct vectors with the smallest ``top + 1`` ids of their rows."""
    w = Window.partitionBy("vec").orderBy("vec_id")
    first = rows.withColumn("n", F.row_number().over(w)).filter(F.col("n") <= top + 1)
    return first.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def _extended(x: np.ndarray) -> np.ndarray:
    """Vectors scaled to norms of at most 1, with a component more that makes all of them 1, so that nearness by angle is
    nearness by inner product."""
    x = x / max(np.abs(x).max(), np.finfo(float).tiny)
    x = x / np.sqrt((x * x).sum(1).max())
    return np.concatenate((x, np.sqrt(np.maximum(1 - (x * x).sum(1), 0))[:, None]), 1).astype(np.float32)


def build_graph(x: np.ndarray, links: int = LINKS, build: int = BUILD) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per level (node numbers, neighbour rows padded with -1) of a graph over the rows of ``x``."""
    n = len(x)
    rng = np.random.default_rng(n)
    level = np.minimum((-np.log(rng.random(n) + 1e-12) / np.log(links)).astype(int), 6)
    order = np.argsort(-level, kind="stable")  # nodes of the upper levels come first
    out = []
    for lev in range(int(level.max()) + 1):
        own = order[: int((level >= lev).sum())]
        out.append((own, _level(x[own], 2 * links if lev == 0 else links, build)))
    return out


def _level(x: np.ndarray, width: int, build: int) -> np.ndarray:
    """Neighbours of the rows of ``x``, added in their order in blocks that double up to 1,024."""
    n = len(x)
    near: list[list[int]] = [[] for _ in range(n)]
    lo = 1
    while lo < n:
        hi = min(n, lo + min(lo, 1024))
        sims = x[lo:hi] @ x[:hi].T
        for i in range(lo, hi):
            s = sims[i - lo, :i]
            k = min(build, i)
            c = np.argpartition(-s, k - 1)[:k] if k < i else np.arange(i)
            near[i] = _diverse(x, c[np.argsort(-s[c], kind="stable")], x[i], width // 2 if i > width else width)
            for j in near[i]:
                near[j].append(i)
                if len(near[j]) > width + width // 2:
                    near[j] = _pruned(x, near[j], j, width)
        lo = hi
    out = np.full((n, width), -1, np.int32)
    for i, own in enumerate(near):
        own = own if len(own) <= width else _pruned(x, own, i, width)
        out[i, :len(own)] = own
    return out


def _pruned(x: np.ndarray, own: list[int], i: int, width: int) -> list[int]:
    c = np.array(own)
    return _diverse(x, c[np.argsort(-(x[c] @ x[i]), kind="stable")], x[i], width)


def _diverse(x: np.ndarray, c: np.ndarray, at: np.ndarray, width: int) -> list[int]:
    """Of candidates by nearness, those nearer to ``at`` than to one already taken; then the nearest of the rest."""
    if len(c) <= width // 2:
        return c.tolist()
    v = x[c]
    to, among = v @ at, v @ v.T
    taken, rest, closest = [], [], np.full(len(c), -np.inf, np.float32)
    for k in range(len(c)):
        if closest[k] < to[k]:
            taken.append(k)
            if len(taken) == width:
                break
            np.maximum(closest, among[k], out=closest)
        else:
            rest.append(k)
    taken += rest[: width - len(taken)] if len(taken) < width // 2 else []
    return c[taken[:width]].tolist()


def walk(rows: np.ndarray, x: np.ndarray, q: np.ndarray, seeds: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, scores): the ``keep`` best nodes that each of the queries ``q`` finds from its ``seeds`` (-1: none found)
    along the neighbour rows; every query opens its best unopened nodes until it has none among its best."""
    m, n = len(q), len(rows)
    seen = np.zeros((m, n), bool)
    nodes, vals, opened = np.full((m, keep), -1, np.int32), np.full((m, keep), -np.inf, np.float32), np.zeros((m, keep), bool)
    k = min(keep, seeds.shape[1])
    nodes[:, :k] = seeds[:, :k]
    vals[:, :k] = np.einsum("ijk,ik->ij", x[seeds[:, :k]], q)
    np.put_along_axis(seen, seeds.astype(np.int64), True, 1)
    active = np.arange(m)
    while len(active):
        rest = np.where(opened[active], -np.inf, vals[active])
        width = min(OPEN, keep)
        pick = np.argpartition(-rest, width - 1, axis=1)[:, :width]
        fit = np.take_along_axis(rest, pick, 1) > -np.inf
        going = fit.any(1)
        active, pick, fit = active[going], pick[going], fit[going]
        if not len(active):
            break
        own, place = np.nonzero(fit)
        at = pick[own, place]
        opened[active[own], at] = True
        near = rows[nodes[active[own], at]]
        names = (active[own][:, None].astype(np.int64) * n + near)[near >= 0]
        names = np.unique(names)
        names = names[~seen.ravel()[names]]
        seen.ravel()[names] = True
        who, node = names // n, (names % n).astype(np.int32)
        score = np.einsum("ij,ij->i", x[node], q[who])
        better = score > vals.min(1)[who]
        who, node, score = who[better], node[better], score[better]
        if not len(who):
            continue
        changed, first, count = np.unique(who, return_index=True, return_counts=True)
        col = np.arange(len(who)) - np.repeat(first, count)
        row = np.repeat(np.arange(len(changed)), count)
        wide = int(count.max())
        more = np.full((len(changed), wide), -np.inf, np.float32), np.full((len(changed), wide), -1, np.int32)
        more[0][row, col], more[1][row, col] = score, node
        every = np.concatenate((vals[changed], more[0]), 1)
        best = np.argpartition(-every, keep - 1, axis=1)[:, :keep]
        vals[changed] = np.take_along_axis(every, best, 1)
        nodes[changed] = np.take_along_axis(np.concatenate((nodes[changed], more[1]), 1), best, 1)
        opened[changed] = np.take_along_axis(np.concatenate((opened[changed], np.zeros_like(more[1], bool)), 1), best, 1)
    return nodes, vals


class Shard:
    """Mapped arrays of one shard, and the search in it."""

    def __init__(self, uri: str):
        meta = np.frombuffer(map_file(f"{uri}.meta"), "<i8")
        n, dim, levels, _ = meta[:4].tolist()
        sizes = meta[4:4 + 2 * levels].reshape(levels, 2).tolist()
        self.vecs = np.frombuffer(map_file(f"{uri}.vecs"), "<f8").reshape(n, dim)
        ids = np.frombuffer(map_file(f"{uri}.ids"), "<i8")
        self.id_offs, self.ids = ids[:n + 1], ids[n + 1:]
        flat, at, self.levels = np.frombuffer(map_file(f"{uri}.links"), "<i4"), 0, []
        for size, width in sizes:
            own = flat[at:at + size]
            rows = flat[at + size:at + size * (1 + width)].reshape(size, width)
            at += size * (1 + width)
            self.levels.append((own, rows))
        # A level's nodes are a prefix of the level below, so a node keeps its place on the way down.
        self.x = _extended(self.vecs)[self.levels[0][0]]
        self.longest = float(np.sqrt((self.vecs * self.vecs).sum(1).max()))

    def search(self, q: np.ndarray, keep: int) -> list[np.ndarray]:
        """Numbers of about ``keep`` nodes nearest to each of the queries."""
        q = q / np.abs(q).max(1, keepdims=True)
        q = np.concatenate((q, np.zeros((len(q), 1))), 1).astype(np.float32)
        seeds = np.zeros((len(q), 1), np.int32)
        for lev in range(len(self.levels) - 1, -1, -1):
            rows = self.levels[lev][1]
            nodes, _ = walk(rows, self.x[:len(rows)], q, seeds, min(keep if lev == 0 else SEEDS, len(rows)))
            found = (nodes >= 0).sum(1).min()
            seeds = np.sort(nodes, 1)[:, -found:] if lev else nodes
        return [self.levels[0][0][own[own >= 0]] for own in seeds]


def scores(q: np.ndarray, vecs: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed in the order of the components."""
    out = np.zeros(len(vecs))
    for d in range(len(q)):
        out += q[d] * vecs[:, d]
    return out


def build(vectors: DataFrame, top: int = TOP, shard_size: int = SHARD_SIZE) -> tuple[str, DataFrame]:
    """Index of ``vectors`` (vec_id, embedding): its folder, and the shards (shard, dim, norm, n)."""
    spark = vectors.sparkSession
    folder = scratch(spark, "graphs")
    v, size = F.col("vec"), F.array_max(F.transform("vec", F.abs))
    squares = F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)
    # The logarithm of the norm to base 2; the slower way where squares leave the range of a double.
    norm = F.when(squares.between(1e-280, 1e280), F.log2(squares) / 2).otherwise(
        F.log2(size) + F.log2(F.aggregate(v, F.lit(0.0), lambda s, x: s + (x / size) * (x / size))) / 2)
    held = staged(nodes(usable(vectors), top).withColumn("dim", F.size("vec")).withColumn("norm", F.rint(2 * norm).cast("int")),
                  "graph-nodes")
    sizes = held.groupBy("dim", "norm").agg(  # a row per vector length and power
        F.greatest(F.lit(1), F.round(F.count(F.lit(1)) / shard_size)).cast("int").alias("of"))
    dealt = held.join(checked_broadcast(sizes), ["dim", "norm"]).select(
        F.concat_ws("-", "dim", "norm", F.pmod(F.xxhash64("vec"), "of")).alias("shard"), "dim", "norm", "vec", "ids")

    def graphs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory.begin()
        for shard, own in by_key(batches):
            yield graph(shard, own)

    def graph(shard: str, batches: Iterator[pa.RecordBatch]) -> pa.RecordBatch:
        vecs, ids, sizes = [], [], []
        for b in batches:
            dim, norm = b.column("dim")[0].as_py(), b.column("norm")[0].as_py()
            vecs.append(b.column("vec").flatten().to_numpy().reshape(-1, dim))
            ids.append(b.column("ids").flatten().to_numpy())
            sizes.append(np.diff(b.column("ids").offsets.to_numpy()))
        vecs, ids, sizes = np.concatenate(vecs), np.concatenate(ids), np.concatenate(sizes)
        offs = np.concatenate(([0], np.cumsum(sizes)))
        order = np.argsort(ids[offs[:-1]], kind="stable")  # the same graph whatever the order of arrival
        ids, sizes = ids[flat_ranges(offs[order], sizes[order])], sizes[order]
        vecs = vecs[order]
        levels = build_graph(_extended(vecs))
        meta = [len(vecs), vecs.shape[1], len(levels), 0, *(x for own, rows in levels for x in (len(own), rows.shape[1]))]
        uri = f"{folder}/{shard}"
        for name, arrays in (("vecs", [vecs.astype("<f8")]), ("links", [a.astype("<i4") for level in levels for a in level]),
                             ("ids", [np.concatenate(([0], np.cumsum(sizes))).astype("<i8"), ids.astype("<i8")]),
                             ("meta", [np.array(meta, "<i8")])):
            write_file(f"{uri}.{name}", lambda out, arrays=arrays: [out.write(a.tobytes()) for a in arrays])
        return pa.RecordBatch.from_arrays(
            [pa.array([shard]), pa.array([vecs.shape[1]], pa.int32()), pa.array([norm], pa.int32()),
             pa.array([len(vecs)], pa.int64())], ["shard", "dim", "norm", "n"])

    made = (dealt.repartition("shard").sortWithinPartitions("shard")
            .mapInArrow(graphs, "shard string, dim int, norm int, n long"))
    return folder, staged(made, "graph-shards")


def search(index: tuple[str, DataFrame], queries: DataFrame, top: int = TOP, keep: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``top`` nearest found; ``queries`` has vec_id and embedding.  ``keep`` nodes of a
    shard stay in view (by default ``SEARCH``, or ``SEARCH_PER_COMPONENT`` of a vector if that is more)."""
    folder, shards = index
    spark = queries.sparkSession
    # Blocks of queries: enough of them that none grows with the query set.
    q = usable(queries).withColumn("dim", F.size("vec"))
    blocks = max(1, -(-q.count() // QUERY_BLOCK))
    packed = (q.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
              .groupBy("dim", "block").agg(F.collect_list(F.struct("vec_id", "vec")).alias("queries")))
    w = Window.partitionBy("dim").orderBy(F.desc("norm"), "shard")
    groups = (shards.withColumn("group", F.floor((F.row_number().over(w) - 1) / SHARDS))  # a row per shard
              .groupBy("dim", "group").agg(F.sort_array(F.collect_list(F.struct((-F.col("norm")).alias("norm"), "shard"))).alias("shards")))
    work = packed.join(groups, "dim").repartition(
        int(spark.conf.get("spark.sql.shuffle.partitions")), "dim", "group", "block")  # few bytes, much work: not coalesced

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory.begin()
        for batch in batches:
            for items, own_shards in zip(batch.column("queries"), batch.column("shards")):
                items = items.as_py()
                ids, q = [x["vec_id"] for x in items], np.array([x["vec"] for x in items], float)
                own_keep = keep or max(SEARCH, int(SEARCH_PER_COMPONENT * q.shape[1]))
                size = np.abs(q).max(1)
                length = size * np.sqrt(((q / size[:, None]) ** 2).sum(1))
                found: list[list[tuple[float, int]]] = [[] for _ in items]
                for x in own_shards.as_py():
                    shard = Shard(f"{folder}/{x['shard']}")
                    # Left out: no vector of the shard can reach the last score, rounding allowed for.
                    reach = length * shard.longest * (1 + 1e-9)
                    near = [k for k, own in enumerate(found) if len(own) < top or reach[k] >= -own[-1][0]]
                    for k, nodes in zip(near, shard.search(q[near], max(own_keep, top + 1)) if near else []):
                        exact = scores(q[k], shard.vecs[nodes])
                        best = np.argsort(-exact, kind="stable")[: top + 1]
                        rows = [(-s, i) for s, n in zip(exact[best].tolist(), nodes[best].tolist())
                                for i in shard.ids[shard.id_offs[n]:shard.id_offs[n + 1]].tolist() if i != ids[k]]
                        found[k] = heapq.nsmallest(top, found[k] + rows)
                rows = [(ids[k], i, -s) for k, own in enumerate(found) for s, i in own]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
                        pa.int64(), pa.int64(), pa.float64()))], ["query_id", "vec_id", "score"])

    found = work.select("queries", "shards").mapInArrow(run, "query_id long, vec_id long, score double")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)
            .select("query_id", "rank", "vec_id", "score"))


def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every row whose vec_id is divisible by 20, over all rows of ``embeddings``."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return search(build(vectors), vectors.filter("vec_id % 20 = 0"))
