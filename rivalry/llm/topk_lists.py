"""Exact top-k search by inner product without random access: sorted lists read from their heads.

Index: the distinct integer vectors, dealt into shards of about ``ENTRIES``
components.  A shard holds, for each component, the list of its vectors in
order of that component, as flat files in the shared folder.  Vectors whose
largest component is the same stand together, so lists of a shard are narrow
where the data are clustered.

Search: a block of queries meets a group of shards in one row of work.  A
query reads the lists of a shard in step, each from the end that adds most to
its score.  What a list still holds adds at most its last value read and at
least the value at its other end, so every vector has an upper and a lower
bound.  Vectors whose upper bound is below the ``top``-th score that is
certain are out, those never seen first; a shard whose first values can't
reach it isn't read.  When the vectors left cost less to read than the lists'
next step, their final scores are resolved and merged: a component of a row is
one of a product, an entry of a list takes several passes (``RESOLVE``).  A
query begins with the shard whose heads promise most, so that the others meet
a score that is high already.  Each (query, group) hands on its ``top``,
merged by a ranked window whose limit comes before the shuffle.

Equal vectors are one entry with the smallest ``top + 1`` ids of their rows
(no more can be among the first), so a vector that a third of all rows share
is read once.

Defined cases: a component is floor(1024 * x), x as double.  Vectors that are
null or hold a null or non-finite component (also after the product) take no
part, nor do rows without an id; zero vectors do; empty ones have score 0 with
each other; vectors of different length are never compared; a row that
repeats an id and a vector counts once; an id with two vectors is two queries,
and no row of a query's id is its candidate; with fewer candidates than ``top`` all are returned; an empty
table gives no rows.  Scores are exact; beyond a long's range they are the
range's end.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rivalry.functions.joins import checked_broadcast
from rivalry.llm.packed import by_key
from rivalry.llm.store import map_file, scratch, staged, write_file
from rivalry.llm.textarrays import flat_ranges

TOP, SCALE = 10, 1024
#: Components of a shard on average: bounds a task's memory; vectors of a shard that its first read of the lists covers.
ENTRIES, FIRST = 1 << 19, 16
#: Components of rows that cost as much to multiply as one entry of a list to read, at least.
RESOLVE = 8
#: Queries and shards of one row of work.
QUERIES, SHARDS = 64, 16
#: Whole numbers below this are exact in double precision, with room for differences of two sums.
EXACT = 1 << 53
LONG = (1 << 63) - 1


def whole(vectors: DataFrame) -> DataFrame:
    """(vec_id, vec array<double>): the rows that take part, components as whole numbers."""
    def floor(x):
        y = x.cast("double") * SCALE
        return F.when(F.abs(y) < float(EXACT), F.floor(y).cast("double")).otherwise(y)  # larger doubles are whole

    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", floor).alias("vec"))
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.filter(F.coalesce(fine, F.lit(False))).distinct()


def entries(rows: DataFrame, top: int = TOP) -> DataFrame:
    """(vec, ids): distinct vectors with the smallest ``top + 1`` ids of their rows."""
    w = Window.partitionBy("vec").orderBy("vec_id")
    first = rows.withColumn("n", F.row_number().over(w)).filter(F.col("n") <= top + 1)
    return first.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def build(vectors: DataFrame, top: int = TOP, shard_entries: int | None = None) -> tuple[str, DataFrame]:
    """Index of ``vectors`` (vec_id, embedding): its folder, and the shards (dim, shard, n)."""
    spark, room = vectors.sparkSession, shard_entries or ENTRIES
    folder = scratch(spark, "lists")
    size = F.transform("vec", F.abs)
    kind = F.coalesce(F.array_position(size, F.array_max(size)), F.lit(0))  # where the largest component is, with its sign
    sign = F.when(F.get("vec", kind.cast("int") - 1) < 0, -1).otherwise(1)
    held = staged(entries(whole(vectors), top).select("vec", "ids", F.size("vec").alias("dim"), (kind * sign).alias("kind")),
                  "entries")
    w = Window.partitionBy("dim").orderBy("kind").rowsBetween(Window.unboundedPreceding, -1)
    kinds = held.groupBy("dim", "kind").agg(F.count(F.lit(1)).alias("own")).select(  # two rows per component at most
        "dim", "kind", "own", F.coalesce(F.sum("own").over(w), F.lit(0)).alias("before"))
    place = F.col("before") + F.pmod(F.xxhash64("vec"), F.col("own"))
    each = F.greatest(F.lit(1), F.floor(F.lit(room) / F.greatest("dim", F.lit(1))))
    dealt = held.join(checked_broadcast(kinds), ["dim", "kind"]).select(
        F.concat_ws("-", "dim", F.floor(place / each).cast("string")).alias("shard"), "dim", "vec", "ids")

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, own in by_key(batches):
            vecs, ids, sizes = [], [], []
            for b in own:
                dim = b.column("dim")[0].as_py()
                vecs.append(b.column("vec").flatten().to_numpy().reshape(b.num_rows, dim))
                ids.append(b.column("ids").flatten().to_numpy())
                sizes.append(np.diff(b.column("ids").offsets.to_numpy()))
            vecs, ids, sizes = np.concatenate(vecs), np.concatenate(ids), np.concatenate(sizes)
            offs = np.concatenate(([0], np.cumsum(sizes)))
            by = np.argsort(vecs.T, axis=1, kind="stable")
            uri = f"{folder}/{shard}"
            for name, arrays in (("rows", [by.astype("<i4")]), ("vals", [np.take_along_axis(vecs.T, by, 1).astype("<f8")]),
                                 ("vecs", [vecs.astype("<f8")]), ("ids", [offs.astype("<i8"), ids.astype("<i8")])):
                write_file(f"{uri}.{name}", lambda out, arrays=arrays: [out.write(a.tobytes()) for a in arrays])
            yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([shard]), pa.array([len(vecs)], pa.int64())],
                                             ["dim", "shard", "n"])

    made = (dealt.repartition("shard").sortWithinPartitions("shard")
            .mapInArrow(lists, "dim int, shard string, n long"))
    return folder, staged(made, "list-shards")


class Lists:
    """Mapped lists of one shard, and the search in them."""

    def __init__(self, uri: str, n: int, dim: int):
        read = {x: map_file(f"{uri}.{x}") for x in ("rows", "vals", "vecs", "ids")} if dim else {
            "rows": b"", "vals": b"", "vecs": b"", "ids": map_file(f"{uri}.ids")}
        self.n = n
        self.rows = np.frombuffer(read["rows"], "<i4").reshape(dim, n)
        self.vals = np.frombuffer(read["vals"], "<f8").reshape(dim, n)
        self.vecs = np.frombuffer(read["vecs"], "<f8").reshape(n, dim)
        ids = np.frombuffer(read["ids"], "<i8")
        self.offs, self.ids = ids[:n + 1], ids[n + 1:]
        self.widest = float(max(-self.vals[:, 0].min(), self.vals[:, -1].max())) if dim else 0.0

    def _read(self, up: np.ndarray, down: np.ndarray, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and values that come a-th to b-th from the heads of the lists ``up`` (greatest first) and ``down``."""
        z = self.n
        return (np.concatenate((self.rows[up, z - b:z - a][:, ::-1], self.rows[down, a:b])),
                np.concatenate((self.vals[up, z - b:z - a][:, ::-1], self.vals[down, a:b])))

    def candidates(self, q: np.ndarray, floor: float, top: int) -> np.ndarray:
        """Rows that may be among the ``top`` of a query whose ``top``-th score so far is ``floor``; no other row can."""
        up, down = np.flatnonzero(q > 0), np.flatnonzero(q < 0)
        w = q[np.concatenate((up, down))]
        most = np.concatenate((self.vals[up, -1], self.vals[down, 0])) * w  # what the lists' heads add, and their ends
        least = np.concatenate((self.vals[up, 0], self.vals[down, -1])) * w
        if most.sum() < floor:
            return np.zeros(0, np.int64)
        alive, at, seen, low = np.arange(self.n), 0, np.zeros(self.n), np.full(self.n, least.sum())
        step = max(1, self.n // FIRST)
        while len(alive) > RESOLVE * step and at < self.n and len(w):
            to = min(self.n, at + step)
            rows, vals = self._read(up, down, at, to)
            flat = rows.ravel()
            got = vals * w[:, None]
            seen += np.bincount(flat, got.ravel(), self.n)
            low += np.bincount(flat, (got - least[:, None]).ravel(), self.n)
            front = got[:, -1]
            every = self._read(up, down, 0, to)[0].ravel() if at else flat
            high = seen + front.sum() - np.bincount(every, np.repeat(front, to), self.n)
            # One place more: the query's own row may be among them.
            if self.n > top:
                floor = max(floor, float(np.partition(low, self.n - top - 1)[self.n - top - 1]))
            alive, at = np.flatnonzero(high >= floor), to
            step = to
        return alive

    def beyond(self, q: np.ndarray) -> bool:
        """Whether sums may pass what double precision holds exactly."""
        return len(q) > 0 and 4 * len(q) * self.widest * float(np.abs(q).max()) >= EXACT

    def scores(self, q: np.ndarray, rows: np.ndarray) -> list[int]:
        """Final scores of some rows."""
        if not len(q):
            return [0] * len(rows)
        if not self.beyond(q):
            return ((self.vecs if len(rows) == self.n else self.vecs[rows]) @ q).astype(np.int64).tolist()
        own = [int(x) for x in q.tolist()]
        return [min(LONG, max(-LONG - 1, sum(a * int(b) for a, b in zip(own, v)))) for v in self.vecs[rows].tolist()]

    def best(self, own: int, q: np.ndarray, found: list[tuple[int, int]], top: int) -> list[tuple[int, int]]:
        """``found`` (-score, vec_id) with this shard's rows merged in."""
        floor = -found[-1][0] if len(found) == top else -np.inf
        if self.beyond(q):
            rows = np.arange(self.n)  # bounds in double precision wouldn't be bounds
        else:
            rows = self.candidates(q, floor, top)
        more = []
        scores = self.scores(q, rows)
        if len(rows) > 4 * top:  # ids are looked up for those that can stay
            least = heapq.nlargest(top + 1, scores)[-1]
            keep = [k for k, s in enumerate(scores) if s >= least]
            rows, scores = rows[keep], [scores[k] for k in keep]
        for k, s in zip(rows.tolist(), scores):
            if s >= floor:
                more += [(-s, i) for i in self.ids[self.offs[k]:self.offs[k + 1]].tolist() if i != own]
        return heapq.nsmallest(top, found + more)


def in_order(lists: list[Lists], items: list[tuple[int, np.ndarray]], top: int) -> list[list[tuple[int, int]]]:
    """The best (-score, vec_id) of each query (vec_id, vector) in some shards: the most promising shard first, then a
    shard at a time for all queries."""
    q = np.array([x for _, x in items])
    with np.errstate(all="ignore"):  # only an order: the search itself minds what is beyond double precision
        heads = [np.maximum(q, 0) @ x.vals[:, -1] + np.minimum(q, 0) @ x.vals[:, 0] for x in lists]
    first = np.argmax(np.nan_to_num(heads), axis=0)
    found = [[] for _ in items]
    for begins in (True, False):
        for s, x in enumerate(lists):
            for k in np.flatnonzero((first == s) == begins).tolist():
                found[k] = x.best(*items[k], found[k], top)
    return found


def search(index: tuple[str, DataFrame], queries: DataFrame, top: int = TOP) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` of each row of ``queries`` (vec_id, embedding) among all others."""
    folder, shards = index
    spark = queries.sparkSession
    q = whole(queries).withColumn("dim", F.size("vec"))
    blocks = max(1, -(-q.count() // QUERIES))
    packed = (q.withColumn("block", F.pmod(F.xxhash64("vec_id", "vec"), F.lit(blocks)))
              .groupBy("dim", "block").agg(F.collect_list(F.struct("vec_id", F.xxhash64("vec").alias("copy"), "vec")).alias("queries")))
    w = Window.partitionBy("dim").orderBy("shard")
    groups = (shards.withColumn("group", F.floor((F.row_number().over(w) - 1) / SHARDS))  # a row per shard
              .groupBy("dim", "group").agg(F.sort_array(F.collect_list(F.struct("shard", "n"))).alias("shards")))
    work = packed.join(groups, "dim").repartition(  # few bytes, much work: not coalesced
        int(spark.conf.get("spark.sql.shuffle.partitions")), "dim", "block", "group")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, queries, shards in zip(*(batch.column(c) for c in range(3))):
                own = queries.as_py()
                lists = [Lists(f"{folder}/{x['shard']}", x["n"], dim.as_py()) for x in shards.as_py()]
                found = in_order(lists, [(x["vec_id"], np.array(x["vec"], float)) for x in own], top)
                rows = [(x["vec_id"], x["copy"], i, -s) for x, best in zip(own, found) for s, i in best]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                                     ["query_id", "copy", "vec_id", "score"])

    # ``copy`` tells apart queries of one id, which have different vectors.
    found = work.select("dim", "queries", "shards").mapInArrow(run, "query_id long, copy long, vec_id long, score long")
    w = Window.partitionBy("query_id", "copy").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)
            .select("query_id", "rank", "vec_id", "score"))


def op11_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 greatest integer inner products of every row whose vec_id is divisible by 100 with all other rows."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return search(build(vectors), vectors.filter("vec_id % 100 = 0"))


#: DuckDB: every pair's inner product, ranked.
ORACLE = """
WITH whole AS (
    SELECT DISTINCT vec_id::BIGINT AS vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS vec
    FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, q.vec AS copy, v.vec_id, list_inner_product(q.vec, v.vec)::BIGINT AS score
    FROM whole q JOIN whole v ON v.vec_id <> q.vec_id AND len(v.vec) = len(q.vec) WHERE q.vec_id % 100 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id, copy ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 10
"""
