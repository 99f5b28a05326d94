"""Similarity join on n-gram sets by signature trees.

Documents link if the Jaccard similarity of their sets of ``k``-word shingles
reaches ``num / den``.  Documents with equal sets form a *class*; only classes
are compared.

1. ``classes`` gives each row its class and the size of its set.
2. ``shared`` finds, per class, the shingles that another class holds too: a
   shingle's classes meet in one record range, where equal (shingle, class)
   pairs are one.  A class whose shared shingles are fewer than
   ceil(num * size / den) can link with nothing and goes.  Shingles of a
   large part of all rows (``OFTEN``) don't meet anywhere: they are known to
   be shared and count as the commonest of all.
3. ``blocks`` connects classes that share one of their rarest shingles: of two
   that link, one of the first (shared - needed + 1) by rarity is common, so
   linked classes are in one block.
4. Within a block, units of at most ``UNIT`` classes on average become
   *signature trees*: a node holds the OR of its members' shingle bitmaps,
   the AND too, and their range of sizes.  A dual traversal drops node pairs
   whose greatest possible overlap can't reach the threshold, and those whose
   members are all connected already; leaves count exact overlaps.
5. Blocks of several units link in three rounds: within units; the components'
   representatives among each other; and every class outside its block's
   largest component with all units.  Two classes that are still apart have
   one of them outside, so no link between components is lost, while a group
   of very many near copies, which the first rounds connect, costs no more
   pairs.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; with fewer than ``k``
words the whole sequence is one shingle; null and empty texts have an empty
set and link with nothing.  Shingles and classes are 64-bit hashes.  Rows that
repeat have the class of their text; null ids are no one's smallest id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivalry.functions.joins import checked_broadcast
from rivalry.llm import memory, packed
from rivalry.llm import textarrays as ta
from rivalry.llm.components import components
from rivalry.llm.store import fresh, staged

K, NUM, DEN = 4, 85, 100
#: Shingles that a task gathers before it sends, and that a receiving task holds on average.
GATHER, RANGE = 2_000_000, 3_000_000
#: Classes of a unit on average, members of a leaf, children of a node, and bits of a bitmap.
UNIT, LEAF, CHILDREN, BITS = 1024, 16, 4, 4096
#: Part of the rows in which a shingle counts as one of the commonest; such shingles are at most 2 / OFTEN times the
#: shingles of an average row.
OFTEN = 0.02
_SET = np.uint64(0x8EBC6AF09C88C6E3)


def shingles(texts: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per slice of rows: first row, row after the last, distinct shingle hashes by row, and their row offsets."""
    for lo, hi, cps, offs in ta.slices(texts):
        cps = np.where((cps >= 0x41) & (cps <= 0x5A), cps + 0x20, cps).astype(np.uint32)
        starts, ends, bounds = ta.words(cps, offs)
        wh, n = ta.segment_hashes(cps, starts, ends), np.diff(bounds)
        at = np.flatnonzero(ta.within(k, bounds))
        h, row = [ta.window_hashes(wh, k)[at]], [np.searchsorted(bounds, at, "right") - 1]
        for few in range(1, k):
            own = np.flatnonzero(n == few)
            if len(own):
                h.append(ta.window_hashes(wh, few)[bounds[own]] ^ np.uint64(few))
                row.append(own)
        h, row = np.concatenate(h), np.concatenate(row)
        order = np.lexsort((h, row))
        h, row = h[order], row[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
        h, row = h[new], row[new]
        yield lo, hi, h, np.searchsorted(row, np.arange(hi - lo + 1))


def set_keys(h: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Class of each row: a hash of its set, whatever the order; 0 for the empty set."""
    out = np.zeros(len(offs) - 1, np.uint64)
    full = np.flatnonzero(np.diff(offs))
    if len(full):
        at = offs[full]
        out[full] = ta.mix(np.add.reduceat(ta.mix(h ^ _SET), at) ^ ta.mix(np.bitwise_xor.reduceat(ta.mix(h), at))
                           + np.diff(offs)[full].astype(np.uint64))
        out[full] += out[full] == 0
    return out.view(np.int64)


def classes(docs: DataFrame, k: int = K) -> DataFrame:
    """(doc_id, key, cls, n) of every row of ``docs``; n is the size of its set, 0 for an empty one.

    ``key`` is a hash of the row's id and text: rows that share it are alike.
    Rows with n = -1 are counts: ``key`` rows of a slice hold the shingle ``cls``.
    """

    @memory.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory.begin()
        for batch in batches:
            for lo, hi, h, offs in shingles(batch.column(1), k):
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns[:1], batch.column(2).slice(lo, hi - lo),
                                                  pa.array(set_keys(h, offs)), pa.array(np.diff(offs))],
                                                 ["doc_id", "key", "cls", "n"])
                h, count = np.unique(h, return_counts=True)
                many = count >= max(4, OFTEN / 2 * (hi - lo))
                if many.any():
                    h, count = h[many].view(np.int64), count[many]
                    yield pa.RecordBatch.from_arrays([pa.nulls(len(h), pa.int64()), pa.array(count), pa.array(h),
                                                      pa.array(np.full(len(h), -1))], ["doc_id", "key", "cls", "n"])

    return (docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))
            .mapInArrow(run, "doc_id long, key long, cls long, n long"))


def commonest(own: DataFrame) -> np.ndarray:
    """Shingles that the slices of ``classes`` count in at least half of ``OFTEN`` of all rows (bounded, see there)."""
    rows = own.filter("n >= 0").count()
    found = (own.filter("n = -1").groupBy("cls").agg(F.sum("key").alias("rows"))
             .filter(F.col("rows") >= max(4, OFTEN / 2 * rows)).select("cls").collect())
    return np.sort(np.array([r.cls for r in found], np.int64).view(np.uint64))


def shared(docs: DataFrame, total: int, common: np.ndarray, k: int, num: int, den: int) -> DataFrame:
    """(cls, n, route, toks): classes that can link, their shared shingles by rarity, and how many of them route.

    ``total`` is about the number of shingles of all classes; ``common`` are those that needn't meet.
    """
    often = docs.sparkSession.sparkContext.broadcast(common)
    ranges = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // RANGE)

    @memory.tidy
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = often.value

        def sent(h, cls) -> Iterator[pa.RecordBatch]:
            to = packed.receivers(h, ranges)
            own, n = np.unique(cls, return_counts=True)  # whole sets: their sizes go straight to the classes
            yield packed.pack(packed.receivers(ta.mix(own.view(np.uint64)), ranges) + 2 * ranges, [n.astype(np.uint64), own],
                              ["toks", "cls"])
            if len(common):
                at = np.minimum(np.searchsorted(common, h), len(common) - 1)
                here = common[at] == h
                full = (to[here].astype(np.uint64) << np.uint64(32)) | (h[here] & np.uint64(0xFFFFFFFF))
                yield packed.pack(packed.receivers(ta.mix(cls[here].view(np.uint64)), ranges) + ranges, [full, cls[here]],
                                  ["toks", "cls"])
                to, h, cls = to[~here], h[~here], cls[~here]
            yield packed.pack(to, [h.astype(np.uint32), cls], ["toks", "cls"])

        gather, seen = packed.Collector(GATHER), np.zeros(0, np.int64)
        for batch in batches:
            for _, _, h, offs in shingles(batch.column(0), k):
                cls = set_keys(h, offs)
                _, first = np.unique(cls, return_index=True)  # equal sets are sent once
                first = first[(cls[first] != 0) & ~np.isin(cls[first], seen)]
                n = np.diff(offs)[first]
                seen = np.union1d(seen, cls[first])
                if gather.add(h[ta.flat_ranges(offs[first], n)], np.repeat(cls[first], n)):
                    yield from sent(*gather.take())
                    seen = np.zeros(0, np.int64)
        if gather.size:
            yield from sent(*gather.take())

    @memory.tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for to, own in packed.by_key(batches):
            if to >= ranges:  # on their way to their classes
                tok, cls = packed.unpack(own, {1: np.uint64, 2: np.int64})
                kind = 0xFFFFFFFF if to < 2 * ranges else 0  # the commonest of all; a size
                yield packed.pack(np.full(len(cls), to % ranges), [cls, tok, np.full(len(cls), kind, np.uint32)],
                                  ["cls", "toks", "df"])
                continue
            tok, cls = packed.unpack(own, {1: np.uint32, 2: np.int64})
            order = np.lexsort((cls, tok))
            tok, cls = tok[order], cls[order]
            new = np.ones(len(tok), bool)
            new[1:] = (tok[1:] != tok[:-1]) | (cls[1:] != cls[:-1])
            tok, cls = tok[new], cls[new]
            head = np.ones(len(tok), bool)
            head[1:] = tok[1:] != tok[:-1]
            at = np.flatnonzero(head)
            often = np.diff(np.append(at, len(tok)))
            df = np.repeat(often, often)
            keep = df > 1
            tok, cls, df = tok[keep], cls[keep], df[keep]
            order = np.argsort(cls, kind="stable")
            full = (np.uint64(to) << np.uint64(32)) | tok[order].astype(np.uint64)
            cls = cls[order]
            yield packed.pack(packed.receivers(ta.mix(cls.view(np.uint64)), ranges), [
                cls, full, np.minimum(df[order], 0xFFFFFFFE).astype(np.uint32)], ["cls", "toks", "df"])

    @memory.tidy
    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, own in packed.by_key(batches):
            cls, tok, df = packed.unpack(own, {1: np.int64, 2: np.uint64, 3: np.uint32})
            order = np.lexsort((tok, df, cls))
            cls, tok, df = cls[order], tok[order].view(np.int64), df[order]
            new = np.ones(len(cls), bool)
            new[1:] = (cls[1:] != cls[:-1]) | (tok[1:] != tok[:-1]) | (df[1:] != df[:-1])
            cls, tok = cls[new], tok[new]
            head = np.ones(len(cls), bool)
            head[1:] = cls[1:] != cls[:-1]
            at = np.append(np.flatnonzero(head), len(cls))
            cls, n, size = cls[at[:-1]], tok[at[:-1]], np.diff(at) - 1  # a class's size comes first
            need = (num * n + den - 1) // den
            can = np.flatnonzero(size >= need)
            tok = tok[ta.flat_ranges(at[:-1][can] + 1, size[can])]
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(size[can]))).astype(np.int32)),
                                             pa.array(tok))
            yield pa.RecordBatch.from_arrays([pa.array(cls[can]), pa.array(n[can]),
                                              pa.array((size - need + 1)[can].astype(np.int32)), lists],
                                             ["cls", "n", "route", "toks"])

    sent = docs.select("text").mapInArrow(send, packed.schema("toks", "cls"))
    counted = (sent.repartition(ranges, "to").sortWithinPartitions("to")
               .mapInArrow(count, packed.schema("cls", "toks", "df")))
    return (counted.repartition(ranges, "to").sortWithinPartitions("to")
            .mapInArrow(gathered, "cls long, n long, route int, toks array<long>"))


def blocks(found: DataFrame) -> DataFrame:
    """(cls, block): classes with a common routing shingle, connected; a class without a partner is in no block."""
    routes = found.select("cls", F.explode(F.slice("toks", F.lit(1), F.col("route"))).alias("tok"))
    least = routes.groupBy("tok").agg(F.min("cls").alias("m"), F.count(F.lit(1)).alias("c")).filter("c > 1")
    links = routes.join(least.select("tok", "m"), "tok").filter("cls > m").selectExpr("cls AS a", "m AS b").distinct()
    return components(links).selectExpr("node AS cls", "root AS block")


class Tree:
    """Signature tree over members ordered by size: nodes by level, leaves first."""

    def __init__(self, bits: np.ndarray, n: np.ndarray, order: np.ndarray):
        self.order, self.levels = order, []
        some = every = bits[order]
        lo = hi = n[order]
        first = True
        while first or len(lo) > 1:
            step = LEAF if first else CHILDREN
            at = np.arange(0, len(lo), step)
            some, every = np.bitwise_or.reduceat(some, at, 0), np.bitwise_and.reduceat(every, at, 0)
            lo, hi = np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at)
            self.levels.append((some, every, lo, hi))
            first = False

    def members(self, level: int, node: int) -> np.ndarray:
        size = LEAF * CHILDREN ** level
        return self.order[node * size:(node + 1) * size]


class Unit:
    """Links among the members of a unit, by dual traversal; connected members aren't compared again."""

    def __init__(self, n: np.ndarray, toks: np.ndarray, offs: np.ndarray, labels: np.ndarray, num: int, den: int):
        self.n, self.offs, self.num, self.den = n, offs, num, den
        local, self.toks = np.unique(toks, return_inverse=True)
        self.mark = np.zeros(len(local), bool)
        self.labels = np.unique(labels, return_inverse=True)[1]
        self.bits = np.zeros((len(n), BITS // 64), np.uint64)
        cell = ta.mix(local.view(np.uint64)) & np.uint64(BITS - 1)
        cell = cell[self.toks]
        row = np.repeat(np.arange(len(n)), np.diff(offs))
        np.bitwise_or.at(self.bits, (row, (cell >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (cell & np.uint64(63)))
        self.links: list[tuple[int, int]] = []

    def _can(self, a: tuple, b: tuple) -> bool:
        """May members of two nodes (some, every, lo, hi) overlap enough?"""
        some_a, every_a, lo_a, hi_a = a
        some_b, every_b, lo_b, hi_b = b
        if self.den * min(hi_a, hi_b) < self.num * max(lo_a, lo_b):
            return False
        # What all of a hold and none of b does can't be common, and the other way round.
        over_a = hi_a - int(np.bitwise_count(every_a & ~some_b).sum())
        over_b = hi_b - int(np.bitwise_count(every_b & ~some_a).sum())
        return self.den * min(over_a, over_b) >= self.num * max(lo_a, lo_b)

    def _join(self, a: int, b: int) -> None:
        self.links.append((a, b))
        self.labels[self.labels == self.labels[b]] = self.labels[a]

    def traverse(self, left: Tree, right: Tree, same: bool) -> None:
        top = len(left.levels) - 1, len(right.levels) - 1
        stack = [(top[0], 0, top[1], 0)]
        while stack:
            la, a, lb, b = stack.pop()
            x, y = left.members(la, a), right.members(lb, b)
            own = self.labels[x]
            if (own == own[0]).all() and (self.labels[y] == own[0]).all():
                continue
            if not self._can([v[a] for v in left.levels[la]], [v[b] for v in right.levels[lb]]):
                continue
            if la == 0 and lb == 0:
                self._leaves(x, y, same and a == b)
            elif same and (la, a) == (lb, b):
                kids = self._children(left, la, a)
                stack += [(la - 1, i, la - 1, j) for i in kids for j in kids if i <= j]
            elif la >= lb:
                stack += [(la - 1, i, lb, b) for i in self._children(left, la, a)]
            else:
                stack += [(la, a, lb - 1, j) for j in self._children(right, lb, b)]

    @staticmethod
    def _children(tree: Tree, level: int, node: int) -> range:
        return range(node * CHILDREN, min((node + 1) * CHILDREN, len(tree.levels[level - 1][2])))

    def _leaves(self, x: np.ndarray, y: np.ndarray, same: bool) -> None:
        for k, a in enumerate(x.tolist()):
            c = y[k + 1:] if same else y
            c = c[self.labels[c] != self.labels[a]]
            if not len(c):
                continue
            small, large = np.minimum(self.n[c], self.n[a]), np.maximum(self.n[c], self.n[a])
            over = np.minimum(self.n[a] - np.bitwise_count(self.bits[a] & ~self.bits[c]).sum(1, dtype=np.int64),
                              self.n[c] - np.bitwise_count(self.bits[c] & ~self.bits[a]).sum(1, dtype=np.int64))
            c = c[(self.den * small >= self.num * large) & (self.den * over >= self.num * large)]
            if not len(c):
                continue
            own = self.toks[self.offs[a]:self.offs[a + 1]]
            self.mark[own] = True
            size = self.offs[c + 1] - self.offs[c]
            hit = self.mark[self.toks[ta.flat_ranges(self.offs[c], size)]]
            common = np.add.reduceat(hit.astype(np.int64), np.cumsum(size) - size)
            self.mark[own] = False
            union = self.n[a] + self.n[c] - common
            for b in c[self.den * common >= self.num * union].tolist():
                if self.labels[a] != self.labels[b]:
                    self._join(a, b)


def unit_links(n, toks, offs, labels, side, num: int, den: int) -> list[tuple[int, int]]:
    """Pairs of positions that connect a unit's members as their links do; ``side`` 0: among all, 1 and 2: between."""
    unit = Unit(n, toks, offs, labels, num, den)
    first = toks[offs[:-1]]

    def tree(own: np.ndarray) -> Tree:
        return Tree(unit.bits, n, own[np.lexsort((first[own], n[own]))])

    if (side == 0).all():
        own = tree(np.arange(len(n)))
        unit.traverse(own, own, True)
    elif (side == 1).any() and (side == 2).any():
        unit.traverse(tree(np.flatnonzero(side == 1)), tree(np.flatnonzero(side == 2)), False)
    return unit.links


def solve(members: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) within the units of ``members`` (unit long, cls, n, toks, label long, side int)."""

    @memory.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory.begin()
        for _, own in packed.by_key(batches):
            parts = list(own)
            cls, n, label, side = (np.concatenate([p.column(c).to_numpy() for p in parts]) for c in (1, 2, 4, 5))
            toks = np.concatenate([p.column(3).flatten().to_numpy() for p in parts])
            offs = np.concatenate(([0], np.cumsum(np.concatenate([np.diff(p.column(3).offsets.to_numpy()) for p in parts]))))
            pairs = unit_links(n, toks, offs, label, side, num, den)
            if pairs:
                at = np.array(pairs)
                yield pa.RecordBatch.from_arrays([pa.array(cls[at[:, 0]]), pa.array(cls[at[:, 1]])], ["a", "b"])

    return (members.select("unit", "cls", "n", "toks", "label", "side").repartition("unit").sortWithinPartitions("unit", "cls")
            .mapInArrow(run, "a long, b long"))


def class_links(found: DataFrame, num: int, den: int, unit: int = UNIT) -> DataFrame:
    """Links (a, b) that connect the classes of ``found`` as all links with the threshold would."""
    where = staged(blocks(found), "blocks")
    sizes = where.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / unit).cast("int").alias("units"))
    sizes = staged(sizes, "block-sizes")
    dealt = (found.join(where.join(sizes, "block"), "cls").withColumn("part", F.pmod(F.xxhash64("cls"), "units")))
    one = dealt.withColumn("unit", F.xxhash64("block", "part")).withColumn("label", F.col("cls")).withColumn("side", F.lit(0))
    links = staged(solve(one, num, den), "unit-links")
    if sizes.filter("units > 1").isEmpty():
        return links
    large = staged(dealt.filter("units > 1"), "large-blocks")

    def labelled(frame: DataFrame, so_far: DataFrame) -> DataFrame:
        root = components(so_far).selectExpr("node AS cls", "root")
        return frame.join(root, "cls", "left").withColumn("label", F.coalesce("root", "cls")).drop("root")

    # The components' representatives, one of each, among each other.
    heads = labelled(large, links).filter("label = cls")
    counts = heads.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / unit).cast("int").alias("of"))
    heads = heads.join(counts, "block").withColumn("unit", F.xxhash64("block", F.pmod(F.xxhash64("cls", F.lit(1)), "of"), F.lit(1)))
    links = staged(links.unionByName(solve(heads.withColumn("side", F.lit(0)), num, den)), "unit-links")
    # All that are outside their block's largest component, with every unit.
    apart = staged(labelled(large, links), "labels")
    largest = (apart.groupBy("block", "label").count().groupBy("block")
               .agg(F.max_by("label", F.struct("count", "label")).alias("main")))
    minor = apart.join(largest, "block").filter("label != main").drop("main")
    parts = minor.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / unit).cast("int").alias("of"))
    minor = minor.join(parts, "block").withColumn("piece", F.pmod(F.xxhash64("cls", F.lit(2)), "of"))
    left = minor.withColumn("part", F.explode(F.expr("sequence(0, units - 1)"))).withColumn("side", F.lit(1))
    right = apart.join(parts, "block").withColumn("piece", F.explode(F.expr("sequence(0, of - 1)"))).withColumn("side", F.lit(2))
    cols = ["block", "part", "piece", "cls", "n", "toks", "label", "side"]
    pairs = left.select(*cols).unionByName(right.select(*cols)).withColumn("unit", F.xxhash64("block", "part", "piece"))
    return links.unionByName(solve(pairs, num, den))


def similarity_join(docs: DataFrame, k: int = K, num: int = NUM, den: int = DEN, unit: int = UNIT) -> DataFrame:
    """(doc_id, key, cls, n, root): every row with its class and its component's least class; no root for an empty set."""
    own = staged(classes(docs, k), "classes")
    common, own = commonest(own), own.filter("n >= 0")
    total = own.groupBy("cls").agg(F.max("n").alias("n")).agg(F.sum("n")).first()[0] or 0
    found = staged(shared(docs, total, common, k, num, den), "shared")
    roots = staged(components(class_links(found, num, den, unit)), "roots")
    return (own.join(roots, F.col("cls") == F.col("node"), "left")
            .select("doc_id", "key", "cls", "n", F.when(F.col("n") > 0, F.coalesce("root", "cls")).alias("root")))


def one_of_each(docs: DataFrame, k: int = K, num: int = NUM, den: int = DEN) -> DataFrame:
    """Rows of ``docs`` without all but one of each component: the one of the smallest id stays (null ids last)."""
    rows = staged(similarity_join(docs, k, num, den).filter("root IS NOT NULL"), "near")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")
    first = rows.groupBy("root").agg(F.min(place).alias("first"))
    name, doc, key = fresh(docs, "_own", "_doc", "_key")
    gone = (rows.join(first, "root").filter(place != F.col("first"))
            .select(F.col("doc_id").alias(doc), F.col("key").alias(key)).distinct())
    twice = rows.groupBy("doc_id", "key").count().filter("count > 1").select(F.col("doc_id").alias(doc), F.col("key").alias(key))

    def on(frame: DataFrame, other: DataFrame, how: str) -> DataFrame:
        return frame.join(other, frame["doc_id"].eqNullSafe(other[doc]) & (frame[name] == other[key]), how)

    own = docs.withColumn(name, F.xxhash64("doc_id", "text"))
    kept = on(own, checked_broadcast(gone), "left_anti")
    if not twice.isEmpty():  # rows that repeat id and text
        again = checked_broadcast(twice)
        kept = on(kept, again, "left_anti").unionByName(on(kept, again, "left_semi").dropDuplicates(["doc_id", name]))
    return kept.drop(name)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of ``documents`` under 4-word shingle similarity of 0.85 or more."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = similarity_join(docs)
    least = rows.filter("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("first"))
    return rows.join(least, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("first", "doc_id").alias("component_id"))


#: All pairs that share a shingle, compared exactly; components by a recursive walk.
ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2),
             lambda i: array_to_string(w[i:i + 3], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g
      FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS seen FROM d UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.seen)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT node, min(seen) AS component_id FROM r GROUP BY node) c ON c.node = d.doc_id
"""
