"""Prefix trie of conversations, measured by the Euler-tour technique.

1. *Turns.*  Rows are sorted over ranges of (conversation, turn, role, text);
   a task numbers its rows and sums a hash of each turn along its
   conversations, and what a range continues from the one before is added
   afterwards from one row per range.  So a conversation that holds a third
   of all rows is spread like any other.  A prefix is named by its length and
   128 bits of hash: the sum of ``v_j * r^j`` over its turns, ``v_j`` being
   the SHA-256 of role and text, in two lanes of 64 bits.
2. *Nodes.*  Rows of equal prefix are one node (a grouped aggregate, partial
   before the shuffle).  A node is then named by its smallest member ``m``
   and its depth: the nodes of one ``m`` are a path of the trie.
3. *Tour.*  Only a path's first node has to look for its parent: these heads
   and the nodes are sorted over ranges of the prefix's name, so that a
   parent stands before its heads and siblings beside each other.  Each node
   has an enter and an exit arc, each with its successor.
4. The tour is ranked and summed in ``euler_tour``; a node's subtree holds
   what is summed between its two arcs.

Order and defined cases: turns come in the order of (turn, null first; role;
text), compared as bytes; null role or text is empty; repeated rows are turns
each; rows without ``conv_id`` take no part; an empty table has no nodes, not
even a root; a conversation whose turns all fall away ends at the root.
Other columns are not read.  ``conv_id - conv_id % 20`` takes the sign of
``%`` from SQL.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivalry.llm import euler_tour
from rivalry.llm.store import staged

#: Conversations that share a base, and the number of opening turns taken from it (the hash modulo this; at most one less).
BASE, SHARED = 20, 4
#: Turns of one conversation that are one group in a join, and nodes of one path that the first contraction keeps together.
PIECE = 4096
#: Ids that one row of an end list holds.
IDS = 1 << 15
WORD = r"[^\x20\x09-\x0D]+"
_R = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
_R_INV = tuple(np.uint64(pow(int(r), -1, 1 << 64)) for r in _R)
_MASK = (1 << 64) - 1
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _powers(first: int, n: int, lane: int) -> np.ndarray:
    """r^first .. r^(first+n-1)."""
    p = np.full(n, _R[lane], np.uint64)
    p[:1] = np.uint64(pow(int(_R[lane]), first, 1 << 64))
    return np.multiply.accumulate(p)


def _signed(x: int) -> int:
    x &= _MASK
    return x - (1 << 64) if x >> 63 else x


def _column(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))

_TURNS = "part int, i long, conv_id long, pos long, c1 long, c2 long, t1 long, t2 long, words int, open boolean"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns (conv_id, digest, words) of a range with number ``pos`` and hash sums, both counted within the range;
    ``open`` marks the conversation that the range begins with."""
    part, rows, opened, conv, count, sums = TaskContext.get().partitionId(), 0, None, None, 0, [0, 0]
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        ids = batch.column(0).to_numpy()
        opened = ids[0] if opened is None else opened
        starts = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
        lens = np.diff(np.append(starts, n))
        goes_on = ids[0] == conv
        base = np.zeros(len(starts), np.int64)
        base[0] = count if goes_on else 0
        pos = np.arange(n) - np.repeat(starts - base, lens) + 1
        lanes = np.frombuffer(b"".join(x[:16] for x in batch.column(1).to_pylist()), "<u8").reshape(n, 2)
        totals, terms = [], []
        for lane in (0, 1):
            low = int(pos.min())
            t = lanes[:, lane] * _powers(low, int(pos.max()) - low + 1, lane)[pos - low]
            c = np.cumsum(t, dtype=np.uint64)
            off = c[starts] - t[starts]
            off[0] -= np.uint64(sums[lane] if goes_on else 0)
            totals.append(c - np.repeat(off, lens))
            terms.append(t)
        conv, count, sums = ids[-1], int(pos[-1]), [int(c[-1]) for c in totals]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(rows, rows + n)), batch.column(0), pa.array(pos),
             *map(_column, totals), *map(_column, terms), batch.column(2), pa.array(ids == opened)], _names(_TURNS))
        rows += n


def _carries(held: DataFrame) -> dict[int, tuple[int, int, int]]:
    """{range: (turns, sums)} of what each range's first conversation has before it; one row per range is collected."""
    ends = held.groupBy("part").agg(F.min_by("conv_id", "i").alias("first"),
                                    F.max_by(F.struct("conv_id", "pos", "c1", "c2", "open"), "i").alias("last"))
    out, before = {}, (None, 0, 0, 0)
    for r in sorted(ends.collect()):
        carry = before[1:] if r.first == before[0] else (0, 0, 0)
        if carry[0]:
            out[r.part] = carry
        n, sums = r.last.pos, (r.last.c1, r.last.c2)
        if r.last.open:
            sums = tuple((c + s * pow(int(x), carry[0], 1 << 64)) & _MASK for c, s, x in zip(carry[1:], sums, _R))
            n += carry[0]
        before = (r.last.conv_id, n, *(s & _MASK for s in sums))
    return out


def numbered(conversations: DataFrame, parts: int | None = None) -> DataFrame:
    """(conv_id, pos, c1, c2, t1, t2, words): each turn's number, hash sums to it, and its own terms of them."""
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "role"))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("copy", F.monotonically_increasing_id())  # spreads equal rows, which may stand in any order
    by = ["conv_id", "turn", "role", "text", "copy"]
    named = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    ordered = rows.repartitionByRange(parts, *by).sortWithinPartitions(*by).select(
        "conv_id", F.unhex(F.sha2(named, 256)).alias("digest"), F.regexp_count("text", F.lit(WORD)).alias("words"))
    held = staged(ordered.mapInArrow(_numbered, _TURNS), "turns")
    carries = _carries(held)

    def carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part, pos, opened = (b.column(c).to_numpy(zero_copy_only=False) for c in (0, 3, 9))
            lanes = [b.column(c).to_numpy().view(np.uint64).copy() for c in (4, 5, 6, 7)]
            pos = pos.copy()
            for k in np.unique(part[opened]).tolist():
                if k in carries:
                    at, (n, *sums) = opened & (part == k), carries[k]
                    pos[at] += n
                    for lane in (0, 1):
                        power = _powers(n, 1, lane)[0]
                        lanes[lane][at] = lanes[lane][at] * power + np.uint64(sums[lane])
                        lanes[2 + lane][at] *= power
            yield pa.RecordBatch.from_arrays([b.column(2), pa.array(pos), *map(_column, lanes), b.column(8)],
                                             ["conv_id", "pos", "c1", "c2", "t1", "t2", "words"])

    return held.mapInArrow(carried, "conv_id long, pos long, c1 long, c2 long, t1 long, t2 long, words int")


def plans(own: DataFrame) -> DataFrame:
    """How each conversation is rebuilt: (conv_id, n own turns, h left out, p taken from the base, ch = own sums at h,
    base = sums and words of the base's opening turns, dmax = its length)."""
    opening = [F.max(F.when(F.col("pos") == j, F.struct("c1", "c2", "words"))).alias(f"o{j}") for j in range(1, SHARED)]
    per = own.groupBy("conv_id").agg(F.max("pos").alias("n"), *opening).select(
        "conv_id", "n", F.array(*(f"o{j}" for j in range(1, SHARED))).alias("own"),
        F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(SHARED)).cast("int").alias("h"))
    per = staged(per, "conversations")
    bases = per.select(F.col("conv_id").alias("base_id"), F.least("n", F.lit(SHARED - 1)).alias("base_n"),
                       F.col("own").alias("base"))
    joined = per.withColumn("base_id", F.expr(f"conv_id - conv_id % {BASE}")).join(bases, "base_id", "left")
    p = F.least("h", F.coalesce("base_n", F.lit(0))).cast("int")
    at = F.least("h", "n").cast("int")
    return joined.select("conv_id", "n", "h", p.alias("p"), F.when(at > 0, F.get("own", at - 1)).alias("ch"), "base",
                         (p + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("dmax"))


_STEPS = "conv_id long, dmax long, depth long, l1 long, l2 long, q1 long, q2 long, words int"


def _rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Own turns after the h-th as steps of the rebuilt conversation: prefix hashes moved to their new places."""
    for b in batches:
        col = {name: b.column(name).to_numpy() for name in b.schema.names}
        shift = col["p"].astype(np.int64) - col["h"]
        out = []
        for lane in (0, 1):
            total, term, left, base = (col[f"{x}{lane + 1}"].view(np.uint64) for x in ("c", "t", "ch", "cb"))
            back = np.array([1] + [pow(int(_R_INV[lane]), k, 1 << 64) for k in range(1, SHARED)], np.uint64)[-shift]
            now = (total - left) * back + base
            out.append((now, now - term * back))
        (l1, q1), (l2, q2) = out
        yield pa.RecordBatch.from_arrays(
            [b.column("conv_id"), b.column("dmax"), pa.array(col["pos"] + shift), *map(_column, (l1, l2, q1, q2)),
             b.column("words")], _names(_STEPS))


def steps(own: DataFrame, plan: DataFrame) -> DataFrame:
    """(conv_id, dmax, depth, l1, l2, q1, q2, words): every prefix of every rebuilt conversation, its name and its parent's."""
    h = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(SHARED))
    sums = {f"c{x}{lane}": F.coalesce(c[f"c{lane}"], F.lit(0).cast("long")) for lane in (1, 2) for x, c in (
        ("h", F.col("ch")), ("b", F.when(F.col("p") > 0, F.get("base", F.col("p") - 1))))}
    pieces = plan.filter("n > h").select(
        "conv_id", "h", "p", "dmax", *(c.alias(name) for name, c in sums.items()),
        F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"n div {PIECE}"))).alias("piece"))
    rest = (own.filter(F.col("pos") > h).withColumn("piece", F.expr(f"pos div {PIECE}"))
            .join(pieces, ["conv_id", "piece"]).drop("piece").mapInArrow(_rebuilt, _STEPS))
    zero = F.lit(0).cast("long")
    j = F.posexplode(F.slice("base", F.lit(1), F.col("p"))).alias("j", "turn")
    opening = plan.filter("p > 0").select("conv_id", "dmax", "base", j).select(
        "conv_id", "dmax", (F.col("j") + 1).cast("long").alias("depth"), F.col("turn.c1").alias("l1"), F.col("turn.c2").alias("l2"),
        *(F.when(F.col("j") > 0, F.get("base", F.col("j") - 1)[c]).otherwise(zero).alias(q) for c, q in (("c1", "q1"), ("c2", "q2"))),
        F.col("turn.words").alias("words"))
    root = plan.select("conv_id", "dmax", *(zero.alias(c) for c in ("depth", "l1", "l2", "q1", "q2")),
                       F.lit(0).alias("words"))
    return rest.unionByName(opening).unionByName(root)


KEY = ["depth", "l1", "l2"]


def end_digests(ends: DataFrame, parts: int | None = None) -> DataFrame:
    """(depth, l1, l2, ends_sha256): digest of the sorted ids of the conversations that end at each node.

    Ids are sorted over ranges and packed, so a node at which very many end has few rows when they meet; their text is
    hashed as it streams by.
    """
    parts = parts or int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [b.column(c).to_numpy() for c in range(4)]
            edge = np.any([c[1:] != c[:-1] for c in cols[:3]], axis=0)
            cuts = np.flatnonzero(np.concatenate(([True], edge, [True])))
            cuts = np.unique(np.concatenate([np.arange(a, z, IDS) for a, z in zip(cuts, cuts[1:])] + [cuts]).astype(int))
            ids = list(map(str, cols[3].tolist()))
            texts = [",".join(ids[a:z]) for a, z in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(c[cuts[:-1]]) for c in cols] + [pa.array(texts)],
                                             [*KEY, "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, h = None, None
        for b in batches:
            done = []
            for *own, ids in zip(*(b.column(c).to_pylist() for c in (0, 1, 2, 4))):
                if own == key:
                    h.update(b"," + ids.encode())
                    continue
                if key:
                    done.append((*key, h.hexdigest()))
                key, h = own, hashlib.sha256(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], [*KEY, "ends_sha256"])
        if key:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*key, h.hexdigest())], [*KEY, "ends_sha256"])

    by = [*KEY, "conv_id"]
    lists = (ends.select(*by).repartitionByRange(parts, *by).sortWithinPartitions(*by)
             .mapInArrow(packed, "depth long, l1 long, l2 long, first long, ids string"))
    return (lists.repartition(parts, *KEY).sortWithinPartitions(*KEY, "first")
            .mapInArrow(hashed, "depth long, l1 long, l2 long, ends_sha256 string"))


_FAMILY = "part int, i long, depth long, l1 long, l2 long, head boolean, m long, pm long, nm long"


def _families(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parents and heads (depth, l1, l2, head, m) of a range with ``pm``, the last parent's m, and ``nm``, the next head's m."""
    part, rows, parent, held = TaskContext.get().partitionId(), 0, None, None

    def joined(b: pa.RecordBatch, after: pa.RecordBatch | None) -> pa.RecordBatch:
        nonlocal rows, parent
        n = b.num_rows
        both = b if after is None else pa.concat_batches([b, after.slice(0, 1)])
        *key, head, m = (both.column(c).to_numpy(zero_copy_only=False) for c in range(5))
        follows = np.zeros(n, bool)
        follows[:len(m) - 1] = (np.all([c[1:] == c[:-1] for c in key], axis=0) & head[1:])
        nm = np.zeros(n, np.int64)
        nm[:len(m) - 1] = m[1:]
        at = np.maximum.accumulate(np.where(head[:n], -1, np.arange(n)))
        pm = np.where(at >= 0, m[np.maximum(at, 0)], 0 if parent is None else parent)
        unknown = (at < 0) & (parent is None)
        parent = None if unknown[-1] else int(pm[-1])
        out = pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(rows, rows + n)), *b.columns,
             pa.array(pm, mask=unknown), pa.array(nm, mask=~follows)], _names(_FAMILY))
        rows += n
        return out

    for b in batches:
        if b.num_rows:
            if held is not None:
                yield joined(held, b)
            held = b
    if held is not None:
        yield joined(held, None)


def families(nodes: DataFrame, parts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Heads (m, depth, pm, s = next sibling head's m) and first heads (m, depth, f) of the nodes that have heads.

    A path's first node is its head; it stands below a node of another path.
    """
    spark = nodes.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    heads = nodes.groupBy("m").agg(F.min("depth").alias("depth"), F.min_by(F.struct("q1", "q2"), "depth").alias("q"))
    rows = nodes.select(*KEY, F.lit(False).alias("head"), "m").unionByName(heads.filter("depth > 0").select(
        (F.col("depth") - 1).alias("depth"), F.col("q.q1").alias("l1"), F.col("q.q2").alias("l2"), F.lit(True).alias("head"), "m"))
    by = [*KEY, "head", "m"]
    held = staged(rows.repartitionByRange(parts, *by).sortWithinPartitions(*by).mapInArrow(_families, _FAMILY), "families")
    key = [F.col(c) for c in KEY]
    ends = held.groupBy("part").agg(F.min_by(F.struct(*key, "head", "m"), "i").alias("first"), F.max("i").alias("i"),
                                    F.max_by(F.struct(*key, "pm"), "i").alias("last")).orderBy("part").collect()
    borders, parent = [], None
    for r, after in zip(ends, [*ends[1:], None]):  # one row per range
        goes_on = after is not None and after.first.head and tuple(after.first)[:3] == tuple(r.last)[:3]
        borders.append((r.part, r.i, parent, after.first.m if goes_on else None))
        parent = parent if r.last.pm is None else r.last.pm
    fix = spark.createDataFrame(borders, "part int, end long, carried long, after long")
    whole = held.join(F.broadcast(fix), "part").select(
        "depth", "head", "m", F.coalesce("pm", "carried").alias("pm"),
        F.coalesce("nm", F.when(F.col("i") == F.col("end"), F.col("after"))).alias("nm"))
    return (whole.filter("head").select("m", (F.col("depth") + 1).alias("depth"), "pm", F.col("nm").alias("s")),
            whole.filter("NOT head AND nm IS NOT NULL").select("m", "depth", F.col("nm").alias("f")))


def linked(nodes: DataFrame, parts: int | None = None) -> DataFrame:
    """(m, depth, dmax, pm, s, f, fp): each node with its parent's m if it is a head, its next sibling head, its first
    head, and its parent's first head if it isn't a head."""
    heads, firsts = families(nodes, parts)
    cols = ("dmax", "pm", "s", "f", "fp")
    told = [nodes.select("m", "depth", "dmax"), heads, firsts,
            firsts.select("m", (F.col("depth") + 1).alias("depth"), F.col("f").alias("fp"))]
    rows = [t.select("m", "depth", *(F.col(c) if c in t.columns else F.lit(None).cast("long").alias(c) for c in cols))
            for t in told]
    every = rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])
    return every.groupBy("m", "depth").agg(*(F.max(c).alias(c) for c in cols)).filter("dmax IS NOT NULL")


def arcs(links: DataFrame) -> DataFrame:
    """(m, x, nm, nx): the enter (x = 2 depth) and exit (x = 2 depth + 1) arc of each node and the arc after it."""
    return links.selectExpr("""inline(array(
        struct(m, 2 * depth AS x,
               CASE WHEN depth < dmax THEN m WHEN f IS NOT NULL THEN f ELSE m END AS nm,
               CASE WHEN depth < dmax OR f IS NOT NULL THEN 2 * depth + 2 ELSE 2 * depth + 1 END AS nx),
        struct(m, 2 * depth + 1 AS x,
               CASE WHEN depth = 0 THEN NULL WHEN pm IS NULL THEN coalesce(fp, m) ELSE coalesce(s, pm) END AS nm,
               CASE WHEN depth = 0 THEN NULL WHEN coalesce(s, if(pm IS NULL, fp, NULL)) IS NOT NULL THEN 2 * depth
                    ELSE 2 * depth - 1 END AS nx)))""")


def trie(conversations: DataFrame, parts: int | None = None, task_arcs: int | None = None) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    own = numbered(conversations, parts)
    plan = staged(plans(own), "plans")
    walked = staged(steps(own, plan), "steps")
    sized = walked.groupBy(*KEY).agg(
        F.min(F.struct("conv_id", "dmax")).alias("least"), F.count(F.lit(1)).alias("n_convs"),
        F.max("words").alias("words"), F.max("q1").alias("q1"), F.max("q2").alias("q2"))
    ends = end_digests(walked.filter("depth = dmax"), parts)
    nodes = staged(sized.join(ends, KEY, "left").select(
        *KEY, F.col("least.conv_id").alias("m"), F.col("least.dmax").alias("dmax"), "n_convs", "words", "q1", "q2",
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256")), "nodes")
    links = staged(linked(nodes, parts), "links")
    ranked = euler_tour.ranks(arcs(links), F.struct("m", F.expr(f"x div {2 * PIECE}")), task_arcs)
    leaf = (F.col("depth") == F.col("dmax")) & F.col("f").isNull()
    gains = links.withColumn("leaf", leaf).join(nodes.select("m", "depth", "n_convs", "words"), ["m", "depth"]).select(
        "m", (2 * F.col("depth")).alias("x"), F.col("leaf").cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    weighed = ranked.join(gains, ["m", "x"], "left").fillna(0, ["leaves", "saved"])
    sums = euler_tour.sums_before(weighed, ["leaves", "saved"]).groupBy("m", F.expr("x div 2").alias("depth")).agg(
        *(F.sum(F.when(F.col("x") % 2 == 1, F.col(c)).otherwise(-F.col(c))).alias(c) for c in ("leaves", "saved")))
    parent = F.when(F.col("depth") > 0, F.coalesce("pm", "m"))
    children = (links.filter("depth > 0").groupBy(parent.alias("m"), (F.col("depth") - 1).alias("depth"))
                .agg(F.count(F.lit(1)).alias("n_children")))
    at = ["m", "depth"]
    return (nodes.select(*at, "n_convs", "ends_sha256").join(links.select(*at, parent.alias("parent_conv_id")), at)
            .join(sums, at).join(children, at, "left")
            .select(F.col("m").alias("conv_id"), "depth", "parent_conv_id", "n_convs",
                    F.coalesce("n_children", F.lit(0)).alias("n_children"), F.col("leaves").alias("n_leaves"),
                    F.col("saved").alias("saved_tokens"), "ends_sha256"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt ``conversations``."""
    return trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


#: DuckDB: prefixes as lists, every node's subtree through the paths of its nodes' smallest members.
ORACLE = """
WITH RECURSIVE turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
    SELECT conv_id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''),
               lambda c: ascii(c)::BIGINT)), lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
               lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 4 AS h
    FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
    SELECT i.conv_id, 0 AS part, t.pos, t.role, t.text FROM ids i JOIN turns t ON t.conv_id = i.conv_id - i.conv_id % 20
    WHERE t.pos <= i.h
    UNION ALL
    SELECT i.conv_id, 1, t.pos, t.role, t.text FROM ids i JOIN turns t USING (conv_id) WHERE t.pos > i.h
), walked AS (
    SELECT conv_id, row_number() OVER w AS depth, text, list({'r': role, 't': text}) OVER w AS path
    FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), steps AS (
    SELECT conv_id, depth, sha256(path::VARCHAR) AS key, text FROM walked
    UNION ALL SELECT conv_id, 0, 'root', '' FROM ids
), lengths AS (SELECT conv_id, max(depth) AS dmax FROM steps GROUP BY conv_id
), nodes AS (
    SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(text) AS text,
           coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = dmax), '') AS ends
    FROM steps JOIN lengths USING (conv_id) GROUP BY key, depth
), placed AS (
    SELECT n.*, p.conv_id AS parent_conv_id, p.key AS parent_key
    FROM nodes n LEFT JOIN (steps s JOIN nodes p ON p.key = s.key AND p.depth = s.depth)
         ON s.conv_id = n.conv_id AND s.depth = n.depth - 1
), family AS (SELECT parent_key AS key, count(*) AS n_children FROM placed WHERE parent_key IS NOT NULL GROUP BY 1
), weighed AS (
    SELECT p.*, coalesce(n_children, 0) AS n_children,
           (n_convs - 1) * len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS saved
    FROM placed p LEFT JOIN family USING (key)
), subtrees AS (
    SELECT s.key, sum((w.n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum(w.saved)::BIGINT AS saved_tokens
    FROM weighed w JOIN steps s ON s.conv_id = w.conv_id AND s.depth <= w.depth GROUP BY s.key
)
SELECT w.conv_id::BIGINT AS conv_id, depth::BIGINT AS depth, parent_conv_id::BIGINT AS parent_conv_id,
       n_convs::BIGINT AS n_convs, n_children::BIGINT AS n_children, n_leaves, saved_tokens, sha256(ends) AS ends_sha256
FROM weighed w JOIN subtrees USING (key)
"""
