import hashlib
import re
import zlib
from collections import defaultdict

import pytest

from rivalry.llm import conversation_trie as ct
from rivalry.llm import euler_tour

SCHEMA = "conv_id long, turn int, role string, text string"


def brute_force(rows):
    """Nodes of the trie by whole prefixes, as {(conv_id, depth): rest}."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    own = {c: [x[2:] for x in sorted(t)] for c, t in convs.items()}
    paths = {}
    for c in own:
        h, base = zlib.crc32(str(c).encode()) % 4, int(c - (abs(c) % 20) * (1 if c >= 0 else -1))
        paths[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, path in sorted(paths.items()):
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    out, children = {}, defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    for p in sorted(members, key=len, reverse=True):
        kids = [out[members[k][0], len(k)] for k in children[p]]
        words = len(re.findall(rb"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        ends = [c for c in members[p] if len(paths[c]) == len(p)]
        out[members[p][0], len(p)] = (
            members[p[:-1]][0] if p else None, len(members[p]), len(kids), sum(k[3] for k in kids) or 1,
            sum(k[4] for k in kids) + (len(members[p]) - 1) * words,
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest())
    return out


def got(df):
    out = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
           for r in df.collect()}
    return out


def test_whole_table(spark):
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(ct.op13_conversation_trie(spark, d)) == brute_force(rows)


ODD = [(5, 1, "user", "hi there"), (5, 1, "user", "hi there"), (5, None, None, None), (None, 0, "user", "x"),
       (0, 2, "a", "same turn b"), (0, 2, "a", "same turn a"), (0, 2, None, "ﬁ x　y"), (0, 7, "u", ""), (-3, 0, "u", "neg ative"),
       (-20, 0, "u", "base"), (41, 0, "u", "x y"), (42, 0, "u", "x y"), (43, 0, "u", "x y"), (44, 0, "u", "x y z"),
       (10**15 + 7, 3, "user", "word " * 40000), (45, 9, "user:", "1"), (46, 9, "user", ":1")]


@pytest.mark.parametrize("task_arcs", [None, 5])
def test_odd_rows(spark, task_arcs):
    frame = spark.createDataFrame([(*r, 7, "m") for r in ODD], SCHEMA + ", depth int, m string")
    assert got(ct.trie(frame, task_arcs=task_arcs)) == brute_force(ODD)
    assert ct.trie(frame.limit(0)).collect() == []


def test_hot_conversation_first_turn_and_copies(spark, monkeypatch):
    """A conversation, a first turn and a group of copies with many rows, over ranges and pieces that cut all of them."""
    monkeypatch.setattr(ct, "PIECE", 16)
    monkeypatch.setattr(ct, "IDS", 7)
    rows = [(3, t, "u", f"turn {t % 3}") for t in range(400)]
    rows += [(c, t, "u", "copied words") for c in range(100, 260) for t in range(3)]
    rows += [(c, t, "u", "first" if t == 0 else f"own {c}") for c in range(300, 420) for t in range(2)]
    want = brute_force(rows)
    assert got(ct.trie(spark.createDataFrame(rows, SCHEMA), parts=11, task_arcs=40)) == want


def test_ranks_and_sums(spark, monkeypatch):
    """A list in no order at all is ranked by rounds of ranges and coins; sums over several blocks."""
    import numpy as np
    from pyspark.sql import functions as F

    monkeypatch.setattr(euler_tour, "BLOCK", 64)
    names = [(int(m), int(x)) for m, x in np.random.default_rng(5).permutation([(m, x) for m in range(60) for x in range(15)])]
    rows = [(*a, *b) for a, b in zip(names, [*names[1:], (None, None)])]
    frame = spark.createDataFrame(rows, "m long, x long, nm long, nx long")
    ranked = euler_tour.ranks(frame, F.col("m") % 7, task_arcs=50)
    place = {(r.m, r.x): r["rank"] for r in ranked.collect()}
    assert place == {a: i for i, a in enumerate(names)}
    sums = euler_tour.sums_before(ranked.selectExpr("m", "x", "rank", "m * x AS w"), ["w"]).collect()
    total = 0
    for r, (m, x) in zip(sorted(sums, key=lambda r: r["rank"]), names):
        assert (r.m, r.x, r.w) == (m, x, total)
        total += m * x


def test_oracle_agrees_with_brute_force(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE VIEW conversations AS SELECT * FROM read_parquet('/root/testdata/sf0.001/conversations.parquet')")
    rows = con.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    res = con.execute(ct.ORACLE)  # last: a connection holds the result of one statement
    cols = [c[0] for c in res.description]
    found = {(r["conv_id"], r["depth"]): tuple(r[c] for c in (
        "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"))
        for r in (dict(zip(cols, x)) for x in res.fetchall())}
    assert found == brute_force(rows)
