import math

import numpy as np
import pytest

from rivalry.llm import topk_lists as tk

SCHEMA = "vec_id long, embedding array<double>"


def brute_force(rows, is_query, top=tk.TOP):
    """Sorted rows (query_id, rank, vec_id, score) over all pairs, in whole numbers."""
    fine = set()
    for i, v in rows:
        if i is not None and v is not None and None not in v and all(math.isfinite(x * 1024) for x in v):
            fine.add((i, tuple(math.floor(x * 1024) for x in v)))
    out = []
    for own, q in fine:
        if is_query(own):
            found = sorted((-max(-tk.LONG - 1, min(tk.LONG, sum(a * b for a, b in zip(q, v)))), i)
                           for i, v in fine if i != own and len(v) == len(q))
            out += [(own, k + 1, i, -s) for k, (s, i) in enumerate(found[:top])]
    return sorted(out)


def got(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def test_whole_table(spark):
    d = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{d}/embeddings.parquet").collect()]
    assert got(tk.op11_topk(spark, d)) == brute_force(rows, lambda i: i % 100 == 0)


@pytest.mark.parametrize("kind", ["even", "clustered", "few values", "one side"])
def test_many_shards(spark, kind):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 12)) * (0.2 if kind == "even" else rng.lognormal(size=(900, 1)))
    if kind == "clustered":
        x += 4 * rng.normal(size=(6, 12))[rng.integers(0, 6, 900)]
    if kind == "few values":
        x = rng.integers(-1, 2, size=(900, 12)).astype(float)
    if kind == "one side":
        x[:600, 0] = np.abs(x[:600]).sum(1) + 1  # two thirds have their largest component in one place
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(x)]
    frame = spark.createDataFrame(rows, SCHEMA)
    index = tk.build(frame, shard_entries=600)
    assert index[1].count() > 10
    assert got(tk.search(index, frame.filter("vec_id % 9 = 0"))) == brute_force(rows, lambda i: i % 9 == 0)


def test_reading_stops_early(spark):
    """A clustered shard is not read to its end, and one that can't reach the score so far isn't read at all."""
    rng = np.random.default_rng(2)
    x = np.floor(1024 * (rng.normal(size=(4000, 8)) + 6 * rng.normal(size=(20, 8))[rng.integers(0, 20, 4000)]))
    by = np.argsort(x.T, axis=1)
    lists = tk.Lists.__new__(tk.Lists)
    lists.n, lists.rows, lists.vals, lists.vecs = 4000, by.astype("i4"), np.take_along_axis(x.T, by, 1), x
    deepest = []
    read = lists._read
    lists._read = lambda up, down, a, b: deepest.append(b) or read(up, down, a, b)
    exact = x @ x[7]
    rows = lists.candidates(x[7], -np.inf, 10)
    assert max(deepest) < 4000 and set(np.argsort(-exact)[:11]) <= set(rows)
    deepest.clear()
    assert len(lists.candidates(x[7], float(np.abs(x).sum(1).max() ** 2), 10)) == 0 and not deepest


def test_rows_are_resolved_where_lists_cost_more(spark):
    """Without clusters the bounds tighten late: the lists are left for final scores long before their ends."""
    x = np.floor(1024 * np.random.default_rng(3).normal(size=(4000, 32)))
    by = np.argsort(x.T, axis=1)
    lists = tk.Lists.__new__(tk.Lists)
    lists.n, lists.rows, lists.vals, lists.vecs = 4000, by.astype("i4"), np.take_along_axis(x.T, by, 1), x
    deepest, read = [], lists._read
    lists._read = lambda up, down, a, b: deepest.append(b) or read(up, down, a, b)
    rows = lists.candidates(x[7], -np.inf, 10)
    assert 0 < max(deepest) <= 1000 and set(np.argsort(-(x @ x[7]))[:11]) <= set(rows)


ODD = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (3, [1.0, 0.0]), (3, [1.0, 0.0]), (4, None), (5, []), (200, []), (300, [0.0, 0.0]),
       (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (9, [None, 1.0]), (None, [1.0, 1.0]), (10, [0.0, -2.0]),
       (400, [1.0, 2.0, 3.0]), (400, [3.0, 2.0, -1.0]), (41, [3.0, 2.0, 1.0]), (500, [5.0]), (600, [1e300, -1e300]),
       (601, [1e300, 1.0]), (700, [-0.0, 1e-9]), (701, [1e15, -3.7]), (702, [1.7e308, 0.0])]


def test_odd_rows(spark):
    rows = ODD + [(i, [1.0, 0.0]) for i in range(1000, 1400)]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", dim int, kind string")
    found = got(tk.search(tk.build(frame, shard_entries=40), frame.filter("vec_id % 100 = 0")))
    assert found == brute_force(rows, lambda i: i % 100 == 0)
    assert tk.search(tk.build(frame.limit(0)), frame.limit(0)).collect() == []


def test_oracle_agrees_with_brute_force():
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE VIEW embeddings AS SELECT * FROM read_parquet('/root/testdata/sf0.001/embeddings.parquet')")
    rows = con.execute("SELECT vec_id, embedding FROM embeddings").fetchall()
    cur = con.execute(tk.ORACLE)
    assert [c[0] for c in cur.description] == ["query_id", "rank", "vec_id", "score"]
    assert sorted(cur.fetchall()) == brute_force(rows, lambda i: i % 100 == 0)
