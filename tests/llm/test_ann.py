from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from rivalry.llm import ann


def inner(a, b):
    return reduce(lambda x, y: x + y, (u * v for u, v in zip(a, b)), 0.0)


def brute_force(rows, queries, top=ann.TOP):
    """{query_id: [(vec_id, score), ...]} over all rows, exactly."""
    rows = sorted({(i, tuple(v)) for i, v in rows if i is not None and v and None not in v
                   and all(np.isfinite(v)) and any(v)})
    out = {}
    for own, q in rows:
        if own not in queries:
            continue
        found = sorted((-inner(q, v), i) for i, v in rows if i != own and len(v) == len(q))
        out[own] = [(i, -s) for s, i in found[:top]]
    return out


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def recall(found, want):
    hit = sum(len({i for i, _ in found.get(q, [])} & {i for i, _ in w}) for q, w in want.items())
    return hit / sum(map(len, want.values()))


def test_recall_on_the_whole_table(spark):
    d = "/root/testdata/sf0.01"
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{d}/embeddings.parquet").collect()]
    want = brute_force(rows, {i for i, _ in rows if i % 20 == 0})
    found = got(ann.op4_ann(spark, d))
    assert set(found) == set(want) and recall(found, want) >= 0.95
    vecs = dict(rows)
    for q, near in found.items():
        assert near == sorted(near, key=lambda x: (-x[1], x[0]))
        assert all(s == inner(vecs[q], vecs[i]) for i, s in near)


def test_several_shards_of_any_length(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 16)) * rng.uniform(0.2, 3, size=(1500, 1)) + rng.integers(0, 4, size=(1500, 1))
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = brute_force(rows, set(range(0, 1500, 50)))
    found = got(ann.search(ann.build(frame, shard_size=400), frame.filter("vec_id % 50 = 0")))
    assert recall(found, want) >= 0.9


def sets():
    rng = np.random.default_rng(7)
    gauss = rng.normal(size=(8000, 128))
    unit = rng.normal(size=(8000, 64))
    clustered = 2 * rng.normal(size=(50, 128))[rng.integers(0, 50, 8000)] + rng.normal(size=(8000, 128))
    huge = unit.copy()
    huge[17] *= 1e30
    return {"gauss": gauss, "unit": unit / np.linalg.norm(unit, axis=1, keepdims=True),
            "clustered, mixed norms": clustered * rng.lognormal(size=(8000, 1)), "one huge": huge,
            "tiny and huge": np.concatenate((unit[:3000] * 1e-150, unit[3000:6000] * 1e120))}


@pytest.mark.parametrize("kind", ["gauss", "unit", "clustered, mixed norms", "one huge", "tiny and huge"])
def test_recall_whatever_the_norms(spark, tmp_path, kind):
    x = sets()[kind]
    pq.write_table(pa.table({"vec_id": np.arange(len(x)), "embedding": list(x)}), tmp_path / "x.parquet")
    frame = spark.read.parquet(str(tmp_path / "x.parquet"))
    found = got(ann.search(ann.build(frame, shard_size=4096), frame.filter("vec_id % 40 = 0")))
    hits = []
    for q in range(0, len(x), 40):
        exact = x @ x[q]
        exact[q] = -np.inf
        hits.append(len(set(np.argsort(-exact, kind="stable")[:20].tolist()) & {i for i, _ in found[q]}))
    assert sum(hits) >= 0.9 * 20 * len(hits), sum(hits) / 20 / len(hits)


def test_a_walk_visits_what_it_should():
    """The block's walk keeps the best nodes of a graph that joins all of them, each once, for every query."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 8)).astype(np.float32)
    near = np.argsort(-(x @ x.T), 1)[:, 1:11].astype(np.int32)
    ring = ((np.arange(300) + 1) % 300).astype(np.int32)
    nodes, vals = ann.walk(np.concatenate((near, ring[:, None]), 1), x, x[:40], np.zeros((40, 1), np.int32), 300)
    assert all(sorted(own.tolist()) == list(range(300)) for own in nodes)
    assert np.allclose(np.sort(vals, 1), np.sort(x[:40] @ x.T, 1), atol=1e-5)


def test_nulls_ties_repeats_and_few(spark):
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (3, [1.0, 0.0]), (3, [1.0, 0.0]), (4, None), (5, []), (6, [0.0, 0.0]),
            (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (9, [None, 1.0]), (None, [1.0, 1.0]), (10, [0.0, 2.0]),
            (40, [1.0, 2.0, 3.0]), (41, [3.0, 2.0, 1.0]), (60, [5.0])] + [(i, [1.0, 0.0]) for i in range(100, 160)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, n int")
    queries = {i for i, _ in rows if i is not None and i % 20 == 0}
    want = {q: w for q, w in brute_force(rows, queries).items() if w}
    assert got(ann.search(ann.build(frame), frame.filter("vec_id % 20 = 0"))) == want
    assert ann.search(ann.build(frame.limit(0)), frame.limit(0)).collect() == []
