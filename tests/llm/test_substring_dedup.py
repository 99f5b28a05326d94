import re

import duckdb
import numpy as np
from pyspark.sql import functions as F

from rivalry.llm import substring_dedup as sd
from tests.llm.conftest import ODD_TEXTS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(rows, k):
    """[(doc_id, kept text, n_words, n_removed)] by comparing the words of all windows."""
    place, first = lambda d: (d is None, d or 0), {}
    split = [(d, WORD.findall(t or "")) for d, t in rows]
    for d, w in split:
        for i in range(len(w) - k + 1):
            key = tuple(w[i:i + k])
            first[key] = min(first.get(key, ((True, 9e99), 0)), (place(d), i))
    out = []
    for d, w in split:
        gone = {j for i in range(len(w) - k + 1) if first[tuple(w[i:i + k])] != (place(d), i) for j in range(i, i + k)}
        out.append((d, " ".join(x for i, x in enumerate(w) if i not in gone), len(w), len(gone)))
    return sorted(out, key=str)


def run(spark, rows, k):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, key int, starts string")
    return sorted((tuple(r) for r in sd.dedup(docs.repartition(3), k).collect()), key=str)


def test_small_vocabulary_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(sd, "GATHER", 300)
    rng = np.random.default_rng(5)
    rows = [(int(i), " ".join(rng.choice(list("abc"), rng.integers(0, 40)))) for i in rng.permutation(60)]
    rows += [(i, t) for i, t in rows[:5]] + [(None, rows[7][1]), (None, "a b c a b c a b c"), (61, "é a b c\x0ba b\tc a  b c")]
    assert run(spark, rows, 4) == brute_force(rows, 4)


def test_odd_texts(spark):
    rows = list(enumerate(ODD_TEXTS)) + [(3, "other text"), (None, None)]
    for k in (1, 20):
        assert run(spark, rows, k) == brute_force(rows, k)
    assert run(spark, [], 20) == []


def test_distances_tell_the_counters():
    rng = np.random.default_rng(8)
    cells = np.unique(np.concatenate([rng.integers(0, 3 * sd.PART, 900), [0, sd.PART - 1, sd.PART, 2 * sd.PART + 1]])).astype(np.uint64)
    more = rng.random(len(cells)) < 0.5
    to, value = sd._steps(cells, more)
    got = [sd._places(value[to == p]) for p in range(3)]
    assert np.array_equal(np.concatenate([c + p * sd.PART for p, (c, _) in enumerate(got)]), cells)
    assert np.array_equal(np.concatenate([m for _, m in got]), more)


def test_sketch_loses_no_repeated_window(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    width = 1 << 12  # far too small: all overestimated, none lost
    sketch = sd.Sketch(sd.build_sketch(docs, width, 20), width)
    hashes = []
    for r in docs.collect():
        cps = sd.ta.code_points(r.text or "")
        hashes.append(sd.document_windows(cps, np.array([0, len(cps)]), 20)[0])
    uniq, n = np.unique(np.concatenate(hashes), return_counts=True)
    assert set(np.flatnonzero(n > 1)) <= set(sketch.repeated(uniq).tolist()) and (n > 1).any()


def test_query_equals_sql(spark, small_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{small_dir}/documents.parquet')")
    want = con.execute(sd.ORACLE)
    names = [d[0] for d in want.description]
    got = sd.op8_substring_dedup(spark, small_dir)
    assert sorted(got.columns) == sorted(names)
    assert sorted(tuple(r) for r in got.select(*names).collect()) == sorted(want.fetchall())
    assert got.agg(F.sum("n_removed")).first()[0] > 0
