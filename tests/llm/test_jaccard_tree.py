import random
import re

import duckdb

from rivalry.llm import jaccard_tree as jt
from rivalry.llm.components import components
from tests.llm.conftest import ODD_TEXTS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, k):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute_force(texts, k, num, den):
    """(set sizes, component of each row as its first row) over all pairs."""
    sets, root = [shingle_set(t, k) for t in texts], list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [len(s) for s in sets], [find(i) for i in range(len(sets))]


def near_copies(rng, groups, size, words=60):
    out = []
    for _ in range(groups):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randint(3, words))]
        for _ in range(rng.randint(1, size)):
            own = list(base)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(len(own))] = f"x{rng.randrange(99)}"
            out.append(" ".join(own if rng.random() < 0.8 else own + base[:5]))
    rng.shuffle(out)
    return out


def check(spark, texts, k, num, den, unit=jt.UNIT):
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in enumerate(texts)], "doc_id long, text string, n int, cls string")
    sizes, roots = brute_force(texts, k, num, den)
    rows = sorted(jt.similarity_join(docs, k, num, den, unit).collect())
    assert [r.n for r in rows] == sizes
    first = {}
    for r in rows:
        if r.root is not None:
            first.setdefault(r.root, r.doc_id)
    assert [r.doc_id if r.root is None else first[r.root] for r in rows] == roots
    return roots


def test_small_units_equal_brute_force(spark):
    texts = near_copies(random.Random(6), 30, 9)
    roots = check(spark, texts, 4, 85, 100, unit=3)
    assert len(set(roots)) < len(roots)


def test_one_large_group_and_a_shared_passage(spark):
    rng = random.Random(7)
    passage = " ".join(f"p{i}" for i in range(40))
    texts = near_copies(rng, 1, 80) + [f"{passage} own{i} tail{i}" for i in range(30)] + [f"{passage} {i} " + " ".join(
        f"q{rng.randrange(999)}" for _ in range(60)) for i in range(20)]
    check(spark, texts, 5, 80, 100, unit=8)


def test_odd_texts_ties_and_repeats(spark):
    texts = ODD_TEXTS + ["A B", "a b", "b a", "a  b\n", "a b c d", "A b C d e", "a b c d"]
    check(spark, texts, 4, 85, 100)
    docs = spark.createDataFrame([(None, "a b c d e"), (5, "a b c d e"), (5, "a b c d e"), (2, None)], "doc_id long, text string")
    rows = jt.similarity_join(docs).collect()
    assert len({r.root for r in rows if r.n}) == 1 and [r.root for r in rows if not r.n] == [None]
    assert jt.similarity_join(docs.limit(0)).collect() == []


def test_query_equals_sql(spark, small_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{small_dir}/documents.parquet')")
    want = con.execute(jt.ORACLE)
    names = [d[0] for d in want.description]
    got = jt.op5_jaccard_join(spark, small_dir)
    assert sorted(got.columns) == sorted(names)
    assert sorted(tuple(r) for r in got.select(*names).collect()) == sorted(want.fetchall())


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 150), (7, 7)] + [(500, i) for i in range(300, 340)]
    want = {i: 0 for i in range(41)} | {100: 100, 200: 100, 150: 100} | {i: 300 for i in [500, *range(300, 340)]}
    for task_links in (None, 30):
        found = components(spark.createDataFrame(links, "a long, b long"), task_links).collect()
        assert len(found) == len(want) and {r.node: r.root for r in found} == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
