import random

from rivalry.llm import decontaminate as dc
from tests.llm.conftest import ODD_TEXTS


def distance(a, b):
    """Smallest edit distance of ``a`` to any part of ``b``, by the plain table."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return min(row)


def brute_force(docs, items, rate=dc.EDIT_RATE):
    out = []
    for doc_id, text in docs:
        for item_id, item in items:
            p = dc.normalise(item)
            t = dc.normalise(text)
            if p and not int(rate * len(p)):
                if p.split() in [t.split()[i:i + len(p.split())] for i in range(len(t.split()))]:
                    out.append((doc_id, item_id, 0))
            elif p and (d := distance(p, t)) <= int(rate * len(p)):
                out.append((doc_id, item_id, d))
    return sorted(out, key=str)


def edited(rng, text, n):
    for _ in range(n):
        i = rng.randrange(len(text))
        text = text[:i] + rng.choice(["", "z", "xy"[:1] + text[i]]) + text[i + 1:]
    return text


def test_myers_equals_the_table():
    rng = random.Random(1)
    for _ in range(300):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(1, 90)))
        b = "".join(rng.choice("abc") for _ in range(rng.randint(0, 40)))
        want = distance(a, b)
        assert dc.myers(a, b, len(a))[0] == want


def test_edited_passages_equal_brute_force(spark, small_dir):
    rng = random.Random(2)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").limit(12).collect()]
    docs = []
    for i in range(36):
        item = items[i % 12][1]
        docs.append((i, "Some words before, " + edited(rng, item.upper(), i // 2) + " and after. " + items[(i + 5) % 12][1][:60]))
    docs += [(100 + i, t) for i, t in enumerate(ODD_TEXTS) if len(t or "") < 100] + [(0, docs[0][1]), (None, items[0][1])]
    items += [(None, "short one!"), (77, "..."), (78, None), (79, "")]
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute_force(docs, items)
    assert len(want) > 12
    for block in (dc.BLOCK_CHARS, 400):
        got = dc.leaks(frame, bench, block_chars=block).collect()
        assert sorted(((r.doc_id, r.item_id, r.distance) for r in got), key=str) == want
    bad = {d for d, _, _ in want}
    assert {r.doc_id for r in dc.clean(frame, bench).collect()} == {d for d, _ in docs} - bad


def test_short_items_are_whole_words(spark):
    items = [(1, "a"), (2, "fine day"), (3, "Nother"), (4, "the day")]
    docs = [(1, "Another fine day"), (2, "a"), (3, "It was a day."), (4, "a fine, day"), (5, "fine days"), (6, "refine day"),
            (7, "thethe day"), (8, "nother nother")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.distance) for r in dc.leaks(frame, bench).collect())
    assert got == brute_force(docs, items) == [(1, 2, 0), (2, 1, 0), (3, 1, 0), (4, 1, 0), (4, 2, 0), (8, 3, 0)]


def test_empty(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.leaks(docs, none).collect() == [] and dc.clean(docs, none).count() == 1
    bench = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    assert dc.leaks(docs.limit(0), bench).collect() == []
