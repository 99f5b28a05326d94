import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rivalry.llm import language as la
from tests.llm.conftest import ODD_TEXTS

WORDS = {"aa": ["banana", "bandana", "nab"], "bb": ["kiwi", "wiki", "ikki"]}


def phrases(word, words):
    """Greedy longest phrases of a word with its borders, by substring tests."""
    text, word, n, i = " " + " ".join(words) + " ", f" {word} ", 0, 0
    while i < len(word):
        k = 1
        while i + k < len(word) and word[i:i + k + 1] in text:
            k += 1
        i, n = i + k, n + 1
    return n


def test_phrase_counts_equal_brute_force():
    model = la.Model(WORDS)
    text = "banana bananab kiwiki wxkiwi a nabnab " + "ab" * 40
    found = [m.span() for m in re.finditer(r"\w+", text)]
    cps = la.ta.code_points(text)
    got = model.phrases(model.classes[cps], np.array([a for a, _ in found]), np.array([b for _, b in found]))
    for k, name in enumerate(model.names):
        assert got[k].tolist() == [phrases(text[a:b], WORDS[name]) for a, b in found]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r.doc_id: (r.lang, r.text) for r in docs.collect()}
    got = la.op6_language(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(lang)
    tested = right = 0
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
        letters = any(c.isalpha() for c in lang[r.doc_id][1] or "")
        assert (r.lang_pred == la.UNKNOWN) == (not letters)
        if r.held_out and letters and lang[r.doc_id][0]:
            tested, right = tested + 1, right + (r.lang_pred == lang[r.doc_id][0])
    assert tested > 100 and right / tested >= 0.97


def test_odd_texts_repeats_and_clashing_columns(spark):
    rows = [(i, t, "x", 1.5) for i, t in enumerate(ODD_TEXTS + ["banana", "BANANA!", "banana"])] + [(None, "kiwi", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string, score double")
    out = la.predict(docs, WORDS).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.lang_pred == la.UNKNOWN) == (not any(c.isalpha() for c in r.text or ""))
        if (r.text or "").lower().startswith("banana"):
            assert r.lang_pred == "aa" and r.score > 0.5
    assert la.predict(docs, {}).filter("lang_pred != 'und'").count() == 0
    assert la.predict(docs.limit(0), WORDS).collect() == []


def test_training_sees_only_its_rows(spark):
    rows = [(i, "banana" if zlib.crc32(str(i).encode()) % 3 == 1 else "kiwi", "xx") for i in range(50)]
    rows += [(None, "nullid", "xx"), (2, "nolabel", None), (3, None, "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert la.train(docs) == {"xx": ["kiwi"]}
    assert la.train(docs.limit(0)) == {}
    assert la.Model({}).predict(pa.array(["a", None])) == (["und", "und"], [0.0, 0.0])
    assert docs.select(la.held_out(F.lit(None).cast("long"))).first()[0] is False


def test_every_label_is_learned(spark, monkeypatch):
    names = [f"l{i:02d}" for i in range(30)]
    own = {n: [a + b + a for a in chr(0x4e00 + 10 * i) + chr(0x4e01 + 10 * i) for b in "xyz"] for i, n in enumerate(names)}
    rows = [(100 * i + j, " ".join(own[n]), n) for i, n in enumerate(names) for j in range(40 if i < 29 else 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    words = la.train(docs)
    assert {n: sorted(w) for n, w in words.items()} == {n: sorted(w) for n, w in own.items()}
    texts = spark.createDataFrame([*rows, (None, None, None), (None, "...", None)], docs.schema)
    got = la.predict(texts, words).collect()
    assert len(got) == len(rows) + 2 and all(r.lang_pred == (r.lang or la.UNKNOWN) for r in got)
    # One table at a time gives what tables held together give.
    model, text = la.Model(words), pa.array([*ODD_TEXTS, *(r[1] for r in rows[::40])])
    monkeypatch.setattr(la.ta.slices, "__defaults__", (50,))
    one = model.predict(text)
    monkeypatch.setattr(la, "HELD", 30)
    assert model.predict(text) == one
