import hashlib
import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from rivalry.llm import sentencepiece_lattice as sl
from tests.llm.conftest import ODD_TEXTS

PATH = public_tokenizers.path("piece_bpe_32k.model")
MORE = ["  two  spaces ", " ", "   ", "▁ literal▁mark", "a" * 100 + " " * 100 + "b", "\n\n" + "ab" * 60, "(((((((" * 20,
        "x=1; y+=2  // code\n\treturn {a: [1,2]}", "Übergrößenträger naïve façade", "  ​ é", "=" * 63, "=" * 62]


def test_ids_equal_the_library_on_the_whole_table(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").collect()
    lib = sentencepiece.SentencePieceProcessor(model_file=PATH)
    want = set()
    for r in docs:
        ids = lib.encode(r.text or "")
        want.add((r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()),
                  hashlib.sha256((r.text or "").encode()).hexdigest()))
    got = [tuple(r) for r in sl.op1_sentencepiece(spark, small_dir).collect()]
    assert len(got) == len(docs) and set(got) == want


def test_odd_texts_and_round_trip(spark):
    texts = ODD_TEXTS + MORE
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, "a", "x")],
                                 "doc_id long, text string, ids string")
    lib = sentencepiece.SentencePieceProcessor(model_file=PATH)
    got = sl.decode(sl.encode(docs, PATH), PATH).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        assert r.ids == lib.encode(r.text or ""), r.text
        assert r.decoded == (r.text or "").replace("▁", " ")
    assert sl.encode(docs.limit(0), PATH).collect() == []


def test_segments_about_the_fold_s_bound(spark):
    ends = range(60, 65)
    texts = [x for n in ends for x in ("=" * n, "漢" + "=" * n, "a" * n, "漢" + "a" * n, "=" * n + " x " + "-" * n)]
    model = sl.Model.of(sl._model_file(PATH))
    _, starts, stops, _ = model.segments([w for t in texts for w in sl.words(t)])
    assert set((stops - starts).tolist()) >= {*ends, 65}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sl.decode(sl.encode(docs, PATH), PATH).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.ids == model.library.encode(r.text) and r.decoded == r.text


def test_dictionary_over_many_ranges(spark):
    """Found by range and binary search; absent segments and two segments of one hash are told."""
    rng = np.random.default_rng(3)
    hashes = np.unique(rng.integers(0, 1 << 64, 5000, dtype=np.uint64))
    ids = {int(h): rng.integers(0, 9, rng.integers(0, 4)).tolist() for h in hashes}
    frame = spark.createDataFrame([(int(np.uint64(h).view(np.int64)), x) for h, x in ids.items()], "h long, ids array<int>")
    lookup = sl.dictionary.Lookup(sl.dictionary.build(frame.repartition(7)))
    asked = rng.choice(hashes, 9000)
    got, at = lookup.encode(asked, np.arange(9001))
    assert [got[a:b].tolist() for a, b in zip(at, at[1:])] == [ids[int(h)] for h in asked]
    assert len(lookup.parts) > 1 and lookup.encode(asked[:0], np.zeros(1, int))[0].tolist() == []
    with pytest.raises(KeyError):
        lookup.encode(np.array([int(hashes[0]) ^ 1], np.uint64), np.arange(2))
    with pytest.raises(Exception, match="one hash"):
        sl.dictionary.build(frame.unionByName(frame.limit(1)))


def test_viterbi_fold_equals_all_paths(spark):
    rng = random.Random(4)
    table = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))): -rng.uniform(1, 9) for _ in range(30)}
    table.pop("c", None)
    rows = [(p, 300 + i, s) for i, (p, s) in enumerate(sorted(table.items()))]
    place = {p: (i, s) for p, i, s in rows}
    segs = ["".join(rng.choice("abcé") for _ in range(rng.randint(1, 9))) for _ in range(60)]
    unknown = min(table.values()) + sl.UNKNOWN_PENALTY

    def best(seg):
        found = []
        for cuts in itertools.product((0, 1), repeat=len(seg) - 1):
            ends = [i + 1 for i, c in enumerate(cuts) if c] + [len(seg)]
            parts = [seg[a:b] for a, b in zip([0, *ends], ends)]
            if all(p in place or len(p) == 1 for p in parts):
                found.append((sum(place[p][1] if p in place else unknown for p in parts), parts))
        top = max(x for x, _ in found)  # any path of the greatest score will do
        return [[i for p in parts for i in ([place[p][0]] if p in place else [3 + b for b in p.encode()])]
                for x, parts in found if x > top - 1e-9]

    frame = spark.createDataFrame(list(enumerate(set(segs))), "h long, seg string")
    edges = sl.lattice(frame, spark.createDataFrame(rows, sl.PIECES), 4)
    got = {r.seg: r.ids for r in sl.fold_viterbi(edges, 3, unknown).collect()}
    assert set(got) == set(segs) and all(got[s] in best(s) for s in got)


def test_fold_stays_in_the_jvm(spark):
    frame = spark.createDataFrame([(1, "▁ab")], "h long, seg string")
    edges = sl.lattice(frame, spark.createDataFrame([("▁a", 300, -1.0), ("b", 301, -2.0), ("▁", 302, -3.0), ("a", 303, -4.0)],
                                                    sl.PIECES), 2)
    out = sl.fold_bpe(edges, 3).withColumn("n", F.size("ids"))
    assert "Python" not in out._jdf.queryExecution().toString() and out.first().ids == [300, 301]


def test_freed_arrow_memory_goes_back(monkeypatch):
    """A worker that ends a task gives back what Arrow's pool holds unused, and keeps no piece table."""
    import pyarrow as pa

    from rivalry.llm import memory

    asked = []

    class Pool:
        def release_unused(self):
            asked.append(True)

    monkeypatch.setattr(pa, "default_memory_pool", Pool)
    assert list(memory.tidy(lambda x: iter(x))([1, 2])) == [1, 2] and asked
