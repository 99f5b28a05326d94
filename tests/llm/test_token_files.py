import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from rivalry.llm import textarrays as ta
from rivalry.llm import token_files
from tests.llm.conftest import ODD_TEXTS

PATH = public_tokenizers.path("word_bpe_49k.json")


def expected(pairs, path=PATH):
    tok, start, out = Tokenizer.from_file(path), 0, []
    for doc_id, text in sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0, p[1] is not None, p[1] or "")):
        ids = tok.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[1])


def test_ids_equal_the_library_on_whole_texts(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    assert rows(token_files.op2_token_files(spark, small_dir)) == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_odd_texts_null_and_repeated_ids(spark):
    pairs = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "null id"), (3, "a"), (3, None)]
    docs = spark.createDataFrame([(*p, 7) for p in pairs], "doc_id long, text string, ids int")
    assert rows(token_files.read(spark, token_files.write(docs, PATH))) == expected(pairs)


def test_a_tokenizer_of_another_kind(spark):
    """It isn't cut into segments but encodes whole texts."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    pairs = list(enumerate(ODD_TEXTS))
    docs = spark.createDataFrame(pairs, "doc_id long, text string")
    assert rows(token_files.read(spark, token_files.write(docs, path))) == expected(pairs, path)


def test_texts_over_a_slice(spark):
    rng = np.random.default_rng(2)
    words = ["alpha", "Beta,", "don't", "élan!", "漢字", "x" * 99, "12.5", "---"]
    long = " ".join(rng.choice(words, 80_000))
    assert len(long) > 1 << 20
    pairs = [(1, "short"), (0, long), (2, "y" * 300_000), (3, None)]
    docs = spark.createDataFrame(pairs, "doc_id long, text string")
    assert rows(token_files.read(spark, token_files.write(docs, PATH))) == expected(pairs)


def test_segments_with_one_hash(monkeypatch):
    """Where the first half of the hash doesn't tell segments apart, or the table is full, the ids are the same."""
    with open(PATH, encoding="utf-8") as f:
        source = f.read()
    texts = ["one two three four", "two five, six", "", "one seven three"]
    offs = np.concatenate(([0], np.cumsum(list(map(len, texts)))))
    cps = ta.code_points("".join(texts))
    library = Tokenizer.from_str(source)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    real = ta.segment_hashes
    for mask, limit in ((0, 10), (3, 10), (7, 0), (0xFFFF, 1)):
        encoder, calls = token_files.Encoder(source), []
        monkeypatch.setattr(token_files, "HELD", limit)

        def weak(keys, s, e):
            calls.append(1)
            return real(keys, s, e) & np.uint64(mask) if len(calls) % 2 else real(keys, s, e)

        monkeypatch.setattr(ta, "segment_hashes", weak)
        for k in range(4):  # one text at a time meets what the table holds
            ids, _ = encoder.slice(cps[offs[k]:offs[k + 1]], np.array([0, offs[k + 1] - offs[k]]))
            assert ids.tolist() == want[k]
        ids, at = encoder.slice(cps, offs)
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_files.read(spark, token_files.write(docs, PATH)).collect() == []
