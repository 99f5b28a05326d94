"""Token-ID output: flat unsigned integer files with 64-bit document offsets, memory-mapped on reading.

A folder holds, per partition ``k`` of the documents in ascending ``doc_id``
order: ``k.ids`` (token ids, little-endian, 2 or 4 bytes by vocabulary size),
``k.docs`` (int64 document ids) and ``k.offs`` (uint64 offsets, one more than
documents, counted within the partition).  ``manifest.json`` gives each
partition's documents, tokens and *base*, the tokens of all partitions before
it (a prefix sum over one row per partition); a document's global start is
its partition's base plus its offset.

The documents are sorted over ranges of ``doc_id`` and encoded where they are
written.  A tokenizer of the kind named by ``NORMALIZER`` and
``PRE_TOKENIZER`` never joins text across white space, nor a word of plain
letters with the ASCII punctuation that ends it, so a text's encoding is the
concatenation of its segments', and a task encodes each distinct segment once.
Any other tokenizer encodes whole texts.

Null texts are empty and still get their end id; null ids come first; rows
that share a ``doc_id`` stand in text order; no rows give empty files.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivalry.llm import memory
from rivalry.llm import textarrays as ta
from rivalry.llm.store import filesystem, map_file, scratch, write_file

END_ID = 1
#: Code points encoded at a time, segments that a task holds before it starts anew, and words encoded in one text.
SLICE, HELD, JOINED = 1 << 18, 400_000, 1000
# The normaliser and pre-tokeniser for which a text's encoding is that of its ``segments``.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
_tokenizers: dict[int, object] = memory.table("tokenizers")


def _letters(cps: np.ndarray) -> np.ndarray:
    """A-Z, a-z and the letters of Latin-1: one code point each after normalisation, lower case and all."""
    low = cps | 0x20
    return ((low >= 0x61) & (low <= 0x7A)) | ((cps >= 0xC0) & (cps <= 0xFF) & (cps != 0xD7) & (cps != 0xF7))


def _lower(cps: np.ndarray) -> np.ndarray:
    up = ((cps >= 0x41) & (cps <= 0x5A)) | ((cps >= 0xC0) & (cps <= 0xDE) & (cps != 0xD7))
    return np.where(up, cps + 0x20, cps).astype(np.uint32)


def segments(cps: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words between ASCII white space; a word of plain letters followed by ASCII punctuation is cut
    between the two and its letters are lower-cased (the tokenizer would do both itself)."""
    starts, ends, _ = ta.words(cps, offs)
    if not len(starts):
        return cps, starts, ends
    letter = _letters(cps)
    ascii_mark = (cps > 0x20) & (cps < 0x7F) & ~letter & ~((cps >= 0x30) & (cps <= 0x39))
    last = np.maximum.accumulate(np.where(ascii_mark, -1, np.arange(len(cps))))  # last place that is no mark
    body = np.maximum(last[ends - 1] + 1, starts)
    count = np.concatenate(([0], np.cumsum(letter)))
    plain = (count[body] - count[starts] == body - starts) & (body > starts)
    change = np.zeros(len(cps) + 1, np.int8)
    change[starts[plain]] += 1
    np.subtract.at(change, body[plain], 1)
    keys = np.where(np.cumsum(change[:-1]) > 0, _lower(cps), cps)
    cut = plain & (body < ends)
    s = np.concatenate((starts, body[cut]))
    e = np.concatenate((np.where(plain, body, ends), ends[cut]))
    order = np.argsort(s, kind="stable")
    return keys, s[order], e[order]


def _tokenizer(source: str):
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    key = hash(source)
    if key not in _tokenizers:
        _tokenizers.clear()
        _tokenizers[key] = Tokenizer.from_str(source)
    return _tokenizers[key]


def by_segments(source: str) -> bool:
    """Whether a tokenizer (its JSON) does to texts what ``segments`` takes for granted."""
    spec = json.loads(source)
    return spec["normalizer"] == NORMALIZER and spec["pre_tokenizer"] == PRE_TOKENIZER


class Encoder:
    """Encodes slices of texts; each distinct segment of a task once."""

    def __init__(self, source: str):
        self.tokenizer, self.salt = _tokenizer(source), np.uint32(0x5BD1E995)
        vocab = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        if mark := json.loads(source)["model"].get("end_of_word_suffix"):
            self.last[[i for t, i in vocab.items() if t.endswith(mark)]] = True
        self.forget()

    def forget(self) -> None:
        self.hashes, self.checks = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.place = np.zeros(0, np.int64)
        self.ids, self.offs = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def whole(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """ids of texts, and their offsets, text by text."""
        got = [x.ids for x in self.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
        return np.array([i for x in got for i in x], np.uint32), np.concatenate(([0], np.cumsum(list(map(len, got))))).astype(np.int64)

    def slice(self, cps: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids of a slice of texts by segments, and their offsets by text.

        A segment is known by 128 bits of hash: the table is sorted by the first half, and where segments that differ
        share it, the second half shows it and the slice is encoded by whole texts, or the table starts anew.
        """
        keys, s, e = segments(cps, offs)
        h, g = ta.segment_hashes(keys, s, e), ta.segment_hashes(keys ^ self.salt, s, e)
        uniq, first, back = np.unique(h, return_index=True, return_inverse=True)
        check = g[first]
        if (check[back] != g).any():
            return self.whole([ta.text_of(cps[a:b]) for a, b in zip(offs, offs[1:])])
        if len(self.hashes) > HELD:
            self.forget()
        known, at = self._known(uniq)
        if (self.checks[at[known]] != check[known]).any():
            self.forget()
            known, at = self._known(uniq)
        if not known.all():
            self._learn(uniq[~known], check[~known], keys, s[first[~known]], e[first[~known]])
            at = np.searchsorted(self.hashes, uniq)
        own = self.place[at][back]
        n = self.offs[own + 1] - self.offs[own]
        ids = self.ids[ta.flat_ranges(self.offs[own], n)]
        return ids, np.concatenate(([0], np.cumsum(n)))[np.searchsorted(s, offs)]

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """ids of words of plain letters, and their offsets: encoded many in one text, told apart by the mark that the
        vocabulary puts on a word's last token."""
        texts = [" ".join(words[lo:lo + JOINED]) for lo in range(0, len(words), JOINED)]
        ids = np.array([i for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False) for i in x.ids], np.uint32)
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(words) or (len(ids) and ends[-1] != len(ids)):
            return self.whole(words)
        return ids, np.concatenate(([0], ends))

    def _known(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes the table has, and where."""
        if not len(self.hashes):
            return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return self.hashes[at] == hashes, at

    def _learn(self, hashes: np.ndarray, checks: np.ndarray, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Encode new segments of ``keys`` and merge them into the sorted table."""
        text, letters = ta.text_of(keys), np.concatenate(([0], np.cumsum(_letters(keys))))
        plain = letters[ends] - letters[starts] == ends - starts
        order = np.argsort(~plain, kind="stable")  # words of plain letters first
        segs = [text[a:b] for a, b in zip(starts[order].tolist(), ends[order].tolist())]
        n = int(plain.sum())
        (a, a_offs), (b, b_offs) = self._words(segs[:n]), self.whole(segs[n:])
        place = np.empty(len(hashes), np.int64)
        place[order] = len(self.offs) - 1 + np.arange(len(hashes))
        self.offs = np.concatenate((self.offs, self.offs[-1] + a_offs[1:], self.offs[-1] + a_offs[-1] + b_offs[1:]))
        self.ids = np.concatenate((self.ids, a, b))
        to = np.searchsorted(self.hashes, hashes)
        self.hashes, self.checks, self.place = (np.insert(a, to, b) for a, b in (
            (self.hashes, hashes), (self.checks, checks), (self.place, place)))


def write(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, folder: str | None = None) -> str:
    """Encode ``docs`` (doc_id, text) and write them as token files; the folder's name is returned."""
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:  # the tokenizer's own file, on the driver
        json_text = f.read()
    source, apart = spark.sparkContext.broadcast(json_text), by_segments(json_text)
    width = "<u2" if max(_tokenizer(json_text).get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
    folder = folder or scratch(spark, "tokens")
    docs = docs.select("doc_id", "text")

    @memory.tidy
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = TaskContext.get().partitionId()
        doc_ids, sizes = [], []

        memory.begin("tokenizers")
        encoder = Encoder(source.value)

        def ids_out(out) -> None:
            for batch in batches:
                doc_ids.append(batch.column(0))
                for lo, hi, cps, offs in ta.slices(batch.column(1), SLICE):
                    ids, at = encoder.slice(cps, offs) if apart else encoder.whole(
                        batch.column(1).slice(lo, hi - lo).to_pylist())
                    out.write(np.insert(ids, at[1:], end_id).astype(width).tobytes())
                    sizes.append(np.diff(at) + 1)

        write_file(f"{folder}/{k:05d}.ids", ids_out)
        n = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        ids = pa.chunked_array(doc_ids, pa.int64())
        null = ids.is_null().to_numpy() if len(ids) else np.zeros(0, bool)
        known = ids.fill_null(0).to_numpy() if len(ids) else np.zeros(0, np.int64)
        for name, a in (("docs", known.astype("<i8")), ("null", null.astype("u1")),
                        ("offs", np.concatenate(([0], np.cumsum(n))).astype("<u8"))):
            write_file(f"{folder}/{k:05d}.{name}", lambda out, a=a: out.write(a.tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (k, len(n), int(n.sum()))],
                                         ["part", "docs", "tokens"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    made = sorted(ordered.mapInArrow(part, "part long, docs long, tokens long").collect())  # one row per partition
    base, rows = 0, []
    for r in made:
        rows.append({"part": r.part, "docs": r.docs, "tokens": r.tokens, "base": base})
        base += r.tokens
    write_file(f"{folder}/manifest.json", lambda out: out.write(
        json.dumps({"dtype": width, "end_id": end_id, "tokens": base, "parts": rows}).encode()))
    return folder


def manifest(folder: str) -> dict:
    fs, path = filesystem(f"{folder}/manifest.json")
    with fs.open_input_stream(path) as f:
        return json.loads(f.read())


def read(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """One row per document of token files: doc_id, start, n_tokens, ids_crc32 (and ``ids``), from mapped files."""
    m = manifest(folder)
    width, rows = m["dtype"], [(p["part"], p["base"]) for p in m["parts"]]

    @memory.tidy
    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                docs, offs, null, ids = (np.frombuffer(map_file(f"{folder}/{k:05d}.{x}"), kind) for x, kind in (
                    ("docs", "<i8"), ("offs", "<u8"), ("null", "u1"), ("ids", width)))
                offs = offs.astype(np.int64)
                for lo in range(0, len(docs), 1024):
                    hi = min(lo + 1024, len(docs))
                    own = [ids[a:b].astype("<u4") for a, b in zip(offs[lo:hi].tolist(), offs[lo + 1:hi + 1].tolist())]
                    cols = [pa.array(docs[lo:hi], mask=null[lo:hi].astype(bool)), pa.array(offs[lo:hi] + base),
                            pa.array(np.diff(offs[lo:hi + 1])), pa.array([zlib.crc32(x) for x in own], pa.int64())]
                    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                    if with_ids:
                        cols.append(pa.array([x.astype(np.int64) for x in own], pa.list_(pa.int64())))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(cols, names)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    frame = spark.createDataFrame(rows, "part long, base long").repartition(max(1, len(rows)), F.col("part"))
    return frame.mapInArrow(load, schema)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` written as token files and read back (word_bpe_49k vocabulary, end id 1)."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return read(spark, write(docs, public_tokenizers.path("word_bpe_49k.json")))
