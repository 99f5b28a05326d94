"""SentencePiece encoding and decoding over a relational lattice.

1. Texts are split into words before spaces, and words into segments between
   characters that no piece of the model holds side by side: no piece crosses
   such a cut, so segments encode alone, and each distinct segment once.
2. ``lattice`` explodes the substrings of each distinct segment, bounded by
   the longest piece, and joins them to the piece table: the lattice's edges.
3. The edges are grouped by segment and folded with Spark's higher-order
   ``aggregate``.  For a *unigram* model the fold is Viterbi's: best score and
   last edge per position.  A *BPE* model's scores are merge ranks, whose sum
   means nothing, so Viterbi's result would be wrong; there the fold keeps the
   set of borders as bits and applies, step by step, the best-scored edge that
   joins two neighbours (the leftmost among equals), which is what the model
   defines.
4. Characters without a piece become the bytes of their UTF-8.
5. Documents are encoded where they are read: a task looks up each distinct
   word of some texts in a mapped dictionary of the segments' ids (see
   ``dictionary``) and puts the words together.

Words with a segment of more than ``MAX_SEGMENT`` characters (its borders
don't fit the fold's bits) are encoded by the sentencepiece library from the
same model.

Null texts are empty and have no ids; repeated rows and ids are encoded each;
``decode`` gives the text back, byte for byte, but that U+2581 becomes a
space as in the library.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivalry.llm import dictionary, memory
from rivalry.llm import textarrays as ta

SPACE = "▁"
MAX_SEGMENT = 62
#: Added to a unigram model's smallest score for a character without a piece; the library's fixed value.
UNKNOWN_PENALTY = -10.0
#: Texts whose words a task looks up together, words that it holds at most before it starts anew, and segments (by their
#: hashes alone) that it knows it has sent.
TEXTS, HELD, SENT = 256, 150_000, 2_000_000
_WORD = re.compile(f"{SPACE}+[^{SPACE}]*")
PIECES = "piece string, id int, score double"
_models: dict[int, Model] = memory.table("pieces")


class Model:
    """A SentencePiece model file: the piece table, and the cuts between characters that it implies."""

    def __init__(self, proto: bytes):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=proto)
        sp = self.library
        byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.first_byte = byte_ids[0]
        probe = "ﬁ １　 é İ\t x  "
        if byte_ids != list(range(self.first_byte, self.first_byte + 256)) or sp.decode(sp.encode(probe)) != probe:
            raise ValueError("the model must leave texts as they are, add a space before, and fall back to bytes")
        rows = self.rows()
        if any(SPACE in p.lstrip(SPACE) for p, _, _ in rows):
            raise ValueError("a piece of the model crosses words")
        self.longest = max((len(p) for p, _, _ in rows), default=1)

    @classmethod
    def of(cls, proto: bytes) -> Model:
        key = hash(proto)
        if key not in _models:
            _models[key] = cls(proto)
        return _models[key]

    def rows(self) -> list[tuple[str, int, float]]:
        """The piece table; not kept, as every worker has the model."""
        sp = self.library
        return [(sp.id_to_piece(i), i, float(sp.get_score(i))) for i in range(len(sp))
                if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]

    @cached_property
    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """(class of each code point, bits of the classes that stand side by side in a piece)."""
        side = {p[i:i + 2] for p, _, _ in self.rows() for i in range(len(p) - 1)}
        chars = sorted({c for p in side for c in p})
        classes = np.zeros(0x110000, np.uint16)
        for i, c in enumerate(chars):
            classes[ord(c)] = i + 1
        table = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for a, b in side:
            table[classes[ord(a)], classes[ord(b)]] = True
        table = np.packbits(table, axis=1)  # a bit for each pair
        return classes, table

    def segments(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Code points of words with their space before, the segments between the cuts, and the segments' offsets by word."""
        text = SPACE + SPACE.join(words)
        keys = ta.code_points(text)
        size = np.fromiter(map(len, words), np.int64, len(words)) + 1
        offs = np.concatenate(([0], np.cumsum(size)))
        classes, table = self.pairs
        c = classes[keys]
        cut = np.ones(len(keys), bool)
        cut[1:] = table[c[:-1], c[1:] >> 3] >> (7 - (c[1:] & 7)) & 1 == 0
        cut[offs[:-1]] = True
        starts = np.flatnonzero(cut)
        return keys, starts, np.append(starts[1:], len(keys)), np.searchsorted(starts, offs)

    @cached_property
    def decoded(self) -> list[bytes]:
        """Bytes of each id, spaces restored."""
        sp = self.library
        out = []
        for i in range(len(sp)):
            if sp.is_byte(i):
                out.append(bytes([i - self.first_byte]))
            elif sp.is_control(i):
                out.append(b"")
            elif sp.is_unknown(i):
                out.append(" ⁇ ".encode())
            else:
                out.append(sp.id_to_piece(i).replace(SPACE, " ").encode())
        return out

    def text(self, ids: list[int]) -> str:
        joined = b"".join(map(self.decoded.__getitem__, ids)).decode("utf-8", "replace")
        return joined[1:] if joined.startswith(" ") else joined


def lattice(segs: DataFrame, pieces: DataFrame, longest: int) -> DataFrame:
    """Edges (h, seg, start, n, id, score) of each distinct segment ``seg``, told by its hash ``h``; a lone character
    without a piece has no id."""
    starts = segs.select("h", "seg", F.explode(F.sequence(F.lit(0), F.length("seg") - 1)).alias("start"))
    spans = starts.select("h", "seg", "start", F.explode(F.sequence(
        F.lit(1), F.least(F.lit(longest), F.length("seg") - F.col("start")))).alias("n"))
    subs = spans.withColumn("piece", F.col("seg").substr(F.col("start") + 1, F.col("n")))
    # The piece table is the model's, bounded by its file; a hash makes the join's key a number.
    table = F.broadcast(pieces.select(F.xxhash64("piece").alias("key"), F.col("piece").alias("own"), "id", "score"))
    found = subs.join(table, (F.xxhash64("piece") == F.col("key")) & (F.col("piece") == F.col("own")), "left")
    return found.filter(F.col("id").isNotNull() | (F.col("n") == 1)).select("h", "seg", "start", "n", "id", "score")


def words(text: str | None) -> list[str]:
    """Words of a text without the space before each; a word after several spaces keeps all but one of them."""
    if not text:
        return []
    found = text.replace(" ", SPACE).split(SPACE)
    if "" in found:
        found = [w[1:] for w in _WORD.findall(SPACE + text.replace(" ", SPACE))]
    return found


def distinct_segments(docs: DataFrame, proto) -> DataFrame:
    """(h, seg): distinct segments of ``docs.text``, of up to ``MAX_SEGMENT`` characters, and their hashes, dealt by hash.

    A task sends a segment once, so nothing is left to combine before the shuffle.
    """

    @memory.tidy
    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory.begin("pieces")
        model, seen, sent = Model.of(proto.value), set(), np.zeros(0, np.uint64)
        for batch in batches:
            for lo in range(0, batch.num_rows, TEXTS):
                new = set()
                for text in batch.column(0).slice(lo, TEXTS).to_pylist():
                    new.update(words(text))
                new -= seen
                if not new:
                    continue
                seen |= new
                keys, starts, ends, _ = model.segments(list(new))
                short = ends - starts <= MAX_SEGMENT
                starts, ends = starts[short], ends[short]
                h, first = np.unique(ta.segment_hashes(keys, starts, ends), return_index=True)
                place = np.searchsorted(sent, h)
                fresh = np.append(sent, np.uint64(0))[place] != h
                fresh |= place == len(sent)
                sent = np.insert(sent, place[fresh], h[fresh])
                text, first = ta.text_of(keys), first[fresh]
                out = [text[s:e] for s, e in zip(starts[first].tolist(), ends[first].tolist())]
                if len(seen) > HELD:
                    seen = set()
                if len(sent) > SENT:
                    sent = np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(h[fresh].view(np.int64)), pa.array(out, pa.string())], ["h", "seg"])

    return docs.select("text").mapInArrow(local, "h long, seg string").repartition("h").dropDuplicates(["h", "seg"])


def _bits(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), at.cast("int"))


def _ids(chosen: Column, first_byte: int) -> Column:
    """ids of the chosen edges (start, n, id), in order; no id: the bytes of the character."""
    def one(e: Column) -> Column:
        raw = F.encode(F.col("seg").substr(e["start"] + 1, F.lit(1)), "UTF-8")
        chars = F.hex(raw)
        fallback = F.transform(F.sequence(F.lit(0), F.octet_length(raw) - 1), lambda b: (
            F.conv(chars.substr(b * 2 + 1, F.lit(2)), 16, 10).cast("int") + F.lit(first_byte)))
        return F.when(e["id"].isNotNull(), F.array(e["id"])).otherwise(fallback)
    return F.flatten(F.transform(F.sort_array(chosen), one))


def fold_bpe(edges: DataFrame, first_byte: int) -> DataFrame:
    """(h, seg, ids): merges in order of score, leftmost first, over the borders held as bits of a long."""
    end = F.col("start") + F.col("n")
    merge = F.struct((-F.col("score")).alias("rank"), "start", (_bits(F.col("start")).bitwiseOR(_bits(end))).alias("ends"),
                     (_bits(end) - _bits(F.col("start") + 1)).alias("inner"))
    edge = F.struct("start", "n", "id")
    grouped = edges.groupBy("h", "seg").agg(F.sort_array(F.collect_list(F.when(F.col("n") > 1, merge))).alias("merges"),
                                            F.collect_list(edge).alias("edges"))
    size = F.length("seg")

    def step(borders: Column, _: Column) -> Column:
        fits = F.filter("merges", lambda e: (borders.bitwiseAND(e["ends"]) == e["ends"])
                        & (F.bit_count(borders.bitwiseAND(e["inner"])) == 1))
        inner = F.coalesce(F.get(fits, F.lit(0))["inner"], F.lit(0).cast("long"))
        return borders.bitwiseAND(F.bitwise_not(inner))

    # The size + 1 lowest bits; 1 << 63 less 1 would pass a long.
    start = F.call_function("shiftrightunsigned", F.lit(-1).cast("long"), F.lit(63) - size)
    folded = F.when(F.size("merges") > 0, F.aggregate(F.sequence(F.lit(1), F.greatest(F.lit(1), size - 1)), start, step)
                    ).otherwise(start)
    out = grouped.withColumn("borders", folded)
    borders = F.col("borders")
    chosen = F.filter("edges", lambda e: (borders.bitwiseAND(_bits(e["start"])) != 0)
                      & (borders.bitwiseAND(_bits(e["start"] + e["n"])) != 0)
                      & (borders.bitwiseAND(_bits(e["start"] + e["n"]) - _bits(e["start"] + 1)) == 0))
    return out.select("h", "seg", _ids(chosen, first_byte).alias("ids"))


def fold_viterbi(edges: DataFrame, first_byte: int, unknown: float) -> DataFrame:
    """(h, seg, ids) of the path of greatest score (ties: the longer last piece); ``unknown`` scores a lone character."""
    edge = F.struct((F.col("start") + F.col("n")).alias("end"), "start", "n", "id",
                    F.coalesce("score", F.lit(unknown)).alias("score"))
    grouped = edges.groupBy("h", "seg").agg(F.sort_array(F.collect_list(edge)).alias("edges"))
    path = "array<struct<start:int,n:int,id:int>>"
    # Edges come by end, then start: all that end at a position come before any that starts there.
    cell = f"struct<score:double,path:{path}>"
    start = F.array(F.struct(F.lit(0.0).alias("score"), F.array().cast(path).alias("path"))).cast(f"array<{cell}>")

    def step(best: Column, e: Column) -> Column:
        before = F.get(best, e["start"])
        here = F.struct((before["score"] + e["score"]).alias("score"), F.concat(
            before["path"], F.array(F.struct(e["start"].alias("start"), e["n"].alias("n"), e["id"].alias("id")))).alias("path")
        ).cast(cell)
        old = F.get(best, e["end"])
        return (F.when(F.size(best) == e["end"], F.concat(best, F.array(here)))
                .when(here["score"] > old["score"], F.concat(F.slice(best, F.lit(1), e["end"]), F.array(here)))
                .otherwise(best))

    folded = F.aggregate("edges", start, step, lambda best: F.element_at(best, -1)["path"])
    return grouped.select("h", "seg", _ids(folded, first_byte).alias("ids"))


def _model_file(path: str) -> bytes:
    with open(path, "rb") as f:  # the model's own file, on the driver
        return f.read()


def learn(docs: DataFrame, proto) -> str:
    """Folder of the dictionary of the segments of ``docs.text``.

    ``proto`` is a broadcast of the model's bytes.
    """
    model = Model.of(proto.value)
    segs = distinct_segments(docs, proto)
    pieces = docs.sparkSession.createDataFrame(model.rows(), PIECES)
    return dictionary.build(fold_bpe(lattice(segs, pieces, model.longest), model.first_byte))


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """``docs`` with ``ids`` (array<int>), the encoding of ``text``; a column of that name is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(_model_file(model_path))
    folder = learn(docs, shared)
    keep = [f for f in docs.schema.fields if f.name != "ids"]
    schema = T.StructType([*keep, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    names = [f.name for f in schema.fields]
    at = [f.name for f in keep].index("text")

    @memory.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, own in _encoded(batches, at, Model.of(shared.value), folder):
            bounds = np.concatenate(([0], np.cumsum([len(x) // 4 for x in own])))
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(np.frombuffer(b"".join(own), "<i4")))
            yield pa.RecordBatch.from_arrays([*part.columns, lists], names)

    return docs.select(*[f.name for f in keep]).mapInArrow(run, schema)


def _encoded(batches, at: int, model: Model, folder: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of batches with the ids of their texts (column ``at``) as little-endian 32-bit integers."""
    memory.begin("pieces", "dictionary")
    known: dict[str, bytes] = {}
    for batch in batches:
        for lo in range(0, batch.num_rows, TEXTS):
            part = batch.slice(lo, TEXTS)
            texts = part.column(at).to_pylist()
            yield part, _looked_up(model, folder, texts, known)


def _looked_up(model: Model, folder: str, texts: list[str | None], known: dict[str, bytes]) -> list[bytes]:
    """ids of texts as bytes; ``known`` keeps the ids of words between calls."""
    split = [words(x) for x in texts]
    new = set().union(*split)
    if len(known) + len(new) > HELD:
        known.clear()
    new = [w for w in new if w not in known]
    long = [w for w in new if len(w) >= MAX_SEGMENT and np.diff(model.segments([w])[1], append=len(w) + 1).max() > MAX_SEGMENT]
    known.update((w, np.array(model.library.encode(w.replace(SPACE, " ")), "<u4").tobytes()) for w in long)
    new = [w for w in new if w not in known] if long else new
    if new:
        keys, starts, ends, bounds = model.segments(new)
        ids, at = dictionary.Lookup.open(folder).encode(ta.segment_hashes(keys, starts, ends), bounds)
        raw, at = ids.astype("<u4").tobytes(), (at * 4).tolist()
        known.update(zip(new, (raw[a:b] for a, b in zip(at, at[1:]))))
    return [b"".join(map(known.__getitem__, x)) for x in split]


def decode(frame: DataFrame, model_path: str) -> DataFrame:
    """``frame`` with ``decoded`` (string), the text of its column ``ids``; null ids give null."""
    shared = frame.sparkSession.sparkContext.broadcast(_model_file(model_path))
    names = [c for c in frame.columns if c != "decoded"]
    schema = T.StructType([*(f for f in frame.schema.fields if f.name in names), T.StructField("decoded", T.StringType())])
    at = names.index("ids")

    @memory.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model.of(shared.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, TEXTS):
                part = batch.slice(lo, TEXTS)
                texts = [None if not v.is_valid else m.text(v.values.to_pylist()) for v in part.column(at)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*names, "decoded"])

    return frame.select(*names).mapInArrow(run, schema)


def round_trip(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, decoded_sha256): texts encoded, and their ids decoded, in one task each."""
    shared = docs.sparkSession.sparkContext.broadcast(_model_file(model_path))
    folder = learn(docs, shared)

    @memory.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model.of(shared.value)
        for part, own in _encoded(batches, 1, m, folder):
            sha = [hashlib.sha256(m.text(np.frombuffer(x, "<u4").tolist()).encode("utf-8")).hexdigest() for x in own]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(x) // 4 for x in own], pa.int64()), pa.array(map(zlib.crc32, own), pa.int64()),
                 pa.array(sha, pa.string())], ["doc_id", "n_tokens", "ids_crc32", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_crc32 long, decoded_sha256 string")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` encoded by the 32k BPE model, and decoded again: digests of both."""
    import public_tokenizers

    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("piece_bpe_32k.model"))
