"""Substring dedup by a count-min prefilter and an exact second pass.

A window is ``WINDOW`` consecutive words of one document.  A word goes if a
window over it also starts earlier: in a smaller ``doc_id``, or in the same
document before.

1. Each task counts its windows into ``DEPTH`` rows of counters and sends the
   counters that it touched; merging adds them up, saturating at 2.  Merged
   counters never fall below a window's count, so no repeated window is lost.
2. A second pass over the texts picks the windows whose counters all say
   "repeated".  Of equal windows a task keeps the earliest and marks the
   others at once, so a passage that very many documents hold reaches the
   exact grouping once per task.
3. The exact grouping finds each window's earliest place among those sent and
   marks the rest.  Marks return to their documents, whose covered words go.

The sketch's width follows the corpus (counted first) up to ``MAX_WIDTH``
counters a row; a fuller sketch only lets more windows into step 2.  Windows
are compared by 64-bit hashes of their words.

Null and empty texts have no words and become the empty string.  Null ids come
after all others.  Rows that share a ``doc_id`` are places of one document:
of two windows that start at the same place of it neither is earlier, so
repeated rows stay alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivalry.llm import memory, packed
from rivalry.llm import textarrays as ta
from rivalry.llm.store import filesystem, map_file, scratch, staged, write_file

WINDOW = 20
DEPTH = 2
#: Counters per row of the sketch: at least, and at most (one bit each in files that tasks map: 128 MB a row).
MIN_WIDTH, MAX_WIDTH = 1 << 20, 1 << 30
#: Counters of a part of a row, merged by one task (two booleans each).
PART = 1 << 23
#: Windows that a task gathers before it sends, and that a grouping task holds on average.
GATHER, GROUP = 2_000_000, 2_000_000
NO_ID = np.iinfo(np.int64).max
_FAR, _SKIP = 0x7FFF, 0xFFFF
_SALT = np.uint64(0xA0761D6478BD642F)
_sketches: dict[str, Sketch] = memory.table("sketches")


def document_windows(cps: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, first word within the row) of every window of a slice."""
    starts, ends, bounds = ta.words(cps, offs)
    h = ta.window_hashes(ta.segment_hashes(cps, starts, ends), k)
    ok = np.flatnonzero(ta.within(k, bounds))
    row = np.searchsorted(bounds, ok, "right") - 1
    return h[ok], row, ok - bounds[row]


def _cells(h: np.ndarray, depth: int, width: int) -> np.ndarray:
    """Counter of each window in a row of the sketch."""
    salt = np.uint64(int(_SALT) * (depth + 1) & ((1 << 64) - 1))
    return ta.mix(h ^ salt) & np.uint64(width - 1)


def _steps(cells: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(part, value) that tell sorted counters by their distances within a part: 15 bits of distance and one of
    "more than once here"; ``_SKIP`` is a distance of ``_FAR`` without a counter."""
    part, place = (cells // np.uint64(PART)).astype(np.int64), (cells % np.uint64(PART)).astype(np.int64)
    step = place.copy()
    step[1:] -= np.where(part[1:] == part[:-1], place[:-1], 0)
    size = step // _FAR + 1
    out = np.full(int(size.sum()), _SKIP, np.uint16)
    out[np.cumsum(size) - 1] = step % _FAR << 1 | more
    return np.repeat(part, size), out


def _places(value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The counters of a part and their "more than once", from the values of ``_steps``."""
    skip = value == _SKIP
    place = np.cumsum(np.where(skip, _FAR, value >> 1).astype(np.int64))
    return place[~skip], (value[~skip] & 1).astype(bool)


def build_sketch(docs: DataFrame, width: int, k: int) -> str:
    """Folder of the merged sketch: per row and part one bit per counter, set if it reached 2."""
    folder = scratch(docs.sparkSession, "sketch")
    parts = max(1, width // PART)

    @memory.tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory.begin("sketches")
        def sent(h: np.ndarray) -> Iterator[pa.RecordBatch]:
            for d in range(DEPTH):
                cells, n = np.unique(_cells(h, d, width), return_counts=True)
                to, value = _steps(cells, n > 1)
                yield packed.pack(to + d * parts, [value], ["cells"])

        gather = packed.Collector(GATHER)
        for batch in batches:
            for _, _, cps, offs in ta.slices(batch.column(0)):
                if gather.add(document_windows(cps, offs, k)[0]):
                    yield from sent(gather.take()[0])
        if gather.size:
            yield from sent(gather.take()[0])

    @memory.tidy
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, own in packed.by_key(batches):
            once, twice = np.zeros(PART, bool), np.zeros(PART, bool)
            for batch in own:
                for raw in batch.column(1).to_pylist():
                    cells, more = _places(np.frombuffer(raw, np.uint16))
                    twice[cells[once[cells] | more]] = True
                    once[cells] = True
            bits = np.packbits(twice, bitorder="little")
            write_file(f"{folder}/{key:05d}.bits", lambda out, bits=bits: out.write(bits.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([int(twice.sum())], pa.int64())], ["n"])

    rows = docs.select("text").mapInArrow(count, packed.schema("cells"))
    tasks = min(parts * DEPTH, max(DEPTH, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    done = rows.repartition(tasks, "to").sortWithinPartitions("to").mapInArrow(merge, "n long")
    done.agg(F.sum("n")).collect()
    return folder


class Sketch:
    """The mapped bits of a merged sketch, by part; a part that no window touched has no file."""

    def __init__(self, folder: str, width: int):
        self.width, parts = width, max(1, width // PART)
        fs, _ = filesystem(folder)
        uris = [[f"{folder}/{p + d * parts:05d}.bits" for p in range(parts)] for d in range(DEPTH)]
        self.rows = [[np.frombuffer(map_file(u), np.uint8) if fs.get_file_info(filesystem(u)[1]).is_file else None
                      for u in row] for row in uris]

    @classmethod
    def of(cls, folder: str, width: int) -> Sketch:
        if folder not in _sketches:
            _sketches.clear()
            _sketches[folder] = cls(folder, width)
        return _sketches[folder]

    def repeated(self, h: np.ndarray) -> np.ndarray:
        """Numbers of the windows that the sketch takes for repeated: all that are, and few more."""
        at = np.arange(len(h))
        for d, row in enumerate(self.rows):
            c = _cells(h[at], d, self.width)
            part = (c // np.uint64(PART)).astype(np.uint16)
            order = np.argsort(part, kind="stable")
            bounds = np.searchsorted(part[order], np.arange(len(row) + 1)).tolist()
            hit = np.zeros(len(c), bool)
            for bits, lo, hi in zip(row, bounds, bounds[1:]):
                if bits is not None and hi > lo:
                    place = (c[order[lo:hi]] % np.uint64(PART)).astype(np.int64)
                    hit[order[lo:hi]] = bits[place >> 3] >> (place & 7).astype(np.uint8) & 1
            at = at[hit]
        return at


def _later(h: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order by window and place, True where the place isn't its window's earliest)."""
    order = np.lexsort((pos, doc, h))
    h, doc, pos = h[order], doc[order], pos[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    first = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    return order, (doc != doc[first][group]) | (pos != pos[first][group])


def marks(docs: DataFrame, k: int = WINDOW) -> DataFrame:
    """(doc, key, starts): per document the first words of its windows that also start earlier.

    ``docs`` has doc (long, not null), key (long; of the row's text) and text.
    """
    spark = docs.sparkSession
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    windows = chars // 5 + 1
    width = min(MAX_WIDTH, max(MIN_WIDTH, 1 << int(4 * windows - 1).bit_length()))
    folder = build_sketch(docs, width, k)
    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), windows // GROUP)

    @memory.tidy
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory.begin("sketches")
        sketch = Sketch.of(folder, width)

        def sent(h, doc, key, pos) -> Iterator[pa.RecordBatch]:
            order, later = _later(h, doc, pos)
            # 0: to the exact grouping; 1: a mark for the document
            a, b = np.sort(order[~later]), np.sort(order[later])
            to = np.concatenate((packed.receivers(h[a], groups), packed.receivers(ta.mix(key[b].view(np.uint64)), groups)
                                 + groups))
            both = np.concatenate((a, b))
            yield packed.pack(to, [h[both], doc[both], key[both], pos[both]], ["h", "doc", "key", "pos"])

        gather = packed.Collector(GATHER)
        for batch in batches:
            doc, key = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for lo, _, cps, offs in ta.slices(batch.column(2)):
                h, row, pos = document_windows(cps, offs, k)
                at = sketch.repeated(h)
                row = row[at] + lo
                if len(at) and gather.add(h[at], doc[row], key[row], pos[at].astype(np.int32)):
                    yield from sent(*gather.take())
        if gather.size:
            yield from sent(*gather.take())

    kinds = {1: np.uint64, 2: np.int64, 3: np.int64, 4: np.int32}

    @memory.tidy
    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for to, own in packed.by_key(batches):
            h, doc, key, pos = packed.unpack(own, kinds)
            if to < groups:
                order, later = _later(h, doc, pos)
                keep = np.sort(order[later])
                doc, key, pos = doc[keep], key[keep], pos[keep]
            dest = packed.receivers(ta.mix(key.view(np.uint64)), groups)
            order = np.lexsort((pos, key, doc))
            yield packed.pack(dest[order], [doc[order], key[order], pos[order]], ["doc", "key", "pos"])

    @memory.tidy
    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, own in packed.by_key(batches):
            doc, key, pos = packed.unpack(own, {1: np.int64, 2: np.int64, 3: np.int32})
            order = np.lexsort((pos, key, doc))
            doc, key, pos = doc[order], key[order], pos[order]
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
            at = np.append(np.flatnonzero(new), len(doc))
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(pos))
            yield pa.RecordBatch.from_arrays([pa.array(doc[at[:-1]]), pa.array(key[at[:-1]]), lists],
                                             ["doc", "key", "starts"])

    # A pass-through for marks made by the second pass: they need no grouping, only to return.
    picked = docs.select("doc", "key", "text").mapInArrow(pick, packed.schema("h", "doc", "key", "pos"))
    grouped = (picked.repartition(groups, F.col("to") % groups).sortWithinPartitions("to")
               .mapInArrow(group, packed.schema("doc", "key", "pos")))
    return (grouped.repartition(groups, "to").sortWithinPartitions("to")
            .mapInArrow(gathered, "doc long, key long, starts array<int>"))


def dedup(docs: DataFrame, k: int = WINDOW) -> DataFrame:
    """(doc_id, text, n_words, n_removed): the words of ``text`` that stay, joined by one space."""
    own = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"),
                      F.xxhash64("doc_id", "text").alias("key"))
    found = staged(marks(own, k), "repeats")
    joined = own.join(found, ["doc", "key"], "left").select("doc_id", "text", "starts")

    @memory.tidy
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            flat, at = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            sizes = np.where(lists.is_valid().to_numpy(zero_copy_only=False), np.diff(at), 0)
            first = np.cumsum(sizes) - sizes
            for lo, hi, cps, offs in ta.slices(batch.column(1)):
                starts, ends, bounds = ta.words(cps, offs)
                n = np.diff(bounds)
                mine = flat[first[lo]:first[hi - 1] + sizes[hi - 1]] + np.repeat(bounds[:-1], sizes[lo:hi])
                change = np.zeros(len(starts) + 1, np.int64)
                np.add.at(change, mine, 1)
                np.add.at(change, mine + k, -1)
                gone = np.cumsum(change[:-1]) > 0
                text, kept = ta.text_of(cps), np.flatnonzero(~gone)
                words = [text[s:e] for s, e in zip(starts[kept].tolist(), ends[kept].tolist())]
                own = np.searchsorted(kept, bounds).tolist()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array([" ".join(words[a:b]) for a, b in zip(own, own[1:])]),
                     pa.array(n, pa.int64()), pa.array(n - np.diff(own), pa.int64())],
                    ["doc_id", "text", "n_words", "n_removed"])

    return joined.mapInArrow(cut, "doc_id long, text string, n_words long, n_removed long")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` without the words of its windows that also start earlier."""
    out = dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


#: Every window is a row and is compared by its words.
ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 19 + 1, 1))) AS p FROM d WHERE len(w) >= 20),
g AS (SELECT doc_id, p, md5(array_to_string(w[p:p + 19], ' ')) AS h FROM s),
f AS (SELECT h, min(struct_pack(d := doc_id, p := p)) AS first FROM g GROUP BY h),
r AS (SELECT DISTINCT g.doc_id, unnest(range(g.p, g.p + 20)) AS i FROM g JOIN f USING (h)
      WHERE f.first.d <> g.doc_id OR f.first.p <> g.p),
l AS (SELECT doc_id, list(i) AS gone FROM r GROUP BY doc_id),
k AS (SELECT d.doc_id, d.w, CASE WHEN l.gone IS NULL THEN d.w
             ELSE list_transform(list_filter(list_zip(d.w, range(1, len(d.w) + 1)), lambda x: NOT list_contains(l.gone, x[2])),
                                 lambda x: x[1]) END AS kept FROM d LEFT JOIN l USING (doc_id))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - len(kept) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256 FROM k
"""
