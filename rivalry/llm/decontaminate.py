"""Benchmark decontamination by pigeonhole edit matching.

Texts and items are normalised (lower case; each run of other characters
than letters, digits and ``_`` is one space).  An item of ``m`` characters
may occur with up to ``k = floor(EDIT_RATE * m)`` edits.  It is split into
``k + 1`` pieces: an occurrence within the budget leaves at least one piece
intact, in or near its place.  An Aho-Corasick automaton over all pieces
finds their exact hits in one pass over a text; each hit gives a window, and
Myers' bit-parallel algorithm finds the smallest edit distance of the item to
any part of it.  An item that is too short for an edit (``k = 0``) must occur
as whole words: its ends are borders of the normalised text's words.

The documents stay where they are read: no shuffle, so documents that share a
passage, however many, cost each its own verification.  The benchmark is the
stated query set; it goes to the tasks in blocks of at most ``BLOCK_CHARS``
characters (whole items), one pass over the texts per block.

Null and empty texts match nothing, and items without a letter or digit match
nothing; null ids are kept as ids; repeated rows give repeated rows; an empty
benchmark or table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from rivalry.llm import memory

#: Edits per character of an item.
EDIT_RATE = 0.08
#: Characters of items that a task holds at once (their automaton takes some 100 bytes a character).
BLOCK_CHARS = 2_000_000
_OTHER = re.compile(r"\W+")


def normalise(text: str | None) -> str:
    return _OTHER.sub(" ", (text or "").lower()).strip()


def pieces(item: str, rate: float = EDIT_RATE) -> list[tuple[int, str]]:
    """(offset, piece) of the k + 1 nearly equal pieces of a normalised item."""
    n = int(rate * len(item)) + 1
    cuts = [i * len(item) // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(pattern: str, text: str, most: int) -> tuple[int, int]:
    """Smallest edit distance of ``pattern`` to any part of ``text``, and the end of the first such part;
    (most + 1, -1) if it is over ``most``.  Bit-parallel: one word of len(pattern) bits per column."""
    m = len(pattern)
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = (m, 0) if m <= most else (most + 1, -1)
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        x = eq | minus
        d0 = ((((x & plus) + plus) ^ plus) | x) & full
        up = (minus | ~(d0 | plus)) & full
        down = plus & d0
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = up << 1 & full  # a part may start anywhere: the top row stays 0
        down = down << 1 & full
        plus = (down | ~(d0 | up)) & full
        minus = up & d0
        if score < best:
            best, end = score, j + 1
    return best, end


class Matcher:
    """Finds a block of items (normalised texts) in normalised texts."""

    def __init__(self, items: list[str], rate: float = EDIT_RATE):
        import ahocorasick

        self.items, self.rate = items, rate
        places: dict[str, list[tuple[int, int]]] = {}
        for n, item in enumerate(items):
            for at, piece in pieces(item, rate) if item else ():
                places.setdefault(piece, []).append((n, at))
        self.tree = ahocorasick.Automaton()
        for piece, at in places.items():
            self.tree.add_word(piece, (len(piece), at))
        if places:
            self.tree.make_automaton()
        self.any = bool(places)

    def find(self, text: str) -> list[tuple[int, int, int]]:
        """(item number, smallest distance, end in ``text``) of each item that occurs within its budget."""
        if not self.any or not text:
            return []
        windows, framed = {}, f" {text} "
        for last, (n, places) in self.tree.iter(text):
            for item, at in places:
                windows.setdefault(item, set()).add(last + 1 - n - at)
        found = []
        for item, starts in windows.items():
            pattern = self.items[item]
            m, k = len(pattern), int(self.rate * len(pattern))
            best, end = k + 1, -1
            if not k:  # whole words: blanks or the text's ends beside them
                starts = {s for s in starts if s >= 0 and framed.startswith(f" {pattern} ", s)}
                if not starts:
                    continue
            for s in starts:
                if s >= 0 and text.startswith(pattern, s):
                    best, end = 0, min(s + m, end) if best == 0 else s + m
            if best:
                lo = hi = None
                for s in sorted(starts):  # windows that overlap are one
                    a, b = max(0, s - k), s + m + k
                    if hi is not None and a <= hi:
                        hi = max(hi, b)
                        continue
                    if hi is not None:
                        best, end = min((best, end), self._verify(pattern, text, lo, hi, k))
                    lo, hi = a, b
                best, end = min((best, end), self._verify(pattern, text, lo, hi, k))
            if best <= k:
                found.append((item, best, end))
        return sorted(found)

    @staticmethod
    def _verify(pattern: str, text: str, lo: int, hi: int, k: int) -> tuple[int, int]:
        d, end = myers(pattern, text[lo:max(lo, hi)], k)
        return d, lo + end if end >= 0 else -1


def item_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int | None, str]]]:
    """Blocks of (item_id, normalised text), streamed through the driver one partition at a time."""
    block, held = [], 0
    for r in benchmark.select("item_id", "text").toLocalIterator():
        item = normalise(r.text)
        if not item:
            continue
        if block and held + len(item) > block_chars:
            yield block
            block, held = [], 0
        block.append((r.item_id, item))
        held += len(item)
    if block:
        yield block


def leaks(docs: DataFrame, benchmark: DataFrame, rate: float = EDIT_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, distance, end_char): the benchmark items that each document holds within their budgets."""
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, distance int, end_char long"
    out = None
    for block in item_blocks(benchmark, block_chars):
        part = docs.select("doc_id", "text").mapInArrow(_finder(spark, block, rate), schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], schema)


def _finder(spark: SparkSession, block, rate: float):
    items = spark.sparkContext.broadcast(block)  # at most BLOCK_CHARS characters
    cache: list[Matcher] = []

    @memory.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory.begin()
        if not cache:
            cache.append(Matcher([t for _, t in items.value], rate))
        ids = [i for i, _ in items.value]
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows += [(doc_id, ids[n], d, end) for n, d, end in cache[0].find(normalise(text))]
            cols = list(zip(*rows)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int64()))],
                ["doc_id", "item_id", "distance", "end_char"])

    return run


def clean(docs: DataFrame, benchmark: DataFrame, rate: float = EDIT_RATE) -> DataFrame:
    """Rows of ``docs`` that hold no benchmark item; judged row by row, all columns kept."""
    spark = docs.sparkSession
    keep = docs
    for block in item_blocks(benchmark):
        keep = keep.mapInArrow(_keeper(spark, block, rate, docs.columns.index("text")), docs.schema)
    return keep


def _keeper(spark: SparkSession, block, rate: float, at: int):
    items = spark.sparkContext.broadcast([t for _, t in block])
    cache: list[Matcher] = []

    @memory.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory.begin()
        if not cache:
            cache.append(Matcher(items.value, rate))
        for batch in batches:
            yield batch.filter(pa.array([not cache[0].find(normalise(x)) for x in batch.column(at).to_pylist()],
                                        pa.bool_()))

    return run


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that the documents hold, with their edit distances."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
