"""Alignment of two tokenizers' tokens by byte offsets: an associative monoid of fragments.

Both encode ``" " + text``; groups are cut where a token of A and a token of B
end at one byte.  A *fragment* describes a byte range: the tokens that end in
it up to its first common end (the open prefix), the groups between its
common ends (closed), and the tokens after its last one (the open suffix).
Two neighbours compose: the left one's suffix and the right one's prefix are
one group more, or stay open where a side has no common end.  Composition is
associative, so the ranges of a very long text are aligned in different tasks
and reduced as a tree, ``FAN`` at a time; closed groups stay where they were
made, and only open ends travel.  A text of up to ``LONG`` characters is one
fragment with nothing open, and is not shuffled.

Texts are encoded by words, each distinct word of a task once: a lone space
between two characters that are no white space starts a token in both
tokenizers (the models are checked for that on loading).  A range is encoded
with what surrounds it up to such spaces, and keeps the tokens that end in it.

Links are the pairs of A and B occurrences of a group.  A unit of about
``UNIT`` characters keeps, per document, numbers into the list of its distinct
id pairs, and sends each pair once with the number of its documents.  The
receivers (dealt by A id) add them up, find each A id's greatest count and
answer the units; so a pair that every document holds is a record per unit.

Defined cases: null and empty texts, and texts whose tokens don't join to
``" " + text`` on either side (U+2581 in a text), have zeros and an empty
digest; repeated rows and ids, null ids among them, are documents each; other
columns are not read; an empty table gives no rows.  A group's links are
formed in one task, as its distinct id pairs.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivalry.llm import memory, packed
from rivalry.llm.sentencepiece_lattice import Model
from rivalry.llm.store import staged
from rivalry.llm.textarrays import flat_ranges

#: Characters of a text that is cut into ranges, bytes of a range, and fragments that one step of the tree composes.
LONG, RANGE, FAN = 1 << 16, 1 << 15, 8
#: Characters encoded at a time, and of a unit; words a task holds before it starts anew; links expanded one by one.
SLICE, UNIT, HELD, PLAIN = 1 << 19, 1 << 22, 150_000, 1 << 12
_CUT = re.compile(r"(?<=\S) (?=\S)")
_aligners: dict[int, Aligner] = memory.table("aligners")


def byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, the rest from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in own]
    return {**{chr(b): b for b in own}, **{chr(256 + k): b for k, b in enumerate(rest)}}


class Aligner:
    """Two tokenizers and the words that a task has encoded."""

    def __init__(self, json_text: str, proto: bytes):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a, self.b = Tokenizer.from_str(json_text), Model.of(proto)
        self.a.encode_special_tokens = True
        chars, special = byte_level(), {t.content for t in self.a.get_added_tokens_decoder().values()}
        vocab = {i: t for t, i in self.a.get_vocab().items()}
        self.bytes_a = [b""] * (max(vocab) + 1)
        for i, t in vocab.items():
            if t not in special:
                self.bytes_a[i] = bytes(map(chars.__getitem__, t))
        probe = ["x", "1", ".", "é", "漢", "'s", "_", "x.", "\x00"]
        for left in probe:  # a lone space starts a token whatever stands beside it
            for right in probe:
                whole = self.a.encode(f" {left} {right}", add_special_tokens=False).ids
                if whole != [i for x in (left, right) for i in self.a.encode(f" {x}", add_special_tokens=False).ids]:
                    raise ValueError("the byte-level model joins text across a space")
                if b"".join(map(self.bytes_a.__getitem__, whole)) != f" {left} {right}".encode():
                    raise ValueError("the byte-level model must leave texts as they are")
        self.bytes_b = self.b.decoded
        self.len_a, self.len_b = (np.array(list(map(len, t)), np.int64) for t in (self.bytes_a, self.bytes_b))
        n = max(len(self.len_a), len(self.len_b))
        self.width = n
        self.parts = np.array([f"{mark}{i}" for mark in ",|;" for i in range(n)], object)
        self.forget()

    @classmethod
    def of(cls, json_text: str, proto: bytes) -> Aligner:
        key = hash((json_text, proto))
        if key not in _aligners:
            _aligners[key] = cls(json_text, proto)
        return _aligners[key]

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = [np.zeros(0, np.int32), np.zeros(0, np.int32)]
        self.offs = [np.zeros(1, np.int64), np.zeros(1, np.int64)]
        self.fine = np.zeros(0, bool)

    def learn(self, words: list[str]) -> None:
        """Encode new words."""
        both = [[x.ids for x in self.a.encode_batch_fast([f" {w}" for w in words], add_special_tokens=False)],
                self.b.library.encode(words, num_threads=1)]
        fine = [b"".join(map(self.bytes_a.__getitem__, a)) == raw == b"".join(map(self.bytes_b.__getitem__, b))
                for a, b, raw in zip(*both, (f" {w}".encode() for w in words))]
        self.fine = np.concatenate((self.fine, np.array(fine, bool)))
        for k, lists in enumerate(both):
            self.ids[k] = np.concatenate((self.ids[k], np.array([i for x in lists for i in x], np.int32)))
            ends = self.offs[k][-1] + np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)))
            self.offs[k] = np.concatenate((self.offs[k], ends))
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words))))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """Which texts have tokens; ids of A and B of those, one after the other; and each side's offsets by text."""
        if len(self.known) > HELD:
            self.forget()
        words = [_CUT.split(t) if t else [] for t in texts]
        new = {w for own in words for w in own if w not in self.known}
        if new:
            self.learn(sorted(new))
        known = self.known
        at = np.array([known[w] for own in words for w in own], np.int64)
        count = np.fromiter(map(len, words), np.int64, len(words))
        row = np.repeat(np.arange(len(words)), count)
        fine = count > 0
        fine[row[~self.fine[at]]] = False
        at, row = at[fine[row]], row[fine[row]]
        ids, offs = [], []
        for k in (0, 1):
            n = self.offs[k][at + 1] - self.offs[k][at]
            ids.append(self.ids[k][flat_ranges(self.offs[k][at], n)])
            offs.append(np.concatenate(([0], np.cumsum(np.bincount(row, n, len(texts)).astype(np.int64)))))
        return fine, ids, offs

    def ends(self, ids: list[np.ndarray]) -> list[np.ndarray]:
        """Byte offsets at which the tokens end."""
        return [np.cumsum(size[x]) for size, x in zip((self.len_a, self.len_b), ids)]

    def text(self, ids: list[np.ndarray], sizes: list[np.ndarray]) -> list[str]:
        """The pieces of ``;a1,a2|b1``... of groups in order: one string per id."""
        first = np.cumsum(sizes[0] + sizes[1]) - sizes[0] - sizes[1]
        codes = np.zeros(len(ids[0]) + len(ids[1]), np.int64)
        for k, start in ((0, first), (1, first + sizes[0])):
            codes[flat_ranges(start, sizes[k])] = ids[k]
        codes[first] += 2 * self.width
        codes[first + sizes[0]] += self.width
        return self.parts[codes].tolist()


def common(ends: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Byte offsets where tokens of both sides end, and the number of tokens of each side that end there or before."""
    a, b = ends
    if not len(a) or not len(b):
        return np.zeros(0, np.int64), [np.zeros(0, np.int64)] * 2
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    cut = np.flatnonzero(b[at] == a)
    return a[cut], [cut + 1, at[cut] + 1]


def links(ids: list[np.ndarray], sizes: list[np.ndarray], row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, pair code a << 32 | b, occurrences) of the links of groups; codes of one row may repeat."""
    n = sizes[0] * sizes[1]
    starts = [np.cumsum(s) - s for s in sizes]
    plain = n <= PLAIN
    s = [x[plain] for x in (*starts, *sizes)]
    a_at = flat_ranges(s[0], s[2])
    owner = np.repeat(np.arange(len(s[0])), s[2])
    codes = (np.repeat(ids[0][a_at], s[3][owner]).astype(np.int64) << 32) | ids[1][flat_ranges(s[1][owner], s[3][owner])]
    out = [(np.repeat(row[plain], n[plain]), codes, np.ones(len(codes), np.int64))]
    for g in np.flatnonzero(~plain).tolist():
        (a, ca), (b, cb) = (np.unique(ids[k][starts[k][g]:starts[k][g] + sizes[k][g]], return_counts=True) for k in (0, 1))
        codes = ((a.astype(np.int64) << 32)[:, None] | b).ravel()
        out.append((np.full(len(codes), row[g]), codes, np.outer(ca, cb).ravel()))
    return tuple(np.concatenate(x) for x in zip(*out))


def distinct(row: np.ndarray, codes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs, and per distinct (row, pair): row, number of the pair, occurrences."""
    pairs, at = np.unique(codes, return_inverse=True)
    key, back = np.unique(row * max(1, len(pairs)) + at, return_inverse=True)
    return pairs, key // max(1, len(pairs)), key % max(1, len(pairs)), np.bincount(back, times, len(key)).astype(np.int64)


#: Rows of a document (or of a part of a long one's pairs), and of the pairs that a unit sends.
_COLS = {"doc_id": pa.int64(), "long_key": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(),
         "n_links": pa.int64(), "groups_sha256": pa.string(), "unit": pa.int64(), "at": pa.binary(), "times": pa.binary(),
         "to": pa.int32(), "pairs": pa.binary(), "held": pa.binary()}
_ROWS = ("doc_id long, long_key long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, unit long, "
         "at binary, times binary, to int, pairs binary, held binary")


def _rows(n: int, **given) -> pa.RecordBatch:
    """``n`` rows of ``_ROWS`` with the given columns; the others are null."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c := given.get(name), pa.Array) else pa.nulls(n, kind) if c is None else pa.array(c, kind)
         for name, kind in _COLS.items()], list(_COLS))


class Units:
    """Gathers documents with their pairs and hands them over unit by unit."""

    def __init__(self, receivers: int, first: int = 0):
        self.receivers, self.held, self.size = receivers, [], 0
        self.number = (first + TaskContext.get().partitionId()) << 24

    def add(self, size: int, rows: dict, n: int, found: tuple) -> Iterator[pa.RecordBatch]:
        """``n`` rows with their columns and ``distinct`` pairs, of ``size`` characters."""
        self.held.append((rows, n, found))
        self.size += size
        if self.size >= UNIT:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        pairs = np.unique(np.concatenate([found[0] for *_, found in self.held]))
        docs = np.zeros(len(pairs), np.int64)
        for rows, n, (own, row, at, times) in self.held:
            at = np.searchsorted(pairs, own)[at].astype(np.int32)
            docs += np.bincount(at, minlength=len(pairs))
            cuts = np.searchsorted(row, np.arange(n + 1)).tolist()
            cols = {name: [x[a:z].tobytes() for a, z in zip(cuts, cuts[1:])] for name, x in (("at", at), ("times", times))}
            yield _rows(n, unit=np.full(n, self.number), **cols, **rows)
        if len(pairs):
            to = packed.receivers(_hash(pairs >> 32), self.receivers)
            sent = packed.pack(to, [np.arange(len(pairs), dtype=np.int32), pairs, docs], ["at", "pairs", "held"])
            yield _rows(sent.num_rows, unit=np.full(sent.num_rows, self.number),
                        **{name: sent.column(name) for name in sent.schema.names})
        self.number, self.held, self.size = self.number + 1, [], 0


def _hash(x: np.ndarray) -> np.ndarray:
    h = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    return h * np.uint64(0xBF58476D1CE4E5B9)


def _slices(texts: pa.Array) -> Iterator[list[str | None]]:
    """Consecutive texts of about ``SLICE`` characters."""
    own, size = [], 0
    for t in texts.to_pylist():
        own.append(t)
        size += len(t or "")
        if size >= SLICE:
            yield own
            own, size = [], 0
    if own:
        yield own


def short(docs: DataFrame, models, receivers: int) -> DataFrame:
    """``_ROWS`` of texts that are one fragment each, made where they are read."""

    @memory.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory.begin("aligners", "pieces")
        aligner, units = Aligner.of(*models.value), Units(receivers)
        for batch in batches:
            lo = 0
            for texts in _slices(batch.column(1)):
                n = len(texts)
                fine, ids, offs = aligner.encode(texts)
                ends = aligner.ends(ids)
                _, at = common(ends)
                sizes = [np.diff(x, prepend=0) for x in at]
                row = np.searchsorted(offs[0], at[0] - 1, "right") - 1 if len(at[0]) else at[0]
                groups = np.bincount(row, minlength=n)
                parts, cuts = aligner.text(ids, sizes), (offs[0] + offs[1]).tolist()
                digests = [hashlib.sha256("".join(parts[a:z])[1:].encode()).hexdigest() if z > a else ""
                           for a, z in zip(cuts, cuts[1:])]
                rows = {"doc_id": batch.column(0).slice(lo, n), "n_a": np.diff(offs[0]), "n_b": np.diff(offs[1]),
                        "n_groups": groups, "n_links": np.bincount(row, sizes[0] * sizes[1], n).astype(np.int64),
                        "groups_sha256": digests}
                yield from units.add(sum(len(t or "") for t in texts), rows, n, distinct(*links(ids, sizes, row)))
                lo += n
        yield from units.flush()

    return docs.mapInArrow(run, _ROWS)


_WINDOW = "doc_id long, long_key long, k long, base long, cuts array<long>, text string"


def windows(docs: DataFrame) -> DataFrame:
    """Byte ranges of long texts, each with the text that its tokens need: from the last lone space before it to the first
    after it (``base``: the byte that this text starts at; ``cuts``: the range's borders).  Ranges without a lone space
    between them stay together, so that no text is encoded more than about twice."""
    keyed = staged(docs.withColumn("long_key", F.monotonically_increasing_id()), "long-texts")

    @memory.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text, key in zip(*(batch.column(c).to_pylist() for c in range(3))):
                cps = np.frombuffer(text.encode("utf-32-le"), np.uint32)
                at = np.cumsum(1 + (cps > 0x7F) + (cps > 0x7FF) + (cps > 0xFFFF).astype(np.int64))  # bytes to the end of each
                size = int(at[-1]) + 1  # with the space before the text
                spaces = np.array([0, *(m.start() + 1 for m in _CUT.finditer(text))])  # places in " " + text
                place = np.concatenate(([0], at[spaces[1:] - 1]))
                borders = [*range(0, size, RANGE), size]
                lo = 0
                while lo < len(borders) - 1:
                    hi = lo + 1
                    while hi < len(borders) - 1 and not (place[np.searchsorted(place, borders[hi], "right") - 1] > borders[hi - 1]):
                        hi += 1
                    first = int(np.searchsorted(place, borders[lo], "right")) - 1
                    last = int(np.searchsorted(place, borders[hi], "left"))
                    end = int(spaces[last]) - 1 if last < len(spaces) else len(text)
                    row = ([doc], [key], [lo], [int(place[first])], [borders[lo:hi + 1]], [text[int(spaces[first]):end]])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, kind) for c, kind in zip(row, (pa.int64(), pa.int64(), pa.int64(), pa.int64(),
                                                                    pa.list_(pa.int64()), pa.string()))],
                        ["doc_id", "long_key", "k", "base", "cuts", "text"])
                    lo = hi

    return keyed.select("doc_id", "text", "long_key").mapInArrow(run, _WINDOW)


#: A fragment (``groups`` false) or closed groups: tokens up to the first common end or all, and those after the last;
#: ``k`` is the range of the first common end, ``sizes_a/b`` the sizes of closed groups.
_FRAGMENT = ("doc_id long, long_key long, k long, groups boolean, cut long, fine boolean, n_a long, n_b long, "
             "a binary, b binary, after_a binary, after_b binary")
_FRAGMENT_NAMES = [c.split()[0] for c in _FRAGMENT.split(", ")]


class Fragment:
    """What a byte range knows of its groups; ``cut`` is the range of its first common end, None if it has none."""

    def __init__(self, cut, before, after, fine=True, count=(0, 0)):
        self.cut, self.before, self.after, self.fine, self.count = cut, before, after, fine, count

    def then(self, right: Fragment) -> tuple[Fragment, tuple | None]:
        """The fragment of both ranges, and the group that their borders close: (its range, tokens of A and B)."""
        fine, count = self.fine and right.fine, tuple(map(sum, zip(self.count, right.count)))
        if self.cut is None:
            before = [x + y for x, y in zip(self.before, right.before)]
            return Fragment(right.cut, before, right.after, fine, count), None
        after = [x + y for x, y in zip(self.after, right.before)]
        if right.cut is None:
            return Fragment(self.cut, self.before, after, fine, count), None
        return Fragment(self.cut, self.before, right.after, fine, count), (right.cut, after)

    def row(self, doc, key, k) -> tuple:
        return (doc, key, k, False, self.cut, self.fine, *self.count, *self.before, *self.after)


def _group_rows(doc, key, made: list[tuple]) -> list[tuple]:
    """Groups that borders closed, as rows that stand before the closed groups of the range that they end in."""
    return [(doc, key, 2 * k, True, None, True, len(a) // 4, len(b) // 4, a, b,
             np.array([len(a) // 4], np.int32).tobytes(), np.array([len(b) // 4], np.int32).tobytes()) for k, (a, b) in made]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), *[pa.binary()] * 4]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], _FRAGMENT_NAMES)


def fragments(found: DataFrame, models) -> DataFrame:
    """Fragments and closed groups (``_FRAGMENT``) of windows; ranges of one window are composed here."""

    @memory.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner.of(*models.value)
        for batch in batches:
            for doc, key, k, base, cuts, text in zip(*(batch.column(c).to_pylist() for c in range(6))):
                fine, ids, _ = aligner.encode([text])
                if not fine[0]:
                    yield _batch([Fragment(None, [b"", b""], [b"", b""], False).row(doc, key, k)])
                    continue
                ends = [base + x for x in aligner.ends(ids)]
                whole, made = None, []
                for r, (lo, hi) in enumerate(zip(cuts, cuts[1:]), k):
                    at = [np.searchsorted(x, (lo, hi), "right") for x in ends]
                    own = [x[s[0]:s[1]] for x, s in zip(ids, at)]
                    _, n = common([x[s[0]:s[1]] for x, s in zip(ends, at)])
                    count = tuple(map(len, own))
                    if len(n[0]):
                        one = Fragment(r, [x[:c[0]].tobytes() for x, c in zip(own, n)], [x[c[-1]:].tobytes() for x, c in zip(own, n)],
                                       count=count)
                        sizes = [np.diff(c).astype(np.int32) for c in n]
                        if len(sizes[0]):
                            yield _batch([(doc, key, 2 * r + 1, True, None, True, int(sizes[0].sum()), int(sizes[1].sum()),
                                           *(x[c[0]:c[-1]].tobytes() for x, c in zip(own, n)), *(s.tobytes() for s in sizes))])
                    else:
                        one = Fragment(None, [x.tobytes() for x in own], [b"", b""], count=count)
                    if whole is None:
                        whole = one
                    else:
                        whole, group = whole.then(one)
                        made += [group] if group else []
                yield _batch([whole.row(doc, key, k), *_group_rows(doc, key, made)])

    return found.mapInArrow(run, _FRAGMENT)


def _composed(batches: Iterator[pa.RecordBatch], step: int) -> Iterator[pa.RecordBatch]:
    """Fragments sorted by (long_key, k), each run of equal ``k div step`` composed."""
    at, whole, made = None, None, []

    def done() -> pa.RecordBatch:
        doc, key, k = at
        return _batch([whole.row(doc, key, k * step), *_group_rows(doc, key, made)])

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            doc, key, k, _, cut, fine, n_a, n_b, a, b, after_a, after_b = row
            one, here = Fragment(cut, [a, b], [after_a, after_b], fine, (n_a, n_b)), (doc, key, k // step)
            if at is not None and here[1:] == at[1:]:
                whole, group = whole.then(one)
                made += [group] if group else []
                continue
            if at is not None:
                yield done()
            at, whole, made = here, one, []
    if at is not None:
        yield done()


def reduced(made: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(one fragment per document, all closed groups) of fragments, by a tree whose steps are shuffles of open ends."""
    last = made.agg(F.max("k")).first()[0] or 0
    groups, now, step = made.filter("groups"), made.filter("NOT groups"), FAN
    while True:
        def compose(batches, step=step):
            return _composed(batches, step)

        dealt = now.repartition("long_key", F.floor(F.col("k") / F.lit(step))).sortWithinPartitions("long_key", "k")
        done = staged(dealt.mapInArrow(compose, _FRAGMENT), "composed")
        groups, now = groups.unionByName(done.filter("groups")), done.filter("NOT groups")
        if step > last:
            return now, groups
        step *= FAN


def closed(a: bytes, b: bytes, sizes_a: bytes, sizes_b: bytes) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Ids and sizes of the groups of a row; a row without sizes is one group."""
    ids = [np.frombuffer(x, np.int32) for x in (a, b)]
    return ids, [np.frombuffer(x, np.int32).astype(np.int64) if x else np.array([len(own)]) for x, own in zip((sizes_a, sizes_b), ids)]


def digests(groups: DataFrame, models, parts: int) -> DataFrame:
    """(long_key, n_groups, n_links, groups_sha256): the groups' rows stream by in order, none is held."""
    names = ["long_key", "n_groups", "n_links", "groups_sha256"]

    @memory.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, key, h, n, of = Aligner.of(*models.value), None, None, 0, 0
        for batch in batches:
            for own, *row in zip(*(batch.column(c).to_pylist() for c in (0, 2, 3, 4, 5))):
                ids, sizes = closed(*row)
                text = "".join(aligner.text(ids, sizes))
                if own != key:
                    if key is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (key, n, of, h.hexdigest())], names)
                    key, h, n, of, text = own, hashlib.sha256(), 0, 0, text[1:]
                h.update(text.encode())
                n, of = n + len(sizes[0]), of + int((sizes[0] * sizes[1]).sum())
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (key, n, of, h.hexdigest())], names)

    ordered = (groups.select("long_key", "k", "a", "b", "after_a", "after_b").repartition(parts, "long_key")
               .sortWithinPartitions("long_key", "k"))
    return ordered.mapInArrow(run, "long_key long, n_groups long, n_links long, groups_sha256 string")


def long_pairs(groups: DataFrame, receivers: int) -> DataFrame:
    """``_ROWS`` of the distinct pairs of long texts; a text's pairs may stand in several rows, each pair in one."""

    @memory.tidy
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, *row in zip(*(c.to_pylist() for c in batch.columns)):
                ids, sizes = closed(*row)
                pairs, _, at, times = distinct(*links(ids, sizes, np.zeros(len(sizes[0]), np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), key)), pa.array(pairs[at]), pa.array(times)],
                                                 ["long_key", "code", "times"])

    @memory.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units(receivers, 1 << 24)
        for batch in batches:
            if batch.num_rows:
                key, code, times = (c.to_numpy() for c in batch.columns)
                keys, row = np.unique(key, return_inverse=True)
                yield from units.add(4 * len(key), {"long_key": keys}, len(keys), distinct(row, code, times))
        yield from units.flush()

    each = groups.select("long_key", "a", "b", "after_a", "after_b").mapInArrow(found, "long_key long, code long, times long")
    return each.groupBy("long_key", "code").agg(F.sum("times").alias("times")).mapInArrow(run, _ROWS)


def answers(rows: DataFrame, receivers: int) -> DataFrame:
    """(unit, at, total, best): for the pairs of each unit, in how many documents they are, and whether that is their A id's most."""
    sent = rows.filter("to IS NOT NULL").select("to", "unit", "at", "pairs", "held")

    @memory.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, own in packed.by_key(batches):
            held = [row for b in own for row in zip(*(b.column(c).to_pylist() for c in (1, 2, 3, 4)))]
            size = np.array([len(p) // 8 for _, _, p, _ in held])
            pairs, docs = (np.frombuffer(b"".join(r[c] for r in held), np.int64) for c in (2, 3))
            codes, at = np.unique(pairs, return_inverse=True)
            total = np.bincount(at, docs, len(codes)).astype(np.int64)
            first = np.flatnonzero(np.diff(codes >> 32, prepend=-1))
            most = np.repeat(np.maximum.reduceat(total, first), np.diff(np.append(first, len(codes))))
            total, best = total[at], (total == most)[at].astype(np.uint8)
            cuts = np.concatenate(([0], np.cumsum(size))).tolist()
            for lo in range(0, len(held), 256):
                part = range(lo, min(lo + 256, len(held)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([held[i][0] for i in part], pa.int64()), pa.array([held[i][1] for i in part], pa.binary()),
                     *(pa.array([x[cuts[i]:cuts[i + 1]].tobytes() for i in part], pa.binary()) for x in (total, best))],
                    ["unit", "at", "total", "best"])

    return (sent.repartition(receivers, "to").sortWithinPartitions("to")
            .mapInArrow(run, "unit long, at binary, total binary, best binary"))


_KEPT = ["doc_id", "long_key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def counted(rows: DataFrame, receivers: int) -> DataFrame:
    """``rows`` of documents with n_best and count_sum, from the answers to their units."""
    told = answers(rows, receivers).select(
        "unit", *(F.lit(None).cast(t).alias(c) for c, t in rows.select(_KEPT).dtypes), "at", F.col("total").alias("times"), "best")
    docs = rows.filter("to IS NULL").select("unit", *_KEPT, "at", "times", F.lit(None).cast("binary").alias("best"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = told.unionByName(docs).repartition(parts, "unit").sortWithinPartitions("unit", F.col("best").isNull())
    names = [*_KEPT, "n_best", "count_sum"]

    @memory.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, total, best = None, None, None
        for own, parts in packed.by_key(batches):
            for b in parts:
                if own != unit:
                    unit, total, best = own, np.zeros(0, np.int64), np.zeros(0, np.int64)
                split = b.num_rows - b.column("best").null_count  # answers come first
                for at, count, top in zip(*(b.column(c).slice(0, split).to_pylist() for c in ("at", "times", "best"))):
                    at = np.frombuffer(at, np.int32)
                    if at[-1] >= len(total):
                        grow = max(2 * len(total), int(at[-1]) + 1) - len(total)
                        total, best = np.pad(total, (0, grow)), np.pad(best, (0, grow))
                    total[at], best[at] = np.frombuffer(count, np.int64), np.frombuffer(top, np.uint8)
                docs = b.slice(split)
                if not docs.num_rows:
                    continue
                held = docs.column("at").to_pylist()
                at = np.frombuffer(b"".join(held), np.int32)
                times = np.frombuffer(b"".join(docs.column("times").to_pylist()), np.int64)
                cuts = np.concatenate(([0], np.cumsum([len(x) // 4 for x in held])))
                sums = []
                for x in (times * best[at], times * total[at]):
                    x = np.concatenate(([0], np.cumsum(x)))
                    sums.append(pa.array(x[cuts[1:]] - x[cuts[:-1]]))
                yield pa.RecordBatch.from_arrays([*(docs.column(c) for c in _KEPT), *sums], names)

    return met.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in rows.select(_KEPT).dtypes) + ", n_best long, count_sum long")


COUNTS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def align(docs: DataFrame, json_path: str, model_path: str) -> DataFrame:
    """One row per document (doc_id, text): doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    with open(json_path, encoding="utf-8") as a, open(model_path, "rb") as b:  # the tokenizers' own files, on the driver
        models = spark.sparkContext.broadcast((a.read(), b.read()))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    is_long = F.coalesce(F.length("text") > LONG, F.lit(False))
    ranges = windows(docs.filter(is_long)).repartition(parts, "long_key", "k")
    whole, groups = reduced(staged(fragments(ranges, models), "fragments"))
    whole = whole.select("doc_id", "long_key", (F.col("fine") & F.col("cut").isNotNull()).alias("fine"), "n_a", "n_b", "cut", "a", "b")
    fine = whole.filter("fine")
    none = F.lit(b"")
    opening = fine.select("long_key", (2 * F.col("cut")).alias("k"), "a", "b", none.alias("after_a"), none.alias("after_b"))
    own = ["long_key", "k", "a", "b", "after_a", "after_b"]  # a text's start is a common end: its prefix is a group
    groups = groups.select(own).unionByName(opening).join(fine.select("long_key"), "long_key", "left_semi").select(own)
    rows = staged(short(docs.filter(~is_long), models, parts).unionByName(long_pairs(groups, parts)), "pairs")
    done = counted(rows, parts)
    sums = done.filter("long_key IS NOT NULL").groupBy("long_key").agg(*(F.sum(c).alias(c) for c in ("n_best", "count_sum")))
    rest = (whole.select("doc_id", "long_key", *(F.when(F.col("fine"), F.col(c)).alias(c) for c in ("n_a", "n_b")))
            .join(digests(groups, models, parts), "long_key", "left").join(sums, "long_key", "left"))
    out = done.filter("long_key IS NULL").drop("long_key").unionByName(rest.drop("long_key"))
    return out.select("doc_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS),
                      F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` by the byte-level (A) and the piece (B) vocabulary."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
