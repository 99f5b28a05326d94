"""Language identification by cross-parsing entropy.

Per language, a suffix automaton holds labelled text.  A text is parsed
greedily into the longest phrases that occur in a language's text; the fewer
phrases per letter, the better the language describes it.  Counts are
normalised by log2 of each language's amount of text, so that languages with
more of it have no advantage; the language of the smallest value wins (ties:
the smaller name).

Words are runs of letters, lower-cased; phrases begin and end within a word
and its borders.  All words of a slice of texts walk an automaton together,
one letter per step, by array operations: its transitions and the restarts
after a phrase are one table.

The labelled text is a bounded sample, as the parameters say: whole texts of
at most ``SAMPLE_ROWS`` rows per language, of which the ``SAMPLE_WORDS`` most
frequent words of at most ``WORD_LETTERS`` letters are kept.  Every label with
such words is learned; every text is predicted whole, by all of them.

A worker holds the tables of up to ``HELD`` languages.  If there are more, each
automaton is built once, by a task, into a flat file of the shared folder, and
workers spread one table at a time over some slices of texts, of whose values
they keep the two smallest.

Null and empty texts and texts without a letter are ``und`` with score 0, as
is every text if no labelled row exists.  Score: the runner-up's value in
proportion to the sum of both (1 if there is one language).  Rows that repeat
are predicted alike; a null id trains nothing and isn't held out.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivalry.functions.joins import checked_broadcast
from rivalry.llm import memory
from rivalry.llm import textarrays as ta
from rivalry.llm.store import map_file, scratch, write_file

UNKNOWN = "und"
#: Bounds of the labelled sample of a language.
SAMPLE_ROWS, SAMPLE_WORDS, WORD_LETTERS = 400, 4000, 40
SPARE = 4
#: Languages whose tables (some 50 MB each) a worker holds; of more, one at a time meets so many slices of texts.
HELD, SLICES = 4, 8
#: Letters with a class of their own; the others share the classes above by code point.
LETTERS, SHARED = 200, 50
_held: dict[str, list[np.ndarray]] = memory.table("languages")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame) -> dict[str, list[str]]:
    """Words per language from a bounded sample of the labelled rows (doc_id, text, lang) that aren't held out."""
    rows = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull()
                       & ~held_out(F.col("doc_id")))
    # A language's sample is its rows of least hash; a bound on the hash, from its count, lets about SPARE samples
    # through, so that what meets in the window doesn't grow with the input.
    part = F.lit(float(SPARE * SAMPLE_ROWS)) / F.col("count")
    bound = F.when(part < 1, (F.lit(-float(1 << 63)) + part * float((1 << 64) - 2048)).cast("long")).otherwise((1 << 63) - 1)
    least = checked_broadcast(rows.groupBy("lang").count().select(F.col("lang").alias("_lang"), bound.alias("_least")))
    w = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    sample = (rows.select("lang", "doc_id", "text").join(least, F.col("lang") == F.col("_lang"))
              .filter(F.xxhash64("doc_id") <= F.col("_least")).select("lang", "doc_id", "text")
              .withColumn("n", F.row_number().over(w)).filter(F.col("n") <= SAMPLE_ROWS))
    words = sample.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("word"))
    counts = words.filter(F.length("word") <= WORD_LETTERS).groupBy("lang", "word").count()
    w = Window.partitionBy("lang").orderBy(F.desc("count"), "word")
    kept = counts.withColumn("n", F.row_number().over(w)).filter(F.col("n") <= SAMPLE_WORDS)
    out: dict[str, list[str]] = {}
    for r in kept.orderBy("lang", "n").collect():  # SAMPLE_WORDS words of each language at most
        out.setdefault(r.lang, []).append(r.word)
    return out


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions per state (0 is the root) of the smallest automaton of all substrings of ``symbols``."""
    edges: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        cur = len(edges)
        edges.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in edges[p]:
            edges[p][c] = cur
            p = link[p]
        if p >= 0:
            q = edges[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(edges)
                edges.append(dict(edges[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                link[q] = link[cur] = clone
                while p >= 0 and edges[p].get(c) == q:
                    edges[p][c] = clone
                    p = link[p]
        last = cur
    return edges


class Model:
    """Parse tables of all languages."""

    def __init__(self, words: dict[str, list[str]]):
        self.names = sorted(words)
        freq: dict[str, int] = {}
        for own in words.values():
            for word in own:
                for c in word:
                    freq[c] = freq.get(c, 0) + 1
        letters = sorted(freq, key=lambda c: (-freq[c], c))[:LETTERS]
        own = {c: i + 1 for i, c in enumerate(letters)}
        # Class 0 is the border of a word; letters of no class share the last ones.
        shared = SHARED if len(freq) > LETTERS else 1
        self.size = 1 + len(letters) + shared
        self.classes = np.zeros(0x110000, np.uint8)
        for cp in range(0x110000):
            c = chr(cp)
            if c.isalpha():
                low = c.lower()[:1]
                self.classes[cp] = own.get(low) or 1 + len(letters) + ord(low) % shared
        self.key, self.folder = uuid.uuid4().hex, None
        self.symbols, self.weights = [], []
        for name in self.names:
            text = [0]
            for word in words[name]:
                text += [own.get(c) or 1 + len(letters) + ord(c) % shared for c in word]
                text.append(0)
            self.symbols.append(bytes(text))
            self.weights.append(np.log2(len(text) + 1))

    def flat(self, k: int) -> np.ndarray:
        """A language's automaton as one array: states, the root's row of the table, places in the table, their values.

        A value is next state * 2 + (1 if the letter starts a phrase).
        """
        edges = suffix_automaton(list(self.symbols[k]))
        root = np.ones(self.size, np.int32)  # a letter that occurs nowhere is a phrase, and the next starts afresh
        for c, to in edges[0].items():
            root[c] = to * 2 + 1
        places = [state * self.size + c for state in range(1, len(edges)) for c in edges[state]]
        values = [to * 2 for state in range(1, len(edges)) for to in edges[state].values()]
        return np.concatenate(([len(edges)], root, places, values)).astype(np.int32)

    def _table(self, flat: np.ndarray) -> np.ndarray:
        """Values by state and class."""
        table = np.tile(flat[1:self.size + 1], flat[0])
        places, values = flat[self.size + 1:].reshape(2, -1)
        table[places] = values
        return table

    def store(self, spark: SparkSession) -> None:
        """Build the automata in tasks, a file each in the shared folder."""
        folder, shared = scratch(spark, "languages"), spark.sparkContext.broadcast(self)

        @memory.tidy
        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in batch.column(0).to_pylist():
                    raw = shared.value.flat(k).tobytes()
                    write_file(f"{folder}/{k:06d}.flat", lambda out, raw=raw: out.write(raw))
                yield batch

        n = len(self.names)
        spark.range(0, n, 1, min(n, 1000)).mapInArrow(build, "id long").count()
        self.folder, self.symbols = folder, []

    def many(self) -> bool:
        return self.folder is not None or len(self.names) > HELD

    def tables(self) -> Iterator[np.ndarray]:
        """Table of each language, in order."""
        if self.many():
            for k in range(len(self.names)):
                yield self._table(np.frombuffer(map_file(f"{self.folder}/{k:06d}.flat"), np.int32) if self.folder
                                  else self.flat(k))
            return
        if self.key not in _held:
            _held.clear()
            _held[self.key] = [self._table(self.flat(k)) for k in range(len(self.names))]
        yield from _held[self.key]

    def _walk(self, table: np.ndarray, symbols: np.ndarray, first: np.ndarray, alive: list[int]) -> np.ndarray:
        """Phrases in one language of words in order of falling length; ``alive``: words longer than each step."""
        at = np.full(len(first), table[0])  # over the border
        count = at & 1
        for step, m in enumerate(alive):
            at[:m] = table[(at[:m] >> 1) * self.size + symbols[first[:m] + step]]
            count[:m] += at[:m] & 1
        return count + (table[(at >> 1) * self.size] & 1)

    @staticmethod
    def _order(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[int]]:
        n = ends - starts
        order = np.argsort(-n, kind="stable")
        size = n[order]
        return order, ([int(x) for x in np.searchsorted(-size, -np.arange(1, int(size[0]) + 1), "right")] if len(size) else [])

    def phrases(self, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Phrases of each word in each language; the border before and after a word is part of it."""
        order, alive = self._order(starts, ends)
        out = np.zeros((len(self.names), len(starts)), np.int64)
        for k, table in enumerate(self.tables()):
            out[k, order] = self._walk(table, symbols, starts[order], alive)
        return out

    def predict(self, texts: pa.Array) -> tuple[list[str], list[float]]:
        names, score = [], []
        for group in batched(ta.slices(texts), SLICES if self.many() else 1):
            parts = []
            for _, _, cps, offs in group:
                symbols = self.classes[cps]
                starts, ends = ta.runs(symbols > 0, offs)
                row, rows = ta.row_of(starts, offs), len(offs) - 1
                order, alive = self._order(starts, ends)
                # The two least values and the language of the least, by row.
                parts.append((symbols, starts[order], alive, row[order], np.bincount(row, ends - starts, rows),
                              np.full((2, rows), np.inf), np.zeros(rows, np.int64)))
            for k, table in enumerate(self.tables()):
                for symbols, first, alive, row, _, least, best in parts:
                    cost = np.bincount(row, self._walk(table, symbols, first, alive), len(best)) * self.weights[k]
                    best[cost < least[0]] = k
                    least[1] = np.minimum(least[1], np.maximum(least[0], cost))
                    least[0] = np.minimum(least[0], cost)
            for *_, letters, least, best in parts:
                for i in range(len(best)):
                    if not letters[i] or not self.names:
                        names.append(UNKNOWN)
                        score.append(0.0)
                    else:
                        names.append(self.names[best[i]])
                        score.append(float(least[1, i] / (least[0, i] + least[1, i])) if len(self.names) > 1 else 1.0)
        return names, score


def predict(docs: DataFrame, words: dict[str, list[str]], into: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the language and its score in the columns ``into`` (which are replaced if there are such); the
    prediction sees nothing but ``text``."""
    model = Model(words)
    if model.many():
        model.store(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [f for f in docs.schema.fields if f.name not in into]
    schema = T.StructType([*keep, T.StructField(into[0], T.StringType()), T.StructField(into[1], T.DoubleType())])
    names = [f.name for f in schema.fields]
    at = [f.name for f in keep].index("text")

    @memory.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory.begin("languages")
        for batch in batches:
            lang, score = shared.value.predict(batch.column(at))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                             names)

    return docs.select(*[f.name for f in keep]).mapInArrow(run, schema)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = predict(docs.select("doc_id", "text"), train(docs))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
