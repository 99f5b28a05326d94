"""Dictionary of text segments -> token ids, in sorted flat files that tasks memory-map.

A tokenizer whose encoding is the concatenation of the encodings of its
segments needs to encode each distinct segment once.  ``build`` takes the
distinct segments with their ids as a DataFrame, deals them by ranges of their
hash, and writes a set of files per range, sorted; ``Lookup`` maps the files
and finds segments by binary search in them.  Nothing is copied into the
workers' own memory, so the dictionary may grow with the corpus' vocabulary:
a task touches the pages that it needs.

Segments are told apart by a 64-bit hash; two of the corpus with one hash are
found when the dictionary is made, and stop it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivalry.llm import memory
from rivalry.llm import textarrays as ta
from rivalry.llm.packed import by_key, receivers
from rivalry.llm.store import map_file, scratch, write_file

_loaded: dict[str, Lookup] = memory.table("dictionary")


def build(pairs: DataFrame) -> str:
    """Write ``pairs`` (h long, ids array<int>) as dictionary files; the folder's name is returned."""
    spark = pairs.sparkSession
    folder, parts = scratch(spark, "segments"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The range of a hash by its upper 32 bits, as in ``packed.receivers``.
    bucket = F.shiftrightunsigned(F.shiftrightunsigned(F.col("h"), 32) * F.lit(parts).cast("long"), 32).cast("int")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory.begin()
        for k, own in by_key(batches):
            hashes, lens, ids = [], [], []
            for b in own:
                hashes.append(b.column(1).to_numpy().view(np.uint64))
                lens.append(np.diff(b.column(2).offsets.to_numpy()))
                ids.append(b.column(2).flatten().to_numpy().astype("<u4"))
            h, n, ids = np.concatenate(hashes), np.concatenate(lens).astype(np.int64), np.concatenate(ids)
            order = np.argsort(h, kind="stable")
            h, at, n = h[order], (np.cumsum(n) - n)[order], n[order]
            if (h[1:] == h[:-1]).any():
                raise ValueError("two segments have one hash")
            arrays = {"hash": h, "first": np.concatenate(([0], np.cumsum(n))), "ids": ids[ta.flat_ranges(at, n)]}
            for name, a in arrays.items():
                write_file(f"{folder}/{k:05d}.{name}", lambda out, a=a: out.write(a.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32())], ["part"])

    dealt = pairs.select(bucket.alias("bucket"), "h", "ids").repartition(parts, "bucket").sortWithinPartitions("bucket")
    made = sorted(r.part for r in dealt.mapInArrow(write, "part int").collect())  # a row per range
    write_file(f"{folder}/manifest.json", lambda out: out.write(json.dumps({"of": parts, "parts": made}).encode()))
    return folder


class Lookup:
    """Encodes segments by a dictionary folder; one per worker process and folder."""

    def __init__(self, folder: str):
        about = json.loads(map_file(f"{folder}/manifest.json").to_pybytes())
        self.folder, self.of, self.known, self.parts = folder, about["of"], set(about["parts"]), {}

    @classmethod
    def open(cls, folder: str) -> Lookup:
        if folder not in _loaded:
            _loaded.clear()
            _loaded[folder] = cls(folder)
        return _loaded[folder]

    def _part(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if k not in self.parts:
            if k not in self.known:
                raise KeyError("a segment is missing from its dictionary")
            self.parts[k] = tuple(np.frombuffer(map_file(f"{self.folder}/{k:05d}.{name}"), kind) for name, kind in (
                ("hash", np.uint64), ("first", np.int64), ("ids", "<u4")))
        return self.parts[k]

    def encode(self, h: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids of the segments ``h`` in order, and id offsets of the rows whose segments start at ``bounds``."""
        uniq, back = np.unique(h, return_inverse=True)
        part = receivers(uniq, self.of)  # in ascending order, as the hashes are
        lens, ids = [], []
        for k in np.unique(part).tolist():
            own = uniq[np.searchsorted(part, k):np.searchsorted(part, k, "right")]
            hashes, first, values = self._part(k)
            at = np.searchsorted(hashes, own)
            if at[-1] >= len(hashes) or (hashes[at] != own).any():
                raise KeyError("a segment is missing from its dictionary")
            n = first[at + 1] - first[at]
            lens.append(n)
            ids.append(values[ta.flat_ranges(first[at], n)])
        n = np.concatenate([np.zeros(0, np.int64), *lens])
        flat, first = np.concatenate([np.zeros(0, "<u4"), *ids]), np.cumsum(n) - n
        return flat[ta.flat_ranges(first[back], n[back])], np.concatenate(([0], np.cumsum(n[back])))[bounds]
