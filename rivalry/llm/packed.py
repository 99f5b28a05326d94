"""Rows that carry arrays: many small records travel a shuffle as one row per sender and receiver."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa


def receivers(keys: np.ndarray, count: int) -> np.ndarray:
    """Receiver 0..count-1 of each 64-bit hash, by its upper bits."""
    return ((keys >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)).astype(np.int64)


def pack(to: np.ndarray, arrays: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    """A row (``to``, one binary per array) for each receiver; records keep their order."""
    order = np.argsort(to, kind="stable")
    to = to[order]
    cuts = np.flatnonzero(np.diff(to)) + 1 if len(to) else np.zeros(0, np.int64)
    starts = np.concatenate(([0], cuts)) if len(to) else cuts
    ends = np.append(cuts, len(to)) if len(to) else cuts
    cols = [pa.array(to[starts].astype(np.int32), pa.int32())]
    for a in arrays:
        a = np.ascontiguousarray(a[order])
        cols.append(pa.array([a[s:e].tobytes() for s, e in zip(starts.tolist(), ends.tolist())], pa.binary()))
    return pa.RecordBatch.from_arrays(cols, ["to", *names])


def schema(*names: str) -> str:
    return "to int, " + ", ".join(f"{n} binary" for n in names)


def by_key(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[tuple[object, Iterator[pa.RecordBatch]]]:
    """(key, its batches) of batches sorted by a column; a key's batches must be used up before the next key."""
    def cut():
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(column).to_numpy(zero_copy_only=False)
            at = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), batch.num_rows]
            for a, b in zip(at, at[1:]):
                yield keys[a], batch.slice(a, b - a)

    for key, parts in groupby(cut(), key=lambda x: x[0]):
        yield key, (p for _, p in parts)


def unpack(batches: Iterator[pa.RecordBatch], kinds: dict[int, np.dtype]) -> list[np.ndarray]:
    """The records of packed rows: one array per binary column (by number and kind), rows concatenated."""
    held: dict[int, list[bytes]] = {c: [] for c in kinds}
    for batch in batches:
        for c in kinds:
            held[c] += batch.column(c).to_pylist()
    return [np.frombuffer(b"".join(held[c]), kind) for c, kind in kinds.items()]


class Collector:
    """Gathers arrays until ``limit`` records, then hands them over in one go."""

    def __init__(self, limit: int):
        self.limit, self.held, self.size = limit, [], 0

    def add(self, *arrays: np.ndarray) -> bool:
        self.held.append(arrays)
        self.size += len(arrays[0])
        return self.size >= self.limit

    def take(self) -> list[np.ndarray]:
        out = [np.concatenate(a) for a in zip(*self.held)]
        self.held, self.size = [], 0
        return out
