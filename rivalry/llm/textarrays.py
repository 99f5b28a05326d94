"""Vectorised text helpers for Arrow batches: code points, words, shingle and window hashes.

Texts are handled as one array of code points per slice of a batch, so a
task's memory is bounded by ``SLICE`` code points (or by one text, if that
is longer) and no Python loop runs per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20
#: White space of the word pattern ``[^\x20\x09-\x0D]+``.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_B, _C1, _C2, _C3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9,
                                              0x94D049BB133111EB))
_INV_B = np.uint64(pow(int(_B), -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def slices(texts: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, code points, row offsets into them) of consecutive slices; null is empty."""
    lens = pc.utf8_length(pc.fill_null(texts, "")).to_numpy(zero_copy_only=False).astype(np.int64)
    lo, n = 0, len(lens)
    while lo < n:
        hi = lo + max(1, int(np.searchsorted(np.cumsum(lens[lo:]), limit, "right")))
        cps = code_points("".join(x or "" for x in texts.slice(lo, hi - lo).to_pylist()))
        yield lo, hi, cps, np.concatenate(([0], np.cumsum(lens[lo:hi])))
        lo = hi


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def text_of(cps: np.ndarray) -> str:
    return cps.tobytes().decode("utf-32-le", "surrogatepass")


def is_space(cps: np.ndarray) -> np.ndarray:
    return (cps == 0x20) | ((cps >= 0x09) & (cps <= 0x0D))


def runs(inside: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``inside`` that don't cross a row offset."""
    n = len(inside)
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    before = np.concatenate(([False], inside[:-1])) if n else inside
    after = np.concatenate((inside[1:], [False])) if n else inside
    starts = np.flatnonzero(inside & (~before | edge[:n]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends


def row_of(starts: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Row index of each start; empty rows own nothing."""
    return np.searchsorted(offs, starts, "right") - 1


def words(cps: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and per-row word offsets of the words ``[^\\x20\\x09-\\x0D]+``."""
    starts, ends = runs(~is_space(cps), offs)
    return starts, ends, np.searchsorted(starts, offs)


def _pows(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((_B, _INV_B)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _C2
    h = (h ^ (h >> np.uint64(27))) * _C3
    return h ^ (h >> np.uint64(31))


def segment_hashes(cps: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the code points of each segment [start, end), the same wherever it stands."""
    p, inv = _pows(len(cps) + 1)
    x = (cps.astype(np.uint64) + _C1) * _C2
    x ^= x >> np.uint64(29)
    x *= p[:-1]
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)))
    return mix((total[ends] - total[starts]) * inv[starts] + (ends - starts).astype(np.uint64) * _C3)


def window_hashes(word_hashes: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of each run of ``k`` consecutive words, by first word; row borders are the caller's."""
    n = len(word_hashes)
    if n < k:
        return np.zeros(0, np.uint64)
    p, inv = _pows(n + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(word_hashes * p[:-1], dtype=np.uint64)))
    return mix((total[k:] - total[:-k]) * inv[:n - k + 1])


def within(k: int, word_offs: np.ndarray) -> np.ndarray:
    """Mask over window starts 0..n-k: True where the window stays in its row."""
    n = int(word_offs[-1])
    ok = np.ones(max(0, n - k + 1), bool)
    cuts = word_offs[1:-1]
    for back in range(1, k):
        at = cuts - back
        ok[at[(at >= 0) & (at < len(ok))]] = False
    return ok


def flat_ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Concatenation of range(s, s + n) for each pair."""
    total = int(lens.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.concatenate(([0], np.cumsum(lens)[:-1]))
    return np.arange(total) + np.repeat(starts - first, lens)
