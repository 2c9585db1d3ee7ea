"""Words of a whole column of texts at once, where they stand in its bytes, and their hashes."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of the texts that are worked off at once.
HELD = 1_000_000
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_P1, _P2, _P3, _P4, _P5 = map(np.uint64, (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
# Bytes of a word from which on its hash takes another way.
_LONG = 32


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _short_hashes(rows: np.ndarray) -> np.ndarray:
    """xxh64 of rows of bytes, of one length below _LONG."""
    n, length = rows.shape
    h = np.full(n, _P5 + np.uint64(length))
    at = 0
    while at + 8 <= length:
        lane = np.ascontiguousarray(rows[:, at:at + 8]).view("<u8")[:, 0]
        h = _turned(h ^ (_turned(lane * _P2, 31) * _P1), 27) * _P1 + _P4
        at += 8
    if at + 4 <= length:
        lane = np.ascontiguousarray(rows[:, at:at + 4]).view("<u4")[:, 0].astype(np.uint64)
        h = _turned(h ^ (lane * _P1), 23) * _P2 + _P3
        at += 4
    for i in range(at, length):
        h = _turned(h ^ (rows[:, i].astype(np.uint64) * _P5), 11) * _P1
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def stretched(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All numbers from every `low` to its `high`, one run after the other."""
    lengths = high - low
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(low - (ends - lengths), lengths)


class Parsed(NamedTuple):
    """Texts and their words: `raw` (bytes), `lower` (those with A-Z in lower case), `texts` (where
    each text starts, and the end), and for every word, in order, `start` and `stop` in the bytes;
    `words` (number of the first word of every text, and of all words)."""

    raw: np.ndarray
    lower: np.ndarray
    texts: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    words: np.ndarray

    def hashes(self) -> np.ndarray:
        """xxh64 of every word in lower case."""
        from xxhash import xxh64_intdigest

        lengths = self.stop - self.start
        out = np.empty(len(lengths), np.uint64)
        order = np.argsort(np.minimum(lengths, _LONG).astype(np.uint8), kind="stable")
        stops = np.cumsum(np.bincount(np.minimum(lengths, _LONG), minlength=_LONG + 1))
        for length in range(1, _LONG):
            mine = order[stops[length - 1]:stops[length]]
            if len(mine):
                out[mine] = _short_hashes(self.lower[self.start[mine][:, None] + np.arange(length)])
        for i in order[stops[_LONG - 1]:].tolist():
            out[i] = xxh64_intdigest(self.lower[self.start[i]:self.stop[i]].tobytes())
        return out


def parsed(column: pa.Array) -> Parsed:
    """The words of texts: runs without the six white-space characters of ASCII; null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.dtype(np.int64 if pa.types.is_large_string(column.type) else np.int32)
    _, places, data = column.buffers()
    texts = np.zeros(len(column) + 1, np.int64)
    if len(column):
        texts[:] = np.frombuffer(places, kind, len(column) + 1, column.offset * kind.itemsize)
    raw = np.empty(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[texts[0]:texts[-1]]
    texts -= texts[0]
    inside = ~_SPACE[raw]
    # A text's end also ends a word.
    before = np.zeros(len(raw) + 1, bool)
    before[texts] = True
    after = before.copy()
    before[1:] |= ~inside
    after[:-1] |= ~inside
    start, stop = np.flatnonzero(inside & before[:-1]), np.flatnonzero(inside & after[1:]) + 1
    return Parsed(raw, _LOWER[raw], texts, start, stop, np.searchsorted(start, texts))


def in_turn(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows in runs of about HELD bytes of text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = min(int(np.searchsorted(ends, done + HELD, "right")) + 1, batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop
