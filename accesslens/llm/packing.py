"""Arrays of a task as compressed byte strings: one row carries many small records."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard

#: Columns of packed tables: where a row goes, what it is, and four arrays.
PACKED = "part int, kind int, a binary, b binary, c binary, d binary"
_NAMES = ["part", "kind", "a", "b", "c", "d"]


def pack(values: np.ndarray) -> bytes:
    """Bytes of equal weight lie together, so that small numbers cost few bytes."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(len(values), -1).T
    return zstandard.compress(planes.tobytes(), 1)


def unpack(packed: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(packed), dtype=np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(dtype).reshape(-1)


def pack_text(text: bytes) -> bytes:
    return zstandard.compress(text, 3)


def unpack_text(packed: bytes) -> bytes:
    return zstandard.decompress(packed)


class Rows:
    """Collects packed rows and turns them into batches."""

    def __init__(self):
        self.rows: list[tuple] = []

    def add(self, part: int, kind: int, *arrays: bytes) -> None:
        self.rows.append((part, kind, *arrays, *[None] * (4 - len(arrays))))

    def batches(self, size: int = 256) -> Iterator[pa.RecordBatch]:
        for lo in range(0, len(self.rows), size):
            some = self.rows[lo : lo + size]
            kinds = [pa.int32(), pa.int32()] + [pa.binary()] * 4
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in some], t) for i, t in enumerate(kinds)], names=_NAMES)
        self.rows = []


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        for i in range(b.num_rows):
            yield tuple(c[i].as_py() for c in b.columns)


def split_by(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(value, positions) for each value of ``part``; positions keep their order."""
    if not len(part):
        return
    order = np.argsort(part, kind="stable")
    at = np.flatnonzero(np.r_[True, np.diff(part[order]) != 0])
    for lo, hi in zip(at, np.r_[at[1:], len(part)]):
        yield int(part[order[lo]]), order[lo:hi]


def spread(ids: np.ndarray, parts: int) -> np.ndarray:
    """A part for each id, evenly."""
    return (mixed(ids.astype(np.int64).view(np.uint64)) % np.uint64(parts)).astype(np.int64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64 bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))
