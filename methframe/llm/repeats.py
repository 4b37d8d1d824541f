"""Bit filters of hashes that occur often, of a fixed size whatever the corpus.

Map tasks count their own hashes, cut them into slices of the hash space and send
each slice's hashes as one packed row; a task per slice adds up the counts and sets
the bits of those that reach a threshold.  Slices are even since a batch sends a hash
once.  The driver joins the slices' bits: LEVELS * BITS / 8 bytes at any input size.

A filter passes every hash that reaches its threshold and some others (the more, the
fuller it is), so callers use it to spare work and never to decide a result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .arrowmap import sliced
from .common import partitions

BITS = 1 << 27  # per filter: 16 MB
SLICES = 1024
KEY_BITS = 32  # of a hash below its slice; with the bits of the slice enough to tell hashes apart for counting
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _places(key: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bit positions below *width* (a power of two up to 2**24) of keys of KEY_BITS bits."""
    w, mask = np.uint64(width), np.uint64((1 << KEY_BITS) - 1)
    return (key * w) >> np.uint64(KEY_BITS), (((key * _ODD) & mask) * w) >> np.uint64(KEY_BITS)


class Filter:
    """Which hashes may have reached a threshold."""

    def __init__(self, bits: np.ndarray, slices: int):
        self.bits, self.slices, self.width = bits, slices, len(bits) * 8 // slices

    def __call__(self, h: np.ndarray) -> np.ndarray:
        part, key = _split(h, self.slices)
        base = part.astype(np.int64) * self.width
        out = np.ones(len(h), bool)
        for place in _places(key, self.width):
            at = base + place.astype(np.int64)
            out &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return out

    def any(self) -> bool:
        return bool(self.bits.any())


def _split(h: np.ndarray, slices: int) -> tuple[np.ndarray, np.ndarray]:
    n = slices.bit_length() - 1
    return h >> np.uint64(64 - n), (h >> np.uint64(64 - n - KEY_BITS)) & np.uint64((1 << KEY_BITS) - 1)


def frequent(df: DataFrame, columns: list[str], hashes: Callable[[], Callable[[pa.RecordBatch], np.ndarray]], thresholds: list[int], bits: int = BITS) -> list[Filter]:
    """One filter per threshold (2 to 255) of the hashes that hashes()(batch) gives over all of df.

    A batch's function may repeat a hash to count it more than once.
    """
    n = partitions(df.sparkSession)
    slices = max(SLICES, 1 << (n - 1).bit_length())

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = hashes()
        for batch in sliced(batches):
            h, count = np.unique(f(batch), return_counts=True)
            if not len(h):
                continue
            part, key = _split(h, slices)
            raw = np.ascontiguousarray(key.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, : KEY_BITS // 8].tobytes()
            counts = np.minimum(count, 255).astype(np.uint8).tobytes()
            used, at = np.unique(part, return_index=True)
            ends = np.append(at[1:], len(h))
            w = KEY_BITS // 8
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(used.astype(np.int32)),
                    pa.array([raw[i * w : j * w] for i, j in zip(at, ends, strict=True)], pa.binary()),
                    pa.array([counts[i:j] for i, j in zip(at, ends, strict=True)], pa.binary()),
                ],
                names=["slice", "keys", "counts"],
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, w = bits // slices, KEY_BITS // 8
        held: dict[int, list[tuple[bytes, bytes]]] = {}
        for batch in batches:
            for s, k, c in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                held.setdefault(s, []).append((k, c))
        for s, rows in held.items():
            raw = np.frombuffer(b"".join(k for k, _ in rows), np.uint8).reshape(-1, w)
            keys = np.zeros((len(raw), 8), np.uint8)
            keys[:, :w] = raw
            keys = keys.view("<u8").ravel().astype(np.uint64)
            count = np.frombuffer(b"".join(c for _, c in rows), np.uint8).astype(np.int64)
            order = np.argsort(keys)
            keys, count = keys[order], count[order]
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            total = np.add.reduceat(count, first)
            out = []
            for t in thresholds:
                flags = np.zeros(width, np.uint8)
                for place in _places(keys[first[total >= t]], width):
                    flags[place.astype(np.int64)] = 1
                out.append(np.packbits(flags, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), *(pa.array([b], pa.binary()) for b in out)], names=["slice", *names])

    names = [f"level_{i}" for i in range(len(thresholds))]
    packed = df.select(*columns).mapInArrow(pack, "slice int, keys binary, counts binary")
    added = packed.repartition(n, "slice").mapInArrow(add, ", ".join(["slice int", *(f"{x} binary" for x in names)]))
    size = bits // 8 // slices
    found = [np.zeros(bits // 8, np.uint8) for _ in thresholds]
    for row in added.toLocalIterator():  # slices rows of a fixed total size
        for array, name in zip(found, names, strict=True):
            array[row["slice"] * size : (row["slice"] + 1) * size] = np.frombuffer(row[name], np.uint8)
    return [Filter(b, slices) for b in found]
