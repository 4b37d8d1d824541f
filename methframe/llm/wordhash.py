"""Vectorised word scanning and hashing over Arrow string batches.

Words are maximal runs of bytes outside ``[\\x20\\x09-\\x0D]``; since every byte
of a multi-byte UTF-8 sequence is at least 0x80, scanning bytes is the same as
scanning characters.

A word's hash takes in its bytes eight at a time, each step followed by a bijective 64-bit
finaliser, so words of up to eight bytes and equal length never collide and no arithmetic
pattern in a longer word cancels out (as it does in polynomials modulo 2**64); words of more than
PIECES * 8 bytes are digested by BLAKE2b.  Windows combine the hashes of their halves
in the same way.  Every hash comes in two independent lanes: `hash`, and `check` where results
rest on equality, which makes 128 bits.  At 10**14 different words or windows, the
chance that any two of them share both is below 2 * 10**-11.

Memory is a few dozen bytes for each byte of a block; a text longer than a block is a block of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa

#: Text bytes handled at once (a single longer document forms its own block).
BLOCK_BYTES = 1 << 19

#: Steps of eight bytes that are hashed in numpy; longer words are digested one by one.
PIECES = 8

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_SEEDS = np.array([0x243F6A8885A308D3, 0x13198A2E03707344], np.uint64)  # by lane
_TURN = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93], np.uint64)
_BYTES = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)  # the lowest k bytes


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _paired(a: np.ndarray, b: np.ndarray, lane: int) -> np.ndarray:
    """The hash of what a hashes followed by what b hashes."""
    x = a * _TURN[lane]
    x += (b << np.uint64(29)) | (b >> np.uint64(35))
    return mix(x)


@dataclass
class Words:
    """The words of a block of documents, in order."""

    data: np.ndarray  # bytes of the block
    start: np.ndarray  # first byte of each word
    end: np.ndarray  # one past the last byte
    first: np.ndarray  # for each document its first word; one entry more at the end
    seen: np.ndarray  # the bytes that count, lower-cased if asked, with room for a last piece

    @cached_property
    def hash(self) -> np.ndarray:
        """uint64 by word."""
        return self._lane(0)

    @cached_property
    def check(self) -> np.ndarray:
        """The second lane."""
        return self._lane(1)

    def _lane(self, lane: int) -> np.ndarray:
        size = self.end - self.start
        h = mix(_SEEDS[lane] + size.astype(np.uint64) * _TURN[lane])
        eight = np.ndarray(len(self.seen) - 7, "<u8", self.seen, strides=(1,))
        pick = slice(None)
        for k in range(PIECES):
            if k:
                pick = np.flatnonzero((size > 8 * k) & (size <= 8 * PIECES))
                if not len(pick):
                    break
            piece = eight[self.start[pick] + 8 * k] & _BYTES[np.minimum(size[pick] - 8 * k, 8)]
            h[pick] = mix(h[pick] ^ piece)
        for w in np.flatnonzero(size > 8 * PIECES).tolist():
            digest = hashlib.blake2b(self.seen[self.start[w] : self.end[w]].tobytes(), digest_size=16).digest()
            h[w] = int.from_bytes(digest[8 * lane : 8 * lane + 8], "little")
        return h

    def document_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def windows(self, n: int, lane: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(index of first word, hash) of every window of n words inside one document."""
        one = self.check if lane else self.hash
        total = len(one)
        if total < n:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        h, size = one, 1
        for bit in bin(n)[3:]:
            h, size = _paired(h[: total - 2 * size + 1], h[size:], lane), 2 * size
            if bit == "1":
                h, size = _paired(h[: total - size], one[size:], lane), size + 1
        ends = np.repeat(self.first[1:], np.diff(self.first))
        at = np.flatnonzero(np.arange(total) + n <= ends)
        return at, h[at]


def scan(data: np.ndarray, offsets: np.ndarray, lower: bool) -> Words:
    """data: the block's bytes; offsets: document boundaries in it, from 0 to len(data)."""
    n = len(data)
    solid = ~_SPACE[data]
    before = np.zeros(n, bool)
    before[1:] = solid[:-1]
    inner = offsets[:-1][offsets[:-1] < n]
    before[inner] = False
    start = np.flatnonzero(solid & ~before)
    after = np.zeros(n, bool)
    after[:-1] = solid[1:]
    last = offsets[1:] - 1
    after[last[last >= 0]] = False
    end = np.flatnonzero(solid & ~after) + 1
    seen = np.zeros(n + 8, np.uint8)
    seen[:n] = _LOWER[data] if lower else data
    return Words(data, start, end, np.searchsorted(start, offsets), seen)


def blocks(text: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, one past the last row, bytes, offsets) of runs of rows of about *limit* bytes; null counts as empty."""
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    if text.null_count:
        text = text.fill_null("")
    wide = pa.types.is_large_string(text.type)
    _, at, raw = text.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(at, kind, len(text) + 1, text.offset * np.dtype(kind).itemsize).astype(np.int64) if len(text) else np.zeros(1, np.int64)
    everything = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8)
    i = 0
    while i < len(text):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        j = min(j, len(text))
        yield i, j, everything[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def scanned(text: pa.Array, lower: bool, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, Words]]:
    for i, j, data, offsets in blocks(text, limit):
        yield i, j, scan(data, offsets, lower)


def signed(x: np.ndarray) -> np.ndarray:
    """uint64 as the long of the same bits."""
    return x.view(np.int64)
