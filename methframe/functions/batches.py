"""Steps that look at every base of a read, in NumPy over Arrow batches: places of a pattern, places as text, and trimming.

Texts of a batch are one array of code points, so a step costs a few array operations for some 100,000 bases and no walk
over the places of each read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from .reads import ADAPTERS

#: Rows are handled in runs of about this many bytes of text; a longer text is a run of its own.
RUN_BYTES = 1 << 20


class Texts:
    """The code points of an Arrow array of texts (null: none), one after another, and where each text begins and ends."""

    def __init__(self, text: pa.Array):
        _, at, raw = text.fill_null("").buffers() if text.null_count else text.buffers()
        offset = 0 if text.null_count else text.offset
        kind = np.int64 if pa.types.is_large_string(text.type) else np.int32
        at = np.frombuffer(at, kind, len(text) + 1, offset * np.dtype(kind).itemsize).astype(np.int64) if len(text) else np.zeros(1, np.int64)
        codes = np.frombuffer(raw, np.uint8)[at[0] : at[-1]] if raw is not None else np.empty(0, np.uint8)
        at = at - at[0]
        if len(codes) and codes.max() > 127:
            begins = np.concatenate([[0], np.cumsum((codes & 0xC0) != 0x80)])
            codes, at = np.frombuffer(codes.tobytes().decode().encode("utf-32-le"), "<u4"), begins[at]
        self.codes, self.begin, self.end = codes, at[:-1], at[1:]

    @property
    def size(self) -> np.ndarray:
        return self.end - self.begin

    def shortened(self, size: np.ndarray) -> Texts:
        """The first places of each text."""
        out = object.__new__(Texts)
        out.codes, out.begin, out.end = self.codes, self.begin, np.minimum(self.end, self.begin + size)
        return out

    def at(self, place: np.ndarray | int, row: np.ndarray | slice = slice(None)) -> np.ndarray:
        """The code points at places of the rows, 0 beyond a text."""
        begin, end = self.begin[row], self.end[row]
        if np.ndim(place) > begin.ndim:
            begin, end = begin[:, None], end[:, None]
        k = begin + place
        if not len(self.codes):
            return np.zeros(k.shape, np.uint8)
        return np.where((k < end) & (k >= begin), self.codes[np.clip(k, 0, len(self.codes) - 1)], 0)

    def places(self, pattern: str) -> tuple[np.ndarray, np.ndarray]:
        """(row, place in it) of each place of the pattern, overlapping ones included, in order."""
        n = len(self.codes) - len(pattern) + 1
        if n < 1 or not len(self.begin):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        hit = self.codes[:n] == ord(pattern[0])
        for k, letter in enumerate(pattern[1:], 1):
            hit &= self.codes[k : n + k] == ord(letter)
        found = np.flatnonzero(hit)
        row = np.searchsorted(self.begin, found, "right") - 1
        inside = found + len(pattern) <= self.end[row]
        found, row = found[inside], row[inside]
        return row, found - self.begin[row]


def _runs(*texts: pa.Array) -> Iterator[list[pa.Array]]:
    """The arrays in runs of rows of about RUN_BYTES."""
    rows = len(texts[0])
    size = sum(pc.binary_length(t).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for t in texts)
    run = np.cumsum(size) // RUN_BYTES
    cuts = (np.flatnonzero(np.diff(run)) + 1).tolist()
    return ([t.slice(a, b - a) for t in texts] for a, b in zip([0, *cuts], [*cuts, rows], strict=True))


def _lists(row: np.ndarray, values: pa.Array, rows: int) -> pa.Array:
    at = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), values)


def _of_text(made: Callable[[Texts], pa.Array], kind: str, text: Column) -> Column:
    def run(text: pa.Array) -> pa.Array:
        return pa.concat_arrays([made(Texts(t)) for (t,) in _runs(text)])

    return F.arrow_udf(run, kind)(text)


def offsets(seq: str, pattern: str, shift: int = 0) -> Column:
    """0-based places of a pattern, and *shift* more; none for null."""

    def made(texts: Texts) -> pa.Array:
        row, place = texts.places(pattern)
        return _lists(row, pa.array((place + shift).astype(np.int32)), len(texts.begin))

    return _of_text(made, "array<int>", F.col(seq))


def trimming(kit: str, min_qual: int, min_size: int, seqs: list[str], quals: list[str]) -> Column:
    """(trimmed_length, adapter_at, tail) of reads or pairs, as a struct.

    trimmed_length: up to the last position at which every quality reaches the threshold; at least 1, since the first is
    not tested.  What follows looks at reads of that length, if they are not shorter than min_size.

    adapter_at: offset of the first seed at which the adapter passes, or null.  Seeds are the places of its first three
    bases in any mate.  It passes if no mate has more than a quarter (rounded up) of the compared bases wrong, and both
    together no more than half of them (rounded down of one more).

    tail: bases to cut (2, 1 or 0) where no adapter was found and the end of the read looks like its start.  Two mates need
    complementary bases as evidence of a short fragment; a single read is cut by two matching bases alone.
    """
    adapter = ADAPTERS[kit]
    ads = [adapter.read1, adapter.read2][: len(seqs)]
    other = np.zeros(256, np.int64)
    other[[ord(b) for b in "ACGT"]] = [ord(b) for b in "TGCA"]

    def kept(quals: list[Texts]) -> np.ndarray:
        size = np.minimum.reduce([q.size for q in quals])
        row = np.repeat(np.arange(len(size)), size)
        place = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        good = np.logical_and.reduce([q.codes[q.begin[row] + place] >= min_qual for q in quals])
        row, place = row[good], place[good]
        last = np.diff(row, append=-1) != 0
        out = np.ones(len(size), np.int64)
        out[row[last]] = place[last] + 1
        return out

    def found(reads: list[Texts], able: np.ndarray) -> np.ndarray:
        """The adapter's offset, -1 where there is none."""
        seeds = [r.places(adapter.seed) for r in reads]
        row, place = (np.concatenate([s[k] for s in seeds]) for k in (0, 1))
        left = reads[0].size[row] - place
        use = able[row] & (left >= 3)
        row, place, left = row[use], place[use], left[use]
        n = np.minimum(adapter.length, left)
        k = np.arange(adapter.length)
        wrong = []
        for read, ad in zip(reads, ads, strict=True):
            codes = np.array([ord(b) for b in ad[: adapter.length]])
            wrong.append(((read.at(place[:, None] + k, row) != codes) & (k < n[:, None])).sum(1))
        passes = np.logical_and.reduce([w <= -(-n // 4) for w in wrong])
        if len(reads) == 2:
            passes &= wrong[0] + wrong[1] <= (n + 1) // 2
        none = np.iinfo(np.int64).max
        out = np.full(len(able), none)
        np.minimum.at(out, row[passes], place[passes])
        return np.where(out == none, -1, out)

    def tails(reads: list[Texts]) -> np.ndarray:
        def ends(base: int, last: int) -> np.ndarray:
            return np.logical_and.reduce([r.at(r.size - last) == ord(a[base]) for r, a in zip(reads, ads, strict=True)])

        two = ends(0, 2) & ends(1, 1)
        if len(reads) == 1:
            return np.where(two, 2, 0)
        n = reads[0].size

        def evidence(i: int, back: int) -> np.ndarray:
            pairs = [(a.at(i), b.at(n - back)) for a, b in (reads, reads[::-1])]
            return np.logical_and.reduce([(x < 256) & (other[x & 255] > 0) & (other[x & 255] == y) for x, y in pairs])

        one = ends(0, 1) & evidence(5, 7) & evidence(6, 8)
        return np.where(n < 9, 0, np.where(two, np.where(evidence(5, 8), 2, 0), np.where(one, 1, 0)))

    def made(texts: list[pa.Array]) -> pa.Array:
        known = [t.is_valid().to_numpy(zero_copy_only=False) for t in texts]
        reads, quals = ([Texts(t) for t in part] for part in (texts[: len(seqs)], texts[len(seqs) :]))
        length = np.where(np.logical_and.reduce(known[len(seqs) :]), kept(quals), 1)
        reads = [r.shortened(length) for r in reads]
        able = np.logical_and.reduce(known[: len(seqs)]) & (length >= min_size)
        at = found(reads, able)
        tail = np.where(able & (at < 0), tails(reads), 0)
        return pa.StructArray.from_arrays(
            [pa.array(length.astype(np.int32)), pa.array(at.astype(np.int32), mask=at < 0), pa.array(tail.astype(np.int32))],
            ["trimmed_length", "adapter_at", "tail"],
        )

    def run1(a: pa.Array, p: pa.Array) -> pa.Array:
        return pa.concat_arrays([made(t) for t in _runs(a, p)])

    def run2(a: pa.Array, b: pa.Array, p: pa.Array, q: pa.Array) -> pa.Array:
        return pa.concat_arrays([made(t) for t in _runs(a, b, p, q)])

    return F.arrow_udf(run2 if len(seqs) == 2 else run1, "trimmed_length int, adapter_at int, tail int")(*seqs, *quals)
