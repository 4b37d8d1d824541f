"""Binary alignment files: a data source that splits them, a writer of sorted parts, and region indexes.

Reading: spark.read.format("bam") after register(spark), with the columns of SAM text.  A file is read in byte ranges; a
task looks for the first block of its range and in there for the first record, told by fields that fit the header and
a chain of such records after it.  A record belongs to the range in which its block begins.  With an index beside the file a region
reads only its chunks: by the option "region", or by filters on chr and pos where Spark hands these on
(spark.sql.python.filterPushdown.enabled).

Writing: each task writes one valid file of its rows under a temporary name; the commit names the parts by their order.
Rows that were dealt by coordinate thus are one sorted file in parts; join_parts copies them into a single file, every
part by a task of its own.
"""

from __future__ import annotations

import json
import struct
import uuid
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

from .. import schemas as S
from ..regions import parse_region
from . import bgzf, files

# Fixed values of the format.
MAGIC = b"BAM\1"
BASES = b"=ACMGRSVTWYHKDBN"
OPS = "MIDNSHP=X"
HEAD = np.dtype([("size", "<i4"), ("ref", "<i4"), ("pos", "<i4"), ("name", "u1"), ("mapq", "u1"), ("bin", "<u2"), ("ops", "<u2"), ("flag", "<u2"), ("bases", "<i4"), ("next_ref", "<i4"), ("next_pos", "<i4"), ("tlen", "<i4")])
NUMBERS = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}
LONGEST = 1 << 29  # positions that bins cover
LEVELS = ((14, 4681), (17, 585), (20, 73), (23, 9), (26, 1))  # bits of a bin and the number of the first of its size
WINDOW = 14  # bits of a window of the linear index

LOOK = 1 << 18  # uncompressed bytes in which a range's first record is looked for, doubled as long as these do not tell,
LOOK_MOST = 1 << 28  # but not for what would be a record longer than this
NEAR = 1 << 11  # places that are judged at a time
CHAIN = 8  # records that must follow one another there, unless the bytes end
MOST_TAGS = 1 << 20  # bytes of the tags of a record that a range may begin with
TASKS = 1024  # from so many ranges on, a task reads several of them, up to files.SPLIT bytes together
ROWS, BYTES = 8192, 4 << 20  # of a batch

_NIBBLE = np.full(256, 15, np.uint8)
for _k, _c in enumerate(BASES):
    _NIBBLE[[_c, ord(chr(_c).lower())]] = _k
_LETTERS = np.frombuffer(BASES, np.uint8)


# --- reading ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Header:
    text: str
    names: tuple[str, ...]
    lengths: tuple[int, ...]
    after: int  # virtual offset of the first record


def read_header(file) -> Header:
    data, marks = bytearray(), []
    stream = bgzf.blocks(file, 0)

    def need(n: int) -> None:
        while len(data) < n:
            offset, more = next(stream)
            marks.append((len(data), offset))
            data.extend(more)

    need(8)
    if data[:4] != MAGIC:
        raise ValueError("not a BAM file")
    at = 8 + struct.unpack_from("<i", data, 4)[0]
    need(at + 4)
    text, n = bytes(data[8:at]).rstrip(b"\0").decode(), struct.unpack_from("<i", data, at)[0]
    at += 4
    names, lengths = [], []
    for _ in range(n):
        need(at + 4)
        k = struct.unpack_from("<i", data, at)[0]
        need(at + 8 + k)
        names.append(bytes(data[at + 4 : at + 3 + k]).decode())
        lengths.append(struct.unpack_from("<i", data, at + 4 + k)[0])
        at += 8 + k
    inside, offset = max(m for m in marks if m[0] <= at)
    return Header(text, tuple(names), tuple(lengths), (offset << 16) + at - inside)


def _fits(data: np.ndarray, at: np.ndarray, header: Header) -> np.ndarray:
    """Whether a record's head that fits the header stands at each place (which lies 36 bytes before the end at least)."""
    h = data[at[:, None] + np.arange(HEAD.itemsize)].view(HEAD).ravel()
    n = len(header.names)
    lengths = np.append(np.array(header.lengths, np.int64), 1 << 31)  # of no reference
    ok = (h["size"] >= 32) & (h["ref"] >= -1) & (h["ref"] < n) & (h["next_ref"] >= -1) & (h["next_ref"] < n) & (h["name"] >= 1) & (h["bases"] >= 0) & (h["pos"] >= -1) & (h["next_pos"] >= -1)
    ok &= (h["pos"] < lengths[np.clip(h["ref"], -1, n - 1)]) & (h["next_pos"] < lengths[np.clip(h["next_ref"], -1, n - 1)])
    bases = h["bases"].astype(np.int64)
    tags = h["size"] - (32 + h["name"].astype(np.int64) + 4 * h["ops"].astype(np.int64) + (bases + 1) // 2 + bases)
    ok &= (tags >= 0) & (tags < MOST_TAGS)
    ends = at + 35 + h["name"]
    ok &= (ends >= len(data)) | (data[np.minimum(ends, len(data) - 1)] == 0)
    return ok


def first_record(data: bytes, own: int, header: Header, last: bool) -> int | None:
    """Where the first record of uncompressed bytes begins among the first `own` of them.

    -1: nowhere; None: what may be one goes on beyond the bytes, so more are needed.  last: the file ends with them.
    """
    raw = np.frombuffer(data, np.uint8)
    most = max(0, min(own, len(raw) - 36))
    # Mostly the first record lies near, so places are judged a few at a time.
    for at in (k + at for k in range(0, most, NEAR) for at in np.flatnonzero(_fits(raw, np.arange(k, min(most, k + NEAR)), header)).tolist()):
        k, n = at, 0
        while n < CHAIN and k + 36 <= len(raw) and _fits(raw, np.array([k]), header)[0]:
            k, n = k + 4 + struct.unpack_from("<i", data, k)[0], n + 1
        if n == CHAIN or last and k == len(raw):
            return at
        if not last and k + 36 > len(raw) and len(raw) < LOOK_MOST:
            return at if n > 2 else None
    return -1 if last or len(raw) - 36 >= own else None


def _records(file, header: Header, begin: int, end: int, exact: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, records' places, virtual offsets of these and of what follows the last) of a stretch of the file.

    Virtual offsets from begin to end if exact; else records whose blocks begin in the range of bytes.
    """
    if exact:
        first, limit, pos = begin >> 16, end, begin & 0xFFFF
    else:
        limit, pos = end << 16, None
        first = bgzf.first_block(file, begin, end)
        if first <= header.after >> 16:
            first, pos = header.after >> 16, header.after & 0xFFFF
    if (first << 16) + (pos or 0) >= limit:
        return
    data, marks, offsets, places = bytearray(), [], [], []
    more = bgzf.blocks(file, first)
    done, look = False, LOOK
    while not done:
        offset, block = next(more, (file.size(), None))
        if block is not None:
            marks.append(len(data))
            offsets.append(offset)
            data += block
        if pos is None:
            if block is not None and len(data) < look:
                continue
            beyond = bisect_left(offsets, limit >> 16)
            pos = first_record(bytes(data), marks[beyond] if beyond < len(marks) else len(data), header, block is None)
            if pos == -1 and (block is None or beyond < len(marks)):
                return  # all of a record that began before
            if pos in (-1, None):
                pos, look = None, 2 * look
                continue
        while pos + 4 <= len(data):
            n = 4 + struct.unpack_from("<i", data, pos)[0]
            if pos + n > len(data):
                break
            places.append(pos)
            pos += n
        at = np.array(marks)

        def virtual(x, at=at):  # of places of the buffer; its end is that of its last block
            k = np.searchsorted(at, x, "right") - 1
            return (np.array(offsets, np.int64)[k] << 16) + x - at[k]

        if block is None and pos < len(data):
            raise ValueError("the file ends within a record")
        done = block is None or bool(len(places) and virtual(np.array(places[-1:]))[0] >= limit) or bool(pos < len(data) and virtual(np.array([pos]))[0] >= limit)
        if done or len(places) >= ROWS or len(data) >= BYTES:
            if places:
                where = np.array(places)
                starts = virtual(where)
                own = int(np.searchsorted(starts, limit))
                if own:
                    yield np.frombuffer(bytes(data), np.uint8), where[:own], virtual(np.append(where, pos)[: own + 1])
            keep = int(np.searchsorted(at, pos, "right")) - 1
            cut = marks[keep] if pos < len(data) else len(data)
            marks, offsets = ([m - cut for m in marks[keep:]], offsets[keep:]) if pos < len(data) else ([], [])
            del data[:cut]
            pos, places = pos - cut, []


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All places of stretches, one after another."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(lengths.sum())


def _strings(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.string(), len(lengths), [None, pa.py_buffer(np.append(0, np.cumsum(lengths)).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


@lru_cache(1 << 16)
def _cigar(raw: bytes) -> str:
    return "".join(f"{v >> 4}{OPS[v & 15]}" for (v,) in struct.iter_unpack("<I", raw)) or "*"


@lru_cache(1 << 14)
def _tags(raw: bytes) -> list[str]:
    out, at = [], 0
    while at < len(raw):
        key, kind, at = raw[at : at + 2].decode(), chr(raw[at + 2]), at + 3
        if kind in NUMBERS:
            value = struct.unpack_from("<" + NUMBERS[kind], raw, at)[0]
            at += struct.calcsize("<" + NUMBERS[kind])
            out.append(f"{key}:f:{value:g}" if kind == "f" else f"{key}:i:{value}")
        elif kind == "A":
            out.append(f"{key}:A:{chr(raw[at])}")
            at += 1
        elif kind in "ZH":
            end = raw.index(b"\0", at)
            out.append(f"{key}:{kind}:{raw[at:end].decode()}")
            at = end + 1
        elif kind == "B":
            part, n = chr(raw[at]), struct.unpack_from("<i", raw, at + 1)[0]
            values = struct.unpack_from(f"<{n}{NUMBERS[part]}", raw, at + 5)
            out.append(f"{key}:B:" + ",".join([part, *(f"{v:g}" if part == "f" else str(v) for v in values)]))
            at += 5 + n * struct.calcsize(NUMBERS[part])
        else:
            raise ValueError(f"unknown kind of tag {kind!r}")
    return out


def _heads(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    return data[at[:, None] + np.arange(HEAD.itemsize)].view(HEAD).ravel()


def decode(data: np.ndarray, at: np.ndarray, header: Header) -> pa.RecordBatch:
    """The records at these places of the bytes as rows of SAM."""
    h = _heads(data, at)
    names = np.array([*header.names, "*"], object)
    name = at + 36
    ops = name + h["name"]
    packed = ops + 4 * h["ops"].astype(np.int64)
    bases = h["bases"].astype(np.int64)
    quals = packed + (bases + 1) // 2
    tags, end = quals + bases, at + 4 + h["size"]
    pairs = data[_spread(packed, (bases + 1) // 2)]
    letters = _LETTERS[np.stack([pairs >> 4, pairs & 15], 1).ravel()]
    firsts = 2 * (np.cumsum((bases + 1) // 2) - (bases + 1) // 2)
    qual = data[_spread(quals, bases)]
    none = bases == 0
    unknown = none | (data[np.minimum(quals, len(data) - 1)] == 255)
    raw = data.tobytes()
    ref = h["ref"]
    columns = [
        _strings(data[_spread(name, h["name"].astype(np.int64) - 1)], h["name"].astype(np.int64) - 1),
        pa.array(h["flag"].astype(np.int32)),
        pa.array(names[ref], pa.string()),
        pa.array(h["pos"].astype(np.int64) + 1),
        pa.array(h["mapq"].astype(np.int32)),
        pa.array([_cigar(raw[i:j]) for i, j in zip(ops.tolist(), packed.tolist(), strict=True)], pa.string()),
        pa.array(np.where((h["next_ref"] == ref) & (ref >= 0), "=", names[h["next_ref"]]), pa.string()),
        pa.array(h["next_pos"].astype(np.int64) + 1),
        pa.array(h["tlen"].astype(np.int64)),
        pc.if_else(pa.array(none), "*", _strings(letters[_spread(firsts, bases)], bases)),
        pc.if_else(pa.array(unknown), "*", _strings(np.where(qual == 255, 33, qual + 33).astype(np.uint8), bases)),
        pa.array([_tags(raw[i:j]) for i, j in zip(tags.tolist(), end.tolist(), strict=True)], pa.list_(pa.string())),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=to_arrow_schema(S.SAM))


def bins_of(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The smallest bin that holds each stretch (0-based, half-open)."""
    out, last = np.zeros(len(begin), np.int64), end - 1
    for bits, first in reversed(LEVELS):
        out = np.where(begin >> bits == last >> bits, first + (begin >> bits), out)
    return out


def bins_over(begin: int, end: int) -> set[int]:
    """All bins that a stretch touches."""
    return {0} | {first + k for bits, first in LEVELS for k in range(begin >> bits, ((end - 1) >> bits) + 1)}


def _extents(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(reference, begin, end) of records, 0-based; without bases on the reference they are one long."""
    h = _heads(data, at)
    n = h["ops"].astype(np.int64)
    raw = data[_spread(at + 36 + h["name"], 4 * n)].view("<u4") if n.sum() else np.empty(0, np.uint32)
    spent = np.where(np.isin(raw & 15, (0, 2, 3, 7, 8)), raw >> 4, 0)
    length = np.bincount(np.repeat(np.arange(len(at)), n), spent, len(at)).astype(np.int64)
    begin = h["pos"].astype(np.int64)
    return h["ref"], begin, begin + np.maximum(length, 1)


def read_index(path: str) -> list[tuple[dict[int, list[tuple[int, int]]], list[int]]]:
    """Per reference (chunks by bin, smallest offset by window)."""
    with files.opened(path) as f:
        data = f.read()
    if data[:4] != b"BAI\1":
        raise ValueError(f"{path} is no index")
    n, at, out = struct.unpack_from("<i", data, 4)[0], 8, []
    for _ in range(n):
        chunks: dict[int, list[tuple[int, int]]] = {}
        bins = struct.unpack_from("<i", data, at)[0]
        at += 4
        for _ in range(bins):
            number, k = struct.unpack_from("<Ii", data, at)
            chunks[number] = list(struct.iter_unpack("<QQ", data[at + 8 : at + 8 + 16 * k]))
            at += 8 + 16 * k
        k = struct.unpack_from("<i", data, at)[0]
        out.append((chunks, list(struct.unpack_from(f"<{k}Q", data, at + 4))))
        at += 4 + 8 * k
    return out


def chunks_of(index, ref: int, begin: int, end: int) -> list[tuple[int, int]]:
    """Virtual offsets of the stretches of the file that hold a region's records (0-based, half-open), in order."""
    chunks, windows = index[ref]
    least = windows[min(begin >> WINDOW, len(windows) - 1)] if windows else 0
    out: list[tuple[int, int]] = []
    for a, b in sorted(c for n in bins_over(begin, end) for c in chunks.get(n, [])):
        if b <= least:
            continue
        if out and a >> 16 <= out[-1][1] >> 16:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


class _Stretch(InputPartition):
    def __init__(self, path: str, begin: int, end: int, exact: bool):
        self.path, self.begin, self.end, self.exact = path, begin, end, exact


class _Ranges(InputPartition):
    """Ranges that follow one another, read by one task."""

    def __init__(self, parts: list[_Stretch]):
        self.parts = parts


def _dealt(parts: list[_Stretch], total: int) -> list[_Ranges]:
    """Ranges by tasks, in their order: one each, or several where there are many, so that small ranges do not make a task each."""
    tasks = max(min(len(parts), TASKS), min(len(parts), -(-total // files.SPLIT)))
    cuts = [k * len(parts) // tasks for k in range(tasks + 1)]
    return [_Ranges(parts[a:b]) for a, b in zip(cuts, cuts[1:])]


class BamReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = files.expand(options.get("path") or options["paths"])
        self.split = int(options.get("splitBytes") or files.SPLIT)
        self.region = parse_region(options["region"]) if options.get("region") else None
        self.chunks = str(options.get("content") or "").lower() == "chunks"

    def partitions(self) -> list[_Ranges]:
        out, whole = [], 0
        for path in self.paths:
            if self.region is None:
                total = files.size(path)
                whole += total
                out += [_Stretch(path, k, min(total, k + self.split), False) for k in range(0, total, self.split)]
                continue
            chr_, start, end = self.region
            with files.opened(path) as f:
                names = read_header(f).names
            if chr_ in names:
                out += [_Stretch(path, a, b, True) for a, b in chunks_of(read_index(path + ".bai"), names.index(chr_), start - 1, end)]
        return _dealt(out or [_Stretch(self.paths[0], 0, 0, False)], whole)

    def read(self, ranges: _Ranges) -> Iterator[pa.RecordBatch]:
        for part in ranges.parts:
            yield from self._stretch(part)

    def _stretch(self, part: _Stretch) -> Iterator[pa.RecordBatch]:
        with files.opened(part.path) as f:
            header = read_header(f)
            if self.chunks:
                yield from self._index(part, f, header)
                return
            for data, at, _ in _records(f, header, part.begin, part.end, part.exact):
                if self.region is not None:
                    ref, begin, end = _extents(data, at)
                    chr_, first, last = self.region
                    at = at[(ref == header.names.index(chr_)) & (begin < last) & (end >= first)]
                if len(at):
                    yield decode(data, at, header)

    def _index(self, part: _Stretch, f, header: Header) -> Iterator[pa.RecordBatch]:
        """Chunks of bins, and of windows (numbered from -1 down) the smallest offset."""
        chunks: dict[tuple[int, int], list[list[int]]] = {}
        windows: dict[tuple[int, int], int] = {}
        for data, at, offsets in _records(f, header, part.begin, part.end, part.exact):
            ref, begin, end = _extents(data, at)
            for r, n, a, b, low, high in zip(ref.tolist(), bins_of(begin, end).tolist(), offsets[:-1].tolist(), offsets[1:].tolist(), begin.tolist(), end.tolist(), strict=True):
                if r < 0 or low < 0:
                    continue
                if high > LONGEST:
                    raise ValueError("an index of this kind holds positions below 2 ** 29")
                own = chunks.setdefault((r, n), [])
                if own and a >> 16 <= own[-1][1] >> 16:
                    own[-1][1] = b
                else:
                    own.append([a, b])
                for w in range(low >> WINDOW, ((high - 1) >> WINDOW) + 1):
                    windows[r, w] = min(a, windows.get((r, w), a))
        rows = [(r, n, a, b) for (r, n), own in chunks.items() for a, b in own] + [(r, -1 - w, a, a) for (r, w), a in windows.items()]
        columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array([part.path] * len(rows), pa.string()), *(pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.int64()), strict=True))], names=["file", "ref", "bin", "begin", "end"])


class FilteredBamReader(BamReader):
    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes a region from filters on chr and pos, if indexes are there; Spark applies all filters again."""
        chr_, low, high = None, 1, LONGEST
        for f in filters:
            match f:
                case EqualTo(("chr",), value):
                    chr_ = value
                case GreaterThan(("pos",), value) | GreaterThanOrEqual(("pos",), value):
                    low = max(low, value)
                case LessThan(("pos",), value) | LessThanOrEqual(("pos",), value):
                    high = min(high, value)
        if chr_ not in (None, "*") and self.region is None and low <= high and all(files.exists(p + ".bai") for p in self.paths):
            self.region = (chr_, low, high)
        yield from filters


# --- writing ---------------------------------------------------------------------------


def header_bytes(text: str) -> tuple[bytes, dict[str, int]]:
    """(a file's head, number of each reference) from header lines."""
    refs = []
    for line in text.split("\n"):
        if line.startswith("@SQ\t"):
            fields = dict(f.split(":", 1) for f in line.split("\t")[1:])
            refs.append((fields["SN"], int(fields["LN"])))
    body = text.encode()
    out = MAGIC + struct.pack("<i", len(body)) + body + struct.pack("<i", len(refs))
    for name, length in refs:
        out += struct.pack("<i", len(name) + 1) + name.encode() + b"\0" + struct.pack("<i", length)
    return out, {name: k for k, (name, _) in enumerate(refs)}


@lru_cache(1 << 16)
def _packed_cigar(cigar: str) -> tuple[bytes, int, int]:
    """(packed, operations, bases on the reference)."""
    if cigar == "*":
        return b"", 0, 0
    out, n, number, spent = b"", 0, "", 0
    for c in cigar:
        if c.isdigit():
            number += c
            continue
        op = OPS.index(c)
        out += struct.pack("<I", int(number) << 4 | op)
        spent += int(number) if op in (0, 2, 3, 7, 8) else 0
        n, number = n + 1, ""
    return out, n, spent


@lru_cache(1 << 16)
def _packed_tag(tag: str) -> bytes:
    key, kind, value = tag.split(":", 2)
    head = key.encode() + kind.encode()
    if kind == "i":
        return key.encode() + (b"i" if -(1 << 31) <= int(value) < 1 << 31 else b"I") + struct.pack("<i" if int(value) < 1 << 31 else "<I", int(value))
    if kind == "f":
        return head + struct.pack("<f", float(value))
    if kind == "A":
        return head + value.encode()
    if kind == "B":
        part, *values = value.split(",")
        return head + part.encode() + struct.pack(f"<i{len(values)}{NUMBERS[part]}", len(values), *(float(v) if part == "f" else int(v) for v in values))
    return head + value.encode() + b"\0"


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, lengths) of strings, none of which is null."""
    column = column.cast(pa.large_string())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return held[ends[0] : ends[-1]] if len(column) else held[:0], np.diff(ends)


def _looked_up(column: pa.Array, of) -> tuple[np.ndarray, list]:
    """For each row the number of its value, and of(value) for each of the different values."""
    coded = column.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), [of(v) for v in coded.dictionary.to_pylist()]


def _pieces(numbers: np.ndarray, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, lengths) of the pieces of these numbers, one after another."""
    lengths = np.array([len(p) for p in pieces], np.int64)
    starts, held = np.cumsum(lengths) - lengths, np.frombuffer(b"".join(pieces), np.uint8)
    return held[_spread(starts[numbers], lengths[numbers])], lengths[numbers]


def encode(batch: pa.RecordBatch, refs: dict[str, int]) -> bytes:
    """Rows of SAM as records: fields are worked out for all rows at once, and put at their places among the records."""
    if not batch.num_rows:
        return b""
    col = {c: batch.column(batch.schema.names.index(c)) for c in S.SAM.names}
    number = {c: pc.fill_null(col[c].cast(pa.int64()), 0).to_numpy(zero_copy_only=False) for c in ("flag", "pos", "mapq", "pnext", "tlen")}
    title, title_n = _texts(pc.if_else(pc.equal(pc.fill_null(col["qname"], ""), ""), "*", col["qname"]))

    kinds, cigars = _looked_up(pc.if_else(pc.equal(pc.fill_null(col["cigar"], ""), ""), "*", col["cigar"]), _packed_cigar)
    ops, ops_n = _pieces(kinds, [c[0] for c in cigars])
    spent = np.array([c[2] for c in cigars], np.int64)[kinds]

    def reference(name: str | None) -> int:
        return refs[name] if name not in (None, "*") else -1

    kinds, known = _looked_up(pc.fill_null(col["chr"], "*"), reference)
    ref = np.array(known, np.int64)[kinds]
    kinds, known = _looked_up(pc.fill_null(col["rnext"], "*"), lambda name: -2 if name == "=" else reference(name))
    next_ref = np.array(known, np.int64)[kinds]
    next_ref = np.where(next_ref == -2, ref, next_ref)

    letters, bases = _texts(pc.if_else(pc.equal(pc.fill_null(col["seq"], "*"), "*"), "", col["seq"]))
    halves = (bases + 1) // 2
    codes = np.zeros(2 * int(halves.sum()), np.uint8)
    codes[_spread(2 * (np.cumsum(halves) - halves), bases)] = _NIBBLE[letters]
    packed = codes[::2] << 4 | codes[1::2]
    absent = pc.equal(pc.fill_null(col["qual"], "*"), "*")
    told, told_n = _texts(pc.if_else(absent, "", col["qual"]))
    absent = absent.to_numpy(zero_copy_only=False)
    wrong = np.flatnonzero(~absent & (told_n != bases))
    if len(wrong):
        raise ValueError(f"read {col['qname'][int(wrong[0])].as_py()}: bases and qualities differ in number")
    quals = np.full(int(bases.sum()), 255, np.uint8)
    quals[np.repeat(~absent, bases)] = told - 33

    lists = pc.fill_null(col["tags"], pa.scalar([], col["tags"].type))
    kinds, own = _looked_up(lists.flatten(), _packed_tag)
    each = np.array([len(t) for t in own], np.int64)[kinds]
    count = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    tags, _ = _pieces(kinds, own)
    tags_n = np.bincount(np.repeat(np.arange(len(count)), count), each, len(count)).astype(np.int64)

    begin = number["pos"] - 1
    low = np.maximum(begin, 0)
    h = np.zeros(batch.num_rows, HEAD)
    body = 32 + title_n + 1 + ops_n + halves + bases + tags_n
    fields = {
        "size": body, "ref": ref, "pos": begin, "name": title_n + 1, "mapq": number["mapq"], "bin": np.where(begin >= 0, bins_of(low, low + np.maximum(spent, 1)), 4680), "ops": ops_n // 4,
        "flag": number["flag"], "bases": bases, "next_ref": next_ref, "next_pos": number["pnext"] - 1, "tlen": number["tlen"],
    }
    for name, values in fields.items():
        limits = np.iinfo(HEAD[name])
        if values.min() < limits.min or values.max() > limits.max:
            raise ValueError(f"a record's {name} does not fit the format: {values.min()} to {values.max()}")
        h[name] = values
    out = np.zeros(int((4 + body).sum()), np.uint8)
    at = np.cumsum(4 + body) - (4 + body)
    out[_spread(at, np.full(len(at), HEAD.itemsize))] = h.view(np.uint8)
    at = at + HEAD.itemsize
    for held, lengths, gap in ((title, title_n, 1), (ops, ops_n, 0), (packed, halves, 0), (quals, bases, 0), (tags, tags_n, 0)):
        out[_spread(at, lengths)] = held
        at = at + lengths + gap
    return out.tobytes()


@dataclass
class _Part(WriterCommitMessage):
    number: int
    name: str
    body: int  # bytes of the head before the records
    size: int
    rows: int


class BamWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.folder, self.text, self.overwrite, self.run = options["path"].rstrip("/"), options["header"], overwrite, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Part:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        store, at = files.located(self.folder)
        store.create_dir(at, recursive=True)
        name = f"_{self.run}-{number}-{uuid.uuid4().hex}"  # attempts of a task do not share one
        head, refs = header_bytes(self.text)
        rows = 0
        with store.open_output_stream(f"{at}/{name}") as sink:
            out = bgzf.Writer(sink)
            out.write(head)
            out.flush()  # records begin with a block
            body = out.written
            for batch in iterator:
                for k in range(0, batch.num_rows, ROWS):
                    part = batch.slice(k, ROWS)
                    out.write(encode(part, refs))
                    rows += part.num_rows
            out.flush()
            sink.write(bgzf.END)
            return _Part(number, name, body, out.written + len(bgzf.END), rows)

    def commit(self, messages: list[_Part | None]) -> None:
        store, at = files.located(self.folder)
        parts = sorted((m for m in messages if m is not None), key=lambda m: m.number)
        full = [m for m in parts if m.rows] or parts[:1]
        if self.overwrite:
            for info in store.get_file_info(files._fs.FileSelector(at)):
                if info.base_name.startswith("part-"):
                    store.delete_file(info.path)
        for m in parts:
            if m not in full:
                store.delete_file(f"{at}/{m.name}")
        names = [f"part-{k:05d}-{self.run}.bam" for k in range(len(full))]
        for m, name in zip(full, names, strict=True):
            store.move(f"{at}/{m.name}", f"{at}/{name}")
        with store.open_output_stream(f"{at}/_parts.json") as f:
            f.write(json.dumps([{"name": name, "body": m.body, "size": m.size, "rows": m.rows} for m, name in zip(full, names, strict=True)]).encode())

    def abort(self, messages: list[_Part | None]) -> None:
        store, at = files.located(self.folder)
        for m in messages:
            if m is not None:
                store.delete_file(f"{at}/{m.name}")


class BamSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> T.StructType | str:
        if str(self.options.get("content") or "").lower() == "chunks":
            return "file string, ref int, bin int, begin long, end long"
        return S.SAM

    def reader(self, schema) -> BamReader:
        return FilteredBamReader(self.options) if self.options.get("pushdown") == "true" else BamReader(self.options)

    def writer(self, schema, overwrite: bool) -> BamWriter:
        return BamWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(BamSource)


def read(spark: SparkSession, paths: str, region: str | None = None, split: int | None = None) -> DataFrame:
    """Rows of SAM from files (a list with patterns); of a region ('chr7:1,234-5,678') only its chunks are read, which needs indexes."""
    register(spark)
    source = spark.read.format("bam").option("path", paths).option("pushdown", spark.conf.get("spark.sql.python.filterPushdown.enabled"))
    if region:
        source = source.option("region", region)
    return (source.option("splitBytes", split) if split else source).load()


def write_parts(df: DataFrame, header: str, folder: str, partitions: int | None = None) -> None:
    """Rows of SAM in the order of the header's references and of places, as parts whose order is that of the whole; rows without a place come last."""
    spark = df.sparkSession
    register(spark)
    order = {name: k for name, k in header_bytes(header)[1].items()}
    listed = F.broadcast(spark.createDataFrame([*order.items(), ("*", len(order))], "chr string, ref_no int"))  # a header's references
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = df.withColumn("chr", F.coalesce("chr", F.lit("*")))
    rows = named.join(listed, "chr", "left").withColumn("ref_no", F.coalesce("ref_no", F.raise_error(F.concat(F.lit("no such reference: "), "chr")).cast("int")))
    rows = rows.repartitionByRange(n, "ref_no", "pos", "qname").sortWithinPartitions("ref_no", "pos", "qname", "flag").select(*S.SAM.names)
    rows.write.format("bam").mode("append").option("header", header).save(folder)


def part_list(folder: str) -> list[dict]:
    with files.opened(f"{folder.rstrip('/')}/_parts.json") as f:
        return json.loads(f.read())


def join_parts(spark: SparkSession, folder: str, path: str) -> None:
    """The parts as one file: each is copied to its place by a task of its own.  Needs a local or mounted path, where files are written at any place."""
    from pyarrow import fs

    parts, (store, at) = part_list(folder), files.located(path)
    if not isinstance(store, fs.LocalFileSystem):
        raise ValueError("parts are joined on local or mounted storage only; elsewhere read them as they are")
    place, rows = 0, []
    for k, p in enumerate(parts):
        begin, end = (p["body"] if k else 0), p["size"] - len(bgzf.END)
        rows.append((f"{folder.rstrip('/')}/{p['name']}", begin, end, place))
        place += end - begin
    with open(at, "wb") as f:
        f.truncate(place)
        f.seek(place)
        f.write(bgzf.END)

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                with files.opened(r["name"]) as src, open(at, "r+b") as out:
                    src.seek(r["begin"])
                    out.seek(r["place"])
                    left = r["end"] - r["begin"]
                    while left:
                        data = src.read(min(left, 4 << 20))
                        out.write(data)
                        left -= len(data)
            yield batch.select(["place"])

    table = spark.createDataFrame(rows, "name string, begin long, end long, place long")
    table.repartition(max(1, len(rows)), "name").mapInArrow(copy, "place long").write.format("noop").mode("overwrite").save()


def build_index(spark: SparkSession, paths: str, split: int | None = None) -> None:
    """An index beside each file: chunks of bins and offsets of windows are gathered where the file is read, then put together by reference."""
    register(spark)
    listed = files.expand(paths)
    source = spark.read.format("bam").option("path", paths).option("content", "chunks")
    rows = (source.option("splitBytes", split) if split else source).load()

    def section(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        chunks: dict[int, list[tuple[int, int]]] = {}
        windows: dict[int, int] = {}
        for n, a, b in sorted(zip(*(table.column(c).to_pylist() for c in ("bin", "begin", "end")), strict=True), key=lambda x: (x[0], x[1])):
            if n < 0:
                windows[-1 - n] = min(a, windows.get(-1 - n, a))
            elif chunks.get(n) and a >> 16 <= chunks[n][-1][1] >> 16:
                chunks[n][-1] = (chunks[n][-1][0], max(b, chunks[n][-1][1]))
            else:
                chunks.setdefault(n, []).append((a, b))
        out = struct.pack("<i", len(chunks))
        for n, own in sorted(chunks.items()):
            out += struct.pack("<Ii", n, len(own)) + b"".join(struct.pack("<QQ", *c) for c in own)
        last, line = 0, []
        for w in range(max(windows, default=-1) + 1):
            last = windows.get(w, last)
            line.append(last)
        out += struct.pack(f"<i{len(line)}Q", len(line), *line)
        return pa.table({"file": [key[0].as_py()], "ref": pa.array([key[1].as_py()], pa.int32()), "section": [out]})

    # A reference's bins and windows bound its section, whatever the number of records.
    sections = rows.groupBy("file", "ref").applyInArrow(section, "file string, ref int, section binary").orderBy("file", "ref")
    found = iter(sections.toLocalIterator())
    row = next(found, None)
    for path in sorted(listed):
        with files.opened(path) as f:
            refs = len(read_header(f).names)
        store, at = files.located(path + ".bai")
        with store.open_output_stream(at) as out:
            out.write(b"BAI\1" + struct.pack("<i", refs))
            for k in range(refs):
                if row is not None and row["file"] == path and row["ref"] == k:
                    out.write(bytes(row["section"]))
                    row = next(found, None)
                else:
                    out.write(struct.pack("<ii", 0, 0))
