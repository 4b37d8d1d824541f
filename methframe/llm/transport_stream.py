"""MPEG-2 transport streams as a media column.

`write_stream` muxes a payload of samples into a single-program stream: program
tables before every random-access point, one elementary packet (PES) of private data
per access unit with its timestamp, a clock reference and the random-access
indicator in the adaptation field.  `read_stream` is a general reader: it finds the
tables, checks their checksums, the sync bytes and the continuity counters, joins packets into
elementary packets and returns payload, timestamps and random-access points.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .arrowmap import add_columns

# Fixed values of the format.
PACKET = 188
SYNC = 0x47
PAT_PID = 0x0000
NULL_PID = 0x1FFF
CRC_POLYNOMIAL = 0x04C11DB7
PRIVATE_STREAM_1 = 0xBD
PRIVATE_DATA_TYPE = 0x06
CLOCK = 90_000

# Choices of this writer.
FRAME = 192  # payloads are whole frames of this many samples
FRAMES_PER_UNIT = 32
UNITS_PER_POINT = 8  # a random-access point every so many access units
SAMPLE_RATE = 8_000
PMT_PID, DATA_PID, PROGRAM = 0x1000, 0x0100, 1
FILL = b" "


class StreamError(ValueError):
    """The bytes are not a stream this reader accepts."""


def _crc_table() -> list[int]:
    out = []
    for i in range(256):
        c = i << 24
        for _ in range(8):
            c = (c << 1) ^ (CRC_POLYNOMIAL if c & 0x80000000 else 0)
        out.append(c & 0xFFFFFFFF)
    return out


_CRC = _crc_table()


def section_crc(data: bytes) -> int:
    c = 0xFFFFFFFF
    for b in data:
        c = ((c << 8) & 0xFFFFFFFF) ^ _CRC[(c >> 24) ^ b]
    return c


def padded(text: bytes) -> bytes:
    """The text, filled with spaces to a positive multiple of FRAME."""
    return text + FILL * (max(1, -(-len(text) // FRAME)) * FRAME - len(text))


def _section(table: int, number: int, body: bytes) -> bytes:
    """A program-specific section with its checksum, as the payload of one packet."""
    length = len(body) + 9
    head = bytes([table, 0xB0 | length >> 8, length & 255, number >> 8, number & 255, 0xC1, 0, 0]) + body
    whole = b"\0" + head + section_crc(head).to_bytes(4, "big")
    return whole.ljust(PACKET - 4, b"\xff")


_PAT = _section(0x00, 1, PROGRAM.to_bytes(2, "big") + (0xE000 | PMT_PID).to_bytes(2, "big"))
_PMT = _section(0x02, PROGRAM, (0xE000 | DATA_PID).to_bytes(2, "big") + b"\xf0\x00" + bytes([PRIVATE_DATA_TYPE]) + (0xE000 | DATA_PID).to_bytes(2, "big") + b"\xf0\x00")


def _timestamp(pts: int) -> bytes:
    return bytes([0x21 | (pts >> 29) & 0x0E, (pts >> 22) & 255, 0x01 | (pts >> 14) & 0xFE, (pts >> 7) & 255, 0x01 | (pts << 1) & 0xFE])


def write_stream(payload: bytes) -> bytes:
    """The stream of a payload (whole frames); equal payloads give equal bytes."""
    unit = FRAME * FRAMES_PER_UNIT
    out: list[bytes] = []
    data_counter = table_counter = 0
    middle = [bytes([SYNC, DATA_PID >> 8, DATA_PID & 255, 0x10 | c]) for c in range(16)]
    for n, at in enumerate(range(0, len(payload), unit)):
        part = payload[at : at + unit]
        pts = at * CLOCK // SAMPLE_RATE & 0x1FFFFFFFF
        point = n % UNITS_PER_POINT == 0
        if point:
            for pid, section in ((PAT_PID, _PAT), (PMT_PID, _PMT)):
                out += (bytes([SYNC, 0x40 | pid >> 8, pid & 255, 0x10 | table_counter]), section)
            table_counter = (table_counter + 1) & 15
        pes = b"\0\0\1" + bytes([PRIVATE_STREAM_1]) + (len(part) + 8).to_bytes(2, "big") + b"\x84\x80\x05" + _timestamp(pts) + part
        pcr = (pts << 15 | 0x7E << 8).to_bytes(6, "big")
        field_ = bytes([0x50 if point else 0x10]) + pcr
        room = PACKET - 5 - len(field_)
        if len(pes) < room:
            field_ += b"\xff" * (room - len(pes))
            room = len(pes)
        out += (bytes([SYNC, 0x40 | DATA_PID >> 8, DATA_PID & 255, 0x30 | data_counter, len(field_)]), field_, pes[:room])
        data_counter = (data_counter + 1) & 15
        at_pes = room
        while len(pes) - at_pes >= PACKET - 4:
            out += (middle[data_counter], pes[at_pes : at_pes + PACKET - 4])
            data_counter = (data_counter + 1) & 15
            at_pes += PACKET - 4
        if rest := len(pes) - at_pes:
            fill = PACKET - 5 - rest
            stuffing = bytes([fill]) + (b"\0" + b"\xff" * (fill - 1) if fill else b"")
            out += (bytes([SYNC, DATA_PID >> 8, DATA_PID & 255, 0x30 | data_counter]), stuffing, pes[at_pes:])
            data_counter = (data_counter + 1) & 15
    return b"".join(out)


@dataclass
class Stream:
    """What a stream holds: one entry in pts and offset per elementary packet."""

    payload: bytes
    pts: list[int] = field(default_factory=list)
    offset: list[int] = field(default_factory=list)
    points: list[tuple[int, int]] = field(default_factory=list)  # (timestamp, payload offset) of random-access points
    packets: int = 0
    discontinuities: int = 0


class _Sections:
    """Joins a PID's packets into program-specific sections, which may span packets and follow one another."""

    def __init__(self):
        self.held: bytearray | None = None  # null: waiting for a start

    def add(self, payload: bytes, starts: bool) -> list[bytes]:
        """The sections that a packet's payload completes, header and checksum included."""
        if starts:
            pointer = payload[0] if payload else 0
            tail, payload = payload[1 : 1 + pointer], payload[1 + pointer :]
            out = self._take(tail) if self.held is not None else []
            self.held = bytearray()
            return out + self._take(payload)
        return self._take(payload) if self.held is not None else []

    def lose(self) -> None:
        """Packets were lost: what is held cannot be completed."""
        self.held = None

    def _take(self, payload: bytes) -> list[bytes]:
        self.held += payload
        out = []
        while len(self.held) >= 3 and self.held[0] != 0xFF:  # else: stuffing up to the next start
            length = 3 + ((self.held[1] & 15) << 8 | self.held[2])
            if len(self.held) < length:
                break
            out.append(bytes(self.held[:length]))
            del self.held[:length]
        return out


def _table_body(section: bytes, table: int) -> bytes | None:
    """The bytes between a section's header and checksum; null for other tables and those not yet in force."""
    if section[0] != table:
        return None
    if len(section) < 12 or section_crc(section):
        raise StreamError("a program table is damaged")
    return section[8:-4] if section[5] & 1 else None


def _read_pes(parts: list[bytes]) -> tuple[int | None, bytes]:
    pes = b"".join(parts)
    if pes[:3] != b"\0\0\1" or len(pes) < 9:
        raise StreamError("an elementary packet has no start code")
    length = pes[4] << 8 | pes[5]
    if length and len(pes) < 6 + length:
        raise StreamError("an elementary packet is cut short")
    body = pes[9 + pes[8] : 6 + length if length else len(pes)]
    pts = None
    if pes[7] & 0x80:
        t = pes[9:14]
        pts = (t[0] >> 1 & 7) << 30 | t[1] << 22 | (t[2] >> 1) << 15 | t[3] << 7 | t[4] >> 1
    return pts, body


def read_stream(data: bytes, strict: bool = True) -> Stream:
    """The first program's first elementary stream.

    With strict, lost packets (a gap in a continuity counter) raise StreamError; otherwise they are
    counted and the damaged elementary packet is dropped.  A jump that the packet itself announces
    (discontinuity indicator) is no loss.  A packet that repeats the one before it, byte for byte but
    for its clock reference, is skipped; one of the same counter and other bytes is a gap.
    Tables may span packets, and several sections may share one.
    """
    if len(data) % PACKET:
        raise StreamError("not a whole number of packets")
    out = Stream(b"", packets=len(data) // PACKET)
    pmt_pid = data_pid = None
    counters: dict[int, int] = {}
    former: dict[int, bytes] = {}  # each PID's last payload
    tables: dict[int, _Sections] = {PAT_PID: _Sections()}
    parts: list[bytes] = []
    bodies: list[bytes] = []
    total, point, damaged = 0, False, False

    def close() -> None:
        nonlocal total
        if parts and not damaged:
            pts, body = _read_pes(parts)
            out.pts.append(-1 if pts is None else pts)
            out.offset.append(total)
            if point:
                out.points.append((out.pts[-1], total))
            bodies.append(body)
            total += len(body)
        parts.clear()

    for i in range(0, len(data), PACKET):
        b1, b3 = data[i + 1], data[i + 3]
        if data[i] != SYNC or b1 & 0x80:
            raise StreamError(f"no good packet at byte {i}")
        pid = (b1 & 0x1F) << 8 | data[i + 2]
        if pid == NULL_PID:
            continue
        at, random_access, announced = i + 4, False, False
        if b3 & 0x20:
            size = data[at]
            if at + 1 + size > i + PACKET:
                raise StreamError(f"an adaptation field is too long at byte {i}")
            random_access = size > 0 and bool(data[at + 1] & 0x40)
            announced = size > 0 and bool(data[at + 1] & 0x80)
            at += 1 + size
        if not b3 & 0x10:  # no payload: the counter stands still
            if announced:
                counters.pop(pid, None)
            continue
        counter, payload = b3 & 15, data[at : i + PACKET]
        if pid in counters and counter != (counters[pid] + 1) & 15 and not announced:
            if counter == counters[pid] and payload == former[pid]:
                continue
            if strict:
                raise StreamError(f"packets of PID {pid} are missing before byte {i}")
            out.discontinuities += 1
            damaged = damaged or pid == data_pid
            if pid in tables:
                tables[pid].lose()
        counters[pid], former[pid] = counter, payload
        starts = bool(b1 & 0x40)
        if pid == data_pid:
            if starts:
                close()
                point, damaged = random_access, False
                parts.append(payload)
            elif parts:
                parts.append(payload)
        elif pid in tables:
            for section in tables[pid].add(payload, starts):
                if pid == PAT_PID and pmt_pid is None and (body := _table_body(section, 0x00)) is not None:
                    pmt_pid = next(((body[k + 2] & 0x1F) << 8 | body[k + 3] for k in range(0, len(body), 4) if body[k] or body[k + 1]), None)
                    if pmt_pid is not None:
                        tables.setdefault(pmt_pid, _Sections())
                elif pid == pmt_pid and data_pid is None and (body := _table_body(section, 0x02)) is not None:
                    k = 4 + ((body[2] & 15) << 8 | body[3])
                    if k + 5 > len(body):
                        raise StreamError("a program has no elementary stream")
                    data_pid = (body[k + 1] & 0x1F) << 8 | body[k + 2]
    close()
    if data_pid is None:
        raise StreamError("no program was found")
    out.payload = b"".join(bodies)
    return out


def store(df: DataFrame, text_col: str = "text", media_col: str = "media", bytes_col: str = "n_bytes") -> DataFrame:
    """df with each text's stream and its length in bytes before padding; null texts count as empty.

    Columns of the output names are replaced, all others pass through.  Repeated rows get equal streams, an
    empty table none.  A worker holds a slice of rows (see SLICE_BYTES) and their streams; a longer text is a slice of
    its own and takes a few times its size.
    """

    def make():
        def run(batch: pa.RecordBatch) -> list:
            raw = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column(text_col).to_pylist()]
            return [[write_stream(padded(t)) for t in raw], [len(t) for t in raw]]

        return run

    return add_columns(df, [(media_col, T.BinaryType()), (bytes_col, T.LongType())], make)


POINT = T.StructType([T.StructField("pts", T.LongType()), T.StructField("offset", T.LongType())])


def load(df: DataFrame, media_col: str = "media", payload_col: str = "payload", pts_col: str = "pts", points_col: str = "access_points") -> DataFrame:
    """df with each stream's payload, the timestamps of its elementary packets and its random-access points.

    A null stream gives nulls; a damaged one raises StreamError.
    """

    def make():
        def run(batch: pa.RecordBatch) -> list:
            found = [None if m is None else read_stream(m) for m in batch.column(media_col).to_pylist()]
            points = [None if s is None else [{"pts": t, "offset": o} for t, o in s.points] for s in found]
            return [[s and s.payload for s in found], [s and s.pts for s in found], points]

        return run

    return add_columns(df, [(payload_col, T.BinaryType()), (pts_col, T.ArrayType(T.LongType())), (points_col, T.ArrayType(POINT))], make)


def describe(df: DataFrame, media_col: str = "media") -> DataFrame:
    """df with digests of a stream and of what is read back from it, without carrying the payload on.

    payload_bytes, payload_sha256, tail_crc32 (of the last 16 payload bytes), media_bytes,
    media_sha256, feature (packets, elementary packets, last timestamp, and timestamp:offset of every random-access point).
    A null stream gives nulls, a damaged one raises StreamError.  Repeated rows get equal digests, an empty table gives
    none; columns of the output names are replaced.  Memory is a few times the longest stream.
    """
    fields = [("payload_bytes", T.LongType()), ("payload_sha256", T.StringType()), ("tail_crc32", T.LongType()), ("media_bytes", T.LongType()), ("media_sha256", T.StringType()), ("feature", T.StringType())]

    def make():
        def one(m: bytes | None) -> tuple:
            if m is None:
                return (None,) * len(fields)
            s = read_stream(m)
            points = ",".join(f"{t}:{o}" for t, o in s.points)
            feature = f"packets={s.packets};units={len(s.pts)};last_pts={s.pts[-1] if s.pts else -1};points={points}"
            return (len(s.payload), hashlib.sha256(s.payload).hexdigest(), zlib.crc32(s.payload[-16:]), len(m), hashlib.sha256(m).hexdigest(), feature)

        return lambda batch: [list(x) for x in zip(*map(one, batch.column(media_col).to_pylist()), strict=True)]

    return add_columns(df, fields, make)
