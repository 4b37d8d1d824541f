"""Block-compressed files: gzip members of at most 64 KB whose extra field tells their size.

A place in the uncompressed bytes is told by a virtual offset: the block's offset in the file times 65,536 plus
the place in the block.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

# Fixed values of the format, but for AHEAD.
MAGIC = b"\x1f\x8b\x08\x04"
MOST = 0xFF00  # bytes of a block before compression
AHEAD = 1 << 20  # bytes read at a time
END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")


def block_size(data: bytes, at: int = 0) -> int:
    """Bytes of the block that starts here, 0 if none does (or its head is cut off)."""
    if data[at : at + 4] != MAGIC or len(data) < at + 18:
        return 0
    extra = struct.unpack_from("<H", data, at + 10)[0]
    k, end = at + 12, at + 12 + extra
    while k + 4 <= min(end, len(data)):
        length = struct.unpack_from("<H", data, k + 2)[0]
        if data[k : k + 2] == b"BC" and length == 2 and k + 6 <= len(data):
            return struct.unpack_from("<H", data, k + 4)[0] + 1
        k += 4 + length
    return 0


def first_block(file, start: int, end: int) -> int:
    """Where the first block at or after start begins; end if there is none before it.

    The bytes of a head may stand in compressed data by chance, so the block must be followed by another, or by the end.
    """
    total = file.size()
    while start < end:
        file.seek(start)
        data = file.read(3 * (1 << 16))
        at = data.find(MAGIC)
        while at >= 0 and at < 1 << 16 and start + at < end:
            n = block_size(data, at)
            if n and (start + at + n == total or block_size(data, at + n)):
                return start + at
            at = data.find(MAGIC, at + 1)
        start += 1 << 16
    return end


def blocks(file, start: int) -> Iterator[tuple[int, bytes]]:
    """(offset, uncompressed bytes) of the blocks from one on."""
    total, data, base = file.size(), b"", start
    while start < total:
        n = block_size(data, start - base)
        if not n or start - base + n > len(data):
            base = start
            file.seek(start)
            data = file.read(AHEAD)
            n = block_size(data, 0)
            if not n or n > len(data):
                raise ValueError(f"no block at byte {start}")
        at = start - base
        head = 12 + struct.unpack_from("<H", data, at + 10)[0]
        yield start, zlib.decompress(data[at + head : at + n - 8], -15)
        start += n


def block(data: bytes, level: int = 6) -> bytes:
    """One block of at most MOST bytes."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    return MAGIC + struct.pack("<IBBHBBHH", 0, 0, 255, 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


class Writer:
    """Bytes into blocks."""

    def __init__(self, sink, level: int = 6):
        self.sink, self.level, self.held, self.written = sink, level, bytearray(), 0

    def write(self, data: bytes) -> None:
        self.held += data
        while len(self.held) >= MOST:
            self._put(MOST)

    def _put(self, n: int) -> None:
        packed = block(bytes(self.held[:n]), self.level)
        del self.held[:n]
        self.sink.write(packed)
        self.written += len(packed)

    def flush(self) -> None:
        """Ends the block, so that what comes next starts one."""
        if self.held:
            self._put(len(self.held))
