"""Binary records are put together for a batch at once; small ranges share tasks, in the order of the file."""

import struct

import pyarrow as pa
import pytest
from pyspark.sql.pandas.types import to_arrow_schema

from methframe import schemas as S
from methframe.sources import bam, files

REFS = {"a": 0, "b": 1}


def batch(*rows):
    names = S.SAM.names
    return pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=to_arrow_schema(S.SAM))


ROWS = [
    ("r1", 99, "b", 7, 42, "3M1D2M", "=", 9, -60, "ACGTN", "IIII#", ["AS:i:-3", "XG:Z:CT"]),
    (None, None, None, None, None, None, None, None, None, None, None, None),
    ("", 4, "*", 0, 0, "*", "*", 0, 0, "*", "*", []),
    ("x", 0, "a", 1, 3, "2S1M", "a", 5, 0, "acR", "*", ["U0:i:3000000000"]),
]


def test_records_of_a_batch_are_those_of_its_rows():
    rows = batch(*ROWS)
    calls, real = [], bam.bins_of
    bam.bins_of = lambda begin, end: calls.append(len(begin)) or real(begin, end)
    try:
        whole = bam.encode(rows, REFS)
    finally:
        bam.bins_of = real
    assert calls == [len(ROWS)]  # for all rows at once
    assert whole == b"".join(bam.encode(rows.slice(k, 1), REFS) for k in range(len(ROWS))) and bam.encode(rows.slice(0, 0), REFS) == b""
    n, ref, pos, name, mapq, _, ops, flag, bases = struct.unpack_from("<iiiBBHHHi", whole)
    assert (ref, pos, name, mapq, ops, flag, bases) == (1, 6, 3, 42, 3, 99, 5) and whole[36:39] == b"r1\0" and whole[39:51] == struct.pack("<III", 3 << 4, 1 << 4 | 2, 2 << 4)
    assert whole[51:54] == bytes([0x12, 0x48, 0xF0]) and whole[54:59] == b"((((\x02" and whole[59 : 4 + n] == b"ASi" + struct.pack("<i", -3) + b"XGZCT\0"


def test_faults_of_a_batch():
    with pytest.raises(KeyError):
        bam.encode(batch((*ROWS[0][:2], "zz", *ROWS[0][3:])), REFS)
    with pytest.raises(ValueError, match="read r1: bases and qualities differ"):
        bam.encode(batch(ROWS[3], (*ROWS[0][:10], "II", [])), REFS)
    with pytest.raises(ValueError, match="mapq"):
        bam.encode(batch((*ROWS[0][:4], 300, *ROWS[0][5:])), REFS)


def test_small_ranges_share_tasks():
    parts = [bam._Stretch("f", k, k + 1, False) for k in range(3001)]
    for total, tasks in ((3001, bam.TASKS), (files.SPLIT * 2000, 2000), (files.SPLIT * 9000, 3001)):
        dealt = bam._dealt(parts, total)
        assert len(dealt) == tasks and [p for r in dealt for p in r.parts] == parts
    assert [len(r.parts) for r in bam._dealt(parts[:3], 5)] == [1, 1, 1]
