"""Binary alignment files: splits, sorted parts, one joined file, indexes and regions."""

import os
import random
import struct

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from methframe import schemas as S
from methframe.functions import cigar as C
from methframe.sources import bam, bgzf, files

HEADER = "@HD\tVN:1.6\tSO:coordinate\n@SQ\tSN:chr1\tLN:100000\n@SQ\tSN:chr2\tLN:5000000"


def sam_rows(n=20_000, seed=1):
    r = random.Random(seed)
    out = []
    for k in range(n):
        length = r.choice([0, 1, r.randint(2, 150)])
        chr_ = r.choice(["chr1", "chr2", "*"])
        seq = "".join(r.choice("ACGTN") for _ in range(length)) or "*"
        qual = "*" if r.random() < 0.05 else "".join(chr(r.randint(33, 74)) for _ in range(length)) or "*"
        cigar = "*" if chr_ == "*" or not length else r.choice([f"{length}M", f"1M2000D{length - 1}M" if length > 1 else "1M"])
        rnext = "*" if chr_ == "*" else r.choice(["*", "=", "chr1" if chr_ == "chr2" else "chr2"])
        tags = r.choice([["XG:Z:CT", "AS:i:-3"], [], ["XF:f:1.5", "XA:A:c", "XB:B:c,1,-2,3", "XI:B:f,0.5", "NM:i:3000000000", "XH:H:1AE3"]])
        out.append((f"read{k}", r.choice([0, 16, 99, 147]), chr_, 0 if chr_ == "*" else r.randint(1, 90_000), r.randint(0, 60), cigar, rnext, r.randint(0, 5000), r.randint(-500, 500), seq, qual, tags))
    return out


def write_file(path, rows, header=HEADER):
    head, refs = bam.header_bytes(header)
    schema = to_arrow_schema(S.SAM)
    batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
    with open(path, "wb") as f:
        w = bgzf.Writer(f)
        w.write(head)
        w.write(bam.encode(batch, refs))
        w.flush()
        f.write(bgzf.END)


def plain(rows):
    return [tuple(list(v) if isinstance(v, list) else v for v in r) for r in rows]


@pytest.mark.parametrize("split", [1 << 30, 200_000, 30_000, 3000])
def test_splits_give_every_record_once(tmp_path, split):
    rows, path = sam_rows(), str(tmp_path / "a.bam")
    write_file(path, rows)
    reader = bam.BamReader({"path": path, "splitBytes": split})
    parts = reader.partitions()
    assert len(parts) == max(1, -(-os.path.getsize(path) // split))
    assert [tuple(d.values()) for p in parts for b in reader.read(p) for d in b.to_pylist()] == rows


def test_records_longer_than_blocks_and_splits(tmp_path):
    r = random.Random(3)
    rows = []
    for k in range(60):
        n = r.choice([10, 200_000])
        rows.append((f"r{k}", 0, "chr2", k + 1, 9, f"{n}M", "*", 0, 0, "".join(r.choices("ACGT", k=n)), "".join(r.choices("#5I", k=n)), ["XZ:Z:" + "q" * r.choice([1, 100_000])]))
    path = str(tmp_path / "long.bam")
    write_file(path, rows)
    for split in (1 << 30, 50_000, 7000):
        reader = bam.BamReader({"path": path, "splitBytes": split})
        assert [tuple(d.values()) for p in reader.partitions() for b in reader.read(p) for d in b.to_pylist()] == rows


def test_block_heads_in_data_do_not_split(tmp_path):
    """Stored blocks hold what looks like the head of a block."""
    path = str(tmp_path / "x.gz")
    data = [os.urandom(30_000) + bgzf.MAGIC + struct.pack("<IBBHBBHH", 0, 0, 255, 6, 66, 67, 2, 5000) + os.urandom(20_000) for _ in range(20)]
    with open(path, "wb") as f:
        for d in data:
            f.write(bgzf.block(d, 0))
        f.write(bgzf.END)
    with files.opened(path) as f:
        total = f.size()
        starts = {bgzf.first_block(f, k, total) for k in range(0, total, 1000)} - {total}
        found = [(o, d) for o, d in bgzf.blocks(f, 0)]
    assert [d for _, d in found] == [*data, b""] and starts == {o for o, _ in found}


def test_parts_join_index_and_regions(spark, tmp_path):
    rows = sam_rows(30_000, 2)
    df = spark.createDataFrame(rows, S.SAM).repartition(5)
    folder, path = str(tmp_path / "parts"), str(tmp_path / "one.bam")
    bam.write_parts(df, HEADER, folder, 6)
    order = {"chr1": 0, "chr2": 1, "*": 2}
    want = sorted(rows, key=lambda r: (order[r[2]], r[3], r[0], r[1]))
    parts = bam.read(spark, folder + "/part-*.bam", split=1 << 30)
    assert parts.rdd.getNumPartitions() == len(bam.part_list(folder)) == 6
    assert plain(parts.collect()) == plain(want)
    bam.join_parts(spark, folder, path)
    whole = bam.read(spark, path, split=40_000)
    assert whole.rdd.getNumPartitions() > 6 and plain(whole.collect()) == plain(want)
    assert not [n for n in os.listdir(folder) if n.startswith("_") and n != "_parts.json"]

    bam.build_index(spark, path, split=40_000)
    end = F.col("pos") + F.greatest(F.lit(1), F.when(F.col("cigar") == "*", 1).otherwise(C.reference_length("cigar"))) - 1
    for region, chr_, a, b in [("chr1:500-900", "chr1", 500, 900), ("chr2:30,000-50,000", "chr2", 30000, 50000), ("chr2:1-5000000", "chr2", 1, 5000000), ("chr2:95000-99000", "chr2", 95000, 99000)]:
        got = bam.read(spark, path, region=region).collect()
        assert plain(got) == plain(df.where((F.col("chr") == chr_) & (F.col("pos") <= b) & (end >= a)).collect() and [r for r in want if r[2] == chr_ and r[3] <= b and r[3] + spent(r[5]) - 1 >= a])
    assert bam.read(spark, path, region="chr1:95000-99000").count() == 0 and bam.read(spark, path, region="chr9:1-5").count() == 0


def test_regions_read_few_bytes(spark, tmp_path, monkeypatch):
    folder, path = str(tmp_path / "parts"), str(tmp_path / "one.bam")
    r = random.Random(5)
    rows = [(f"r{k}", 0, "chr2", 100 * k + 1, 9, "60M", "*", 0, 0, "".join(r.choices("ACGT", k=60)), "".join(r.choices("#5I", k=60)), []) for k in range(40_000)]
    bam.write_parts(spark.createDataFrame(rows, S.SAM), HEADER, folder, 4)
    bam.join_parts(spark, folder, path)
    bam.build_index(spark, path)
    read = []

    class Counted:
        def __init__(self, file):
            self.file = file

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.file.close()

        def __getattr__(self, name):
            return getattr(self.file, name)

        def read(self, *n):
            data = self.file.read(*n)
            read.append(len(data))
            return data

    opened = files.opened
    monkeypatch.setattr(bam.files, "opened", lambda p: opened(p) if p.endswith(".bai") else Counted(opened(p)))
    monkeypatch.setattr(bgzf, "AHEAD", 1 << 16)
    reader = bam.BamReader({"path": path, "region": "chr2:2,000,000-2,001,000"})
    got = [d["pos"] for p in reader.partitions() for b in reader.read(p) for d in b.to_pylist()]
    assert got == [k for k in range(1, 4_000_000, 100) if k <= 2_001_000 and k + 59 >= 2_000_000]
    assert sum(read) < os.path.getsize(path) / 3


def spent(cigar):
    import re

    return 1 if cigar == "*" else max(1, sum(int(n) for n, o in re.findall(r"(\d+)([MIDNSHP=X])", cigar) if o in "MDN=X"))


def test_filters_become_regions(spark, tmp_path):
    path = str(tmp_path / "f.bam")
    rows = [r for r in sam_rows(8000, 4) if r[2] != "*"]
    bam.write_parts(spark.createDataFrame(rows, S.SAM), HEADER, str(tmp_path / "p"), 2)
    bam.join_parts(spark, str(tmp_path / "p"), path)
    bam.build_index(spark, path)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        got = bam.read(spark, path).where("chr = 'chr1' and pos >= 400 and pos < 700")
        assert {r["qname"] for r in got.collect()} == {r[0] for r in rows if r[2] == "chr1" and 400 <= r[3] < 700}
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")
    reader = bam.FilteredBamReader({"path": path})
    kept = list(reader.pushFilters([bam.EqualTo(("chr",), "chr1"), bam.GreaterThanOrEqual(("pos",), 400), bam.LessThan(("pos",), 700)]))
    assert len(kept) == 3 and reader.region == ("chr1", 400, 700)


def test_empty_and_wrong_input(spark, tmp_path):
    folder, path = str(tmp_path / "none"), str(tmp_path / "none.bam")
    bam.write_parts(spark.createDataFrame([], S.SAM), HEADER, folder)
    bam.join_parts(spark, folder, path)
    bam.build_index(spark, path)
    assert bam.read(spark, path).count() == 0 and bam.read(spark, path, region="chr1:1-100").count() == 0
    with pytest.raises(Exception, match="no such reference"):
        bam.write_parts(spark.createDataFrame([("x", 0, "chr9", 1, 0, "*", "*", 0, 0, "*", "*", [])], S.SAM), HEADER, str(tmp_path / "bad"))
    with pytest.raises(ValueError, match="no block"):
        (tmp_path / "t.txt").write_text("no such file at all")
        bam.read_header(files.opened(str(tmp_path / "t.txt")))
