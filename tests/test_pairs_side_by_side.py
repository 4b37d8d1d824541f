"""Mates of equal number are read side by side: the pairs that a join by number gives, without one."""

import gzip
import json
import random

import pytest

from methframe import queries
from methframe.operators import preprocess
from methframe.sources import bgzf, sequence


def _records(r, mate, n):
    return [(f"@{k}/{mate}", "".join(r.choices("ACGTN", k=(m := r.randint(1, 60)))), "".join(r.choices("@+#I", k=m))) for k in range(n)]


def _text(records, end="\n"):
    return "".join(f"{i}{end}{s}{end}+{end}{q}{end}" for i, s, q in records).encode()


def _files(r, path, mate, records):
    """The records over some files: plain with either line end, common gzip, block-compressed; one is empty, one lacks its last line end."""
    cuts = [0, *sorted(r.randint(0, len(records)) for _ in range(3)), len(records)]
    names = [f"{path}/{mate}_{k}.fq{e}" for k, e in enumerate(("", ".gz", ".bgz", ""))]
    for k, name in enumerate(names):
        text = _text(records[cuts[k] : cuts[k + 1]], "\r\n" if k == 3 else "\n")
        with gzip.open(name, "wb") if name.endswith(".fq.gz") else open(name, "wb") as f:
            if name.endswith(".bgz"):
                for at in range(0, len(text), 700):
                    f.write(bgzf.block(text[at : at + 700]))
                f.write(bgzf.END)
            else:
                f.write(text[:-1] if k == 0 else text + b"\n" if k == 1 else text)
    open(f"{path}/{mate}_empty.fq", "wb").close()
    return ",".join([names[0], f"{path}/{mate}_empty.fq", *names[1:]])


@pytest.mark.parametrize("chunk, split, n1, n2", [(64, 300, 400, 400), (1 << 19, 300, 400, 350), (200, 4000, 300, 420), (1 << 19, 1 << 20, 50, 50), (64, 100, 0, 5)])
def test_numbers_meet_in_any_files_and_ranges(tmp_path, monkeypatch, chunk, split, n1, n2):
    r = random.Random(chunk + split)
    monkeypatch.setattr(sequence, "CHUNK", chunk)
    one, two = _records(r, 1, n1), _records(r, 2, n2)
    paths = [_files(r, tmp_path, mate, records) for mate, records in ((1, one), (2, two))]
    counts = []
    for path in paths:
        reader = sequence.FastqReader({"path": path, "splitBytes": split, "content": "counts"})
        counts.append([tuple(c[0].as_py() for c in batch.columns) for part in reader.partitions() for batch in reader.read(part)])
    assert [sum(n for _, _, n in side) for side in counts] == [n1, n2]
    reader = sequence.PairReader({"path1": paths[0], "path2": paths[1], "splitBytes": split, "records": json.dumps(counts)})
    got = sorted(row for part in reader.partitions() for batch in reader.read(part) for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    assert got == [(k, *a, *b) for k, (a, b) in enumerate(zip(one, two, strict=False))]
    with pytest.raises(ValueError):
        sequence.PairReader({"path1": paths[0], "path2": paths[1], "splitBytes": split, "records": json.dumps([counts[0][1:], counts[1]])}).partitions()


def test_what_is_no_record(tmp_path, monkeypatch):
    monkeypatch.setattr(sequence, "CHUNK", 32)
    good = _text([("@a", "ACGT", "IIII"), ("@b", "AC", "II")])

    def read(text):
        (tmp_path / "x.fq").write_bytes(text)
        return [x[0] for part in sequence.FastqReader({"path": f"{tmp_path}/x.fq"}).partitions() for x in sequence._records(part)]

    assert read(good + b"\n" + good) == [b"@a", b"@b"] and read(b"") == []
    for bad in (b"x\nA\n+\nI\n", b"@c\nA\n+\n", b"@c"):
        with pytest.raises(ValueError, match=f"byte {len(good)} "):
            read(good + bad)


def test_pairs_are_not_shuffled(spark, tmp_path):
    r = random.Random(8)
    paths = [_files(r, tmp_path, mate, _records(r, mate, 900)) for mate in (1, 2)]
    plain = [",".join(p for p in path.split(",") if not p.endswith(".fq.gz")) for path in paths]
    got = sequence.mates(spark, *plain, split=2000)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString() and got.rdd.getNumPartitions() > 4
    for a, b in (plain, paths):
        want = preprocess.zip_pairs(sequence.fastq(spark, a, 2000), sequence.fastq(spark, b, 2000))
        assert sorted(map(tuple, sequence.fastq_pairs(spark, a, b, 2000).collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("name", ["fastq_pairs_roundtrip", "fastq_blocks"])
def test_pairs_go_to_files_in_order_and_move_as_keys(spark, name, monkeypatch):
    """Every row of a table of 6,000 in its place; nothing is stored but the files that are read."""
    folders = []
    kept = queries.folder
    monkeypatch.setattr(queries, "folder", lambda *a: folders.append(kept(*a)) or folders[-1])
    monkeypatch.setattr(queries, "stored", lambda *a: pytest.fail("pairs are stored"), raising=False)
    got = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString() and len(folders) == (1 if name == "fastq_pairs_roundtrip" else 2)
    raw = preprocess.equal_mates(queries.Fixtures(spark, "/root/testdata/sf0.001").raw).orderBy("read_no").collect()
    columns = ("id1", "seq1", "qual1", "id2", "seq2", "qual2")
    rows = got.orderBy("read_no").collect()
    assert [x["read_no"] for x in rows] == list(range(len(raw))) and len(raw) > 5000
    assert [[x[c] for c in columns] for x in rows] == [[x[c] for c in columns] for x in raw]
