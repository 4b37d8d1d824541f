"""Sequence files in byte ranges: every record once, numbers in file order, tiles without whole chromosomes."""

import gzip
import random

import pytest

from methframe.operators import align, calls, genome
from methframe.sources import bgzf, blocks, sequence, sinks


def fastq_text(r, n, end="\n"):
    out = []
    for k in range(n):
        length = r.choice([1, 30, 200])
        qual = r.choice("@+I") + "".join(chr(r.randint(33, 74)) for _ in range(length - 1))
        out.append(f"@read{k} @x{end}{''.join(r.choices('ACGT', k=length))}{end}+{r.choice(['', '@again'])}{end}{qual}")
    return end.join(out)


@pytest.mark.parametrize("split", [37, 500, 4000, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_fastq_ranges(spark, tmp_path, split, end):
    r = random.Random(split)
    texts = [fastq_text(r, n, end) for n in (300 if split > 37 else 40, 0, 1, 17)]
    paths = []
    for k, t in enumerate(texts):
        path = tmp_path / f"{k}.fq"
        path.write_bytes((t + (end if k % 2 else "")).encode() if t else b"")
        paths.append(str(path))
    with gzip.open(tmp_path / "z.fq.gz", "wt") as f:
        f.write(texts[3])
    paths.append(str(tmp_path / "z.fq.gz"))
    want, n = [], 0
    for t in [*texts, texts[3]]:
        lines = t.split(end) if t else []
        for k in range(0, len(lines), 4):
            want.append((n, lines[k], lines[k + 1], lines[k + 3]))
            n += 1
    df = sequence.fastq(spark, ",".join(paths), split)
    assert sorted(map(tuple, df.collect())) == want
    reader = sequence.FastqReader({"path": paths[0], "splitBytes": split})
    assert len(reader.partitions()) == max(1, -(-len((tmp_path / "0.fq").read_bytes()) // split))


def test_patterns_and_missing_files(spark, tmp_path):
    (tmp_path / "d1").mkdir()
    (tmp_path / "d2").mkdir()
    for k, d in enumerate(("d2", "d1")):
        (tmp_path / d / "a_1.fq").write_text(f"@r{k}\nACGT\n+\nIIII\n")
    got = sequence.fastq(spark, f"file://{tmp_path}/d*/a_?.fq").orderBy("read_no").collect()
    assert [(x["read_no"], x["id"]) for x in got] == [(0, "@r1"), (1, "@r0")]
    with pytest.raises(FileNotFoundError):
        sequence.expand(f"{tmp_path}/no*.fq")


def genome_file(path, rows, width=50, end="\n"):
    with open(path, "w", newline="") as f:
        for name, seq in rows:
            f.write(f">{name} about it{end}")
            f.write("".join(seq[k : k + width] + end for k in range(0, len(seq), width)))


@pytest.mark.parametrize("split", [23, 100, 1000, 1 << 20])
@pytest.mark.parametrize("width, end", [(50, "\n"), (50, "\r\n"), (1 << 20, "\n")])
def test_fasta_tiles(spark, tmp_path, split, width, end):
    r = random.Random(split)
    lengths = (0, 1, 63, 64, 65, 700) if split > 23 else (0, 65, 130)
    rows = [(f"chr{k}", "".join(r.choices("ACGTacgtN", k=n))) for k, n in enumerate(lengths)]
    genome_file(tmp_path / "a.fa", rows[:3], width, end)
    genome_file(tmp_path / "b.fa", rows[3:], width, end)
    paths = f"{tmp_path}/a.fa,{tmp_path}/b.fa"
    whole = sequence.fasta(spark, paths)
    assert sorted(map(tuple, whole.collect())) == sorted(rows)
    want = {(x["chr"], x["tile"]): bytes(x["piece"]).upper() for x in genome.tiles(whole.where("seq <> ''"), 64, 16).collect()}
    got = sequence.fasta_tiles(spark, paths, 64, 16, split).collect()
    assert {(x["chr"], x["tile"]): bytes(x["piece"]) for x in got} == want and len(got) == len(want)
    assert {(x["chr"], x["length"]) for x in got} == {(n, len(s)) for n, s in rows if s}


def test_calls_and_alignment_over_tiles(spark, tmp_path):
    r = random.Random(7)
    seqs = [(f"chr{k}", "".join(r.choices("ACGT", k=3000))) for k in (1, 2)]
    genome_file(tmp_path / "g.fa", seqs)
    tiles = sequence.fasta_tiles(spark, str(tmp_path / "g.fa"), split=700)
    whole = spark.createDataFrame(seqs, "chr string, seq string")
    reads = []
    for k in range(200):
        name, seq = r.choice(seqs)
        at = r.randrange(0, 2950)
        part = seq[at : at + 50]
        reads.append((k, part.replace("C", "T"), "I" * len(part)))
    df = spark.createDataFrame(reads, "read_no long, seq string, qual string")
    rows = lambda x: sorted(map(repr, x.select(*sorted(x.columns)).collect()))
    one, two = align.align(df, whole, "W"), align.align(df, tiles, "W")
    assert rows(one) == rows(two) and one.count() > 150
    hits = one.selectExpr("*", "'W' as strand")
    assert rows(calls.call(hits, whole)) == rows(calls.call(hits, tiles))
    assert rows(calls.chr_log(hits, calls.call(hits, whole), whole)) == rows(calls.chr_log(hits, calls.call(hits, tiles), tiles))
    assert rows(genome.chr_info(whole)) == rows(genome.chr_info(tiles))


def _blocks(path, text, size):
    """A block-compressed file whose blocks hold *size* bytes of text, and an empty one now and then."""
    with open(path, "wb") as f:
        for k, at in enumerate(range(0, len(text), size)):
            f.write(bgzf.block(text[at : at + size]))
            if k % 7 == 3:
                f.write(bgzf.block(b""))
        f.write(bgzf.END)


@pytest.mark.parametrize("block, split", [(50, 64), (333, 100), (4000, 1500), (100, 1 << 20)])
def test_fastq_in_blocks(tmp_path, block, split):
    r = random.Random(block)
    text = fastq_text(r, 200).encode() + b"\n"
    path = str(tmp_path / "a.fq.gz")
    _blocks(path, text, block)
    lines = text.decode().split("\n")
    want = [(lines[k], lines[k + 1], lines[k + 3]) for k in range(0, len(lines) - 1, 4)]
    reader = sequence.FastqReader({"path": path, "splitBytes": split})
    got = [tuple(x.decode() for x in record) for part in reader.partitions() for record in sequence._records(part)]
    assert got == want
    assert (len(reader.partitions()) > 1) == (split < 1 << 20)


def test_records_that_begin_with_a_block(tmp_path):
    records = [f"@r{k}\nACGT\n+\n@III\n".encode() for k in range(90)]
    with open(tmp_path / "a.fq.bgz", "wb") as f:
        sizes = [f.write(bgzf.block(x)) for x in records]
        f.write(bgzf.END)
    for split in (1, 7, sizes[0], sizes[0] + 1, 3 * sizes[0]):
        reader = sequence.FastqReader({"path": str(tmp_path / "a.fq.bgz"), "splitBytes": split})
        got = [record[0] for part in reader.partitions() for record in sequence._records(part)]
        assert got == [f"@r{k}".encode() for k in range(90)]


def test_written_in_blocks(spark, tmp_path):
    rows = spark.range(0, 5000, 1, 3).selectExpr("id as n", "'r' || id as id", "repeat('ACGT', 20) as seq", "repeat('I', 80) as qual").repartitionByRange(5, "n").sortWithinPartitions("n")
    blocks.write(sinks.fastq_lines(rows), str(tmp_path / "out"))
    paths = sorted((tmp_path / "out").glob("part-*"))
    assert len(paths) == 5 and len(list((tmp_path / "out").iterdir())) == 5
    assert gzip.open(paths[0], "rt").readline() == "@r0\n"  # any gzip program reads it
    got = sequence.fastq(spark, f"{tmp_path}/out/part-*", split=2000)
    assert got.rdd.getNumPartitions() > 5
    assert [(x["read_no"], x["id"]) for x in got.orderBy("read_no").collect()] == [(k, f"@r{k}") for k in range(5000)]
    blocks.write(rows.limit(0).selectExpr("cast(null as string) as value"), str(tmp_path / "none"))
    assert sequence.fastq(spark, f"{tmp_path}/none/part-*").count() == 0
