import gzip

import pytest

from methframe.operators import dedup, genome, merge
from methframe.plans.pipeline import Conf, Pipeline
from methframe.sources import sequence, sinks, text
from methframe.streaming import calls as streaming


def test_fastq_files(spark, tmp_path):
    (tmp_path / "a_1.fq").write_text("@r0 x\nACGT\n+\nIIII\n@r1\nAC\n+\nII\n")
    with gzip.open(tmp_path / "b_1.fq.gz", "wt") as f:
        f.write("@r2\nGGG\n+\nJJJ")
    rows = sequence.fastq(spark, f"{tmp_path}/a_1.fq,{tmp_path}/b_1.fq.gz").orderBy("read_no").collect()
    assert [tuple(r) for r in rows] == [(0, "@r0 x", "ACGT", "IIII"), (1, "@r1", "AC", "II"), (2, "@r2", "GGG", "JJJ")]
    pairs = sequence.fastq_pairs(spark, f"{tmp_path}/a_1.fq", f"{tmp_path}/a_1.fq").collect()
    assert len(pairs) == 2
    with pytest.raises(ValueError):
        sequence.fastq_pairs(spark, f"{tmp_path}/a_1.fq,{tmp_path}/b_1.fq.gz", f"{tmp_path}/a_1.fq")
    lines = sinks.fastq_lines(sequence.fastq(spark, f"{tmp_path}/a_1.fq")).collect()
    assert lines[0]["value"] == "@r0 x\nACGT\n+\nIIII"


def test_fasta(spark, tmp_path):
    (tmp_path / "g.fa").write_text(">1 first\nacgt\nAC\n>chrX\nGG")
    raw = sequence.fasta(spark, str(tmp_path / "g.fa"))
    assert {tuple(r) for r in genome.prepare(raw).collect()} == {("chr1", "ACGTAC"), ("chrX", "GG")}
    assert sinks.fasta_lines(genome.prepare(raw), 4).orderBy("value").first()["value"] == ">chr1\nACGT\nAC"


def test_tables(spark, tmp_path):
    (tmp_path / "x.sam").write_text("@HD\tVN:1.0\nr\t0\tchr1\t5\t30\t4M\t*\t0\t0\tACGT\tIIII\tAS:i:-3\tXS:i:-9\tXG:Z:CT\n")
    row = text.sam(spark, str(tmp_path / "x.sam")).withColumns({"s": merge.score_of(), "second": merge.has_second(), "strand": text.strand_of()}).first()
    assert (row["pos"], row["cigar"], row["s"], row["second"], row["strand"]) == (5, "4M", -3, True, "W")
    (tmp_path / "x.bed").write_text("#c\nchr1\t1\t5\tname\n")
    assert tuple(text.bed(spark, str(tmp_path / "x.bed")).first()) == ("chr1", 1, 5, "chr1\t1\t5\tname")
    (tmp_path / "log").write_text("12\nDropped : 3\nAadaptor: 4\nALL\t9\n")
    assert {tuple(r) for r in text.metrics(spark, str(tmp_path / "log")).collect()} == {("Dropped", 3), ("Aadaptor", 4), ("ALL", 9)}
    (tmp_path / "genes").write_text("\t".join(["0", "n", "chr1", "+", "5", "9"] + ["x"] * 6 + ["G", "x", "x", "x"]) + "\n")
    assert tuple(text.refgene(spark, str(tmp_path / "genes")).first()) == ("chr1", "+", 5, 9, "G")


def test_text_forms(spark):
    info = spark.createDataFrame([("chr2", 20), ("chr1", 10)], "chr string, length long")
    values = spark.createDataFrame([("chr1", 1, 2.5)], "chr string, pos long, value double")
    assert [r["value"] for r in sinks.wig_lines(values, 10, info, "t").collect()] == ["track type='wiggle_0' name='t' description='t, bin=10'", "variableStep chrom=chr1 span=10", "1\t2.5000", "variableStep chrom=chr2 span=10"]
    assert [r["value"].split("\t")[0] for r in sinks.sam_header(info, {}).collect()] == ["@HD", "@SQ", "@SQ", "@PG"]
    counters = spark.createDataFrame([(10, 1, 2, 3)], "total long, dropped long, adapter long, tail long")
    assert [r["value"] for r in sinks.trim_log_lines(counters).collect()] == ["11", "Dropped : 1", "Aadaptor: 2", "Tail Hit: 3"]


def test_pipeline_run(spark, tmp_path):
    g = spark.createDataFrame([("chr1", "ACGTTCGA"), ("chrL", "CG")], "chr string, seq string")
    reads = spark.createDataFrame(
        [(1, "chr1", 1, 40, "8M", "ACGTTTGA", "IIIIIIII", "W"), (2, "chr1", 1, 40, "8M", "ACATTCGA", "IIIIIIII", "C"), (3, "chr1", 1, 40, "8M", "ACGTTTGA", "IIIIIIII", "W"), (4, "chrU", 1, 9, "8M", "ACGTTTGA", "IIIIIIII", "W")],
        "read_no long, chr string, pos long, mapq int, cigar string, seq string, qual string, strand string",
    )
    out = Pipeline(spark, Conf(call_cph=True), str(tmp_path)).run(reads, g, cycle=8)
    assert tuple(out["dedup_log"].first()) == (4, 2, 1, 1)
    assert out["calls"].count() == 2 and out["cph"].count() == 2
    assert {r["strand"]: r["level"] for r in out["totals"].collect()} == {"watson": 50.0, "crick": 50.0, "total": 50.0}
    assert out["conversion"].first()["rate"] is None


def test_conf_checks():
    with pytest.warns(UserWarning):
        assert Conf(mode=4, protocol="bs").checked().mode == 3
    assert Conf(protocol="taps", mode=4).checked().protocol == "TAPS"
    for bad in (Conf(kit="x"), Conf(max_ins=0), Conf(min_ins=5, max_ins=4), Conf(phred=1), Conf(mode=5), Conf(protocol="x")):
        with pytest.raises(ValueError):
            bad.checked()


def test_streamed_calls(spark, tmp_path):
    schema = "chr string, locus long, total long, wC long, wT long, wO long, context string, cC long, cT long, cO long"
    parts = [[("chr1", 5, 2, 1, 1, 0, "ACGT", 0, 0, 0)], [("chr1", 5, 1, 0, 0, 0, "ACGT", 1, 0, 0), ("chr1", 9, 1, 1, 0, 0, "TCGA", 0, 0, 0)]]
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
        for f in (tmp_path / "in" / str(i)).glob("part-*"):
            f.rename(tmp_path / "in" / f"{i}-{f.name}")
    query = streaming.write_merged(streaming.read_calls(spark, f"{tmp_path}/in", 1), f"{tmp_path}/out", f"{tmp_path}/state")
    query.processAllAvailable()
    query.stop()
    rows = {r["locus"]: (r["total"], r["wC"], r["wT"], r["cC"]) for r in streaming.latest(spark, f"{tmp_path}/out").collect()}
    assert rows == {5: (3, 1, 1, 1), 9: (1, 1, 0, 0)}


def test_unknown_chromosomes(spark):
    info = spark.createDataFrame([("chr1", 5)], "chr string, length long")
    df = spark.createDataFrame([("chr1", 1), ("chrU", 2)], "chr string, read_no long")
    assert [r["read_no"] for r in dedup.discarded(df, info).collect()] == [2]


def test_longer_reads_than_100_bases_have_all_cycles(spark):
    """Without a given cycle the M-bias table covers the longest read, on both strands."""
    g = spark.createDataFrame([("chr1", "ACGT" * 60)], "chr string, seq string")
    reads = spark.createDataFrame(
        [(k, "chr1", 1 + 4 * k, 40, "150M", ("ACGT" * 40)[:150], "I" * 150, strand) for k, strand in enumerate("WCWC")],
        "read_no long, chr string, pos long, mapq int, cigar string, seq string, qual string, strand string",
    )
    out = Pipeline(spark, Conf()).run(reads, g)
    table = {r["cycle"]: r for r in out["mbias_1"].collect()}
    assert sorted(table) == list(range(1, 151))
    counters = ["wC", "wT", "wO", "cC", "cT", "cO"]
    called = out["calls"].collect()
    assert [sum(r[k] for r in table.values()) for k in counters] == [sum(r[k] for r in called) for k in counters]
    # C of CpG at offset 1 on W; on C its G at offset 2, counted from the read's right end.
    assert table[2]["wC"] == 2 and table[148]["cC"] == 2
