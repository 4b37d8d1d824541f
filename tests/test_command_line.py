from methframe.__main__ import main


def read(path):
    return sorted(x for f in path.glob("part-*") for x in f.read_text().splitlines())


def test_commands(spark, tmp_path):
    (tmp_path / "g.fa").write_text(">chr1\nACGTTCGA\n>chr2\nCCGG\n")
    main(["index", str(tmp_path / "g.fa"), str(tmp_path / "index")])
    reads = spark.createDataFrame(
        [(1, "a_R1", "chr1", 1, 40, "8M", "ACGTTTGA", "IIIIIIII", "W"), (2, "b_R1", "chr1", 1, 40, "8M", "ACATTCGA", "IIIIIIII", "C")],
        "read_no long, name string, chr string, pos long, mapq int, cigar string, seq string, qual string, strand string",
    )
    reads.write.parquet(str(tmp_path / "aln"))
    main(["run", str(tmp_path / "aln"), str(tmp_path / "index"), str(tmp_path / "out"), "--cycle", "8"])
    rows = [x for x in read(tmp_path / "out" / "calls") if not x.startswith("#")]
    assert rows == ["chr1\t2\t2\t1\t0\t0\tACGT\t0\t1\t0", "chr1\t6\t2\t0\t1\t0\tTCGA\t1\t0\t0"]
    assert "total" in (tmp_path / "out" / "report.html").read_text()
    main(["view", str(tmp_path / "aln"), str(tmp_path / "index"), "chr1:1-8", str(tmp_path / "v")])
    assert (tmp_path / "v.txt").read_text().splitlines()[3:] == ["-M---U--", "-U---M--"]
    (tmp_path / "info").write_text("chr1\t8\nchr2\t4\n")
    (tmp_path / "bed").write_text("chr1\t0\t4\tx\nchr1\t2\t5\ty\n")
    main(["regions", str(tmp_path / "info"), str(tmp_path / "out" / "calls"), str(tmp_path / "bed"), str(tmp_path / "r")])
    assert read(tmp_path / "r") == ["chr1\t0\t4\tx\t1\t1\t1", "chr1\t2\t5\ty\t0\t0\t0"]
    main(["merge", str(tmp_path / "m"), str(tmp_path / "out" / "calls"), str(tmp_path / "out" / "calls")])
    assert "chr1\t2\t4\t2\t0\t0\tACGT\t0\t2\t0" in read(tmp_path / "m")
    main(["bins", str(tmp_path / "out" / "calls"), "4", str(tmp_path / "b"), "--mask", "hs"])
    assert len([x for x in read(tmp_path / "b") if x.startswith("hs1\t")]) == 2
    main(["wig", str(tmp_path / "info"), str(tmp_path / "bed"), "4", str(tmp_path / "w"), "--raw"])
    assert "1\t4.0000" in read(tmp_path / "w")
    (tmp_path / "x.fq").write_text("@r\n" + "ACGT" * 8 + "\n+\n" + "I" * 32 + "\n")
    main(["trim", str(tmp_path / "x.fq"), str(tmp_path / "t")])
    assert any(x.startswith("@0+1;5;9") for x in read(tmp_path / "t" / "R1.fq"))
