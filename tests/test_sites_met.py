"""CpG sites are met by stretches, without a walk over the places of each read; overlapping mates are judged at the sites alone."""

from methframe.operators import calls, genome

SEQ = "CGAACGTTCGCGATACGcgTTACG" * 6 + "C"


def frame(spark, schema, rows):
    return spark.createDataFrame(rows, schema)


def test_sites_of_any_tile_and_stretch(spark):
    g = frame(spark, "chr string, seq string", [("chr1", SEQ), ("chr2", "CG"), ("chr3", "C"), ("chr4", "")])
    want = sorted((c, k + 1, ("X" + s)[k : k + 4]) for c, s in (("chr1", SEQ), ("chr2", "CG")) for k in range(len(s) - 1) if s[k : k + 2].upper() == "CG")
    for near, tile in ((64, 1 << 16), (64, 16), (5, 16), (7, 32)):
        got = genome.cpg_sites(g, near, tile, 16).collect()
        assert sorted((r["chr"], r["locus"], r["context"]) for r in got) == want
        assert all(r["near"] == (r["locus"] - 1) // near for r in got)


def test_overlapping_mates_at_sites(spark):
    g = frame(spark, "chr string, seq string", [("chr1", SEQ)])
    rows = []
    for k in range(60):
        a, b, n, m = 1 + k, 1 + k * 7 % 80, 30 + k % 9, 20 + k % 23
        q1, q2 = ("".join(chr(40 + (k * s + i * t) % 30) for i in range(w)) for s, t, w in ((3, 7, n), (5, 11, m)))
        rows.append((k, "chr1", "WC"[k % 2], 40, a, f"{n}M", SEQ[a - 1 : a - 1 + n].replace("C", "T"), q1, b, f"{m}M", SEQ[b - 1 : b - 1 + m], q2))
    pairs = frame(spark, "read_no long, chr string, strand string, mapq int, pos1 long, cigar1 string, seq1 string, qual1 string, pos2 long, cigar2 string, seq2 string, qual2 string", rows)
    observed = calls.observations(calls.shown(pairs, g), g)
    whole = calls.fragments(calls.usable(pairs, g)).collect()  # mates joined base by base
    want = []
    for f in whole:
        for i in range(len(f["bases"])):
            at = f["pos"] - 1 + i - (f["strand"] == "C")
            if at >= 0 and SEQ[at : at + 2].upper() == "CG":
                want.append((f["strand"], f["mate"], f["apart"], at + 1, i, len(f["bases"]), f["bases"][i], ("X" + SEQ)[at : at + 4]))
    got = [(r["strand"], r["mate"], r["apart"], r["locus"], r["i"], r["n"], r["base"], r["context"]) for r in observed.collect()]
    assert sorted(got) == sorted(want) and any(not f["apart"] for f in whole) and any(f["apart"] for f in whole)
    plan = observed._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(sequence(" not in plan and "transform(sequence(" not in plan
