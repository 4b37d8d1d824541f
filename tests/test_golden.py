"""Hand-derived cases of single operators."""

import pytest
from pyspark.sql import functions as F

from methframe.functions import cigar as C
from methframe.functions import reads as R
from methframe.operators import calls, dedup, genome, intervals, merge, preprocess, profile, simulate, view


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def one(df):
    return tuple(df.first())


def test_cigar_projection(spark):
    df = frame(spark, "cigar string, seq string", ("3M1I2M2D2M", "AAACGGTT"))
    assert one(df.select(C.bases("cigar", "seq"), C.reference_length("cigar"))) == ("AAAGGNNTT", 9)
    assert one(frame(spark, "cigar string", ("5M3S",)).select(C.reference_length("cigar"), C.supported("cigar"))) == (0, False)


def test_mode3_read1(spark):
    df = frame(spark, "read_no long, id string, seq string, qual string", (1, "@name x", "ACGTCCGC", "IIIIIIII"))
    out = preprocess.packed_ids(preprocess.convert(df, 3), 3).first()
    assert (out["seq"], out["conv"], out["name1"]) == ("ATGTTTGT", [1, 4, 5, 7], "@1+1;4;5;7#name")


def test_mode4_mates(spark):
    df = frame(spark, "read_no long, id1 string, seq1 string, qual1 string, id2 string, seq2 string, qual2 string", (1, "@name", "ACGTCCGC", "IIIIIIIQ", "@name", "GACGTCG", "QIIIIII"))
    out = preprocess.packed_ids(preprocess.convert(df, 4), 4).first()
    assert (out["seq1"], out["conv1"], out["end_qual1"], out["name1"]) == ("ATGTCTG", [1, 5], "Q", "@1+Q|1;5#name")
    assert (out["seq2"], out["conv2"], out["end_qual2"], out["name2"]) == ("ACATCA", [3, 6], "Q", "@Q|3;6#name")
    back = preprocess.unpack_ids(frame(spark, "name1 string", (out["name1"],))).first()
    assert (back["line"], back["end_qual"], back["conv"], back["id"]) == (1, "Q", [1, 5], "name")


def test_deconvert(spark):
    schema = "seq string, qual string, cigar string, pos long, strand string, conv array<int>, end_qual string"
    w1 = merge.deconvert(frame(spark, schema, ("ATGTCTG", "IIIIIII", "7M", 10, "W", [1, 5], "Q")), 1)
    assert one(w1.select("seq", "qual", "cigar", "pos")) == ("ACGTCCGC", "IIIIIIIQ", "8M", 10)
    w2 = merge.deconvert(frame(spark, schema, ("TGATGT", "IIIIII", "6M", 10, "W", [3, 6], "Q")), 2)
    assert one(w2.select("seq", "qual", "cigar", "pos")) == ("CGACGTC", "IIIIIIQ", "7M", 10)


def test_quality_trim_pair(spark):
    df = frame(spark, "a string, b string", ("III#I###", "IIIII###"))
    assert one(df.select(R.quality_trim(53, "a", "b"))) == (5,)
    assert one(frame(spark, "a string", ("####",)).select(R.quality_trim(53, "a"))) == (1,)


@pytest.mark.parametrize("lead, at, dropped", [(22, 22, False), (18, 18, True)])
def test_adapter_single(spark, lead, at, dropped):
    seq = "CT" * (lead // 2) + "AGATCGG"
    df = frame(spark, "read_no long, id string, seq string, qual string", (1, "@r", seq, "I" * len(seq)))
    out = preprocess.trim(df).first()
    assert (out["adapter_at"], out["dropped"]) == (at, dropped)
    counters = preprocess.trim_counters(preprocess.trim(df)).first()
    assert (counters["adapter"], counters["dropped"]) == (1, int(dropped))


@pytest.mark.parametrize(
    "w, c, expected",
    [
        ((40, -6, False), (30, 0, False), ("C", 15)),
        ((40, 0, False), (40, 0, False), None),
        ((40, -6, False), (1, 0, False), None),
        ((1, 0, False), None, ("W", 1)),
        ((1, 0, True), None, None),
        (None, (2, 0, True), ("C", 2)),
    ],
)
def test_merge(spark, w, c, expected):
    schema = "read_no long, mapq int, as_score int, has_xs boolean"
    sides = [frame(spark, schema, (7, *x)) if x else spark.createDataFrame([], schema) for x in (w, c)]
    rows = merge.merge_hypotheses(*sides).collect()
    assert [(r["strand"], r["mapq"]) for r in rows] == ([expected] if expected else [])


PAIR = "read_no long, chr string, strand string, mapq int, pos1 long, cigar1 string, seq1 string, qual1 string, pos2 long, cigar2 string, seq2 string, qual2 string"


def test_dedup_pairs(spark):
    q = "I" * 36
    info = frame(spark, "chr string, length long", ("chr1", 1000))
    w, c = (3, "chr1", "W", 30, 100, "36M", q, q, 150, "36M", q, q), (4, "chr1", "C", 30, 150, "36M", q, q, 100, "36M", q, q)
    df = frame(spark, PAIR, w, c)
    assert [r["frag_size"] for r in dedup.dedup_pairs(df, info).collect()] == [86, 86]
    same = frame(spark, PAIR, w, (7, *w[1:]))
    unique = dedup.dedup_pairs(same, info)
    assert [r["read_no"] for r in unique.collect()] == [3]
    assert one(dedup.dedup_log(same, info, unique)) == (2, 1, 1, 0)


@pytest.fixture
def small(spark):
    g = frame(spark, "chr string, seq string", ("chr1", "ACGTTCGA"))
    reads = frame(
        spark, "read_no long, chr string, pos long, mapq int, cigar string, seq string, qual string, strand string",
        (1, "chr1", 1, 40, "8M", "ACGTTTGA", "I" * 8, "W"), (2, "chr1", 1, 40, "8M", "ACATTCGA", "I" * 8, "C"),
    )
    return g, reads


def test_calls(small):
    g, reads = small
    called = calls.call(reads, g)
    assert {tuple(r) for r in called.collect()} == {("chr1", 2, 2, 1, 0, 0, "ACGT", 0, 1, 0), ("chr1", 6, 2, 0, 1, 0, "TCGA", 1, 0, 0)}
    for protocol in ("BS", "TAPS"):
        assert {tuple(r) for r in calls.bedgraph(called, protocol).collect()} == {("chr1", 1, 2, 50.0), ("chr1", 5, 6, 50.0)}
    assert one(calls.chr_log(reads, called, g)) == ("chr1", 2, 1, 1, 1, 1)
    table = {r["cycle"]: tuple(r)[1:] for r in calls.mbias(calls.observations(calls.shown(reads, g), g), 8).collect()}
    assert len(table) == 8 and table[2] == (1, 0, 0, 1, 0, 0) and table[6] == (0, 1, 0, 0, 1, 0)
    assert all(not any(v) for k, v in table.items() if k not in (2, 6))


def test_cph(small):
    g, reads = small
    found = {(r["locus"], r["cC"], r["cT"]) for r in calls.call(reads, g, context="CpH").collect()}
    assert found == {(3, 0, 1), (7, 1, 0)}
    assert calls.call(reads, g, context="CpH", exclude_crick_cpg=True).count() == 0


def test_region_stats(spark, small):
    g, reads = small
    bed = frame(spark, "chr string, start long, end long", ("chr1", 0, 4), ("chr1", 2, 5), ("chr9", 0, 5), ("chr1", 0, 4))
    out = sorted(tuple(r) for r in profile.region_stats(calls.call(reads, g), bed, genome.chr_info(g)).collect())
    assert out == [("chr1", 0, 4, 1, 1, 1), ("chr1", 0, 4, 1, 1, 1), ("chr1", 2, 5, 0, 0, 0)]


def test_coverage(spark):
    bed, info = frame(spark, "chr string, start long, end long", ("chr1", 5, 25)), frame(spark, "chr string, length long", ("chr1", 100))
    assert {(r["pos"], r["value"]) for r in intervals.coverage(bed, info, 10, normalise=False).collect()} == {(1, 4.0), (11, 10.0), (21, 6.0)}


def test_tss_bins(spark):
    genes = frame(spark, "chr string, strand string, tx_start long, tx_end long, gene string", ("chr1", "+", 5000, 9000, "A"), ("chr2", "-", 1000, 5000, "B"))
    rows = genome.tss_bins(genes).collect()
    assert len(rows) == 82
    at = {r["chr"]: (r["start"], r["end"]) for r in rows if r["distance"] == -4000}
    assert at == {"chr1": (1000, 1200), "chr2": (8800, 9000)}


def test_glyphs(spark, small):
    g, reads = small
    frags = reads.select(F.col("read_no").cast("string").alias("name"), "chr", "pos", "seq", "strand")
    assert {r["strand"]: r["glyphs"] for r in view.glyphs(frags, g).collect()} == {"W": "-M---U--", "C": "-U---M--"}


@pytest.mark.parametrize("errors, total, kept", [(5, 50, False), (5, 51, True), (4, 4, True)])
def test_site_filter(spark, errors, total, kept):
    df = frame(spark, "wO long, cO long, total long", (errors, 0, total))
    assert profile.clean_sites(df).count() == int(kept)


def test_binned_names(spark):
    schema = "chr string, locus long, wC long, wT long, cC long, cT long"
    df = frame(spark, schema, *[(c, 5, 1, 1, 0, 0) for c in ("chr1", "chrX", "chrM", "chr6_random")])
    assert {r["chr"] for r in profile.binned(df, 100, "hs").collect()} == {"hs1", "hsX"}


def test_tiles_do_not_change_calls(spark, small):
    g, reads = small
    g = g.unionByName(frame(spark, "chr string, seq string", ("chr2", "ACGTTCGA" * 9)))
    far = reads.withColumn("chr", F.lit("chr2")).withColumn("pos", F.col("pos") + 40)
    df = reads.unionByName(far)
    frags = calls.shown(df, g)
    plain = calls.calls(calls.observations(frags, g))
    tiled = calls.calls(calls.observations(frags, g, tile=16, span=16))
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, tiled.collect()))


def test_region_text():
    assert view.parse_region("chr7:1,234-5,678") == ("chr7", 1234, 5678)
    with pytest.raises(ValueError):
        view.parse_region("chr7")
    assert view.region_warning("chr1:1-20001") and not view.region_warning("chr1:1-100")


def test_simulated_level(spark):
    """Reads simulated at a known rate give it back."""
    seq = simulate.random_sequences(spark, 1, 20_000, seed=3).first()["seq"]
    g = frame(spark, "chr string, seq string", ("chr1", seq))
    conf = simulate.SimConfig(n=2000, length=60, paired=False, cg_conversion=30.0, ch_conversion=100.0)
    reads = simulate.simulate(spark, g, conf)
    assert sorted(map(tuple, reads.collect())) == sorted(map(tuple, reads.repartition(3).collect()))
    p = F.split("id", "[_:-]")
    strand = F.when(F.expr("pmod(xxhash64(1, 'strand', read_no), 1073741824) < 536870912"), "W").otherwise("C")
    placed = reads.withColumn("strand", strand)
    seq_ = F.when(F.col("strand") == "W", F.col("seq")).otherwise(R.reverse_complement("seq"))
    aligned = placed.select("read_no", p[1].alias("chr"), p[2].cast("long").alias("pos"), F.lit(40).alias("mapq"), F.lit("60M").alias("cigar"), seq_.alias("seq"), "qual", "strand")
    total = calls.call(aligned, g).agg(F.sum(F.col("wC") + F.col("cC")).alias("c"), F.sum(F.col("wT") + F.col("cT")).alias("t"), F.sum(F.col("wO") + F.col("cO")).alias("o")).first()
    assert abs(total["c"] / (total["c"] + total["t"]) - 0.7) < 0.03 and total["o"] == 0


def test_quality_curve():
    curve = simulate.quality_curve(100, 0.5)
    assert curve[0] >= curve[-1] >= 2 and abs(sum(10 ** (-q / 10) for q in curve) - 0.5) < 0.1
    assert simulate.quality_curve(5, 0) == [40] * 5


def test_aligner_finds_simulated_places(spark):
    """Simulated bisulfite reads, aligned under both hypotheses and merged, lie where they came from."""
    from methframe.operators import align

    seq = simulate.random_sequences(spark, 1, 30_000, seed=5).first()["seq"]
    g = frame(spark, "chr string, seq string", ("chr1", seq))
    conf = simulate.SimConfig(n=400, length=60, paired=False, cg_conversion=50.0, ch_conversion=99.5, error=0.5)
    reads = simulate.simulate(spark, g, conf)
    converted = preprocess.convert(reads, 3)
    merged = merge.merge_hypotheses(align.align(converted, g, "W"), align.align(converted, g, "C"))
    rows = profile.accuracy_single(merged.join(reads.select("read_no", "id"), "read_no")).first()
    assert rows["total"] > 0.95 * reads.count() and rows["percent"] > 97


def test_aligner_checks_every_place_of_a_repeat(spark):
    """Reads of a repeat family of more than 64 copies are aligned and told to be ambiguous."""
    from methframe.operators import align

    parts = [r["seq"] for r in simulate.random_sequences(spark, 101, 60, seed=7).collect()]
    unit, rest = parts[0].replace("C", "T"), [p.replace("C", "T") for p in parts[1:]]
    odd = rest[99][:40] + unit[40:]  # one place whose last seed alone is a repeat
    g = frame(spark, "chr string, seq string", ("chr1", "".join(unit + p for p in rest)), ("chr2", odd))
    worse = unit[:50] + ("A" if unit[50] != "A" else "G") + unit[51:]
    reads = frame(spark, "read_no long, seq string, qual string", (1, unit, "I" * 60), (2, worse, "I" * 60), (3, rest[5], "I" * 60), (4, odd, "I" * 60))
    def out(**options):
        return {r["read_no"]: (r["chr"], r["pos"], r["mapq"], r["as_score"], r["has_xs"]) for r in align.align(reads, g, "W", **options).collect()}

    assert out(every_place=True) == {1: ("chr1", 1, 1, 0, True), 2: ("chr1", 1, 1, -6, True), 3: ("chr1", 661, 42, 0, False), 4: ("chr2", 1, 42, 0, False)}
    # Without, the last one may have another, worse place in the repeat.
    assert out() == {1: ("chr1", 1, 1, 0, True), 2: ("chr1", 1, 1, -6, True), 3: ("chr1", 661, 42, 0, False), 4: ("chr2", 1, 30, 0, True)}


def test_parts_of_frequent_seeds_hold_every_place(spark):
    from methframe.operators import align

    index = spark.range(1000).selectExpr("if(id < 900, 'often', concat('k', id)) as kmer", "concat('chr', id % 3) as chr", "id as pos")
    seeds = frame(spark, "read_no long, kmer string", (1, "often"), (2, "often"), (3, "k950"), (4, "none"))
    got = sorted((r["read_no"], r["pos"]) for r in align.seed_places(seeds, index, 7).collect())
    assert got == sorted([(n, p) for n in (1, 2) for p in range(900)] + [(3, 950)])


def test_merge_across_tiles(spark):
    """Intervals that span tiles, nest, touch and leave gaps, against a plain sweep."""
    import random

    r = random.Random(3)
    data = [(f"chr{r.randint(1, 2)}", s, s + r.choice((0, 1, 5, 40, 300))) for s in (r.randint(0, 3000) for _ in range(150))] + [("chr3", 0, 5000), ("chr3", 10, 20), ("chr3", 4990, 4999), ("chr3", 5003, 5004)]
    df = spark.createDataFrame(data, "chr string, start long, end long").repartition(3)
    for gap in (0, 2):
        want = []
        for c, s, e in sorted(data):
            if want and want[-1][0] == c and s <= want[-1][2] + gap:
                want[-1][2], want[-1][3] = max(want[-1][2], e), want[-1][3] + 1
            else:
                want.append([c, s, e, 1])
        for tile in (16, 256, 1 << 14):
            got = intervals.merge(df, gap, tile).select("chr", "start", "end", "count").collect()
            assert sorted(map(list, got)) == want


def test_far_rows_raise(spark):
    genome_ = spark.createDataFrame([("chr1", "ACGT" * 100)], "chr string, seq string")
    row = spark.createDataFrame([(1, "chr1", 30)], "read_no long, chr string, pos long")
    got = genome.with_reference(row, genome_, "pos", "20", tile=32, span=32).first()["ref"]
    assert got == ("ACGT" * 100)[27:51]
    with pytest.raises(Exception, match="raise span"):
        genome.with_reference(row, genome_, "pos", "60", tile=32, span=32).collect()


def test_dedup_plan(spark):
    """Hash aggregation over short rows, and a broadcast list of chromosomes."""
    reads = spark.createDataFrame([(k, "chr1", "W", k % 3, "IIII"[: 1 + k % 4]) for k in range(40)], "read_no long, chr string, strand string, pos long, qual string")
    listed = spark.createDataFrame([("chr1", 10)], "chr string, length long")
    out = dedup.dedup_single(reads, listed)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan and "BroadcastHashJoin" in plan
    assert sorted(r["read_no"] for r in out.collect()) == [3, 7, 11]
