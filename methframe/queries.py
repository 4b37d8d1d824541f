"""Registered queries: each applies one operator, with production settings, to whole derived tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .fixtures import RAW, Fixtures
from .functions import cigar as C
from .functions import reads as R
from .operators import align, calls, charts, dedup, genome, intervals, merge, ordering, preprocess, profile, report, simulate, suffixes, view
from .plans.pipeline import Conf
from .sources import bam, blocks, sequence, sinks, text
from .storage import folder, moved_once

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CYCLE = 50
REGION = "chr3:201-900"
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def query(f: Callable[[Fixtures], DataFrame]) -> Callable[[Fixtures], DataFrame]:
    QUERIES[f.__name__] = lambda spark, sf_dir: f(Fixtures(spark, sf_dir))
    return f


def cpg(x: Fixtures) -> DataFrame:
    return calls.call(x.single, x.genome)


def info(x: Fixtures) -> DataFrame:
    return genome.chr_info(x.genome)


# --- calls ---------------------------------------------------------------------------


@query
def cpg_calls(x):
    return cpg(x)


@query
def cpg_calls_mapq(x):
    return calls.call(x.single, x.genome, min_mapq=30)


@query
def cpg_calls_pe(x):
    return calls.call(x.pairs, x.genome)


@query
def cph_calls(x):
    return calls.call(x.single, x.genome, context="CpH")


@query
def cph_calls_strict(x):
    return calls.call(x.single, x.genome, context="CpH", exclude_crick_cpg=True)


@query
def cpg_bedgraph_bs(x):
    return calls.bedgraph(cpg(x), "BS")


@query
def cpg_bedgraph_taps(x):
    return calls.bedgraph(cpg(x), "TAPS")


@query
def chr_log(x):
    return calls.chr_log(x.single, cpg(x), x.genome)


@query
def chr_levels(x):
    return calls.chr_levels(calls.chr_log(x.single, cpg(x), x.genome))


@query
def overall_level(x):
    return report.methylation_totals(calls.chr_log(x.single, cpg(x), x.genome))


@query
def lambda_conversion(x):
    return report.control_conversion(calls.chr_log(x.single, cpg(x), x.genome))


@query
def mbias_se(x):
    return calls.mbias(calls.observations(calls.shown(x.single, x.genome), x.genome), CYCLE)


@query
def mbias_r1(x):
    return calls.mbias(calls.observations(calls.shown(x.pairs, x.genome), x.genome), CYCLE, 1)


@query
def mbias_r2(x):
    return calls.mbias(calls.observations(calls.shown(x.pairs, x.genome), x.genome), CYCLE, 2)


@query
def mbias_level(x):
    return calls.mbias_levels(mbias_se(x))


# --- duplicates, merging -------------------------------------------------------------


@query
def dedup_se(x):
    return dedup.dedup_single(x.single, info(x)).select("read_no", "chr", "strand", "pos")


@query
def dedup_pe(x):
    return dedup.dedup_pairs(x.pairs, info(x)).select("read_no", "chr", "strand", "left", "frag_size")


@query
def dedup_log(x):
    return dedup.dedup_log(x.pairs, info(x), dedup.unique_places(x.pairs, info(x)))


@query
def discard_unknown_chr(x):
    return dedup.discarded(x.pairs, info(x)).select("read_no", "chr")


@query
def size_dist(x):
    return dedup.size_distribution(dedup.dedup_pairs(x.pairs, info(x)), Conf().max_ins)


@query
def size_axis(x):
    return dedup.size_axis(dedup.size_distribution(dedup.dedup_pairs(x.pairs, info(x)), Conf().max_ins))


@query
def merge_hypotheses(x):
    return merge.merge_hypotheses(x.hyp_w, x.hyp_c)


@query
def merge_strand_counts(x):
    return merge.strand_counts(merge.merge_hypotheses(x.hyp_w, x.hyp_c))


@query
def mate_fields(x):
    return merge.mate_fields(x.pairs.where(C.supported("cigar1") & C.supported("cigar2")))


# --- scalar functions ----------------------------------------------------------------


@query
def cigar_reflen(x):
    return x.single.select("read_no", C.reference_length("cigar").cast("long").alias("ref_length"))


@query
def cigar_projection(x):
    return x.single.where(C.supported("cigar")).select("read_no", C.bases("cigar", "seq").alias("bases"))


@query
def qual_sum(x):
    return x.single.select("read_no", C.quality_sum("qual").alias("score"))


@query
def fragment_sizes(x):
    return x.pairs.select("read_no", C.fragment_size("strand", "pos1", "cigar1", "pos2", "cigar2").alias("frag_size"))


@query
def clean_ids(x):
    return x.raw.select("read_no", R.clean_id("id1").alias("id"))


@query
def reverse_complement(x):
    return x.raw.select("read_no", R.reverse_complement("seq1").alias("seq"))


@query
def hex_offsets(x):
    packed = x.raw.select("read_no", R.hex_join("filter(sequence(0, length(seq1) - 1), i -> substr(seq1, i + 1, 1) = 'C')").alias("packed"))
    return packed.withColumn("n", F.size(R.hex_split("packed")).cast("long")).withColumn("last", F.array_max(R.hex_split("packed")).cast("long"))


@query
def colour_space(x):
    return x.genome.select("chr", R.color_space("seq").alias("colours"))


@query
def phred_error(x):
    return x.single.select("read_no", F.round(R.phred_error("qual"), 9).alias("error"))


@query
def number_format(x):
    return chr_log(x).select("chr", R.thousands("wT").alias("wT"), R.percent_text("wC", "wC + wT").alias("share"))


# --- preprocessing -------------------------------------------------------------------


def se(x: Fixtures) -> DataFrame:
    return x.raw.selectExpr("read_no", "id1 as id", "seq1 as seq", "qual1 as qual")


def pe(x: Fixtures) -> DataFrame:
    return preprocess.crop(preprocess.equal_mates(x.raw), CYCLE)


@query
def cycle_detect(x):
    """The longest of the first reads in the order of the input."""
    return preprocess.detect_cycle(ordering.numbered(se(x), "read_no", name="read_no"))


@query
def fqstat(x):
    return preprocess.composition(pe(x))


@query
def fqstat_pct(x):
    return preprocess.composition_percent(preprocess.composition(pe(x)))


@query
def fqstat_axis(x):
    return preprocess.composition_limit(preprocess.composition_percent(preprocess.composition(pe(x))))


@query
def quality_trim_se(x):
    return se(x).select("read_no", R.quality_trim(53, "qual").alias("kept"))


@query
def quality_trim_pe(x):
    return pe(x).select("read_no", R.quality_trim(53, "qual1", "qual2").alias("kept"))


def _trimmed(df: DataFrame, *seqs: str) -> DataFrame:
    return preprocess.trim(df).select("read_no", "trimmed_length", "adapter_at", "tail", "dropped", *seqs)


@query
def adapter_cut_se(x):
    return _trimmed(preprocess.crop(se(x), CYCLE), "seq")


@query
def adapter_cut_pe(x):
    return _trimmed(pe(x), "seq1", "seq2")


@query
def trim_counters(x):
    return preprocess.trim_counters(preprocess.trim(pe(x)))


@query
def trim_counters_se(x):
    return preprocess.trim_counters(preprocess.trim(preprocess.crop(se(x), CYCLE)))


def _flat(df: DataFrame) -> DataFrame:
    lists = {c: F.array_join(F.col(c).cast("array<string>"), ";") for c in df.columns if c.startswith("conv")}
    return df.withColumns(lists).drop("id1", "id2")


@query
def convert_mode3(x):
    return _flat(preprocess.convert(pe(x), 3))


@query
def convert_mode4(x):
    return _flat(preprocess.convert(pe(x), 4))


@query
def packed_names(x):
    return preprocess.packed_ids(preprocess.convert(pe(x), 4), 4).select("read_no", "name1", "name2")


@query
def deconvert_roundtrip(x):
    """Converted mate 1 put back on either strand: must equal the original bases, oriented as aligned."""
    c = preprocess.convert(pe(x), 4).selectExpr("read_no", "seq1 as read", "qual1 as read_qual", "conv1 as conv", "end_qual1 as end_qual")
    w = c.withColumns({"strand": F.lit("W"), "seq": F.col("read"), "qual": F.col("read_qual")})
    b = c.withColumns({"strand": F.lit("C"), "seq": R.reverse_complement("read"), "qual": F.reverse("read_qual")})
    rows = w.unionByName(b).withColumns({"cigar": F.expr("length(read) || 'M'"), "pos": F.lit(100).cast("long")})
    return merge.deconvert(rows).select("read_no", "strand", "seq", "qual", "cigar", "pos")


# --- intervals and profiles ----------------------------------------------------------


@query
def region_stats(x):
    return profile.region_stats(cpg(x), x.bed, info(x), clean=False)


@query
def region_stats_clean(x):
    return profile.region_stats(cpg(x), x.bed, info(x))


@query
def clean_sites(x):
    return profile.clean_sites(cpg(x)).select("chr", "locus", "total", "wO", "cO")


@query
def binned_methylome(x):
    return profile.binned(cpg(x), 100, "hs")


@query
def merge_calls(x):
    return profile.merge_calls(calls.call(x.single.where("read_no % 2 = 0"), x.genome), calls.call(x.single.where("read_no % 2 = 1"), x.genome), calls.call(x.pairs, x.genome))


@query
def tss_bins(x):
    return genome.tss_bins(x.refgene)


@query
def tss_profile(x):
    return profile.tss_profile(cpg(x), genome.tss_bins(x.refgene))


@query
def bed_wig(x):
    return intervals.coverage(x.bed, info(x), 100, normalise=False)


@query
def bed_wig_norm(x):
    return intervals.coverage(x.bed, info(x), 100)


@query
def interval_overlap(x):
    return intervals.overlaps(x.bed, genome.mirror(x.bed, info(x)))


@query
def interval_semijoin(x):
    return intervals.overlapping(x.bed, genome.mirror(x.bed, info(x)))


@query
def merge_intervals(x):
    return intervals.merge(x.bed)


@query
def mirror_bed(x):
    return genome.mirror(x.bed, info(x))


@query
def pe_bed(x):
    ok = x.pairs.where(C.supported("cigar1") & C.supported("cigar2"))
    return intervals.pair_fragments(merge.mate_fields(ok))


@query
def se_bed(x):
    return intervals.single_fragments(x.single.where(C.supported("cigar")), 200)


# --- genome --------------------------------------------------------------------------


@query
def chr_info(x):
    return info(x)


@query
def genome_convert(x):
    return genome.converted(x.genome)


@query
def genome_convert_counts(x):
    return genome.conversion_counts(x.genome)


@query
def ct_rich_tiles(x):
    return genome.ct_rich(x.genome, 50, 0.6)


@query
def genome_kmers(x):
    return genome.kmers(x.genome, 12)


@query
def sam_header(x):
    return sinks.sam_header(info(x), {"mode": "3"})


# --- accuracy, view, report, simulation ----------------------------------------------


def _named(x: Fixtures) -> DataFrame:
    """Single reads named by a place that is right for two of three."""
    return x.single.withColumn("id", F.expr("concat(read_no, '_', chr, ':', pos + if(read_no % 3 = 0, 1, 0), '-', pos + length(seq) - 1)"))


@query
def accuracy_se(x):
    return profile.accuracy_single(_named(x))


@query
def accuracy_pe(x):
    p = x.pairs.withColumn("id", F.expr("concat(read_no, '_', chr, ':', least(pos1, pos2), '-', if(pos1 <= pos2, pos2 + length(seq2) - 1, pos1 + length(seq1) - 1) + if(mapq % 4 = 0, 1, 0))"))
    return profile.accuracy_pairs(p)


def _mates(x: Fixtures) -> DataFrame:
    p = x.pairs
    one = [p.select(F.concat("name", F.lit(f"_R{k}")).alias("name"), "chr", F.col(f"pos{k}").alias("pos"), F.col(f"cigar{k}").alias("cigar"), F.col(f"seq{k}").alias("seq"), F.col(f"qual{k}").alias("qual"), "strand") for k in "12"]
    return one[0].unionByName(one[1])


def _viewed(x: Fixtures) -> DataFrame:
    return view.fragments(view.in_region(_mates(x), REGION))


@query
def viewer_fragments(x):
    return _viewed(x)


@query
def viewer_glyphs(x):
    return view.glyphs(_viewed(x), x.genome)


@query
def viewer_glyphs_taps(x):
    return view.glyphs(_viewed(x), x.genome, "TAPS")


def _picture(x: Fixtures) -> DataFrame:
    return view.padded(view.glyphs(_viewed(x), x.genome))


@query
def viewer_trim(x):
    return view.trim(_picture(x), 301, 600)


@query
def viewer_snp_column(x):
    return view.snp_column(_picture(x))


@query
def viewer_snp_sorted(x):
    return view.snp_sorted(_picture(x)).select("name", "pos", "allele")


def _reference(x: Fixtures, first: int, n: int) -> str:
    chr_ = view.parse_region(REGION)[0]
    return x.genome.where(F.col("chr") == chr_).select(F.substring("seq", first, n).alias("s")).first()["s"]


def _left(x: Fixtures) -> int:
    return _viewed(x).agg(F.min("pos").alias("left")).first()["left"] or 1


@query
def viewer_dense1(x):
    return view.dense(_picture(x), _reference(x, _left(x), 1000)).select("name", "row")


@query
def viewer_dense2(x):
    return view.packed(view.dense(_picture(x), _reference(x, _left(x), 1000)))


def _report(x: Fixtures) -> DataFrame:
    log = calls.chr_log(x.pairs, calls.call(x.pairs, x.genome), x.genome)
    counters = preprocess.trim_counters(preprocess.trim(pe(x)))
    return report.table(counters, merge.strand_counts(x.pairs), dedup_log(x), log)


@query
def report_rows(x):
    """The report of a run of pairs."""
    return _report(x)


@query
def html_report(x):
    return report.page(_report(x))


@query
def chart_composition(x):
    return charts.composition(fqstat(x))


@query
def chart_sizes(x):
    return charts.sizes(size_dist(x))


@query
def chart_mbias(x):
    return charts.mbias(mbias_se(x))


@query
def chart_tss(x):
    return charts.tss(tss_profile(x))


@query
def chart_chromosomes(x):
    return charts.chromosomes(chr_log(x))


@query
def report_table(x):
    log = calls.chr_log(x.single, cpg(x), x.genome)
    t = report.methylation_totals(log)
    return t.select("strand", R.thousands("c").alias("c"), R.thousands("t").alias("t"), R.percent_text("c", "c + t").alias("level"))


@query
def sim_reads(x):
    return simulate.simulate(x.spark, x.genome, simulate.SimConfig(n=5000, length=50, cg_conversion=50.0, ch_conversion=99.5, error=0.5))


@query
def sim_bisulfite(x):
    """Whole conversion of simulated reads: no C is left in mate 1."""
    conf = simulate.SimConfig(conversion=100.0)
    rows = x.raw.select("read_no", F.col("seq1").alias("seq"))
    return simulate.bisulfite(rows, "seq", conf)


# --- text forms, written to a shared folder and read again ------------------------------


def _written(x: Fixtures, lines: DataFrame, by: tuple[str, ...] = (), **options: str) -> str:
    path = folder(x.spark, "text")
    with moved_once(x.spark):
        lines.select(*by, "value").write.options(**options).partitionBy(*by).text(path)
    return path


def _raw_in_ranges(x: Fixtures) -> DataFrame:
    """Sequenced pairs, partition by partition in ranges of read_no: keys are dealt before the bases are cut out, and a broadcast join leaves rows in their partitions (not in an order)."""
    n = int(x.spark.conf.get("spark.sql.shuffle.partitions"))
    return x._sql(RAW, keyed=x.keyed.repartitionByRange(n, "read_no"), genome=F.broadcast(x.genome))


def _record(tag: str) -> Column:
    return sinks.fastq_record(f"id{tag}", f"seq{tag}", f"qual{tag}")


def _in_files(x: Fixtures, df: DataFrame, tags: str, in_ranges: bool = False) -> list[str]:
    """Mates' records as gzip files in the order of read_no, written in one pass; each mate's paths, which the FASTQ source expands."""
    rows = df if in_ranges else ordering.ranged(df, "read_no")
    records = F.explode(F.array(*[F.struct(F.lit(tag).alias("mate"), _record(tag)) for tag in tags]))
    lines = rows.select("read_no", records.alias("m")).select("read_no", "m.mate", "m.value").sortWithinPartitions("mate", "read_no")
    path = _written(x, lines, by=("mate",), **GZIP).removeprefix("file:")
    return [f"{path}/mate={tag}/part-*" for tag in tags]


@query
def fastq_roundtrip(x):
    """Single reads as plain FASTQ files."""
    path = _written(x, sinks.fastq_lines(se(x)))
    return sequence.fastq(x.spark, path.removeprefix("file:") + "/part-*", split=1 << 20).select("id", "seq", "qual")


@query
def fastq_pairs_roundtrip(x):
    """Both mates as several gzip files, joined in their order by number and cut to equal lengths."""
    return sequence.fastq_pairs(x.spark, *_in_files(x, _raw_in_ranges(x), "12", in_ranges=True))


@query
def fastq_blocks(x):
    """Both mates as block-compressed files, read in small ranges and joined by number."""
    folders = {f"value{tag}": folder(x.spark, "text").removeprefix("file:") for tag in "12"}
    rows = _raw_in_ranges(x).sortWithinPartitions("read_no")
    with moved_once(x.spark):
        blocks.write_columns(rows.select(*[_record(tag).alias(f"value{tag}") for tag in "12"]), folders, level=1)
    return sequence.mates(x.spark, *[f"{path}/part-*" for path in folders.values()], split=1 << 16)


@query
def fasta_roundtrip(x):
    path = _written(x, sinks.fasta_lines(x.genome))
    return sequence.fasta(x.spark, path.removeprefix("file:") + "/part-*")


@query
def genome_with_control(x):
    """The genome and a control sequence, with plain names prefixed and bases in upper case."""
    bare = x.genome.select(F.expr("substr(chr, 4)").alias("chr"), F.lower("seq").alias("seq"))
    return genome.prepare(bare, x.genome.where("chr = 'chrL'").select(F.lit("lambda").alias("chr"), "seq"))


@query
def chr_info_roundtrip(x):
    return text.chr_info(x.spark, _written(x, sinks.tsv_lines(info(x), header=False)))


@query
def calls_roundtrip(x):
    return text.calls(x.spark, _written(x, sinks.call_lines(cpg(x))))


@query
def bed_roundtrip(x):
    return text.bed(x.spark, _written(x, sinks.tsv_lines(x.bed, header=False))).select("chr", "start", "end")


@query
def refgene_roundtrip(x):
    rows = x.refgene.selectExpr("'0' as bin", "'t' as name", "chr", "strand", "tx_start", "tx_end", *[f"'.' as c{k}" for k in range(6, 12)], "gene", "'.' as c13", "'.' as c14", "'.' as c15")
    return text.refgene(x.spark, _written(x, sinks.tsv_lines(rows, header=False)))


@query
def conf_roundtrip(x):
    """A settings table written under comments and between blank lines."""
    rows = x.table("nation").select(F.col("n_name").alias("key"), F.col("n_regionkey").cast("string").alias("value"))
    lines = sinks.tsv_lines(rows).unionByName(x.spark.createDataFrame([("",), ("# a comment\t1",)], "value string"))
    return text.conf(x.spark, _written(x, lines))


def _sam(x: Fixtures) -> DataFrame:
    """Single reads as SAM lines under a header."""
    tags = "concat_ws('\t', 'AS:i:' || -(mapq % 7), if(mapq % 3 = 0, 'XS:i:-3', 'NM:i:1'), if(strand = 'W', 'XG:Z:CT', 'XG:Z:GA'))"
    body = x.single.selectExpr(f"concat_ws('\t', name, if(strand = 'W', 0, 16), chr, pos, mapq, cigar, '*', 0, 0, seq, qual, {tags}) as value")
    return sinks.sam_header(info(x), {}).select("value").unionByName(body)


@query
def sam_roundtrip(x):
    """SAM text read again, its strand, score and second-place tags parsed."""
    rows = text.sam(x.spark, _written(x, _sam(x)))
    return rows.select("qname", "flag", "chr", "pos", "mapq", "cigar", "seq", "qual", text.strand_of().alias("strand"), merge.score_of().alias("as_score"), merge.has_second().alias("has_xs"))


@query
def alignments_roundtrip(x):
    """Coordinate-sorted alignments by chromosome, read back whole."""
    path = folder(x.spark, "text")
    sinks.write_alignments(x.single, path)
    return x.spark.read.schema(x.single.schema).parquet(path).select("read_no", "chr", "pos", "cigar", "seq", "qual", "strand")


@query
def metrics_roundtrip(x):
    """The trimming log as text, read as labels and numbers."""
    counters = preprocess.trim_counters(preprocess.trim(pe(x)))
    return text.metrics(x.spark, _written(x, sinks.trim_log_lines(counters)))


@query
def log_lines(x):
    """Lines of the duplicate and merge logs."""
    return sinks.dedup_log_lines(dedup_log(x)).unionByName(sinks.merge_log_lines(merge_strand_counts(x)))


@query
def mbias_lines(x):
    return sinks.tsv_lines(mbias_se(x), order=["cycle"])


@query
def bedgraph_lines(x):
    return sinks.bedgraph_lines(cpg_bedgraph_bs(x).select("chr", "start", "end", F.round("level").cast("int").alias("level")))


@query
def wig_lines(x):
    return sinks.wig_lines(bed_wig(x), 100, info(x), "depth")


@query
def annotated_bed(x):
    rows = profile.region_stats(cpg(x), x.bed.withColumn("line", F.concat_ws("\t", "chr", "start", "end")), info(x), clean=False)
    return sinks.annotated_bed_lines(rows)


# --- selections and parts of the simulator whose outcome is certain ---------------------


@query
def concordant_pairs(x):
    return dedup.concordant(x.pairs, 40, 80).select("read_no")


@query
def viewer_one_strand(x):
    return view.in_region(_mates(x).where(C.supported("cigar")), REGION, "C").select("name", "pos", "strand")


def _changed():
    """Places at which a read differs from what it was."""
    return F.expr(R.bound("size(filter(sequence(1, length(s_)), i -> substr(s_, i, 1) <> substr(w_, i, 1)))", s_="seq", w_="was")).cast("long").alias("changed")


@query
def sim_errors(x):
    """Every base wrong: reads differ from their originals at each of the four bases' places."""
    rows = x.raw.select("read_no", F.translate("seq1", "N", "A").alias("seq"))
    wrong = simulate.errors(rows.withColumn("was", F.col("seq")), "seq", "1D", simulate.SimConfig(), "error")
    return wrong.select("read_no", _changed(), F.length("seq").cast("long").alias("n"))


@query
def sim_snps(x):
    rows = x.raw.select("read_no", F.translate("seq1", "N", "A").alias("seq"))
    changed = simulate.snps(rows.withColumn("was", F.col("seq")), "seq", simulate.SimConfig(snps=3))
    return changed.select("read_no", _changed())


@query
def sim_adapter(x):
    conf = simulate.SimConfig(adapter="AGATCGGAAGAGC", fixed_adapter=10)
    return simulate.with_adapter(x.raw.select("read_no", F.col("seq1").alias("seq")), "seq", conf)


@query
def sim_random(x):
    """Random sequences: as many, as long and of the four bases alone."""
    rows = simulate.random_sequences(x.spark, 200, 40)
    return rows.select("read_no", F.length("seq").cast("long").alias("n"), F.col("seq").rlike("^[ACGT]+$").alias("pure"))


# --- binary files, mates as rows of their own, total orders ------------------------------


def _single_rows(x: Fixtures) -> DataFrame:
    tags = F.expr("array('AS:i:' || -(mapq % 7), if(mapq % 3 = 0, 'XS:i:-3', 'NM:i:1'))")
    return merge.single_rows(x.single.withColumn("tags", tags))


def _binary(x: Fixtures) -> str:
    """Single reads as sorted binary parts; their paths."""
    path = folder(x.spark, "bam")
    bam.write_parts(_single_rows(x), "\n".join(r["value"] for r in sinks.sam_header(info(x).unionByName(_unknown(x)), {}).collect()), path)
    return f"{path}/part-*.bam"


def _unknown(x: Fixtures) -> DataFrame:
    """Chromosomes of reads that the genome lacks."""
    return x.single.select("chr").distinct().join(x.genome, "chr", "left_anti").select("chr", F.lit(1 << 20).cast("long").alias("length"))


def _parsed(rows: DataFrame) -> DataFrame:
    return rows.select("qname", "flag", "chr", "pos", "mapq", "cigar", "seq", "qual", text.strand_of().alias("strand"), merge.score_of().alias("as_score"), merge.has_second().alias("has_xs"))


@query
def bam_roundtrip(x):
    """Binary files in small splits: what SAM text gives."""
    return _parsed(bam.read(x.spark, _binary(x), split=1 << 16))


@query
def bam_region(x):
    """A region's reads through indexes."""
    path = _binary(x)
    bam.build_index(x.spark, path)
    return _parsed(bam.read(x.spark, path, region=REGION)).where(C.supported("cigar"))


@query
def bam_order(x):
    """The order of the sorted parts, taken as they are read."""
    rows = bam.read(x.spark, _binary(x)).where(F.col("chr").rlike("^chr[0-9XYL]+$"))
    return ordering.digest(ordering.as_read(rows, "n"), "n", "chr", "pos", "qname")


@query
def sam_pairs(x):
    """Pairs as SAM text in a mixed order, linked by name."""
    lines = merge.to_sam(x.pairs).repartition(F.md5("value"))
    pairs, _ = merge.link_mates(text.sam(x.spark, _written(x, lines, **GZIP)), text.strand_of())
    return pairs.select("name", "chr", "strand", "mapq", "pos1", "cigar1", "seq1", "qual1", "pos2", "cigar2", "seq2", "qual2")


@query
def sam_pair_lines(x):
    """Both mates' lines of merged pairs."""
    return merge.to_sam(x.pairs.where(C.supported("cigar1") & C.supported("cigar2")))


@query
def mate_fixup(x):
    """Mate fields computed from rows that lack them; mates without a partner keep none."""
    rows = merge.pair_rows(x.pairs.where(C.supported("cigar1") & C.supported("cigar2")))
    bare = rows.where((F.col("flag").bitwiseAND(merge.FIRST) != 0) | (F.col("mapq") >= 3)).withColumns({"rnext": F.lit("*"), "pnext": F.lit(0).cast("long"), "tlen": F.lit(0).cast("long")})
    return merge.fix_mates(bare, text.strand_of()).select("qname", "flag", "chr", "pos", "mapq", "rnext", "pnext", "tlen")


def _order(x: Fixtures, lines: DataFrame) -> DataFrame:
    """Number and digest of lines as files have them in the order of their names."""
    return ordering.digest(text.numbered_lines(x.spark, _written(x, lines)), "line_no", "value")


@query
def calls_order(x):
    return _order(x, sinks.tsv_lines(cpg(x), header=False, order=["chr", "locus"]))


@query
def genome_order(x):
    return _order(x, sinks.tsv_lines(info(x), header=False, order=["chr"]))


@query
def bins_order(x):
    return _order(x, sinks.tsv_lines(binned_methylome(x).select("chr", "bin", "c", "t"), header=False, order=["chr", "bin"]))


@query
def name_order(x):
    """Reads of both mates by name, mates in their order."""
    rows = merge.pair_rows(x.pairs).select("qname", F.col("flag").bitwiseAND(merge.SECOND).alias("second"), "pos")
    return ordering.digest(ordering.numbered(rows, "qname", "second"), "n", "qname", "second", "pos")


@query
def fqstat_file(x):
    """The composition table as text, read again."""
    path = _written(x, sinks.tsv_lines(fqstat(x), order=["mate", "cycle"]))
    return x.spark.read.csv(path, sep="\t", comment="#", schema="mate int, cycle long, A long, C long, G long, T long, N long")


@query
def logs_roundtrip(x):
    """The logs of merging and duplicates and the counts per chromosome, as a report of an earlier run reads them."""
    merged = text.metrics(x.spark, _written(x, sinks.merge_log_lines(merge_strand_counts(x)))).withColumn("log", F.lit("merge"))
    dups = text.metrics(x.spark, _written(x, sinks.dedup_log_lines(dedup_log(x)))).withColumn("log", F.lit("duplicates"))
    called = text.chr_log(x.spark, _written(x, sinks.tsv_lines(chr_log(x), order=["chr"])))
    names = [c for c in called.columns if c != "chr"]
    per = called.select(F.explode(F.array(*[F.struct(F.concat_ws(":", "chr", F.lit(c)).alias("key"), F.col(c).alias("value")) for c in names])).alias("m")).select("m.*", F.lit("calls").alias("log"))
    return merged.unionByName(dups).unionByName(per)


# --- alignment, files in ranges -----------------------------------------------------------


@query
def align_gapped(x):
    """Reads with and without gaps at their places; which of equal places a gap takes is left open."""
    found = align.align(x.placed.select("read_no", "seq", "qual"), x.genome, "W")
    return found.select("read_no", "chr", "pos", "as_score", C.reference_length("cigar").cast("long").alias("spanned"), F.col("cigar").rlike("[ID]").alias("gapped"))


@query
def align_paired(x):
    found = align.align_pairs(x.placed_pairs.select("read_no", "seq1", "qual1", "seq2", "qual2"), x.genome, "W")
    return found.select("read_no", "chr", "pos1", "pos2", "as_score", "cigar1", "cigar2")


@query
def cpg_calls_tiled(x):
    """Calls over a genome that is read as tiles, in small ranges."""
    path = _written(x, sinks.fasta_lines(x.genome)).removeprefix("file:") + "/part-*"
    return calls.call(x.single, sequence.fasta_tiles(x.spark, path, split=4096))


@query
def suffix_places(x):
    """Every place of the reads' first 20 letters in the converted genome, by backward search."""
    index = suffixes.build(x.genome.select("chr", F.translate(F.upper("seq"), "C", "T").alias("seq")))
    seeds = x.placed.select(F.substring("seq", 1, 20).alias("pattern")).distinct()
    return suffixes.places(index, suffixes.ranges(index, seeds)).select("pattern", "chr", "pos")


@query
def viewer_paper(x):
    """The sheet that the picture of each chromosome's reads takes."""
    size = x.single.groupBy("chr").agg((F.max("pos") - F.min("pos")).cast("int").alias("width"), F.count(F.lit(1)).cast("int").alias("rows"))
    portrait, landscape = (F.coalesce(*[F.when(F.col("width") > least, sheet) for least, sheet in view.SHEETS[k]], F.lit("A4")) for k in ("Portrait", "Landscape"))
    wide = F.col("width") > 2 * F.col("rows")
    return size.select("chr", "width", "rows", F.when(wide, landscape).otherwise(portrait).alias("sheet"), F.when(wide, "Landscape").otherwise("Portrait").alias("orientation"))
