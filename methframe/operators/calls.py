"""Methylation calls: observations per base, counts per place, and the tables derived from them.

Aligned single reads: (read_no, chr, pos, mapq, cigar, seq, qual, strand); pairs have pos1, cigar1, ... pos2, ....
Reads meet CpG sites by stretches of the reference; for other sites a read looks in the reference it covers.  Only sites become rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cigar as C
from ..functions import reads as R
from .genome import SPAN, TILE, cpg_sites, listed_names, names, with_reference

NEAR = 64  # bases of a stretch by which fragments meet sites
COUNTERS = ["wC", "wT", "wO", "cC", "cT", "cO"]


def usable(df: DataFrame, genome: DataFrame, min_mapq: int = 0) -> DataFrame:
    """Reads (or pairs) of enough mapping quality on known chromosomes with supported CIGARs, laid out along the reference."""
    known = df.where(F.col("mapq") >= min_mapq).join(names(genome), "chr", "left_semi")
    tags = ["1", "2"] if "pos2" in df.columns else [""]
    for t in tags:
        known = known.where(C.supported(f"cigar{t}"))
    new = {f"bases{t}": C.bases(f"cigar{t}", f"seq{t}") for t in tags}
    if len(tags) == 2:
        new |= {f"quals{t}": C.qualities(f"cigar{t}", f"qual{t}") for t in tags}
    return known.withColumns(new)


def _laid(pairs: DataFrame) -> DataFrame:
    """What a usable pair shows: (read_no, chr, strand, mate, pos, bases, apart, quals, over, over_quals, shift).

    Mates apart: both, and they count for the M-bias table.  Overlapping mates are one row with the right one laid over the
    left one, shift bases on; if the right mate ends inside the left one, mate 1 alone is shown.
    """
    one_first = F.col("pos1") <= F.col("pos2")
    rows = pairs
    for n, (a, b) in {"x": ("1", "2"), "y": ("2", "1")}.items():
        for c in ("pos", "bases", "quals"):
            rows = rows.withColumn(f"{c}_{n}", F.when(one_first, F.col(f"{c}{a}")).otherwise(F.col(f"{c}{b}")))
    end_x, end_y = F.col("pos_x") + F.length("bases_x"), F.col("pos_y") + F.length("bases_y")

    def shown(mate, pos, bases, apart, *rest):
        more = zip(("quals", "over", "over_quals"), rest or [F.lit(None).cast("string")] * 3, strict=True)
        shift = (F.col("pos_y") - F.col("pos_x")).cast("int") if rest else F.lit(None).cast("int")
        return F.struct(F.lit(mate).alias("mate"), pos.cast("long").alias("pos"), bases.alias("bases"), F.lit(apart).alias("apart"), *[c.alias(k) for k, c in more], shift.alias("shift"))

    both = F.array(shown(1, F.col("pos1"), F.col("bases1"), True), shown(2, F.col("pos2"), F.col("bases2"), True))
    joined = shown(1, F.col("pos_x"), F.col("bases_x"), False, F.col("quals_x"), F.col("bases_y"), F.col("quals_y"))
    parts = F.when(end_x <= F.col("pos_y"), both).when(end_y >= end_x, F.array(joined)).otherwise(F.array(shown(1, F.col("pos1"), F.col("bases1"), False)))
    return rows.select("read_no", "chr", "strand", F.explode(parts).alias("f")).select("read_no", "chr", "strand", "f.*")


def fragments(pairs: DataFrame) -> DataFrame:
    """What a usable pair shows: (read_no, chr, strand, mate, pos, bases, apart).

    Mates apart: both, and they count for the M-bias table.  Overlapping mates are joined to one read
    with the better base at each place (the left mate's on ties); if the right mate ends inside the left one,
    mate 1 alone is shown.
    """
    # What x shows alone, the better base of each place of both, what y shows alone: only the middle is walked.
    better = "if(ascii(substr(qx_, d_ + k + 1, 1)) < ascii(substr(qy_, k + 1, 1)), substr(by_, k + 1, 1), substr(bx_, d_ + k + 1, 1))"
    joined = R.bound(
        f"concat(substr(bx_, 1, d_), array_join(transform(sequence(0, length(bx_) - d_ - 1), k -> {better}), ''), substr(by_, length(bx_) - d_ + 1))",
        bx_="bases", by_="over", qx_="quals", qy_="over_quals", d_="shift",
    )
    return _laid(pairs).select("read_no", "chr", "strand", "mate", "pos", F.expr(f"case when over is null then bases else {joined} end").alias("bases"), "apart")


def _base(i: str) -> str:
    """The base that a fragment shows at 0-based place i: of mates laid over each other the better one."""
    left, right = f"substr(bases, {i} + 1, 1)", f"substr(over, {i} - shift + 1, 1)"
    worse = f"{i} >= length(bases) or ascii(substr(quals, {i} + 1, 1)) < ascii(substr(over_quals, {i} - shift + 1, 1))"
    return f"case when over is null or {i} < shift then {left} when {worse} then {right} else {left} end"


def single_fragments(reads: DataFrame) -> DataFrame:
    return reads.select("read_no", "chr", "strand", F.lit(1).alias("mate"), F.col("pos").cast("long").alias("pos"), "bases", F.lit(True).alias("apart"))


def shown(df: DataFrame, genome: DataFrame, min_mapq: int = 0) -> DataFrame:
    """Fragments of reads or pairs, whichever df holds; of overlapping mates the left one's bases and what lies over them, which observations() joins at the sites."""
    rows = usable(df, genome, min_mapq)
    return _laid(rows) if "pos2" in df.columns else single_fragments(rows)


def observations(frags: DataFrame, genome: DataFrame, context: str = "CpG", exclude_crick_cpg: bool = False, tile: int = TILE, span: int = SPAN) -> DataFrame:
    """One row per base at a site: (chr, locus, strand, mate, apart, i, n, base, context); i: place in the fragment of n bases.

    CpG sites of both strands are placed at their C.  CpH: C not before G on W; on C every G (also that of a CpG,
    unless exclude_crick_cpg), at its own place.
    """
    laid = "over" in frags.columns
    base, n = (_base("i"), "if(over is null, length(bases), shift + length(over))") if laid else ("substr(bases, i + 1, 1)", "length(bases)")
    rows = frags.withColumn("n", F.expr(n))
    names = ["chr", "pos", "strand", "mate", "apart", "n", "bases", *(["quals", "over", "over_quals", "shift"] if laid else [])]
    if context == "CpG":
        # Fragments meet the sites themselves, by short stretches: no walk over their places.
        back = "if(strand = 'W', 0, 1)"
        near = rows.where("n > 0").select(*names, F.expr(f"pos - {back}").alias("first"))
        near = near.withColumn("near", F.explode(F.expr(f"sequence((first - 1) div {NEAR}, (first + n - 2) div {NEAR})")))
        hits = near.join(cpg_sites(genome, NEAR, tile, span), ["chr", "near"]).where("locus between first and first + n - 1").withColumn("i", F.expr("cast(locus - first as int)"))
        return hits.select("chr", "locus", "strand", "mate", "apart", "i", "n", F.expr(base).alias("base"), "context")
    rows = with_reference(rows, genome, "pos", "n", "ref", tile, span)
    # u[i + 3] (1-based) is the reference at pos + i; binding u keeps it from being cut out anew for every i.
    w = "substr(u, i + 3, 1) = 'C' and substr(u, i + 4, 1) <> 'G'"
    c = "substr(u, i + 3, 1) = 'G'" + (" and substr(u, i + 2, 1) <> 'C'" if exclude_crick_cpg else "")
    every = "sequence(0, n - 1)"
    found = f"case when n = 0 then array() when strand = 'W' then filter({every}, i -> {w}) else filter({every}, i -> {c}) end"
    sites = F.expr(f"transform(array(ref), r -> transform(array(upper(r)), u -> transform({found}, i -> struct(i, substr(r, i + 2, 4) as context)))[0])[0]")
    hits = rows.select(*names, F.explode(sites).alias("site")).withColumns({"i": F.col("site.i"), "context": F.col("site.context")})
    return hits.select("chr", F.expr("pos + i").alias("locus"), "strand", "mate", "apart", "i", "n", F.expr(base).alias("base"), "context")


def _counters() -> list:
    """Six counters: read as C, as T, other, by strand (complements on C)."""
    w, c, b = F.col("strand") == "W", F.col("strand") == "C", F.col("base")
    kinds = {"wC": w & (b == "C"), "wT": w & (b == "T"), "wO": w & ~b.isin("C", "T"), "cC": c & (b == "G"), "cT": c & (b == "A"), "cO": c & ~b.isin("G", "A")}
    return [F.count_if(kinds[k]).alias(k) for k in COUNTERS]


def calls(observed: DataFrame) -> DataFrame:
    """(chr, locus, total, wC, wT, wO, context, cC, cT, cO)."""
    # The context is a function of the place; as a key it leaves the counters to hash aggregation.
    counted = observed.groupBy("chr", "locus", "context").agg(F.count(F.lit(1)).alias("total"), *_counters())
    return counted.select("chr", "locus", "total", "wC", "wT", "wO", "context", "cC", "cT", "cO")


def call(df: DataFrame, genome: DataFrame, min_mapq: int = 0, context: str = "CpG", **options) -> DataFrame:
    return calls(observations(shown(df, genome, min_mapq), genome, context, **options))


def bedgraph(called: DataFrame, protocol: str = "BS") -> DataFrame:
    """(chr, start, end, level) of sites with a C or T."""
    rows = called.select("chr", (F.col("locus") - 1).alias("start"), F.col("locus").alias("end"), (F.col("wC") + F.col("cC")).alias("c"), (F.col("wT") + F.col("cT")).alias("t"))
    return rows.where("c + t > 0").select("chr", "start", "end", R.level(protocol, "c", "t").alias("level"))


def chr_log(df: DataFrame, called: DataFrame, genome: DataFrame, min_mapq: int = 0) -> DataFrame:
    """(chr, reads, wC, wT, cC, cT) for every chromosome of the genome, also without reads."""
    reads = usable(df, genome, min_mapq).groupBy("chr").agg(F.count(F.lit(1)).alias("reads"))
    sums = called.groupBy("chr").agg(*[F.sum(c).alias(c) for c in ("wC", "wT", "cC", "cT")])
    return listed_names(genome).join(reads, "chr", "left").join(sums, "chr", "left").fillna(0)


def longest(df: DataFrame) -> int | None:
    """The largest read length of all aligned reads or pairs; None without reads."""
    seqs = ["seq1", "seq2"] if "pos2" in df.columns else ["seq"]
    return max((n for n in df.agg(*[F.max(F.length(c)).alias(c) for c in seqs]).first() if n), default=None)


def mbias(observed: DataFrame, cycle: int, mate: int = 1) -> DataFrame:
    """(cycle, six counters) for cycles 1 to *cycle*: reads in the direction of sequencing, overlapping pairs left out."""
    forward, back = F.col("i") + 1, F.lit(cycle) - F.col("i")
    ahead = F.col("strand") == ("W" if mate == 1 else "C")
    rows = observed.where(F.col("apart") & (F.col("mate") == mate)).withColumn("cycle", F.when(ahead, forward).otherwise(back))
    counted = rows.where(F.col("cycle").between(1, cycle)).groupBy("cycle").agg(*_counters())
    every = observed.sparkSession.range(1, cycle + 1).select(F.col("id").cast("int").alias("cycle"))
    return every.join(F.broadcast(counted), "cycle", "left").fillna(0)


def mbias_levels(table: DataFrame, protocol: str = "BS") -> DataFrame:
    return table.select("cycle", R.level(protocol, "wC", "wT").alias("watson"), R.level(protocol, "cC", "cT").alias("crick"))


def chr_levels(log: DataFrame, protocol: str = "BS") -> DataFrame:
    return log.select("chr", R.level(protocol, "wC", "wT").alias("watson"), R.level(protocol, "cC", "cT").alias("crick"))
