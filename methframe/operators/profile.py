"""Methylation over regions, bins and transcription starts, and merging of call tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import reads as R
from .genome import names
from .intervals import points_in

MAX_ERRORS, MAX_ERROR_PERCENT = 5, 10  # fixed values of the site filter


def clean_sites(called: DataFrame) -> DataFrame:
    """Sites without many other bases: not both MAX_ERRORS of them and MAX_ERROR_PERCENT of all (whole percent)."""
    errors = F.col("wO") + F.col("cO")
    return called.where(~((errors >= MAX_ERRORS) & (F.floor(errors * 100 / F.col("total")) >= MAX_ERROR_PERCENT)))


def region_stats(called: DataFrame, bed: DataFrame, info: DataFrame, clean: bool = True) -> DataFrame:
    """bed with (sites, c, t): covered sites and their bases in every interval of a listed chromosome, also empty ones.

    Equal rows of bed are one row per copy, as all copies have equal sums.
    """
    sites = clean_sites(called) if clean else called
    points = sites.select("chr", "locus", (F.col("wC") + F.col("cC")).alias("c"), (F.col("wT") + F.col("cT")).alias("t")).where("c + t > 0")
    known = bed.join(names(info), "chr", "left_semi")
    regions = known.groupBy(*bed.columns).agg(F.count(F.lit(1)).alias("copies"))
    met = points_in(points, regions, "left").groupBy(*bed.columns, "copies")
    stats = met.agg(F.count("locus").alias("sites"), F.coalesce(F.sum("c"), F.lit(0)).cast("long").alias("c"), F.coalesce(F.sum("t"), F.lit(0)).cast("long").alias("t"))
    return stats.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copy", "copies")


def binned(called: DataFrame, width: int, mask: str = "chr", protocol: str = "BS") -> DataFrame:
    """(chr, bin, c, t, level) of numbered chromosomes, X and Y, renamed with mask; bins without bases are left out."""
    rows = called.where(F.col("chr").rlike("[0-9XY]$") & ~F.col("chr").contains("_"))
    name = F.concat(F.lit(mask), F.regexp_replace("chr", "^chr", ""))
    sums = rows.groupBy(name.alias("chr"), F.floor(F.col("locus") / width).alias("bin")).agg(F.sum(F.col("wC") + F.col("cC")).alias("c"), F.sum(F.col("wT") + F.col("cT")).alias("t"))
    return sums.where("c + t > 0").withColumn("level", R.level(protocol, "c", "t"))


def merge_calls(*tables: DataFrame) -> DataFrame:
    """One call table from several: counters are added up."""
    every = tables[0]
    for t in tables[1:]:
        every = every.unionByName(t)
    counters = ["total", "wC", "wT", "wO", "cC", "cT", "cO"]
    out = every.groupBy("chr", "locus").agg(*[F.sum(c).alias(c) for c in counters], F.max("context").alias("context"))
    return out.select("chr", "locus", "total", "wC", "wT", "wO", "context", "cC", "cT", "cO")


def tss_profile(called: DataFrame, bins: DataFrame, protocol: str = "BS") -> DataFrame:
    """(distance, watson, crick): level around transcription starts by gene strand, for distances that + genes have; null without bases."""
    points = called.select("chr", "locus", (F.col("wC") + F.col("cC")).alias("c"), (F.col("wT") + F.col("cT")).alias("t"))
    hit = F.col("t" if protocol.upper() == "TAPS" else "c")
    sums = points_in(points, bins).groupBy("distance", "strand").agg(F.sum(hit).alias("hit"), F.sum(F.col("c") + F.col("t")).alias("all"))
    share = F.when(F.col("all") > 0, F.col("hit").cast("double") / F.col("all"))
    wide = sums.withColumn("level", share).groupBy("distance").agg(F.max(F.when(F.col("strand") == "+", F.col("level"))).alias("watson"), F.max(F.when(F.col("strand") == "-", F.col("level"))).alias("crick"))
    plus = bins.where("strand = '+'").select("distance").distinct()
    return plus.join(F.broadcast(wide), "distance", "left")  # one row per distance


def accuracy_pairs(pairs: DataFrame) -> DataFrame:
    """(total, q30, correct, percent) of simulated pairs named n_chr:start-end: both outer ends must be right."""
    p = F.split("id", "[_:-]")
    one_left = F.col("pos1") <= F.col("pos2")
    left = F.least("pos1", "pos2")
    right = F.when(one_left, F.col("pos2") + F.length("seq2") - 1).otherwise(F.col("pos1") + F.length("seq1") - 1)
    return _accuracy(pairs, (F.col("chr") == p[1]) & (left == p[2].cast("long")) & (right == p[3].cast("long")))


def accuracy_single(reads: DataFrame) -> DataFrame:
    """The same for single reads: first and last base."""
    p = F.split("id", "[_:-]")
    ok = (F.col("chr") == p[1]) & (F.col("pos") == p[2].cast("long")) & (F.col("pos") + F.length("seq") - 1 == p[3].cast("long"))
    return _accuracy(reads, ok)


def _accuracy(df: DataFrame, ok) -> DataFrame:
    out = df.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("mapq") >= 30).alias("q30"), F.count_if(ok).alias("correct"))
    return out.withColumn("percent", F.when(F.col("total") > 0, F.col("correct").cast("double") * 100 / F.col("total")))
