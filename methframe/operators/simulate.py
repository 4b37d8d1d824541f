"""A deterministic read simulator: every draw is a hash of seed, read number and purpose, so runs and partitionings agree."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import reads as R
from .genome import SPAN, TILE, with_reference


# Fixed values of the quality curve: quality - A x + B x^2 - C v x^3, and its least quality.
CURVE_A, CURVE_B, CURVE_C, CURVE_LEAST = 0.034286, 0.0009263, 1e-5, 2


@dataclass(frozen=True)
class SimConfig:
    n: int = 1_000_000
    length: int = 100
    paired: bool = True
    min_fragment: int = 70
    max_fragment: int = 400
    conversion: float = 100.0  # percent of all C, if cg and ch are not given
    cg_conversion: float | None = None
    ch_conversion: float | None = None
    error: float = 0.0  # percent per base
    quality: int = 40
    snps: int = 0
    non_directional: bool = False
    adapter: str | None = None
    fixed_adapter: int = 0  # bases of adapter at the 3' end of every read
    variable_adapter: float | None = None  # mean fragment length of a normal distribution
    adapter_spread: float = 60.0
    seed: int = 1


def uniform(seed: int, purpose: str, *keys: Column, bits: int = 30) -> Column:
    """In [0, 1), from a hash, in 2**bits steps (53 at most, all that a double tells apart)."""
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(purpose), *keys), F.lit(1 << bits)).cast("double") / float(1 << bits)


def places(spark: SparkSession, info: DataFrame, conf: SimConfig) -> DataFrame:
    """(read_no, chr, start, size, strand): fragments uniform over the genome; those over an end are left out later."""
    sizes = sorted((r["chr"], r["length"]) for r in info.collect())  # one row per chromosome
    ends = np.cumsum([n for _, n in sizes]).tolist()
    total = ends[-1] if ends else 0
    k = F.col("read_no")
    # A genome may have more places than 2**30.
    at = F.floor(uniform(conf.seed, "place", k, bits=53) * total).cast("long")
    size = F.lit(conf.length) if not conf.paired else F.floor(uniform(conf.seed, "size", k) * (conf.max_fragment - conf.min_fragment + 1) + conf.min_fragment)
    starts = [0, *ends[:-1]]
    table = F.array(*[F.struct(F.lit(c).alias("chr"), F.lit(s).cast("long").alias("from"), F.lit(e).cast("long").alias("to")) for (c, _), s, e in zip(sizes, starts, ends, strict=True)])
    rows = spark.range(conf.n).select(F.col("id").alias("read_no")).withColumns({"at": at, "size": size.cast("int")})
    rows = rows.withColumn("c", F.element_at(F.filter(table, lambda x: (x["from"] <= F.col("at")) & (F.col("at") < x["to"])), 1))
    rows = rows.where(F.expr("at + size <= c.to"))
    strand = F.when(uniform(conf.seed, "strand", k) < 0.5, "W").otherwise("C")
    return rows.select("read_no", F.col("c.chr").alias("chr"), F.expr("at - c.from + 1").alias("start"), "size", strand.alias("strand"))


def _per_base(seq: str, conf: SimConfig, purpose: str, changed: str) -> Column:
    """Each base by an expression of its place i (1-based) and its draw u."""
    draw = f"(pmod(xxhash64({conf.seed}, '{purpose}', read_no, i), 1073741824) / 1073741824D)"
    each = changed.replace("%u", draw).replace("%s", "s_")
    return F.expr(R.bound(f"array_join(transform(sequence(1, length(s_)), i -> {each}), '')", s_=seq))


def bisulfite(df: DataFrame, seq: str, conf: SimConfig, purpose: str = "convert") -> DataFrame:
    """df with C of seq read as T at the rate of its context; a last C counts as CH."""
    b = "substr(%s, i, 1)"
    if conf.cg_conversion is None and conf.ch_conversion is None:
        rate = f"{conf.conversion / 100}D"
    else:
        cg, ch = (conf.cg_conversion or 0) / 100, (conf.ch_conversion or 0) / 100
        rate = f"if(substr(%s, i + 1, 1) = 'G', {cg}D, {ch}D)"
    return df.withColumn(seq, _per_base(seq, conf, purpose, f"case when {b} = 'C' and %u < {rate} then 'T' else {b} end"))


def errors(df: DataFrame, seq: str, rate: str, conf: SimConfig, purpose: str) -> DataFrame:
    """df with wrong bases at the rate (an SQL expression of place i)."""
    b = "substr(%s, i, 1)"
    other = f"substr(replace('ACGT', {b}, ''), 1 + cast(pmod(xxhash64({conf.seed}, '{purpose}-base', read_no, i), 3) as int), 1)"
    return df.withColumn(seq, _per_base(seq, conf, purpose, f"if(%u < {rate}, {other}, {b})"))


def snps(df: DataFrame, seq: str, conf: SimConfig) -> DataFrame:
    """df with conf.snps distinct places of seq changed."""
    if not conf.snps:
        return df
    picked = f"slice(sort_array(transform(sequence(1, length({seq})), i -> struct(xxhash64({conf.seed}, 'snp', read_no, i) as h, i as i))), 1, {conf.snps})"
    b = "substr(s, x.i, 1)"  # the places are distinct, so it is still the base that was read
    other = f"substr(replace('ACGT', {b}, ''), 1 + cast(pmod(xxhash64({conf.seed}, 'snp-base', read_no, x.i), 3) as int), 1)"
    # Only the places picked are changed: nothing is worked out anew for every base.
    changed = f"aggregate({picked.replace(f'length({seq})', 'length(s_)')}, s_, (s, x) -> overlay(s placing {other} from x.i))"
    return df.withColumn(seq, F.expr(R.bound(changed, s_=seq)))


def with_adapter(df: DataFrame, seq: str, conf: SimConfig, purpose: str = "adapter") -> DataFrame:
    """df with the read's 3' end replaced by adapter: a fixed number of bases, or what lies beyond a normally distributed fragment."""
    if not conf.adapter:
        return df
    tail = f"rpad('{conf.adapter}', length({seq}), 'ACGT')"
    if conf.variable_adapter is None:
        return df.withColumn(seq, F.expr(f"concat(substr({seq}, 1, length({seq}) - {conf.fixed_adapter}), substr({tail}, 1, {conf.fixed_adapter}))"))
    u1, u2 = uniform(conf.seed, f"{purpose}-a", F.col("read_no")), uniform(conf.seed, f"{purpose}-b", F.col("read_no"))
    normal = F.sqrt(-2 * F.log(1 - u1)) * F.cos(2 * np.pi * u2)
    kept = F.greatest(F.lit(0), F.floor(conf.variable_adapter + conf.adapter_spread * normal)).cast("int")
    rows = df.withColumn("kept_bases", kept)
    return rows.withColumn(seq, F.expr(f"if(kept_bases >= length({seq}), {seq}, substr(concat(substr({seq}, 1, kept_bases), {tail}), 1, length({seq})))")).drop("kept_bases")


def quality_curve(length: int, mean_error: float, quality: int = 40, tolerance: float = 1e-4) -> list[int]:
    """Phred qualities by cycle: a constant, falling ever faster, so that the mean error is met within the tolerance (percent); at least 2."""
    if mean_error <= 0:
        return [quality] * length
    x = np.arange(1, length + 1)

    def curve(v: float) -> np.ndarray:
        return np.maximum(CURVE_LEAST, quality - CURVE_A * x + CURVE_B * x**2 - CURVE_C * v * x**3)

    low, high = 0.0, 1.0
    while np.mean(10 ** (-curve(high) / 10)) * 100 < mean_error and high < 1e6:
        high *= 2
    for _ in range(200):
        middle = (low + high) / 2
        got = np.mean(10 ** (-curve(middle) / 10)) * 100
        if abs(got - mean_error) <= tolerance:
            break
        low, high = (middle, high) if got < mean_error else (low, middle)
    return [int(round(q)) for q in curve((low + high) / 2)]


def random_sequences(spark: SparkSession, n: int, length: int, seed: int = 1) -> DataFrame:
    """(read_no, seq) of four equally likely bases."""
    base = f"substr('ACGT', 1 + cast(pmod(xxhash64({seed}, 'random', id, i), 4) as int), 1)"
    return spark.range(n).select(F.col("id").alias("read_no"), F.expr(f"array_join(transform(sequence(1, {length}), i -> {base}), '')").alias("seq"))


def simulate(spark: SparkSession, genome: DataFrame, conf: SimConfig, regions: DataFrame | None = None, tile: int = TILE, span: int = SPAN) -> DataFrame:
    """Reads (read_no, id, seq, qual) or pairs (read_no, id1, seq1, qual1, id2, ...) whose names hold their true place.

    Fragments with N or outside the regions (chr, start, end), if given, are left out.  Mates of C fragments start
    at the right end.  Each read's own C are converted, mate 2's as G.
    """
    from .genome import chr_info
    from .intervals import overlapping

    at = places(spark, chr_info(genome), conf)
    if regions is not None:
        at = overlapping(at.withColumn("end", F.expr("start + size - 1")), regions.select("chr", (F.col("start") + 1).alias("start"), "end")).drop("end")
    rows = with_reference(at, genome, "start", "size", "ref", tile, span)
    rows = rows.withColumn("fragment", F.expr("upper(substr(ref, 3, size))")).where("fragment not like '%N%' and length(fragment) = size").drop("ref")
    rows = snps(rows, "fragment", conf)
    rows = rows.withColumn("fragment", F.when(F.col("strand") == "W", F.col("fragment")).otherwise(R.reverse_complement("fragment")))
    rows = bisulfite(rows, "fragment", conf)
    if conf.non_directional:
        swap = uniform(conf.seed, "swap", F.col("read_no")) < 0.5
        rows = rows.withColumn("fragment", F.when(swap, R.reverse_complement("fragment")).otherwise(F.col("fragment")))
    rows = rows.withColumn("seq1", F.expr(f"substr(fragment, 1, {conf.length})"))
    names = ["seq1"]
    if conf.paired:
        rows = rows.withColumn("seq2", F.substring(R.reverse_complement("fragment"), 1, conf.length))
        names.append("seq2")
    curve = quality_curve(conf.length, conf.error, conf.quality)
    quals = "".join(chr(33 + q) for q in curve)
    rates = F.array(*[F.lit(10 ** (-q / 10)) for q in curve])
    for s in names:
        rows = with_adapter(rows, s, conf, f"adapter-{s}")
        if conf.error > 0:
            rows = errors(rows.withColumn("rates", rates), s, "rates[i - 1]", conf, f"error-{s}").drop("rates")
    name = F.expr("concat('@', read_no, '_', chr, ':', start, '-', start + size - 1)")
    out = [F.col("read_no")]
    for k, s in enumerate(names, 1):
        tag = str(k) if conf.paired else ""
        out += [F.concat(name, F.lit(f"_R{k}")).alias(f"id{tag}"), F.col(s).alias(f"seq{tag}"), F.substring(F.lit(quals), 1, conf.length).alias(f"qual{tag}")]
    return rows.select(*out)
