"""Duplicate removal by place, strand and (for pairs) fragment size; of equals the best qualities stay.

The best read of a key is a hash aggregate over one number, its rank, so map tasks send one short row per key they saw
and a hot place does not gather its reads in one task.  Whole rows then move once, to meet the winners' numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cigar as C
from .genome import few, names


def on_known(df: DataFrame, chr_info: DataFrame) -> DataFrame:
    return df.join(names(chr_info), "chr", "left_semi")


def discarded(df: DataFrame, chr_info: DataFrame) -> DataFrame:
    """Rows on chromosomes that are not listed."""
    return df.join(names(chr_info), "chr", "left_anti")


def with_fragment(pairs: DataFrame) -> DataFrame:
    size = C.fragment_size("strand", "pos1", "cigar1", "pos2", "cigar2")
    left = F.when(F.col("strand") == "W", F.col("pos1")).otherwise(F.col("pos2"))
    return pairs.withColumns({"left": left, "frag_size": size})


_ORDERS = "18446744073709551616BD"  # more than the different read numbers


def _best(df: DataFrame, keys: list[str], score: Column) -> DataFrame:
    """Of equal keys the row of the highest score, on ties of the smallest read_no (which names a row)."""
    order = F.lit((1 << 63) - 1).cast("decimal(20,0)") - F.col("read_no").cast("decimal(20,0)")  # 0 to _ORDERS - 1
    rank = (score.cast("decimal(17,0)") * F.expr(_ORDERS) + order).cast("decimal(38,0)")
    best = df.groupBy(*keys).agg(F.max(rank).alias("rank"))
    won = F.lit((1 << 63) - 1).cast("decimal(20,0)") - F.pmod(F.col("rank"), F.expr(_ORDERS))
    return df.join(best.select(won.cast("long").alias("read_no")), "read_no", "left_semi").select(df.columns)


def dedup_single(reads: DataFrame, chr_info: DataFrame) -> DataFrame:
    """Of reads with equal chr, strand and leftmost position the one with the highest quality sum, on ties the smallest read_no."""
    return _best(on_known(reads, chr_info), ["chr", "strand", "pos"], C.quality_sum("qual"))


def dedup_pairs(pairs: DataFrame, chr_info: DataFrame) -> DataFrame:
    """The same for pairs by chr, strand, left end and fragment size, with the qualities of both mates."""
    rows = with_fragment(on_known(pairs, chr_info))
    return _best(rows, ["chr", "strand", "left", "frag_size"], C.quality_sum("qual1") + C.quality_sum("qual2"))


def unique_places(pairs: DataFrame, chr_info: DataFrame) -> DataFrame:
    """(chr, strand, left, frag_size) of the pairs that dedup_pairs() keeps, a row each: for counting them, since neither qualities nor whole rows are needed for that."""
    return with_fragment(on_known(pairs, chr_info)).select("chr", "strand", "left", "frag_size").distinct()


def dedup_log(df: DataFrame, chr_info: DataFrame, unique: DataFrame) -> DataFrame:
    """(all, unique, duplicate, discard)."""
    every = df.join(few(chr_info.select("chr", F.lit(1).alias("listed"))), "chr", "left").agg(F.count(F.lit(1)).alias("all"), F.count_if(F.col("listed").isNull()).alias("discard"))
    one = unique.agg(F.count(F.lit(1)).alias("unique"))
    return every.crossJoin(one).select("all", "unique", (F.col("all") - F.col("unique") - F.col("discard")).alias("duplicate"), "discard")  # two rows of counters


def size_distribution(unique: DataFrame, max_size: int) -> DataFrame:
    """(size, count, proportion) for sizes from 1 to max_size; proportions are of all unique pairs, also larger ones."""
    total = unique.agg(F.count(F.lit(1)).alias("total"))
    sizes = unique.where(F.col("frag_size").between(1, max_size)).groupBy(F.col("frag_size").alias("size")).agg(F.count(F.lit(1)).alias("count"))
    return sizes.join(F.broadcast(total)).select("size", "count", (F.col("count").cast("double") * 100 / F.col("total")).alias("proportion"))


def size_axis(sizes: DataFrame) -> DataFrame:
    """(x_min, x_max) of the drawn distribution."""
    low = F.min("size")
    x_min = F.when(low > 100, 100).when(low > 50, 50).otherwise(0)
    x_max = F.greatest(F.lit(300), F.coalesce(F.max(F.when(F.col("proportion") > 0.01, F.col("size"))), F.lit(300)))
    return sizes.agg(x_min.cast("long").alias("x_min"), x_max.cast("long").alias("x_max"))


def concordant(pairs: DataFrame, min_size: int = 0, max_size: int = 1000) -> DataFrame:
    """Pairs whose fragment size lies in the range."""
    return pairs.where(C.fragment_size("strand", "pos1", "cigar1", "pos2", "cigar2").between(min_size, max_size))
