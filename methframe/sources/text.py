"""Readers of text tables: chromosome lists, intervals, calls, gene tables, SAM, settings and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S


def _tsv(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    return spark.read.csv(path, sep="\t", comment="#", schema=schema, quote="")


def chr_info(spark: SparkSession, path: str) -> DataFrame:
    return _tsv(spark, path, S.CHR_INFO)


def calls(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return _tsv(spark, path, S.CALL)


def bed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(chr, start, end, line): any BED file; the whole line is kept."""
    lines = spark.read.text(path).where(~F.col("value").rlike("^(#|track|browser|\\s*$)"))
    f = F.split("value", "\\s+")
    return lines.select(f[0].alias("chr"), f[1].cast("long").alias("start"), f[2].cast("long").alias("end"), F.col("value").alias("line"))


def refgene(spark: SparkSession, path: str) -> DataFrame:
    """Gene tables of 16 columns, plain or compressed."""
    f = F.split("value", "\t")
    lines = spark.read.text(path).where(~F.col("value").startswith("#"))
    return lines.select(f[2].alias("chr"), f[3].alias("strand"), f[4].cast("long").alias("tx_start"), f[5].cast("long").alias("tx_end"), f[12].alias("gene"))


def tss_bins(spark: SparkSession, path: str) -> DataFrame:
    return _tsv(spark, path, S.TSS_BIN)


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(line_no, value) of text files in the order of their paths, from 0: splits count their own lines, and one row a split tells where it starts."""
    lines = spark.read.text(path).select("value", "_metadata.file_path", F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    splits = lines.groupBy("file_path", "block").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("file_path", "block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = splits.select("file_path", "block", (before - F.col("first")).alias("shift"))
    return lines.join(F.broadcast(starts), ["file_path", "block"]).select((F.col("at") + F.col("shift")).alias("line_no"), "value")


def sam(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Alignment lines; header lines are left out, optional tags are an array."""
    lines = spark.read.text(path).where(~F.col("value").startswith("@"))
    f = F.split("value", "\t")
    kinds = S.SAM.fields[:-1]
    columns = [f[i].cast(k.dataType).alias(k.name) for i, k in enumerate(kinds)]
    return lines.where(F.size(f) >= len(kinds)).select(*columns, F.slice(f, len(kinds) + 1, F.greatest(F.lit(0), F.size(f) - len(kinds))).alias("tags"))


def strand_of(tags: str = "tags"):
    """'W' or 'C' by a line's strand tag."""
    return F.when(F.array_contains(tags, "XG:Z:CT"), "W").when(F.array_contains(tags, "XG:Z:GA"), "C")


def chr_log(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Counts per chromosome of an earlier run."""
    return _tsv(spark, path, S.CHR_LOG)


def conf(spark: SparkSession, path: str) -> DataFrame:
    return _tsv(spark, path, S.CONF).where("trim(key) <> ''")


def metrics(spark: SparkSession, path: str) -> DataFrame:
    """(key, value) of logs whose lines are a label and a number."""
    lines = spark.read.text(path)
    pattern = r"^(.*?)\s*:?\s+([0-9]+)\s*$"
    return lines.where(F.col("value").rlike(pattern)).select(F.regexp_extract("value", pattern, 1).alias("key"), F.regexp_extract("value", pattern, 2).cast("long").alias("value"))
