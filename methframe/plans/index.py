"""Reference tables of one genome: written once, read by runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import genome as GENOME
from ..sources import sequence, text


def build(spark: SparkSession, fasta: str, path: str, refgene: str | None = None, control: str | None = None) -> None:
    """genome, chr_info, converted, counts and (with a gene table) tss_bins as Parquet under path."""
    extra = sequence.fasta(spark, control) if control else None
    GENOME.prepare(sequence.fasta(spark, fasta), extra).write.mode("overwrite").parquet(f"{path}/genome")
    genome = spark.read.parquet(f"{path}/genome")
    tables = {"chr_info": GENOME.chr_info(genome), "converted": GENOME.converted(genome), "counts": GENOME.conversion_counts(genome)}
    if refgene:
        tables["tss_bins"] = GENOME.tss_bins(text.refgene(spark, refgene))
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def load(spark: SparkSession, path: str, name: str = "genome") -> DataFrame:
    return spark.read.parquet(f"{path}/{name}")
