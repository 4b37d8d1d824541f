"""Writers of text forms.  Tables inside a run are Parquet; these are for exchange with other tools."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S


def lines(df: DataFrame, path: str, single: bool = False) -> None:
    """The column value as text files; one file only if asked (small tables)."""
    (df.coalesce(1) if single else df).select("value").write.mode("overwrite").text(path)


def tsv_lines(df: DataFrame, header: bool = True, order: list[str] | None = None) -> DataFrame:
    """Rows as tab-separated text (null as NA), sorted, under a header line that starts with #."""
    keys = order or []
    body = df.orderBy(*keys) if keys else df
    value = F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("NA")) for c in df.columns])
    body = body.select(F.lit(1).alias("part"), value.alias("value"))
    if not header:
        return body.select("value")
    head = df.sparkSession.createDataFrame([(0, "#" + "\t".join(df.columns))], "part int, value string")
    return head.unionByName(body).select("value")


def fastq_record(name: str = "id", seq: str = "seq", qual: str = "qual") -> Column:
    at = F.when(F.col(name).startswith("@"), F.col(name)).otherwise(F.concat(F.lit("@"), name))
    return F.concat_ws("\n", at, seq, F.lit("+"), qual).alias("value")


def fastq_lines(df: DataFrame, name: str = "id", seq: str = "seq", qual: str = "qual") -> DataFrame:
    return df.select(fastq_record(name, seq, qual))


def fasta_lines(genome: DataFrame, width: int = 50) -> DataFrame:
    wrapped = F.regexp_replace("seq", f"(.{{{width}}})(?=.)", "$1\n")
    return genome.select(F.concat(F.lit(">"), "chr", F.lit("\n"), wrapped).alias("value"))


def sam_header(info: DataFrame, settings: dict[str, str], program: str = "methframe", version: str = "1.0") -> DataFrame:
    """(n, value): header lines in order, chromosomes by name."""
    spark = info.sparkSession
    about = " ".join(f"{k}={v}" for k, v in sorted(settings.items()))
    ends = spark.createDataFrame([(0, "", "@HD\tVN:1.0\tSO:coordinate"), (2, "", f"@PG\tID:{program}\tVN:{version}\tCL:{about}")], "n int, k string, value string")
    middle = info.select(F.lit(1).alias("n"), F.col("chr").alias("k"), F.concat(F.lit("@SQ\tSN:"), "chr", F.lit("\tLN:"), F.col("length").cast("string")).alias("value"))
    return ends.unionByName(middle).orderBy("n", "k").select("n", "value")


def coordinate_sorted(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows ranged by chromosome and position over partitions, each sorted: the order of a sorted alignment file."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, "chr", "pos").sortWithinPartitions("chr", "pos")


def write_alignments(df: DataFrame, path: str) -> None:
    """Coordinate-sorted alignments as Parquet by chromosome, so that a region reads few files and row groups."""
    coordinate_sorted(df).write.mode("overwrite").partitionBy("chr").parquet(path)


def call_lines(called: DataFrame) -> DataFrame:
    return tsv_lines(called, order=["chr", "locus"])


def bedgraph_lines(levels: DataFrame) -> DataFrame:
    return tsv_lines(levels, header=False, order=["chr", "start"])


def trim_log_lines(counters: DataFrame) -> DataFrame:
    """The counters as text; its first number is one more than the reads."""
    rows = F.array(
        F.struct(F.lit(0).alias("n"), (F.col("total") + 1).cast("string").alias("value")),
        F.struct(F.lit(1).alias("n"), F.concat(F.lit("Dropped : "), F.col("dropped").cast("string")).alias("value")),
        F.struct(F.lit(2).alias("n"), F.concat(F.lit("Aadaptor: "), F.col("adapter").cast("string")).alias("value")),
        F.struct(F.lit(3).alias("n"), F.concat(F.lit("Tail Hit: "), F.col("tail").cast("string")).alias("value")),
    )
    return counters.select(F.explode(rows).alias("r")).select("r.n", "r.value").orderBy("n").select("value")


def merge_log_lines(strands: DataFrame) -> DataFrame:
    name = F.when(F.col("strand") == "W", "WATSON").otherwise("CRICK")
    return strands.orderBy(F.desc("strand")).select(F.concat_ws("\t", name, F.col("reads").cast("string")).alias("value"))


def dedup_log_lines(log: DataFrame) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(i).alias("n"), F.concat_ws("\t", F.lit(k.capitalize()), F.col(k).cast("string")).alias("value")) for i, k in enumerate(("all", "unique", "duplicate", "discard"))])
    return log.select(F.explode(rows).alias("r")).select("r.n", "r.value").orderBy("n").select("value")


def wig_lines(values: DataFrame, width: int, info: DataFrame, track: str | None = None) -> DataFrame:
    """Signal per chromosome (also those without any) in the variable-step form, four decimals."""
    heads = info.where("substr(chr, 4, 1) <> 'M'").select("chr", F.lit(-1).cast("long").alias("pos"), F.concat(F.lit("variableStep chrom="), "chr", F.lit(f" span={width}")).alias("value"))
    body = values.select("chr", F.col("pos").cast("long").alias("pos"), F.concat_ws("\t", F.col("pos").cast("string"), F.format_string("%.4f", F.col("value"))).alias("value"))
    out = heads.unionByName(body)
    if track:
        out = out.unionByName(info.sparkSession.createDataFrame([("", -2, f"track type='wiggle_0' name='{track}' description='{track}, bin={width}'")], "chr string, pos long, value string"))
    return out.orderBy("chr", "pos").select("value")


def annotated_bed_lines(stats: DataFrame) -> DataFrame:
    """Each interval's own line with its three sums."""
    return stats.select(F.concat_ws("\t", "line", *[F.col(c).cast("string") for c in ("sites", "c", "t")]).alias("value"))


def conf_table(spark, settings: dict[str, object]) -> DataFrame:
    return spark.createDataFrame([(k, str(v)) for k, v in settings.items()], S.CONF)
