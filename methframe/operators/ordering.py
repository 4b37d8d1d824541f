"""Total orders over partitioned tables: rows by ranges of their keys, their numbers, and digests that tell an order.

No task sees more than its range: the parts' sizes are added up, a number for each part, and a row's number is its part's
start and its place in the part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..storage import folder


def ranged(df: DataFrame, *keys: str | Column, partitions: int | None = None) -> DataFrame:
    """df in an order that goes on from partition to partition, so that files written from it are in that order by their names."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)


def cumulated(df: DataFrame, *keys: str | Column, weight: str, name: str) -> DataFrame:
    """df with the sum of the weights of all rows before each one in the order of the keys."""
    path = folder(df.sparkSession, "ordered")
    ranged(df, *keys).write.parquet(path)
    rows = df.sparkSession.read.schema(df.schema).parquet(path).select("*", F.regexp_extract("_metadata.file_name", "part-([0-9]+)", 1).cast("long").alias("_part"), F.col("_metadata.row_index").alias("_at"))
    sums = rows.groupBy("_part").agg(F.sum(weight).alias("_sum"))  # a row a file
    starts = F.broadcast(sums.select("_part", F.coalesce(F.sum("_sum").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before")))
    inside = F.coalesce(F.sum(weight).over(Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("_inside", inside).join(starts, "_part").withColumn(name, F.col("_before") + F.col("_inside")).drop("_part", "_at", "_before", "_inside")


def parts_numbered(spark: SparkSession, path: str, schema, name: str, start: int = 0) -> DataFrame:
    """The rows of a Parquet table in the order of its files and their rows, with their numbers."""
    rows = spark.read.schema(schema).parquet(path).select("*", F.regexp_extract("_metadata.file_name", "part-([0-9]+)", 1).cast("long").alias("_part"), F.col("_metadata.row_index").alias("_at"))
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # a row a file
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = F.broadcast(sizes.select("_part", before.alias("_before")))
    return rows.join(starts, "_part").withColumn(name, F.col("_before") + F.col("_at") + start).drop("_part", "_at", "_before")


def numbered(df: DataFrame, *keys: str | Column, name: str = "n", start: int = 0) -> DataFrame:
    """df with the number of each row in the order of the keys; rows of equal keys get different numbers.

    The ordered rows are written once, so numbers do not change when results are computed again.
    """
    path = folder(df.sparkSession, "ordered")
    ranged(df, *keys).write.parquet(path)
    return parts_numbered(df.sparkSession, path, df.schema, name, start)


def as_read(df: DataFrame, name: str = "n", start: int = 0) -> DataFrame:
    """df with the number of each row in the order in which its partitions have them, as a source reads its files."""
    path = folder(df.sparkSession, "ordered")
    df.write.parquet(path)
    return parts_numbered(df.sparkSession, path, df.schema, name, start)


def digest(df: DataFrame, number: str, *columns: str) -> DataFrame:
    """(rows, digest) of a numbered table: equal only for equal rows (null as NA) in an equal order."""
    text = F.concat_ws("|", F.col(number).cast("string"), *[F.coalesce(F.col(c).cast("string"), F.lit("NA")) for c in columns])
    share = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(share % 1_000_000_007), F.lit(0)).alias("digest"))
