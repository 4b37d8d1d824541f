"""Call tables that grow: counters are additive, so new call files update the merged table as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas as S
from ..operators.profile import merge_calls


def read_calls(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """Call tables (Parquet) that are added to a folder."""
    return spark.readStream.schema(S.CALL).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def merged(stream: DataFrame) -> DataFrame:
    """The merged call table so far; state is one row per called place."""
    return merge_calls(stream)


def write_merged(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes the places that a batch changed to path/batch=n; latest() reads the table as it stands."""

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return merged(stream).writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(save).start()


def latest(spark: SparkSession, path: str) -> DataFrame:
    """The merged table: of each place the row of the last batch that changed it."""
    rows = spark.read.parquet(path)
    columns = [c for c in rows.columns if c != "batch"]
    return rows.groupBy("chr", "locus").agg(F.max_by(F.struct(*columns), "batch").alias("r")).select("r.*")
