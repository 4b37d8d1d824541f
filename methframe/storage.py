"""Tables and texts written to storage that driver and executors share."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, kind: str) -> str:
    """A new path in the folder that spark.checkpoint.dir names; a temporary one only where that is unset and driver and executors are one process."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not (spark.sparkContext.master or "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix=f"{kind}-")
    return f"{shared}/{kind}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def moved_once(spark: SparkSession) -> Iterator[None]:
    """While a table is written: what was shuffled for it goes when it is written, not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def stored(df: DataFrame, kind: str = "table") -> DataFrame:
    """df as a Parquet table in a new shared folder, read again: what follows is computed from the same rows, whatever is lost."""
    path = folder(df.sparkSession, kind)
    with moved_once(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
