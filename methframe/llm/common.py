"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A table of a few numbers a row is broadcast only after it was counted and found to be within this bound.
BROADCAST_ROWS = 100_000


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster shares (spark.checkpoint.dir); a temporary one only where that is unset and driver and executors are one process, as in tests."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if not (sc.master or "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="checkpoints-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(found)
    return found


def stash(df: DataFrame) -> DataFrame:
    """df, written as a Parquet table to the shared folder and read again: cuts the lineage and survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/stash-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def at_most(df: DataFrame, rows: int) -> bool:
    """Whether df (already stashed) has at most *rows* rows; reads no more than one row beyond."""
    return len(df.limit(rows + 1).select(F.lit(1)).take(rows + 1)) <= rows


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df (already stashed, of a few numbers a row), hinted for a broadcast if it has at most *rows* rows; left to the planner otherwise."""
    return F.broadcast(df) if at_most(df, rows) else df


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like *names* that df does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def without(df: DataFrame, *names: str) -> DataFrame:
    """df without columns that an operator's output columns replace."""
    lost = {n.lower() for n in names}
    return df.select([df[c] for c in df.columns if c.lower() not in lost]) if lost & {c.lower() for c in df.columns} else df


def bucket(id_column: Column, modulus: int) -> Column:
    """crc32(id as text) mod modulus; a null id gives null."""
    return F.crc32(id_column.cast("string").cast("binary")) % F.lit(modulus)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
