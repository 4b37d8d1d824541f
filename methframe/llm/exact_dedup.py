"""Exact duplicates with skew-safe combining.

Rows are combined three times, with their full content as part of the key each time:
locally in the map tasks (the partial half of the first aggregate, before any shuffle), then by
(digest, salt, content), then the salts' winners by (digest, content).  A hot text so
leaves a map task as one row per salt and meets in one task as one row per salt.

Verdicts take the same way back, by digest alone: each (digest, salt) that occurs (at most as many per text as there are
salts) learns the group's outcome, and every input row meets its own salt's.  No key of any of
these joins and aggregates holds more than a salt's share of a text's copies, at any size of
input; nothing depends on how many texts repeat.  The digest only routes rows: where different contents
share one, content decides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, partitions, stash

SPACES = r"[\x20\x09-\x0D]+"
SALTS = 64  # at least; as many as there are shuffle partitions if those are more


def normalised(text: Column) -> Column:
    """Null as empty; each run of white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def sha256(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def _routed(df: DataFrame, id_col: str, text_col: str, salts: int, digest: Callable[[Column], Column]) -> DataFrame:
    """(doc_id, content, digest, salt); the salt comes from the id, so rows that repeat an id share it."""
    rows = df.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("content"))
    return rows.select("doc_id", "content", digest(F.col("content")).alias("digest"), F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("salt"))


def _winners(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(salted, groups): rows per (digest, salt, content) with their smallest id and number, and the same per (digest, content)."""
    salted = rows.groupBy("digest", "salt", "content").agg(F.min("doc_id").alias("salt_id"), F.count(F.lit(1)).alias("salt_n"))
    groups = salted.groupBy("digest", "content").agg(F.min("salt_id").alias("keep_id"), F.sum("salt_n").alias("n"))
    return salted, groups


def exact_dedup(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int | None = None,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when equal after *normalised*; a null text counts as empty, so
    all null, empty texts form one group and white-space-only texts (one space) another.
    The smallest id of a group stays.  A null id never stays unless all ids of
    the group are null; then keep_id is null and kept is false.  Rows that repeat id and
    text all count in group_size and share one verdict.  Other columns are not read.
    An empty table gives an empty result.

    digest maps normalised content to a string; it only routes rows (tests use a weak one).
    Rows with null ids share one salt.
    """
    salts = salts or max(SALTS, partitions(df.sparkSession))
    rows = _routed(df, id_col, text_col, salts, digest)
    _, groups = _winners(rows)
    found = stash(groups.select("digest", "keep_id", "n"))
    collides = digest is not sha256 or bool(found.groupBy("digest").count().where("count > 1").take(1))
    key = ["digest", "content"] if collides else ["digest"]
    routes = ["salt", *key]
    rows = stash(rows.select("doc_id", *routes))
    verdicts = rows.select(*routes).distinct().join(stash(groups) if collides else found, key)
    text_sha256 = F.col("digest") if digest is sha256 else sha256(F.col("content"))
    return rows.join(verdicts, routes, "left").select(
        "doc_id",
        "keep_id",
        F.col("n").cast("long").alias("group_size"),
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"),
        text_sha256.alias("text_sha256"),
    )


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int | None = None) -> DataFrame:
    """The rows of df that exact_dedup keeps, with all their columns; its ids decide, so rows with a null id stay, and all rows that repeat a kept id and its text."""
    (mark,) = fresh(df, "dropped_id")
    verdict = exact_dedup(df, id_col, text_col, salts).filter("not kept and doc_id is not null")
    dropped = stash(verdict.select(F.col("doc_id").alias(mark)).distinct())
    return df.join(dropped, df[id_col] == dropped[mark], "left_anti")
