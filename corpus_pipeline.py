"""The corpus pipeline: stages that each call one operator, and their whole run.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's docs.  All but the last return the columns of documents, and drop any others that
docs has.  An empty table passes all stages as one.  Rows that repeat an id and its text share every decision; what
nulls do is said with each stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from methframe.llm import language_id, pieces
from methframe.llm.common import bucket, stash, table
from methframe.llm.exact_dedup import drop_copies
from methframe.llm.jaccard_join import keep_one_of_each
from methframe.llm.mixing import mix_sources
from methframe.llm.queries import HELD_OUT, piece_model

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter: only 'und' is rejected, that is null texts, texts without a letter, and all if nothing was learned.

    Which language is predicted, and how surely, decides nothing: texts of no learned language pass.
    Rows with a null id or lang are judged like others, and not learned from.
    """
    model = language_id.fit(language_id.training_rows(docs, bucket(F.col("doc_id"), 4), HELD_OUT))
    found = language_id.identify(docs, model, lang_out="stage_lang", score_out="stage_score")
    return found.where(F.col("stage_lang") != language_id.UNDETERMINED).select(COLUMNS)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id; null counts as empty, rows with a null id stay."""
    return drop_copies(docs).select(COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by shingles the one with the smallest id; rows with a null id, and texts without words, link with nothing and stay."""
    return keep_one_of_each(docs).select(COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to their sources' target weights, in a random order; a null source is '', a null id draws as 'null', sources without characters give no rows."""
    return mix_sources(docs).select(COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, decoded_sha256, exact) of every copy; a null text counts as empty."""
    return pieces.round_trip(docs, piece_model())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mix_sources", mix),
    ("sentencepiece", encode),
]

#: SQL cannot express language identification and piece encoding; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
