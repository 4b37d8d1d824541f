"""Registered queries of the corpus operators: thin callers that derive the contracted columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import gru_lm, html_text, language_id, lexical_search, nearest, pieces, quality, spelling, transport_stream
from .common import bucket, table
from .exact_dedup import exact_dedup
from .jaccard_join import jaccard_join
from .mixing import mix_sources
from .substring_dedup import substring_dedup

HELD_OUT = 2  # remainder, modulo 4, of documents that nothing is learned from


def piece_model() -> str:
    """The model file that the query uses; the operator takes any path."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"), piece_model())


def op4_transport_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = transport_stream.store(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return transport_stream.describe(stored.select("doc_id", "n_bytes", "media")).drop("media")


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = bucket(F.col("doc_id"), 10) == 0
    scored = gru_lm.score(docs, docs.where(~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("remainder", bucket(F.col("doc_id"), 4))
    model = language_id.fit(language_id.training_rows(docs, F.col("remainder"), HELD_OUT))
    rows = docs.select("doc_id", (F.col("remainder") == HELD_OUT).alias("held_out"), "text")
    return language_id.identify(rows, model).drop("text")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("html")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", bucket(F.col("doc_id"), 4).alias("remainder"), "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = quality.fit(docs.where(F.col("remainder") != HELD_OUT), labels)
    return quality.score_quality(docs.select("doc_id", (F.col("remainder") == HELD_OUT).alias("held_out"), "text"), model).drop("text")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = spelling.letter_runs(table(spark, sf_dir, "documents"), min_length=7)  # a slip makes no run longer
    words = runs.select(spelling.with_slips(runs, 31).alias("word"))
    return spelling.variant_groups(spelling.count_words(words, min_length=7, min_count=2), ratio=10)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(lexical_search.build(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


def op13_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest.nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_substring_dedup, op2_mix_sources, op3_sentencepiece, op4_transport_stream, op5_language_model, op6_language_id, op7_html_text, op8_quality, op9_exact_dedup, op10_jaccard_join, op11_spelling_variants, op12_lexical_search, op13_nearest)
}
