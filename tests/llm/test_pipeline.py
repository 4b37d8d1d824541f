import collections
import re

import corpus_pipeline
from methframe.llm.mixing import mix_sources

from .conftest import DIR
from .test_dedup_and_mixing import linked


def test_stages_by_brute_force(spark):
    """Each stage on what its predecessor kept: rows by the definition of the stage."""
    import sentencepiece

    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    data = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = {i: t for i, t in data.items() if any(c.isalpha() for c in t or "")}
    first = {}
    for i in sorted(kept):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", kept[i]), i)
    kept = {i: kept[i] for i in first.values()}
    kept = {i: kept[i] for i, _, c in linked(list(kept.items())) if c == i}
    rows = spark.createDataFrame(docs.where(docs.doc_id.isin(list(kept))).collect(), docs.schema)
    mixed = collections.Counter(r["doc_id"] for r in mix_sources(rows).collect())
    model = sentencepiece.SentencePieceProcessor(model_file=corpus_pipeline.piece_model())
    want = collections.Counter({(i, tuple(model.encode(kept[i]))): n for i, n in mixed.items()})
    got = collections.Counter((r["doc_id"], tuple(r["ids"])) for r in corpus_pipeline.run(spark, DIR).collect())
    assert got == want


def test_stages_keep_columns_and_edges(spark, docs, empty):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs.select(*corpus_pipeline.COLUMNS), DIR)
        none = stage(spark, empty, DIR)
        if name != "sentencepiece":
            assert out.columns == none.columns == corpus_pipeline.COLUMNS
        assert none.count() == 0 and out.count() > 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "mix_sources", "sentencepiece"]
