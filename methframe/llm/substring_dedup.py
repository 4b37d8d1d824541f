"""Removal of repeated passages by level-wise doubling.

A window of 2n words can be repeated only if each window of n words in it is.  So,
from BASE words on, windows repeated at one length alone are extended to twice that
length, until MIN_WORDS is reached or none survives.  Below MIN_WORDS a level only has to
rule windows out, so each window of 2n words is judged by one window of n words in it, its anchor (the
one with the smallest hash); equal windows have equal anchors, and about 2 in n + 2
windows are anchors of any.  Repeated anchors are kept as a bit filter of fixed size.

At MIN_WORDS every surviving window is grouped by both its hashes (128 bits), and all but the first
(smallest id, then earliest start) cover the words that go.  Repetitions within one
batch are settled there, so a passage that a third of all documents share sends one row
per batch to its group, and the windows of one passage go to different groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from .arrowmap import sliced
from .repeats import BITS, Filter, frequent
from .wordhash import Words, mix, scanned, signed

BASE = 10
MIN_WORDS = 20


def _windows(words: Words, n: int, base: int, filters: dict[int, Filter]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, hash, start of the anchor of n / 2 words) of the windows of n words that may be repeated."""
    at, h = words.windows(n)
    if n == base:
        return at, h, at
    half = n // 2
    low_at, low = words.windows(half)
    by_word = np.zeros(len(words.start), np.uint64)
    by_word[low_at] = low
    best, anchor = by_word[at], at.copy()
    for k in range(1, half + 1):
        other = by_word[at + k]
        less = other < best
        best = np.where(less, other, best)
        anchor = np.where(less, at + k, anchor)
    alive = filters[half](best) if half in filters else np.ones(len(at), bool)
    if half != base:
        known = np.zeros(len(words.start), bool)
        known[_windows(words, half, base, filters)[0]] = True
        alive &= known[anchor]
    return at[alive], h[alive], anchor[alive]


def _ladder(df: DataFrame, text_col: str, base: int, min_words: int, bits: int) -> dict[int, Filter] | None:
    """Filters of repeated anchors by their length; null if no candidate survived."""
    filters: dict[int, Filter] = {}
    n = base
    while n < min_words:
        level = n

        def hashes(level: int = level):
            shared = spark_filters

            def run(batch: pa.RecordBatch) -> np.ndarray:
                out = []
                for _, _, words in scanned(batch.column(0), False):
                    _, _, anchor = _windows(words, 2 * level, base, shared.value)
                    at, h = words.windows(level)
                    by_word = np.zeros(len(words.start), np.uint64)
                    by_word[at] = h
                    out.append(by_word[np.unique(anchor)])
                return np.concatenate(out) if out else np.empty(0, np.uint64)

            return run

        spark_filters = df.sparkSession.sparkContext.broadcast(dict(filters))
        (found,) = frequent(df, [text_col], hashes, [2], bits)
        if not found.any():
            return None
        filters[n] = found
        n *= 2
    return filters


def _squeezed(words: Words, keep: np.ndarray) -> pa.Array:
    """Kept words of every document of the block, joined by one space, without a loop over words."""
    owner = words.document_of()[keep]
    start, size = words.start[keep], (words.end - words.start)[keep]
    docs = len(words.first) - 1
    per = np.bincount(owner, minlength=docs)
    lead = np.ones(len(owner), np.int64)
    lead[np.cumsum(per)[per > 0] - per[per > 0]] = 0  # no space before a document's first word
    total = size + lead
    ends = np.cumsum(total)
    out = np.full(int(ends[-1]) if len(ends) else 0, 32, np.uint8)
    to = np.repeat(ends - size, size) + _ramp(size)
    out[to] = words.data[np.repeat(start, size) + _ramp(size)]
    offsets = np.zeros(docs + 1, np.int32)
    np.cumsum(np.bincount(owner, total, docs).astype(np.int64), out=offsets[1:])
    return pa.StringArray.from_buffers(docs, pa.py_buffer(offsets.tobytes()), pa.py_buffer(out.tobytes()))


def _ramp(size: np.ndarray) -> np.ndarray:
    """0, 1, ..., size - 1 for each size, one after the other."""
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)


RESULT = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())]
)


def substring_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, base: int = BASE, bits: int = BITS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) of every row of df.

    Words are runs outside [\\x20\\x09-\\x0D].  Each word covered by a window of min_words words
    goes if the window's words also start earlier (in a smaller id, or before in the same
    row); windows are judged on the input.  kept_text joins the words left by one space.

    Null and empty texts have no words and give empty text.  A row with a null id neither
    removes nor loses anything.  Rows that repeat an id with the same text do not remove
    each other's words; if their texts differ, places removed in one are removed in both.  Other
    columns are not read.  min_words must be base times a power of two (base even or equal to it).
    """
    ratio = min_words // base
    if base * ratio != min_words or ratio & (ratio - 1) or base < 1:
        raise ValueError("min_words must be base times a power of two")
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    filters = _ladder(docs, "text", base, min_words, bits)
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(filters or {})
    none_left = filters is None

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(key, check, doc_id, start, sure): one row per surviving window; sure: an earlier one is in the same batch."""
        for batch in sliced(batches):
            ids, known = _ids(batch.column(0))
            hs, cs, ds, ps = [], [], [], []
            for i, _, words in scanned(batch.column(1), False):
                at, h, _ = _windows(words, min_words, base, shared.value)
                doc = words.document_of()[at]
                ok = known[i + doc]
                every, c = words.windows(min_words, 1)
                hs.append(h[ok])
                cs.append(c[np.searchsorted(every, at[ok])])
                ds.append(ids[i + doc][ok])
                ps.append((at - words.first[doc])[ok])
            h, c, d, p = (np.concatenate(x) for x in (hs, cs, ds, ps))
            order = np.lexsort((p, d, c, h))
            h, c, d, p = h[order], c[order], d[order], p[order]
            sure = np.zeros(len(h), bool)
            sure[1:] = (h[1:] == h[:-1]) & (c[1:] == c[:-1])
            # Rows that repeat an id and a start tie with the first one.
            first = np.maximum.accumulate(np.where(sure, 0, np.arange(len(h)))) if len(h) else np.empty(0, np.int64)
            sure &= (d != d[first]) | (p != p[first])
            key = np.where(sure, mix(h + np.uint64(2) * np.arange(len(h), dtype=np.uint64) + np.uint64(1)), h)
            for a in range(0, len(h), 1 << 18):
                b = a + (1 << 18)
                yield pa.RecordBatch.from_arrays([pa.array(signed(key[a:b])), pa.array(signed(c[a:b])), pa.array(d[a:b]), pa.array(p[a:b].astype(np.int32)), pa.array(sure[a:b])], names=["key", "check", "doc_id", "start", "sure"])

    def settled(batches: Iterator[pa.RecordBatch], wanted: bool) -> Iterator[pa.RecordBatch]:
        """Documents that have surviving windows (with their text), or results of those that have none."""
        for batch in sliced(batches):
            _, known = _ids(batch.column(0))
            for i, j, words in scanned(batch.column(1), False):
                docs_here = j - i
                open_ = np.zeros(docs_here, bool)
                if not none_left:
                    at, _, _ = _windows(words, min_words, base, shared.value)
                    open_[words.document_of()[at]] = True
                    open_ &= known[i:j]
                pick = np.flatnonzero(open_ == wanted)
                if not len(pick):
                    continue
                rows = batch.slice(i, docs_here).take(pa.array(pick))
                if wanted:
                    yield pa.RecordBatch.from_arrays(rows.columns, names=["doc_id", "text"])
                else:
                    n = np.diff(words.first)
                    kept = _squeezed(words, np.ones(len(words.start), bool)).take(pa.array(pick))
                    yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(n[pick]), pa.array(np.zeros(len(pick), np.int64)), kept], names=RESULT.names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Takes the covered words out of (doc_id, text, starts of removed windows)."""
        for batch in sliced(batches):
            starts = batch.column(2)
            at, values = starts.offsets.to_numpy(), starts.values.to_numpy(zero_copy_only=False)
            for i, j, words in scanned(batch.column(1), False):
                n = np.diff(words.first)
                size = np.diff(at[i : j + 1])
                begin = np.repeat(words.first[:-1], size) + values[at[i] : at[j]]
                edge = np.zeros(len(words.start) + 1, np.int64)
                np.add.at(edge, begin, 1)
                np.add.at(edge, begin + min_words, -1)
                keep = np.cumsum(edge[:-1]) == 0
                gone = np.add.reduceat(np.append(~keep, False).astype(np.int64), words.first[:-1]) * (n > 0)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(n), pa.array(gone), _squeezed(words, keep)], names=RESULT.names)

    closed = docs.mapInArrow(lambda b: settled(b, False), RESULT)
    if none_left:
        return closed
    found = docs.mapInArrow(candidates, "key long, check long, doc_id long, start int, sure boolean")
    turn = F.rank().over(Window.partitionBy("key", "check").orderBy("doc_id", "start"))
    removed = found.withColumn("turn", turn).where("sure or turn > 1").groupBy("doc_id").agg(F.collect_list("start").alias("starts"))
    texts = docs.mapInArrow(lambda b: settled(b, True), docs.schema)
    starts = F.coalesce(F.col("starts"), F.array().cast("array<int>"))
    opened = texts.join(removed, "doc_id", "left").select("doc_id", "text", starts.alias("starts"))
    return closed.unionByName(opened.mapInArrow(cut, RESULT))


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids (0 for null) and which are not null."""
    return column.fill_null(0).to_numpy(zero_copy_only=False), column.is_valid().to_numpy(zero_copy_only=False)
