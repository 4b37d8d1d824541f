"""Ranked lexical search over dual-sorted wavelet trees, one per shard of documents.

A shard holds the postings of all its terms in one sequence: term by term, and within a term the documents of
largest impact first.  A wavelet tree over this sequence splits it by document number, bit by bit, and keeps the order,
so a term's postings are one range in every node, and the first of the range has the largest impact of all its
documents below that node.  The sum of these, weighted, bounds every score in the node's stretch of documents.  A query opens
the nodes of the highest bounds first; a leaf's bound is its document's score.  Nodes below the k-th best score
are dropped, so the answer is exact.  Nodes are opened in growing batches, so that NumPy works on all terms of many nodes at once.

Shards are made where the documents lie and stored as rows; no posting is shuffled.  Queries visit all shards in blocks
of a fixed size, and each task sends k answers of a query at most.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from .arrowmap import sliced
from .common import stash

ITEMS = 1024  #: queries of a block at most,
ITEM_BYTES = 16 << 20  #: and bytes of their texts, but for a longer one on its own
OPENED = 32  #: nodes of the first batch; each further one is twice as large, up to
MOST_OPENED = 4096
SALTS = 64  # into which the answers of a query are dealt before their last ranking

_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[65:91] += 32
_KEPT = np.zeros(256, bool)
_KEPT[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True  # digits, letters, all of any non-ASCII code point

_SHARD = "ids binary, known binary, term_bytes binary, term_ends binary, starts binary, impacts binary, bits binary, zeros array<int>"


def tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(terms, document of each) of string rows in their order; nulls have none."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]] if len(ends) else np.empty(0, np.uint8)
    ends = ends - ends[0]
    kept = _KEPT[data]
    start = kept.copy()
    start[1:] &= ~kept[:-1]
    edges = ends[:-1][ends[:-1] < len(data)]
    start[edges] = kept[edges]  # a text's first term does not go on from the text before
    at = np.flatnonzero(start)
    before = np.cumsum(kept) - kept
    offsets = np.append(before[at], kept.sum()).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(_LOWERED[data[kept]])])
    return words, np.searchsorted(ends[1:], at, "right")


def count_terms(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """Documents with a term, and terms of all documents with repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs_seen = terms = 0
        for batch in sliced(batches):
            _, doc = tokens(batch.column(0))
            docs_seen += len(np.unique(doc))
            terms += len(doc)
        yield pa.RecordBatch.from_arrays([pa.array([docs_seen], pa.int64()), pa.array([terms], pa.int64())], names=["docs", "terms"])

    found = docs.select(text_col).mapInArrow(run, "docs long, terms long").agg(F.sum("docs"), F.sum("terms")).first()
    return found[0] or 0, found[1] or 0


def make_shard(ids: pa.Array, texts: pa.Array, n_docs: int, n_terms: int) -> dict | None:
    """The stored form of a shard; None without a term.  n_docs and n_terms are of all documents."""
    words, doc = tokens(texts)
    if not len(words):
        return None
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    numbers = ids.fill_null(np.iinfo(np.int64).max).to_numpy()
    length = np.bincount(doc, minlength=len(numbers))
    order = np.lexsort((numbers, ~known))  # by id, null ids last
    order = order[length[order] > 0]
    local = np.zeros(len(numbers), np.int64)
    local[order] = np.arange(len(order))
    # Python's numbers: the product leaves 64 bits on large corpora
    m = np.array([25 + 75 * int(n) * n_docs // n_terms for n in length[order]], np.int64)
    coded = words.dictionary_encode()
    n = len(order)
    pair, tf = np.unique(coded.indices.to_numpy().astype(np.int64) * n + local[doc], return_counts=True)
    term, at = pair // n, pair % n
    impact = 1_000_000_000 * tf.astype(np.int64) // (1000 * tf + 8 * m[at])
    starts = np.append(0, np.cumsum(np.bincount(term, minlength=len(coded.dictionary)))).astype(np.int32)
    by_impact = np.argsort((term << 20) + (1_000_000 - impact), kind="stable")  # an impact is below 10 ** 6
    at, impact = at[by_impact], impact[by_impact]
    bits, zeros = [], []
    for k in range((n - 1).bit_length() - 1, -1, -1):
        one = (at >> k & 1).astype(bool)
        bits.append(np.packbits(one).tobytes())
        zeros.append(int(len(one) - one.sum()))
        at = np.concatenate([at[~one], at[one]])
    ends = np.frombuffer(coded.dictionary.buffers()[1], np.int64)[: len(coded.dictionary) + 1]
    return {
        "ids": numbers[order].tobytes(), "known": known[order].tobytes(), "term_bytes": coded.dictionary.buffers()[2].to_pybytes()[: ends[-1]], "term_ends": ends.tobytes(),
        "starts": starts.tobytes(), "impacts": impact.astype(np.int32).tobytes(), "bits": b"".join(bits), "zeros": zeros,
    }


def shard_terms(row: dict) -> tuple[pa.Array, np.ndarray]:
    """(terms, where each one's postings start, and the last end) of a stored shard."""
    ends = np.frombuffer(row["term_ends"], np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(row["term_bytes"])]), np.frombuffer(row["starts"], np.int32)


class Shard:
    """A stored shard, opened for search: per level of the tree the ones before each place, and the impacts in its order."""

    def __init__(self, row: dict):
        self.ids, self.known = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["known"], bool)
        self.zeros = np.array([*row["zeros"], 0], np.int64)
        self.levels = len(row["zeros"])
        impact = np.frombuffer(row["impacts"], np.int32)
        n = self.n = len(impact)
        width = -(-n // 8)
        self.ones = np.zeros(self.levels * (n + 1), np.int32)
        self.impacts = np.empty((self.levels + 1) * n, np.int32)
        self.impacts[:n] = impact
        for k in range(self.levels):
            one = np.unpackbits(np.frombuffer(row["bits"], np.uint8, width, k * width), count=n).astype(bool)
            np.cumsum(one, out=self.ones[k * (n + 1) + 1 : (k + 1) * (n + 1)])
            impact = np.concatenate([impact[~one], impact[one]])
            self.impacts[(k + 1) * n : (k + 2) * n] = impact

    def top(self, start: np.ndarray, end: np.ndarray, weight: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """(scores, documents' numbers) of the k best documents of score above 0 and at least floor, ties to the smaller number.

        start, end and weight are of the query's terms that the shard has.
        """
        left, right, weight = start.astype(np.int64), end.astype(np.int64), weight.astype(np.int64)
        scores, docs = np.empty(0, np.int64), np.empty(0, np.int64)
        if not len(left):
            return scores, docs
        # Nodes are columns; the ranges of a node's terms stand together, sizes[i] of them.
        bounds = np.array([(weight * self.impacts[left]).sum()])
        level, low, sizes = np.zeros(1, np.int64), np.zeros(1, np.int64), np.array([len(left)])
        least, opened = max(1, floor), OPENED
        while True:
            keep = bounds >= least
            if not keep.any():
                return scores, docs
            pick = np.zeros(len(bounds), bool)
            pick[np.flatnonzero(keep) if keep.sum() <= opened else np.argpartition(-bounds, opened)[:opened]] = True
            opened = min(2 * opened, MOST_OPENED)
            of = np.repeat(pick, sizes)
            stay = keep & ~pick
            still = np.repeat(stay, sizes)
            rest = bounds[stay], level[stay], low[stay], sizes[stay], left[still], right[still], weight[still]
            bounds, level, low, sizes, left, right, weight = bounds[pick], level[pick], low[pick], sizes[pick], left[of], right[of], weight[of]
            leaf = level == self.levels
            if leaf.any():
                scores, docs = np.append(scores, bounds[leaf]), np.append(docs, low[leaf])
                best = np.lexsort((docs, -scores))[:k]
                scores, docs = scores[best], docs[best]
                if len(scores) == k:
                    least = max(least, int(scores[-1]))
                of = np.repeat(~leaf, sizes)
                level, low, sizes, left, right, weight = level[~leaf], low[~leaf], sizes[~leaf], left[of], right[of], weight[of]
            parts = [rest]
            if len(level):
                at = np.repeat(level, sizes)
                node = np.repeat(np.arange(len(level)), sizes)
                row = at * (self.n + 1)
                a, b = self.ones[row + left].astype(np.int64), self.ones[row + right].astype(np.int64)
                zero = self.zeros[at]
                for lefts, rights, step in ((left - a, right - b, 0), (zero + a, zero + b, 1)):
                    there = rights > lefts
                    lefts, rights, heavy, whose = lefts[there], rights[there], weight[there], node[there]
                    counts = np.bincount(whose, minlength=len(level))
                    sums = np.append(0, np.cumsum(heavy * self.impacts[(at[there] + 1) * self.n + lefts]))
                    edge = np.append(0, np.cumsum(counts))
                    some = counts > 0
                    deeper = level[some] + 1
                    parts.append(((sums[edge[1:]] - sums[edge[:-1]])[some], deeper, low[some] + (step << (self.levels - deeper)), counts[some], lefts, rights, heavy))
            bounds, level, low, sizes, left, right, weight = (np.concatenate(x) for x in zip(*parts, strict=True))


@dataclass
class Index:
    """Stored shards of all documents, and what the weights need of the whole."""

    shards: DataFrame
    n_docs: int
    n_terms: int


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """The index of every document: one pass counts, one makes a shard of each slice of a few MB."""
    n_docs, n_terms = count_terms(docs, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            row = make_shard(batch.column(0), batch.column(1), n_docs, n_terms)
            if row is not None:
                yield pa.RecordBatch.from_pylist([row], schema)

    schema = pa.schema([(name, pa.list_(pa.int32()) if kind == "array<int>" else pa.binary()) for name, kind in (f.split(" ") for f in _SHARD.split(", "))])
    return Index(stash(docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, _SHARD)), n_docs, n_terms)


def _block(rows: list[Row]) -> tuple[pa.Array, list[dict[int, int]]]:
    """(vocabulary, occurrences by place in it for each row) of a block of queries."""
    words, row = tokens(pa.array([r["text"] for r in rows], pa.string()))
    coded = words.dictionary_encode()
    found: list[dict[int, int]] = [{} for _ in rows]
    for (i, c), n in Counter(zip(row.tolist(), coded.indices.to_pylist(), strict=True)).items():
        found[i][c] = n
    return coded.dictionary, found


def _document_counts(index: Index, words: pa.Array) -> np.ndarray:
    """In how many documents each of the words stands: read from the shards' term tables alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(words), np.int64)
        for batch in batches:
            for k in range(batch.num_rows):
                terms, starts = shard_terms({c: batch.column(c)[k].as_py() for c in batch.schema.names})
                at = pc.index_in(words, value_set=terms)
                has = at.is_valid().to_numpy(zero_copy_only=False)
                where = at.drop_null().to_numpy()
                total[has] += starts[where + 1] - starts[where]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["word", "n"])

    out = np.zeros(len(words), np.int64)
    for r in index.shards.select("term_bytes", "term_ends", "starts").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).toLocalIterator():
        out[r["word"]] = r["n"]  # a number for each word of a block
    return out


def _search_block(index: Index, rows: list[Row], k: int) -> DataFrame:
    """(item_id, rank, doc_id, score) for the rows (item_id, text) of one block."""
    words, found = _block(rows)
    df = _document_counts(index, words)
    weight = np.array([math.floor(1000 * math.log((2 * index.n_docs + 2) / (2 * int(n) + 1))) for n in df], np.int64)
    queries = [(np.array(list(f), np.int64), np.array([weight[c] * n for c, n in f.items()], np.int64)) for f in found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, bool, int]]] = [[] for _ in queries]  # (-score, id is null, id): the k best of this task
        for batch in batches:
            for row in batch.to_pylist():
                terms, starts = shard_terms(row)
                place = pc.index_in(words, value_set=terms).fill_null(-1).to_numpy()
                shard = Shard(row)
                for q, (of, heavy) in enumerate(queries):
                    at = place[of]
                    has = at >= 0
                    at = at[has]
                    floor = -best[q][-1][0] if len(best[q]) == k else 1
                    scores, docs = shard.top(starts[at], starts[at + 1], heavy[has], k, floor)
                    if len(scores):
                        new = zip((-scores).tolist(), (~shard.known[docs]).tolist(), shard.ids[docs].tolist(), strict=True)
                        best[q] = sorted([*best[q], *new])[:k]
                del shard
        flat = [(q, None if null else i, -s) for q, b in enumerate(best) for s, null, i in b]
        yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in flat], pa.int64()) for c in range(3)], names=["query", "doc_id", "score"])

    met = index.shards.mapInArrow(run, "query long, doc_id long, score long")
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    for key in (["query", "salt"], ["query"]):  # all tasks' answers of a query are ranked by salt first
        if key[-1] == "salt":
            met = met.withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS)))
        met = met.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(F.col("rank") <= k)
    spark = index.shards.sparkSession
    items = F.broadcast(spark.createDataFrame([(q, r["item_id"]) for q, r in enumerate(rows)], "query long, item_id long"))  # a block
    return met.join(items, "query").select("item_id", "rank", "doc_id", "score")


def search(index: Index, items: DataFrame, k: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): for each row of items its k documents of highest score above 0, equal scores by ascending id.

    Items come to the driver in blocks of a fixed size, one at a time.  A null or termless text gives no rows, and a row that repeats an
    id is answered on its own.  Documents with a null id count and rank like others, after equal scores; repeated rows are documents each.
    No items or no documents give no rows.
    """
    spark = items.sparkSession
    done: list[DataFrame] = []
    rows: list[Row] = []
    held = 0

    def answer() -> None:
        nonlocal rows, held
        if rows:
            done.append(_search_block(index, rows, k))
        rows, held = [], 0

    if index.n_docs:
        for r in items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).where("text is not null").toLocalIterator():
            if done and not rows:
                done[-1] = stash(done[-1])  # more than one block: each is written, so that plans stay small
            rows.append(r)
            held += len(r["text"].encode())
            if len(rows) >= ITEMS or held >= ITEM_BYTES:
                answer()
        answer()
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for df in done:
        out = out.unionByName(df)
    return out
