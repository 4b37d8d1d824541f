"""Nearest neighbours by cosine through an inverted multi-index.

Vectors of length one are cut into two halves, and each half is quantised by a codebook of its own; the pair of
centroids is a vector's cell.  A query goes through the pairs in the order of their summed squared distances, taken from
a heap, first until the cells hold enough entries for a first answer.  A near vector's own distance and its cell's
summed distance differ by a quantisation error; its quantile over near pairs of a sample is the index's margin.  The
query goes through the pairs once more, up to the distance of its first answer plus the margin, and every entry of these
cells is ranked by the cosine of the original vectors.  No number of cells or entries is fixed: dense data end sooner.

Entries are dealt by their first centroid, in pieces, and the queries that visit any of its cells, with the list of
these, in blocks, so no task holds more than a piece and a block.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .arrowmap import release, sliced
from .common import stash

SAMPLE = 20_000  #: vectors, about, that codebooks and margin are fitted on
PROBES = 512  #: of them that serve as queries for the margin
CENTROIDS = 256  #: of a half at most; a table of their pairs is what is broadcast
QUANTILE = 0.95  #: of near pairs of the sample whose cell lies within the margin
FIRST = 1000  #: entries that the cells of a first answer hold at least
PIECE, BLOCK = 4096, 1024  #: entries and queries that meet in one group at most, about
ROUNDS = 10
NEVER = -2.0  # below every cosine: no first answer yet
ANY = -1e9  # the floor of a first answer that has fewer than k: no cell is too far
_SLACK = 1e-9  # far above the rounding error of a sum, for a choice before exact scores


def _rows(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) of the non-null lists of each length above 0; null components are nan."""
    starts = np.append(0, np.cumsum(column.value_lengths().fill_null(0).to_numpy())).astype(np.int64)
    lengths, flat = np.diff(starts), column.flatten().cast(pa.float64()).fill_null(math.nan).to_numpy()
    for d in np.unique(lengths[lengths > 0]):
        at = np.flatnonzero(lengths == d)
        yield at, flat[starts[at][:, None] + np.arange(d)[None]]


def _lists(matrix: np.ndarray) -> pa.Array:
    n, d = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * d), pa.array(np.ascontiguousarray(matrix).ravel()))


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two that keeps squares from over- and underflowing; cosines do not change by it."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None])


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1))[:, None]


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, dim, vector) of the rows that take part: an id, a vector of finite components that are not all zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            for at, x in _rows(batch.column(1)):
                good = known[at] & np.isfinite(x).all(1) & (x != 0).any(1)
                at, x = at[good], _scaled(x[good])
                if len(at):
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(np.full(len(at), x.shape[1], np.int32)), _lists(x)], names=["vec_id", "dim", "vector"])

    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return rows.mapInArrow(run, "vec_id long, dim int, vector array<double>")


def _codebook(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """At most k centroids by Lloyd's rounds from different rows of x."""
    distinct = np.unique(x, axis=0)
    centres = distinct[np.random.default_rng(seed).choice(len(distinct), min(k, len(distinct)), replace=False)]
    for _ in range(ROUNDS):
        at = _distances(x, centres).argmin(1)
        n = np.bincount(at, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, at, x)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)[None], 0.0)


@dataclass
class Codebooks:
    """Centroids of both halves, and the margin between a near vector's distance and its cell's."""

    halves: tuple[np.ndarray, np.ndarray]
    margin: float = 4.0

    def distances(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.halves[0].shape[1]
        return _distances(unit[:, :cut], self.halves[0]), _distances(unit[:, cut:], self.halves[1])

    def cells(self, unit: np.ndarray) -> np.ndarray:
        a, b = self.distances(unit)
        return a.argmin(1) * len(self.halves[1]) + b.argmin(1)


def fit(sample: np.ndarray, n: int, k: int = 5) -> Codebooks:
    """Codebooks for n vectors from a sample of them; more vectors have more centroids, up to CENTROIDS a half."""
    unit, cut = _unit(sample), sample.shape[1] // 2
    size = max(1, min(CENTROIDS, round(math.sqrt(n) / 2.5)))
    books = Codebooks((_codebook(unit[:, :cut], size, 1), _codebook(unit[:, cut:], size, 2)))
    probes = unit[:PROBES]
    cosine = probes @ unit.T
    cosine[np.arange(len(probes)), np.arange(len(probes))] = NEVER
    near = np.argsort(-cosine, axis=1)[:, : min(k, len(unit) - 1)]
    if near.size:
        a, b = books.distances(probes)
        cell = books.cells(unit)[near]
        m = len(books.halves[1])
        summed = np.take_along_axis(a, cell // m, 1) + np.take_along_axis(b, cell % m, 1)
        books.margin = float(np.quantile(summed - (2 - 2 * np.take_along_axis(cosine, near, 1)), QUANTILE))
    return books


def pairs_in_order(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """(a[i] + b[j], i, j) of all pairs, smallest sums first, by a heap of one pair for each i begun."""
    by_a, by_b = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
    x, y = a[by_a].tolist(), b[by_b].tolist()
    heap = [(x[0] + y[0], 0, 0)]
    while heap:
        s, i, j = heapq.heappop(heap)
        yield s, int(by_a[i]), int(by_b[j])
        if j == 0 and i + 1 < len(x):
            heapq.heappush(heap, (x[i + 1] + y[0], i + 1, 0))
        if j + 1 < len(y):
            heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))


@dataclass
class Index:
    """Stored entries (vec_id, vector, first, second, row) of one length, their codebooks, and how many each cell (first, second) has."""

    entries: DataFrame
    books: Codebooks
    sizes: np.ndarray


def build(vectors: DataFrame, n: int) -> Index:
    """The index of the n usable vectors of one length; codebooks see about SAMPLE of them, chosen by a hash, the index has all."""
    spread = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(max(1, n // SAMPLE)))
    sample = vectors.where(spread == 0).select("vector").limit(2 * SAMPLE).toArrow().column(0).combine_chunks()  # a bounded number
    if not len(sample):  # the same few vectors over and over
        sample = vectors.select("vector").limit(SAMPLE).toArrow().column(0).combine_chunks()
    books = fit(next(_rows(sample))[1], n)
    m = len(books.halves[1])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            for _, x in _rows(batch.column(1)):
                cell = books.cells(_unit(x)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell // m), pa.array(cell % m)], names=["vec_id", "vector", "first", "second"])

    assigned = vectors.select("vec_id", "vector").mapInArrow(assign, "vec_id long, vector array<double>, first int, second int")
    entries = stash(assigned.withColumn("row", F.monotonically_increasing_id()))
    sizes = np.zeros((len(books.halves[0]), m), np.int64)
    for r in entries.groupBy("first", "second").count().collect():  # a row a cell
        sizes[r["first"], r["second"]] = r["count"]
    return Index(entries, books, sizes)


def _visits(queries: DataFrame, index: Index) -> DataFrame:
    """(first, query_row, seconds) of the cells with entries that each query (query_row, vector, floor) goes through.

    floor is the cosine that its first answer ends with; without one (NEVER) the query stops at FIRST entries.
    """
    books, sizes = index.books, index.sizes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            rows, floors = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            for at, x in _rows(batch.column(1)):
                near = books.distances(_unit(x))
                for k, i in enumerate(at):
                    far = 2 - 2 * floors[i] + books.margin if floors[i] != NEVER else -1.0
                    cells: dict[int, list[int]] = {}
                    met = 0
                    for s, a, b in pairs_in_order(near[0][k], near[1][k]):
                        if met >= FIRST and s > far:
                            break
                        if sizes[a, b]:
                            cells.setdefault(a, []).append(b)
                            met += sizes[a, b]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(cells), pa.int32()), pa.array(np.full(len(cells), rows[i])), pa.array(list(cells.values()), pa.list_(pa.int32()))], names=["first", "query_row", "seconds"]
                    )

    return queries.select("query_row", "vector", "floor").mapInArrow(run, "first int, query_row long, seconds array<int>")


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of the rows of a and b one by one, the same for equal rows wherever they stand."""
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


def _rerank(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(queries: pa.Table, entries: pa.Table) -> pa.Table:
        rows, ids, floors = (queries.column(c).to_numpy() for c in ("query_row", "query_id", "floor"))
        found, second = entries.column("vec_id").to_numpy(), entries.column("second").to_numpy()
        q, e = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        a = b = np.empty((0, 1))
        if len(rows) and len(found):
            a = next(_rows(queries.column("query_vector").combine_chunks()))[1]
            b = next(_rows(entries.column("vector").combine_chunks()))[1]
            ua, ub = _unit(a), _unit(b)
            lists = queries.column("seconds").combine_chunks()
            visited = np.zeros((len(rows), int(max(second.max(), lists.flatten().to_numpy().max(initial=0))) + 1), bool)
            visited[np.repeat(np.arange(len(rows)), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()] = True
            for cell in np.unique(second):
                those, asked = np.flatnonzero(second == cell), np.flatnonzero(visited[:, cell])
                s = ua[asked] @ ub[those].T
                s[ids[asked, None] == found[None, those]] = NEVER
                kth = np.partition(s, -k, axis=1)[:, -k] if len(those) >= k else np.full(len(s), NEVER)
                i, j = np.nonzero((s >= np.maximum(kth, floors[asked])[:, None] - _SLACK) & (s > NEVER))
                q.append(asked[i])
                e.append(those[j])
        q, e = np.concatenate(q), np.concatenate(e)
        exact = np.concatenate([np.empty(0), *(cosines(a[q[j : j + PIECE]], b[e[j : j + PIECE]]) for j in range(0, len(q), PIECE))])
        order = np.lexsort((found[e], -exact, q))
        q, e, exact = q[order], e[order], exact[order]
        best = np.arange(len(q)) - np.searchsorted(q, q) < k
        out = {"query_row": rows[q[best]], "query_id": ids[q[best]], "vec_id": found[e[best]], "score": exact[best]}
        release()
        return pa.table(out)

    return run


def _shares(spark: SparkSession, counts: dict[int, int], most: int, name: str) -> DataFrame:
    """(first, name) of first centroids that have more than most rows: into how many parts they are dealt; CENTROIDS rows at most."""
    return spark.createDataFrame([(int(c), -(-int(n) // most)) for c, n in counts.items() if n > most], f"first int, {name} int")


def _answers(queries: DataFrame, index: Index, k: int) -> DataFrame:
    """(query_row, query_id, vec_id, score, rank): the k best of all visited entries of each query (query_row, query_id, query_vector, floor)."""
    spark = queries.sparkSession
    visits = stash(_visits(queries.select("query_row", F.col("query_vector").alias("vector"), "floor"), index))
    counts = {r["first"]: r["count"] for r in visits.groupBy("first").count().collect()}  # a row a centroid
    pieces = F.broadcast(_shares(spark, dict(enumerate(index.sizes.sum(1).tolist())), PIECE, "pieces"))
    blocks = F.broadcast(_shares(spark, counts, BLOCK, "blocks"))

    def dealt(df: DataFrame, number: Column) -> DataFrame:
        """Rows with the pieces and blocks of their centroid, and the number that tells their own."""
        return df.join(pieces, "first", "left").join(blocks, "first", "left").withColumns({"pieces": F.coalesce("pieces", F.lit(1)), "blocks": F.coalesce("blocks", F.lit(1)), "number": number})

    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    own = lambda c: F.pmod(F.col("number"), F.col(c)).cast("int")
    asked = dealt(visits, F.xxhash64("query_row")).withColumn("piece", every("pieces")).withColumn("block", own("blocks"))
    asked = asked.join(queries, "query_row").select("first", "piece", "block", "query_row", "query_id", "query_vector", "floor", "seconds")
    there = dealt(index.entries, F.xxhash64("row")).withColumn("block", every("blocks")).withColumn("piece", own("pieces")).select("first", "piece", "block", "vec_id", "vector", "second")
    key = ["first", "piece", "block"]
    met = asked.groupBy(*key).cogroup(there.groupBy(*key)).applyInArrow(_rerank(k), "query_row long, query_id long, vec_id long, score double")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of queries its k nearest rows of vectors by cosine, nearest first, ties to the smaller id.

    A vector that is null, empty or all zero, or has null or non-finite components, takes no part, nor does a row with a
    null id.  Candidates are of the query's length (each length has an index) and of another id; rows that
    repeat an id are candidates each, and queries each.  Fewer candidates than k are returned all; empty tables give no rows.
    """
    spark = vectors.sparkSession
    whole = stash(usable(vectors, id_col, vector_col))
    asked = stash(usable(queries, id_col, vector_col).withColumn("query_row", F.monotonically_increasing_id()))
    out = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for dim, n in sorted((r["dim"], r["count"]) for r in whole.groupBy("dim").count().collect()):
        own = asked.where(F.col("dim") == dim).select("query_row", F.col("vec_id").alias("query_id"), F.col("vector").alias("query_vector"))
        index = build(whole.where(F.col("dim") == dim), n)
        first = _answers(own.withColumn("floor", F.lit(NEVER)), index, k)
        floors = first.groupBy("query_row").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("kth"))
        again = own.join(floors, "query_row", "left").select("query_row", "query_id", "query_vector", F.coalesce("kth", F.lit(ANY)).alias("floor"))
        out = out.unionByName(_answers(stash(again), index, k).select("query_id", "rank", "vec_id", "score"))
    return out
