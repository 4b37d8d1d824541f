"""Spelling variants: words that one inserted, deleted or replaced code point tells apart, led to their common form.

Deleting one code point turns every such pair into equal strings: a replacement leaves the same rest at the same place,
an insertion leaves the other word.  So each word of L code points gives L + 1 integer keys, made from the polynomial
hashes of its prefixes and suffixes by NumPy for all words of a length at once.  Keys are dealt by their leading bits
and sorted by Spark, which spills; equal neighbours are candidates, and only these meet their words again and are
compared as strings.  A group of equal rests is bounded by the alphabet and the length, whatever the corpus; it is never
expanded into pairs: each word takes its number of near words and the best of them from the group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrowmap import sliced
from .common import partitions, stash

#: Letters of a run, and how only A-Z are lower-cased.
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Moduli and bases of the two halves of a key; collisions cost time and change nothing.
PRIMES = (2147483647, 2147483629)
BASES = (911382323, 972663749)
#: Code points that are hashed at a time, which bounds memory also for very long words.
CHUNK = 1 << 20


def letter_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 1) -> DataFrame:
    """(id, run) for each maximal run of letters of at least min_length code points, A-Z lower-cased; repeats are kept.

    A null or empty text has no run, and a null id stays null.
    """
    runs = F.regexp_extract_all(F.col(text_col), F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))
    return docs.select(F.col(id_col).alias("id"), F.explode(runs).alias("run")).select("id", F.translate("run", UPPER, LOWER).alias("run"))


def with_slips(runs: DataFrame, every: int) -> Column:
    """The run, or for one run of `every` (by crc32 of '<id>:<run>', a null id as 'null') the run without one code point that the hash names."""
    at = F.crc32(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("null")), F.lit(":"), F.col("run")).cast("binary"))
    place = (at % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    return F.when(at % every == 0, cut).otherwise(F.col("run"))


def count_words(words: DataFrame, min_length: int, min_count: int) -> DataFrame:
    """(word, n) of the column word: distinct words of enough code points and occurrences; nulls do not count."""
    return words.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def deletion_keys(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, row, place) of words of one length L: for each of L places the key of the word without it, and the key of the whole word.

    place is -1 for the whole word, else twice the place, plus one where the code point differs from the one
    before it (of a stretch of equal code points, all of whose deletions are equal, only the first has it).
    """
    m, n = len(words), len(words[0])
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(m, n).astype(np.uint64)
    keys = np.zeros((m, n + 1), np.uint64)
    for p, b in zip(np.array(PRIMES, np.uint64), BASES, strict=True):
        prefix, suffix = np.zeros((m, n + 1), np.uint64), np.zeros((m, n + 1), np.uint64)
        powers = np.ones(n + 1, np.uint64)
        base = np.uint64(b)
        for i in range(n):
            prefix[:, i + 1] = (prefix[:, i] * base + points[:, i] + np.uint64(1)) % p
            powers[i + 1] = powers[i] * base % p
        for i in range(n - 1, -1, -1):
            suffix[:, i] = (suffix[:, i + 1] + (points[:, i] + np.uint64(1)) % p * powers[n - 1 - i]) % p
        half = np.empty((m, n + 1), np.uint64)
        half[:, :n] = (prefix[:, :n] * powers[n - 1 :: -1][None] + suffix[:, 1:]) % p
        half[:, n] = prefix[:, n]
        keys = (keys << np.uint64(32)) | half
    keys = (keys ^ (keys >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)  # spreads the leading bits
    first = np.ones((m, n), bool)
    first[:, 1:] = points[:, 1:] != points[:, :-1]
    place = np.full((m, n + 1), -1, np.int32)
    place[:, :n] = 2 * np.arange(n, dtype=np.int32)[None] + first
    return keys.view(np.int64).ravel(), np.repeat(np.arange(m), n + 1), place.ravel()


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        ids, words = batch.column(0).to_numpy(), batch.column(1).to_pylist()
        lengths = np.array([len(w) for w in words], np.int64)
        for n in np.unique(lengths):
            rows = np.flatnonzero(lengths == n)
            step = max(1, CHUNK // (int(n) + 1))
            for i in range(0, len(rows), step):
                at = rows[i : i + step]
                key, row, place = deletion_keys([words[k] for k in at])
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(ids[at][row]), pa.array(place)], names=["key", "id", "place"])


def _matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key and place those that have a partner: (id, place, whole) with whole null for a replacement's rest."""

    def partners(key: np.ndarray, ids: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
        start = np.append(True, key[1:] != key[:-1])
        group = np.cumsum(start) - 1
        slot = place >> 1
        same = ~start[1:] & (slot[1:] == slot[:-1]) & (slot[1:] >= 0)
        replaced = np.append(False, same) | np.append(same, False)
        whole = place == -1
        shorter = (place >= 0) & (place & 1 == 1)
        n = group[-1] + 1
        both = (np.bincount(group, whole, n) > 0) & (np.bincount(group, shorter, n) > 0)
        grown = (whole | shorter) & both[group]
        a, b = np.flatnonzero(replaced), np.flatnonzero(grown)
        kind = np.concatenate([np.zeros(len(a), np.int8), np.where(whole[b], 1, 2).astype(np.int8)])
        at = np.concatenate([a, b])
        return pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(slot[at]), pa.array(kind)], names=["id", "slot", "kind"])

    held: list[np.ndarray] | None = None
    for batch in sliced(batches):
        part = [batch.column(i).to_numpy() for i in range(3)]
        if held is not None:
            part = [np.concatenate(x) for x in zip(held, part, strict=True)]
        last = int(np.searchsorted(part[0], part[0][-1], "left"))  # the last key may go on in the next batch
        if last:
            yield partners(*(x[:last] for x in part))
        held = [x[last:].copy() for x in part]
    if held is not None:
        yield partners(*held)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of every row of words (id, word, n; stored, ids and words unique) that has a near word.

    best is the near word of largest n, of equal ones the smallest in code-point order.
    """
    n = partitions(words.sparkSession)
    bits = max(12, (8 * n - 1).bit_length())
    keys = words.select("id", "word").mapInArrow(_keyed, "key long, id long, place int")
    dealt = keys.repartition(n, F.shiftrightunsigned("key", 64 - bits)).sortWithinPartitions("key", "place")
    found = dealt.mapInArrow(_matched, "id long, slot int, kind byte").join(words, "id")
    rest = F.concat(F.substring("word", F.lit(1), F.col("slot")), F.substring("word", F.col("slot") + 2, F.length("word")))
    # Equal strings, not equal keys: a collision ends in a group of its own, without a partner.
    found = found.select(F.when(F.col("kind") == 1, F.col("word")).otherwise(rest).alias("rest"), F.when(F.col("kind") == 0, F.col("slot")).otherwise(-1).alias("slot"), "kind", F.struct((-F.col("n")).alias("k"), "word").alias("it"))
    groups = found.groupBy("rest", "slot").agg(
        F.sort_array(F.collect_list(F.when(F.col("kind") != 1, F.col("it")))).alias("others"), F.max(F.when(F.col("kind") == 1, F.col("it"))).alias("whole")
    )

    def row(it: Column, near: Column, best: Column) -> Column:
        return F.struct(it["word"].alias("word"), near.cast("long").alias("near"), best.alias("best"))

    others, whole = F.col("others"), F.col("whole")
    replaced = F.transform(others, lambda x: row(x, F.size(others) - 1, F.when(x == others[0], F.element_at(others, 2)).otherwise(others[0])))
    grown = F.concat(F.array(row(whole, F.size(others), others[0])), F.transform(others, lambda x: row(x, F.lit(1), whole)))
    rows = F.when(F.col("slot") >= 0, F.when(F.size(others) > 1, replaced)).otherwise(F.when(whole.isNotNull() & (F.size(others) > 0), grown))
    met = groups.select(F.explode(rows).alias("r")).select("r.*")
    best = met.groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))
    return best.select("word", "n_near", (-F.col("best.k")).alias("best_n"), F.col("best.word").alias("best"))


def follow(links: DataFrame) -> DataFrame:
    """(word, root) of links (word, form), which have no cycle: forms followed to the last one, twice as far each round."""
    ahead = stash(links.select("word", F.col("form").alias("root")))
    while True:
        further = ahead.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ahead = stash(ahead.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if not ahead.where("moved").take(1):
            return ahead.select("word", "root")
        ahead = ahead.select("word", "root")


def variant_groups(words: DataFrame, ratio: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of words (word, n; words unique).

    Two words are near if they differ by exactly one inserted, deleted or replaced code point.  The form of a word is its
    near word of largest n (ties: the smallest) if that n is at least ratio times the word's, else null; its root is where
    forms lead from it.  n_near is 0 and root the word itself where there is none.  Rows with a null word or n are left
    out; no rows give none.  ratio must be above 1, so that forms have no cycle.
    """
    if ratio <= 1:
        raise ValueError("ratio must be above 1")
    words = stash(words.where("word is not null and n is not null").select("word", F.col("n").cast("long").alias("n")).withColumn("id", F.monotonically_increasing_id()))
    near = words.join(near_words(words), "word", "left")
    chosen = F.col("best_n") >= ratio * F.col("n")
    near = stash(near.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(chosen, F.col("best")).alias("form"), F.when(chosen, F.col("best_n")).alias("form_n")))
    roots = follow(near.where("form is not null"))
    return near.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
