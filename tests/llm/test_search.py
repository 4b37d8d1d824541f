import collections
import math
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from methframe.llm import lexical_search, nearest
from methframe.llm.oracles import ORACLES
from methframe.llm.queries import QUERIES

from .conftest import DIR

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(k): chr(k + 32) for k in range(65, 91)})


def terms(text):
    return [w.translate(LOWER) for w in TERM.findall(text or "")]


def brute_scores(docs, items):
    """[(item_id, doc_id, score)] of every pair with a score, an item once for each of its rows."""
    bags = [(i, collections.Counter(terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = collections.Counter(w for _, b in bags for w in b)
    out = []
    for item_id, text in items:
        scores = []
        for i, b in bags:
            m = 100 - 75 + (75 * sum(b.values()) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((1000000000 * b[w]) // (1000 * b[w] + 8 * m)) for w in terms(text) if b[w])
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item_id, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scores)[:10], 1)]
    return out


def same(df, want):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    assert collections.Counter(map(tuple, df.collect())) == collections.Counter(want)


def test_terms_of_texts():
    texts = ["One two-THREE", None, "", "x", "yÄ漢 \x7fz", "é", "_a[b", " "]
    for part in (slice(0, 8), slice(2, 6), slice(4, 8), slice(7, 8)):
        arr = pa.array(texts, pa.string())[part]
        words, doc = lexical_search.tokens(arr)
        assert list(zip([w.decode() for w in words.to_pylist()], doc.tolist(), strict=True)) == [(w, k) for k, t in enumerate(texts[part]) for w in terms(t)]


def test_search_on_nulls_ties_and_repeats(spark, docs, empty):
    data = [(r["doc_id"], r["text"]) for r in docs.collect()]
    items = [(1, "red green Blue"), (1, "dog"), (2, None), (3, "..."), (None, "one ONE two absent"), (4, data[14][1]), (5, "a"), (5, "a"), (6, " ".join(t or "" for _, t in data))]
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("score", F.lit("clash"))
    index = lexical_search.build(docs)
    want = brute_scores(data, [x for x in items if x[1] is not None])
    same(lexical_search.search(index, table), want)
    assert lexical_search.search(lexical_search.build(empty), table).count() == 0
    assert lexical_search.search(index, table.limit(0)).count() == 0


def test_blocks_shards_and_batches(spark, monkeypatch):
    """Small blocks, many shards, one node at a time, and hot terms: the same answers."""
    r = random.Random(1)
    words = [f"w{k}" for k in range(60)]
    data = [(1000 - k // 2, " ".join(r.choice(words[: r.choice([3, 20, 60])]) for _ in range(r.choice([1, 5, 40])))) for k in range(700)]
    items = [(k, " ".join(r.choice(words) for _ in range(r.randint(1, 12)))) for k in range(25)]
    want = brute_scores(data, items)
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(7)
    table = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(lexical_search, "ITEMS", 7)
    same(lexical_search.search(lexical_search.build(docs), table), want)


@pytest.mark.parametrize("opened", [1, 32])
def test_tree_drops_nodes_and_stays_exact(opened, monkeypatch):
    monkeypatch.setattr(lexical_search, "OPENED", opened)
    monkeypatch.setattr(lexical_search, "MOST_OPENED", opened)
    r = random.Random(2)
    words = [f"w{k}" for k in range(400)]
    data = [" ".join(words[min(399, int(r.expovariate(0.02)))] for _ in range(30)) for _ in range(3000)]
    data[1234] = " ".join(words[300:330])
    n_terms = sum(len(t.split()) for t in data)
    row = lexical_search.make_shard(pa.array(range(3000), pa.int64()), pa.array(data), 3000, n_terms)
    shard = lexical_search.Shard(row)
    words_of, starts = lexical_search.shard_terms(row)
    place = {w.decode(): k for k, w in enumerate(words_of.to_pylist())}
    read = []
    monkeypatch.setattr(shard, "impacts", Counted(shard.impacts, read))
    at = np.array([place[w] for w in words[300:330]])
    scores, docs = shard.top(starts[at], starts[at + 1], np.full(len(at), 5), 10, 1)
    want = [(d, s) for _, _, d, s in brute_weighted(data, words[300:330], n_terms)]
    assert list(zip(docs.tolist(), scores.tolist(), strict=True)) == want and docs[0] == 1234
    postings = int((starts[at + 1] - starts[at]).sum())
    assert sum(read) < postings * shard.levels  # whole stretches were never opened
    # a floor from other shards leaves what reaches it, ties included
    scores, docs = shard.top(starts[at], starts[at + 1], np.full(len(at), 5), 10, want[3][1])
    assert list(zip(docs.tolist(), scores.tolist(), strict=True)) == [x for x in want if x[1] >= want[3][1]]


class Counted:
    def __init__(self, array, read):
        self.array, self.read = array, read

    def __getitem__(self, at):
        self.read.append(np.size(at))
        return self.array[at]


def brute_weighted(data, query, n_terms):
    out = []
    for d, t in enumerate(data):
        b = collections.Counter(t.split())
        m = 25 + 75 * sum(b.values()) * len(data) // n_terms
        s = sum(5 * (1000000000 * b[w] // (1000 * b[w] + 8 * m)) for w in query if b[w])
        if s:
            out.append((-s, d, d, s))
    return sorted(out)[:10]


def test_search_query_equals_brute_force_and_sql(spark, sample):
    data = [(r["doc_id"], r["text"]) for r in sample.collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").select("item_id", "text").collect()]
    want = brute_scores(data, items)
    same(QUERIES["op12_lexical_search"](spark, DIR), want)
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.execute(f"create view {t} as select * from read_parquet('{DIR}/{t}.parquet')")
    assert collections.Counter(c.execute(f"select item_id, rank, doc_id, score from ({ORACLES['op12_lexical_search']})").fetchall()) == collections.Counter(want)


def brute_nearest(vectors, k=5):
    ids = np.array([i for i, _ in vectors])
    x = np.array([v for _, v in vectors], float)
    u = x / np.sqrt((x * x).sum(1))[:, None]
    out = {}
    for q in np.flatnonzero(ids % 50 == 0):
        s = u @ u[q]
        near = sorted((-round(s[j], 12), ids[j]) for j in range(len(ids)) if ids[j] != ids[q])[:k]
        out[ids[q]] = [i for _, i in near]
    return out


def answers(df):
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    out = collections.defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out[r["query_id"]].append(r["vec_id"])
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_pairs_come_in_order():
    r = np.random.default_rng(0)
    a, b = r.random(7), r.random(9)
    got = list(nearest.pairs_in_order(a, b))
    assert [s for s, _, _ in got] == sorted(s for s, _, _ in got) and {(i, j) for _, i, j in got} == {(i, j) for i in range(7) for j in range(9)}
    assert all(abs(s - a[i] - b[j]) < 1e-12 for s, i, j in got)


def test_nearest_on_odd_vectors(spark):
    nan, inf = math.nan, math.inf
    rows = [(50, [1.0, 0.0, 0.0]), (1, [2.0, 0.1, 0.0]), (2, [2.0, 0.1, 0.0]), (3, [-1.0, 0.0, 0.0]), (4, None), (5, []), (6, [0.0, 0.0, 0.0]), (7, [1.0, None, 0.0]), (8, [nan, 1.0, 1.0]), (9, [inf, 1.0, 1.0]), (None, [1.0, 0.0, 0.0])]
    rows += [(10, [1.0, 1.0]), (100, [1e300, 1e300]), (150, [1e-300, 2e-300]), (200, None), (250, [5.0]), (11, [0.0, 1.0, 0.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string").repartition(2)
    got = answers(nearest.nearest(df, df.where("vec_id % 50 = 0")))
    assert got == {50: [1, 2, 11, 3], 100: [10, 150], 150: [10, 100]}
    few = answers(nearest.nearest(df, df.where("vec_id % 50 = 0"), k=1))
    assert few == {50: [1], 100: [10], 150: [10]}
    assert nearest.nearest(df.limit(0), df).count() == 0 and nearest.nearest(df, df.limit(0)).count() == 0


@pytest.mark.parametrize("kind", ["noise", "groups", "copies"])
def test_recall_where_cells_are_left_out(spark, monkeypatch, kind):
    """A first answer from few cells, hot cells in pieces, queries in blocks, a sample smaller than the table."""
    r = np.random.default_rng(4)
    n = 6000
    x = r.normal(size=(n, 24))
    if kind != "noise":
        x = r.normal(size=(40, 24))[r.integers(0, 40, n)] + 0.3 * x
    if kind == "copies":
        x[: n // 3] = x[0]  # a third of all rows are one vector
    vectors = [(int(i), v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    for name, value in (("FIRST", 60), ("PIECE", 200), ("BLOCK", 16), ("SAMPLE", 1500)):
        monkeypatch.setattr(nearest, name, value)
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").repartition(3)
    got, want = answers(nearest.nearest(df, df.where("vec_id % 50 = 0"))), brute_nearest([(i, np.float32(v)) for i, v in vectors])
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    recall = np.mean([len(set(got[q]) & set(want[q])) / 5 for q in want])
    assert recall >= 0.95, recall
    if kind == "copies":
        assert got[0] == [1, 2, 3, 4, 5]


def test_nearest_query_equals_brute_force(spark):
    data = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{DIR}/embeddings.parquet").collect()]
    df = QUERIES["op13_nearest"](spark, DIR)
    assert answers(df) == brute_nearest(data)
    by = {i: np.array(v, float) for i, v in data}
    for r in df.collect():
        a, b = by[r["query_id"]], by[r["vec_id"]]
        assert abs(r["score"] - a @ b / math.sqrt((a @ a) * (b @ b))) < 1e-12


def test_recall_on_a_larger_table(spark):
    at = "/root/testdata/sf0.1"
    data = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{at}/embeddings.parquet").collect()]
    got, want = answers(QUERIES["op13_nearest"](spark, at)), brute_nearest(data)
    assert np.mean([len(set(got[q]) & set(want[q])) / 5 for q in want]) >= 0.95
