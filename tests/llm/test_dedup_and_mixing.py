import collections
import hashlib
import math
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from methframe.llm import exact_dedup as exact_dedup_module
from methframe.llm import mixing
from methframe.llm.exact_dedup import drop_copies, exact_dedup
from methframe.llm.jaccard_join import LocalJoin, jaccard_join, keep_one_of_each
from methframe.llm.mixing import mix_sources, source_rates
from methframe.llm.oracles import ORACLES
from methframe.llm.queries import QUERIES
from methframe.llm.substring_dedup import substring_dedup

from .conftest import DIR, rows

SPACE = re.compile(r"[\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(k): chr(k + 32) for k in range(65, 91)})


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def counted(items):
    return collections.Counter(items)


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup(docs, weak):
    groups = collections.defaultdict(list)
    data = rows()
    for r in data:
        groups[SPACE.sub(" ", r[1] or "")].append(r[0])
    want = []
    for r in data:
        t = SPACE.sub(" ", r[1] or "")
        known = [i for i in groups[t] if i is not None]
        keep = min(known) if known else None
        want.append((r[0], keep, len(groups[t]), r[0] is not None and r[0] == keep, hashlib.sha256(t.encode()).hexdigest()))
    # A digest of four values, so that different texts collide.
    options = {"digest": lambda c: F.translate(F.substring(F.sha2(c.cast("binary"), 256), 1, 1), "456789abcdef", "012301230123")} if weak else {}
    got = exact_dedup(docs, salts=3, **options)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert counted(map(tuple, got.collect())) == counted(want)


def test_drop_copies(docs, empty):
    kept = drop_copies(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 3 not in ids and {1, 2, 4, 6, 7, 9} <= set(ids) and 5 not in ids and 8 not in ids
    assert drop_copies(empty).count() == 0 and exact_dedup(empty).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.execute(f"create view {t} as select * from read_parquet('{DIR}/{t}.parquet')")
    df = QUERIES[name](spark, DIR)
    columns = sorted(df.columns)
    result = c.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    want = [tuple(r[names.index(k)] for k in columns) for r in result.fetchall()]
    assert counted(map(tuple, df.select(*columns).collect())) == counted(want)


def test_mixing(docs, empty):
    out = mix_sources(docs)
    assert set(out.columns) == set(docs.columns)
    data = out.collect()
    assert {r["source"] for r in data} <= {"a", "b", "c", "d", None}
    keys = collections.defaultdict(set)
    for r in data:
        keys[r["doc_id"], r["text"]].add(r["replica"])
    assert all(v == set(range(1, len(v) + 1)) for v in keys.values())
    again = mix_sources(docs.repartition(2))
    assert counted((r["doc_id"], r["replica"], r["order_key"]) for r in data) == counted((r["doc_id"], r["replica"], r["order_key"]) for r in again.collect())
    assert mix_sources(empty).count() == 0
    assert mix_sources(docs, weights={}).count() == 0


def test_mixing_meets_weights(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x" * 10).alias("text"), F.when(F.col("id") % 10 < 9, "big").otherwise("small").alias("source"))
    rates = {r["name"]: r["rate"] for r in source_rates(df, "source", "text", {"big": 1, "small": 3}, 2.0).collect()}
    assert rates == pytest.approx({"big": 0.25 * 2 / 0.9, "small": 0.75 * 2 / 0.1})
    n = {r["source"]: r["count"] for r in mix_sources(df, {"big": 1, "small": 3}, epochs=2.0).groupBy("source").count().collect()}
    assert n["small"] / (n["small"] + n["big"]) == pytest.approx(0.75, abs=0.01) and n["small"] + n["big"] == pytest.approx(40_000, rel=0.02)


def inverted(rate, key, seed=17):
    """Numbers of copies by inversion, part by part, in plain Python."""
    parts = math.ceil(rate / 32)
    mean, out = rate / parts, []
    for k in range(parts):
        u = int(hashlib.md5(f"{seed}:{key}{f':{k}' if k else ''}".encode()).hexdigest()[:13], 16) / 2**52
        n, p = 0, math.exp(-mean)
        total = p
        while total <= u:
            n += 1
            p *= mean / n
            total += p
        out += [256 * k + j + 1 for j in range(n)]
    return out


@pytest.mark.parametrize("sources", [4096, 1])
def test_mixing_of_any_mean(spark, monkeypatch, sources):
    """Means from below one to many thousands, null and repeated ids; few tables are broadcast, of more only those of hot sources."""
    monkeypatch.setattr(mixing, "SOURCES", sources)
    monkeypatch.setattr(mixing, "HOT_SHARE", 3)
    data = [(k, "x" * 100, "big") for k in range(300)] + [(900, "y", "tiny"), (901, "yy" * 5, "small"), (901, "yy" * 5, "small"), (None, "zz", None), (None, None, "big"), (903, "", "empty")]
    df = spark.createDataFrame(data, "doc_id long, text string, source string").repartition(3)
    weights = {"big": 1.0, "tiny": 2.0, "small": 0.05, "": 0.5, "empty": 1.0}
    rates = {r["name"]: r["rate"] for r in source_rates(df, "source", "text", weights, 1.0).collect()}
    assert rates["tiny"] > 10_000 and rates["big"] < 1
    want = counted((i, t, k) for i, t, s in data if rates[s or ""] > 0 for k in inverted(rates[s or ""], "null" if i is None else i))
    assert counted((r["doc_id"], r["text"], r["replica"]) for r in mix_sources(df, weights).collect()) == want


def test_mixing_sql_on_null_and_repeated_ids(spark, tmp_path):
    df = spark.createDataFrame([(k % 40 if k % 7 else None, "word " * (k % 13), "en", ["a", "b", None][k % 3], k) for k in range(120)] + [(500, "z", "en", "lone", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    c = duckdb.connect()
    c.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    got = QUERIES["op2_mix_sources"](spark, str(tmp_path))
    assert counted(map(tuple, got.select("doc_id", "text", "lang", "source", "n_chars", "replica", "order_key").collect())) == counted(c.execute(ORACLES["op2_mix_sources"]).fetchall())


def without_repeats(data, size):
    """Removed words by the definition: starts in a smaller id, or earlier in the same document."""
    first = {}
    for i, t in data:
        w = words(t)
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            if i is not None and (key not in first or (i, k) < first[key]):
                first[key] = (i, k)
    out = []
    for i, t in data:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if i is not None and first[tuple(w[k : k + size])] < (i, k):
                gone[k : k + size] = [True] * size
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


@pytest.mark.parametrize("size, base", [(20, 10), (8, 2), (4, 4), (1, 1)])
def test_substring_dedup(docs, size, base):
    want = without_repeats([(r[0], r[1]) for r in rows()], size)
    got = substring_dedup(docs, min_words=size, base=base, bits=1 << 20)
    assert counted(map(tuple, got.collect())) == counted(want)


def test_substring_dedup_sample(sample, empty):
    want = without_repeats([(r["doc_id"], r["text"]) for r in sample.collect()], 20)
    assert counted(map(tuple, substring_dedup(sample).collect())) == counted(want)
    assert sum(r[2] for r in want) > 0
    assert substring_dedup(empty).count() == 0
    with pytest.raises(ValueError):
        substring_dedup(empty, min_words=15, base=10)


def linked(data, percent=75):
    """Smallest ids of components by comparing all pairs."""
    sets = []
    for i, t in data:
        w = words((t or "").translate(LOWER))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    parent = list(range(len(data)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(data)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and data[a][0] is not None and data[b][0] is not None and 100 * len(x & y) >= percent * len(x | y):
                parent[root(a)] = root(b)
    low = {}
    for k, (i, _) in enumerate(data):
        if i is not None:
            low[root(k)] = min(i, low.get(root(k), i))
    return [(i, len(sets[k]), low[root(k)] if i is not None else None) for k, (i, _) in enumerate(data)]


@pytest.mark.parametrize("group", [512, 2])
def test_jaccard_join(docs, group):
    want = linked([(r[0], r[1]) for r in rows()])
    got = jaccard_join(docs, group=group, bits=1 << 20)
    assert counted(map(tuple, got.collect())) == counted(want)


def test_jaccard_join_random(spark):
    """Many sets around the threshold, with equal sizes and ties, and sets of very different sizes."""
    import random

    r = random.Random(4)
    base = [[f"w{r.randint(0, 400)}" for _ in range(n)] for n in (30, 60, 90, 45)]
    data = []
    for k in range(160):
        w = list(r.choice(base))
        for _ in range(r.randint(0, 4)):
            at = r.randrange(len(w))
            if r.random() < 0.5:
                w[at] = f"v{r.randint(0, 50)}"
            else:
                del w[at : at + r.randint(1, 6)]
        data.append((1000 - k, " ".join(w)))
    want = linked(data)
    assert len({c for _, _, c in want}) > 8
    df = spark.createDataFrame(data, "doc_id long, text string")
    for group in (512, 5):
        assert counted(map(tuple, jaccard_join(df, group=group, bits=1 << 20).collect())) == counted(want)


def test_keep_one(docs, empty):
    kept = keep_one_of_each(docs, bits=1 << 20)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert 100 in ids and not ids & set(range(101, 108)) and {4, 5, 6, None} <= ids
    assert jaccard_join(empty, bits=1 << 20).count() == 0


def test_local_join_agrees_with_all_pairs():
    import numpy as np

    r = np.random.default_rng(3)
    pool = np.sort(r.integers(0, 1 << 60, 500, dtype=np.uint64))
    sets = []
    for _ in range(120):
        start = int(r.integers(0, 8)) * 40
        s = pool[start : start + int(r.integers(20, 60))]
        sets.append(s[r.random(len(s)) < r.choice([0.9, 0.97, 1.0])])
    sets = [s for s in sets if len(s)]
    sizes = np.array([len(s) for s in sets])
    got = LocalJoin(sets, sizes, 75).components()
    parent = list(range(len(sets)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            o = len(set(sets[a].tolist()) & set(sets[b].tolist()))
            if 175 * o >= 75 * (len(sets[a]) + len(sets[b])):
                parent[root(a)] = root(b)
    groups = collections.defaultdict(set)
    for k in range(len(sets)):
        groups[root(k)].add(int(got[k]))
    assert all(len(v) == 1 for v in groups.values()) and len({int(x) for x in got}) == len(groups)


def test_exact_dedup_spreads_hot_texts(spark):
    """Half of all rows hold one text: each exchange deals its rows by salt, whatever may be broadcast."""
    data = [(k, "the same text" if k % 2 else f"text {k}") for k in range(4000)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows_ = exact_dedup_module._routed(df, "doc_id", "text", 64, exact_dedup_module.sha256)
        plan = rows_.groupBy("digest", "salt", "content").agg(F.min("doc_id"))._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"hashpartitioning\(digest#\d+, salt#\d+, content#\d+", plan) and plan.count("HashAggregate") >= 2
        salted, _ = exact_dedup_module._winners(rows_)
        assert salted.count() == 2000 + 64  # a hot text is one row per salt in the global step
        out = exact_dedup(df)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"hashpartitioning\(salt#\d+, digest#\d+", plan) and "Broadcast" not in plan
        most = rows_.groupBy("salt", "digest").count().agg(F.max("count")).first()[0]
        assert most <= 3 * 2000 / 64  # rows of one key on the way back
        assert out.where("kept").count() == 2001 and {r["group_size"] for r in out.collect()} == {1, 2000}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
