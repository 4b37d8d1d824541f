import collections
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from methframe.llm.queries import QUERIES
from methframe.llm.spelling import count_words, deletion_keys, follow, letter_runs, variant_groups, with_slips

from .conftest import DIR, SCHEMA

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans({chr(k): chr(k + 32) for k in range(65, 91)})


def brute_words(data, min_length=7, min_count=2):
    seen = collections.Counter()
    for doc_id, text in data:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= min_length and n >= min_count}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) >= len(b)) :] == b[i + (len(b) >= len(a)) :]


def brute_groups(count, ratio=10):
    out = {}
    words = sorted(count)
    for w in words:
        around = [v for v in words if near(w, v)]
        best = min(around, key=lambda v: (-count[v], v), default=None)
        form = best if best is not None and count[best] >= ratio * count[w] else None
        out[w] = [form, None, count[w], len(around), count[form] if form else None]
    for w in words:
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        out[w][1] = root
    return {(w, *v) for w, v in out.items()}


def rows(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_groups_against_brute_force(spark):
    r = random.Random(5)
    count = {}
    for base in ["aaaaaaa", "abababab", "banana", "ÀÿÀÿÀÿÀ", "mississippi"]:
        for _ in range(120):
            w = list(base)
            for _ in range(r.randint(0, 3)):
                k = r.randrange(len(w))
                what = r.randint(0, 2)
                if what == 0:
                    w[k : k + 1] = []
                elif what == 1:
                    w[k] = r.choice("abinsÀÿ")
                else:
                    w.insert(k, r.choice("abinsÀÿ"))
            count["".join(w)] = r.choice([2, 3, 20, 20, 200, 2000, 20000])
    count |= {"x": 5, "y": 70, "xy": 900, "": 1, "\U0001f600a": 4, "\U0001f600": 90}
    df = spark.createDataFrame(list(count.items()), "word string, n long").repartition(3)
    assert rows(variant_groups(df)) == brute_groups(count)
    assert rows(variant_groups(df, 2)) == brute_groups(count, 2)


def test_chains_end_at_their_root(spark):
    links = [(f"w{k}", f"w{k + 1}") for k in range(37)]
    got = dict(map(tuple, follow(spark.createDataFrame(links, "word string, form string")).collect()))
    assert got == {f"w{k}": "w37" for k in range(37)}


def test_long_words_and_nulls(spark):
    long_ = "ab" * 40_000
    data = [(long_, 5), (long_[:-1], 70), ("c" + long_[1:], 2), (None, 5), ("short", None), ("short", 4)]
    got = rows(variant_groups(spark.createDataFrame(data, "word string, n long")))
    want = brute_groups({w: n for w, n in data if w is not None and n is not None})
    assert got == want and len(got) == 4


def test_keys_are_those_of_the_rest():
    words = ["abcab", "aabbc", "ccccc"]
    key, row, place = deletion_keys(words)
    by = collections.defaultdict(set)
    for k, r, p in zip(key, row, place, strict=True):
        w = words[r]
        by[w if p < 0 else w[: p >> 1] + w[(p >> 1) + 1 :]].add(k)
    assert all(len(v) == 1 for v in by.values()) and len(set.union(*by.values())) == len(by)
    assert by["bcab"] == {deletion_keys(["bcab"])[0][-1]}
    firsts = collections.Counter(r for r, p in zip(row, place, strict=True) if p >= 0 and p & 1)
    assert firsts == {0: 5, 1: 3, 2: 1} and key.dtype == np.int64


def test_runs_slips_and_counts(docs, empty):
    data = [(r["doc_id"], r["text"]) for r in docs.collect()]
    runs = letter_runs(docs)
    words = runs.select(with_slips(runs, 31).alias("word"))
    for low, least in ((1, 1), (3, 2), (7, 2)):
        got = dict(map(tuple, count_words(words, low, least).collect()))
        assert got == brute_words(data, low, least)
    assert rows(variant_groups(count_words(words, 3, 2), 2)) == brute_groups(brute_words(data, 3, 2), 2)
    assert letter_runs(empty).count() == 0
    assert variant_groups(count_words(letter_runs(empty).select(F.col("run").alias("word")), 7, 2)).count() == 0


@pytest.mark.parametrize("copies", [1, 12])
def test_query_equals_brute_force(spark, tmp_path, copies):
    data = [(k * 1000 + r["doc_id"], r["text"]) for k in range(copies) for r in spark.read.parquet(f"{DIR}/documents.parquet").limit(60 if copies > 1 else 200).collect()]
    data += [(None, "Straße Straße über übers überss UEBERSS überss"), (5, None), (6, "")]
    spark.createDataFrame([(a, b, None, None, None) for a, b in data], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = rows(QUERIES["op11_spelling_variants"](spark, str(tmp_path)))
    count = brute_words(data)
    by_length = collections.defaultdict(list)
    for w in count:
        by_length[len(w)].append(w)
    assert {g[0]: g[3] for g in got} == count
    r = random.Random(3)
    want = {w: sum(near(w, v) for k in (-1, 0, 1) for v in by_length[len(w) + k]) for w in r.sample(sorted(count), min(300, len(count)))}
    assert {g[0]: g[4] for g in got if g[0] in want} == want
    if copies > 1:
        assert any(g[1] for g in got)
