"""The suffix array is the sorted order of suffixes, and any pattern's places are those that a scan finds."""

import random

import pytest

from methframe.operators import suffixes


def genomes():
    r = random.Random(1)
    unit = "".join(r.choices("AGT", k=14))
    a = "".join(r.choices("AGT", k=200)) + unit * 3 + "T" * 24 + "".join(r.choices("AGTN", k=60)) + unit
    return {"chr1": a, "chr2": a[100:126] + unit, "chr3": "GA", "chr10": unit}


@pytest.fixture(scope="module")
def index(spark):
    frame = spark.createDataFrame(list(genomes().items()), "chr string, seq string")
    return suffixes.build(frame, 8)


def test_order_of_suffixes(index):
    rows = sorted((x["rank"], x["chr"], x["pos"]) for x in index.suffixes.collect())
    g = genomes()
    want = sorted((g[c][p:] + " ", c, p + 1) for c in g for p in range(len(g[c]) + 1))
    assert [(c, p) for _, c, p in rows] == [(c, p) for _, c, p in want] and [n for n, _, _ in rows] == list(range(len(want)))


def test_places_of_patterns(spark, index):
    g, r = genomes(), random.Random(2)
    patterns = ["A", "T", "TTTT", "T" * 15, "C", "GCA", "N", "GA", g["chr3"], g["chr10"], "X"]
    for _ in range(30):
        c = r.choice(["chr1", "chr2"])
        at = r.randrange(0, 30)
        patterns.append(g[c][at : at + r.choice([1, 3, 7, 8, 9, 14])])
    patterns = sorted(set(patterns))
    df = spark.createDataFrame([(k, p) for k, p in enumerate([*patterns, "", None])], "id long, pattern string")
    found = suffixes.ranges(index, df)
    got = {x["id"]: x["hi"] - x["lo"] for x in found.collect()}
    want = {k: sorted((c, i + 1) for c, s in g.items() for i in range(len(s)) if s.startswith(p, i)) for k, p in enumerate(patterns)}
    assert got == {k: len(v) for k, v in want.items()}
    where: dict = {}
    for x in suffixes.places(index, found).collect():
        where.setdefault(x["id"], []).append((x["chr"], x["pos"]))
    assert {k: sorted(v) for k, v in where.items()} == {k: v for k, v in want.items() if v}
    few = suffixes.places(index, found, 3).groupBy("id").count().collect()
    assert {x["id"]: x["count"] for x in few} == {k: min(3, len(v)) for k, v in want.items() if v}
