"""Queries over whole tables leave no row out."""

from collections import Counter

from methframe.fixtures import Fixtures
from methframe.operators import genome
from methframe.queries import QUERIES

from .test_oracles import DIR


def test_every_interval_is_joined(spark):
    x = Fixtures(spark, DIR)
    a = [tuple(r) for r in x.bed.select("chr", "start", "end").collect()]
    b = [tuple(r) for r in genome.mirror(x.bed, genome.chr_info(x.genome)).select("chr", "start", "end").collect()]
    pairs = Counter((p, q) for p in a for q in b if p[0] == q[0] and p[1] <= q[2] and p[2] >= q[1])
    got = QUERIES["interval_overlap"](spark, DIR).select("chr_a", "start_a", "end_a", "chr_b", "start_b", "end_b").collect()
    assert Counter((tuple(r)[:3], tuple(r)[3:]) for r in got) == pairs
    met = {p for p, _ in pairs}
    got = QUERIES["interval_semijoin"](spark, DIR).select("chr", "start", "end").collect()
    assert Counter(map(tuple, got)) == Counter(p for p in a if p in met)
    assert any(p[1] % 2 for p in met)


def test_whole_chromosomes_are_encoded(spark):
    want = {r["chr"]: r["seq"] for r in Fixtures(spark, DIR).genome.collect()}
    got = {r["chr"]: r["colours"] for r in QUERIES["colour_space"](spark, DIR).collect()}
    assert {c: len(v) for c, v in got.items()} == {c: len(s) + 1 for c, s in want.items()}
    for c, s in want.items():
        assert got[c] == "T" + "".join(str("ACGT".index(a) ^ "ACGT".index(b)) for a, b in zip("T" + s, s, strict=False))


def test_every_fragment_size_is_counted(spark):
    unique = QUERIES["dedup_pe"](spark, DIR).collect()
    want = Counter(r["frag_size"] for r in unique if 1 <= r["frag_size"] <= 1000)
    got = {r["size"]: r["count"] for r in QUERIES["size_dist"](spark, DIR).collect()}
    assert got == want and max(got) > 70
    assert len(QUERIES["size_axis"](spark, DIR).collect()) == 1
