"""Mates' places meet within a pair's row where they are few, by stretches where they are many: the same pairs either way."""

import random

import pytest

from methframe.operators import align


def _rc(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def _tables(spark):
    """A genome with a stretch that occurs 40 times, one that occurs three times, and pairs in, beside and across them."""
    r = random.Random(11)
    unit, thrice = ("".join(r.choices("ACGT", k=60)) for _ in range(2))
    parts = ["".join(r.choices("ACGT", k=150)) + (unit if k < 40 else thrice if k < 43 else "") for k in range(50)]
    seqs = {"chr1": "".join(parts[:25]), "chr2": "".join(parts[25:])}
    rows = []
    for k in range(300):
        name = r.choice(["chr1", "chr2"])
        t = seqs[name].replace("C", "T")
        a = r.randrange(0, len(t) - 250)
        b = a + r.randint(0, 150)
        if k % 5 == 0:  # both mates in the stretch that occurs often
            a = b = seqs[name].find(unit) + r.randint(0, 5)
        one, two = t[a : a + 45], t[b : b + 50]
        if k % 3 == 0:
            two = two[:20] + ("A" if two[20] != "A" else "G") + two[21:]
        rows.append((k, one if k % 41 else None, "I" * len(one), _rc(two), "#" * len(two)))
    rows += [(1000 + k, *x[1:]) for k, x in enumerate(rows[:50])]
    rows += [(2000, "ACGT", "IIII", "ACGT", "IIII"), (2001, rows[1][1], "I" * 45, _rc("".join(r.choices("AGT", k=50))), "I" * 50)]
    genome = spark.createDataFrame(list(seqs.items()), "chr string, seq string")
    return spark.createDataFrame(rows, "read_no long, seq1 string, qual1 string, seq2 string, qual2 string"), genome


@pytest.mark.parametrize("max_places, every_place", [(64, False), (8, False), (64, True)])
def test_the_same_pairs_either_way(spark, monkeypatch, max_places, every_place):
    pairs, genome = _tables(spark)
    got = {}
    for wide, listed in ((16, 100_000), (16, 0), (0, 100_000), (2, 100_000), (100, 100_000)):
        monkeypatch.setattr(align, "WIDE", wide)
        monkeypatch.setattr(align, "LISTED", listed)
        found = align.align_pairs(pairs, genome, "W", 0, 300, max_places=max_places, every_place=every_place)
        got[wide, listed] = sorted(map(tuple, found.collect()))
        names = found.columns
    assert len(got[16, 100_000]) > 250 and len({str(x) for x in got.values()}) == 1
    quality = {x[names.index("mapq")] for x in got[16, 100_000]}
    assert {1, 42} <= quality


def test_pairs_of_few_places_are_not_shuffled(spark):
    r = random.Random(12)
    seq = "".join(r.choices("ACGT", k=3000))
    t = seq.replace("C", "T")
    genome = spark.createDataFrame([("chr1", seq)], "chr string, seq string")
    rows = [(k, t[k : k + 40], "I" * 40, _rc(t[k + 30 : k + 70]), "I" * 40) for k in range(500)]
    found = align.align_pairs(spark.createDataFrame(rows, "read_no long, seq1 string, qual1 string, seq2 string, qual2 string"), genome, "W")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
    assert sorted((x["read_no"], x["pos1"], x["pos2"], x["mapq"]) for x in found.collect()) == [(k, k + 1, k + 31, 42) for k in range(500)]
