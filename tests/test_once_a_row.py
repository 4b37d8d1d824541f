"""Columns that a lambda names are worked out once a row, not once an element."""

import pytest
from pyspark.sql import functions as F

from methframe.functions import reads as R
from methframe.operators import calls, merge, preprocess, simulate

WALKS = ("transform(sequence(", "filter(sequence(")


def walked(df):
    """The arguments of each walk over the places of a read in the optimized plan."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    for walk in WALKS:
        at = plan.find(walk)
        while at >= 0:
            end = begin = at + walk.index("(") + 1
            depth = 1
            while depth:
                depth += {"(": 1, ")": -1}.get(plan[end], 0)
                end += 1
            yield plan[begin : end - 1].partition("lambdafunction")[2]
            at = plan.find(walk, at + 1)


def reads(spark, columns):
    rows = spark.createDataFrame([(k, f"{k}ACGTCCGCAGATCGG", f"{k}") for k in range(3)], "read_no long, t string, u string")
    text = {c: F.expr(f"substr(repeat(md5(concat(u, '{c}')), 2), 1, 40)") if c.startswith("qual") else F.expr("substr(concat(t, t), 2, 40)") for c in columns}
    return rows.select("read_no", *[e.alias(c) for c, e in text.items()])


def trimmed(spark):
    return preprocess.trim(reads(spark, ["seq1", "qual1", "seq2", "qual2"])).select("trimmed_length", "adapter_at")


def restored(spark):
    c = preprocess.convert(reads(spark, ["seq1", "qual1", "seq2", "qual2"]), 4).selectExpr("read_no", "seq1 as seq", "qual1 as qual", "conv1 as conv", "end_qual1 as end_qual", "'W' as strand", "'3M' as cigar", "1L as pos")
    return merge.deconvert(c).select("seq")


def joined(spark):
    p = reads(spark, ["bases1", "qual1", "bases2", "qual2"]).withColumnRenamed("qual1", "quals1").withColumnRenamed("qual2", "quals2")
    return calls.fragments(p.selectExpr("*", "'chr1' as chr", "'W' as strand", "read_no as pos1", "read_no + 2 as pos2")).select("bases")


def snps(spark):
    return simulate.snps(reads(spark, ["seq"]), "seq", simulate.SimConfig(snps=3)).select("seq")


@pytest.mark.parametrize("made", [trimmed, restored, joined, snps])
def test_walks_hold_no_other_work(spark, made):
    df = made(spark)
    for body in walked(df):
        assert not any(work in body for work in ("md5(", "repeat(", "sequence(", "array_sort(", "split(")), body
    assert df.count() >= 3


def test_places_of_overlapping_patterns(spark):
    texts = ["AGAGATTAGA", "", "AG", "AGA", "TTT", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.expr(R.places_of("t", "AGA")).alias("at")).collect()
    assert {r["t"]: r["at"] for r in got} == {t: None if t is None else [k for k in range(len(t)) if t[k : k + 3] == "AGA"] for t in texts}


def test_restored_places_within_the_read(spark):
    df = spark.createDataFrame([("TTTT", [0, 2, 9, -1]), ("", [0]), ("AT", [])], "seq string, at array<int>")
    assert [r["s"] for r in df.select(R.restore("seq", "at", "C").alias("s")).collect()] == ["CTCT", "", "AT"]


def test_last_good_place_of_both_mates(spark):
    quals = [("IIII#I##", "IIIII###"), ("####", "####"), ("I", "I"), ("III", "I"), ("##II", "II##"), (None, "II"), ("", "")]
    got = [r["n"] for r in spark.createDataFrame(quals, "a string, b string").select(R.quality_trim(53, "a", "b").alias("n")).collect()]
    good = [[i for i in range(len(a or "")) if (a[i] >= "5") and b[i : i + 1] >= "5"] for a, b in quals]
    assert got == [max([i + 1 for i in g] + [1]) for g in good]
