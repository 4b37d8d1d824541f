"""Mates from SAM rows in any order, mate fields, and the total order of tables."""

import random

from pyspark.sql import functions as F

from methframe import schemas as S
from methframe.fixtures import Fixtures
from methframe.operators import merge, ordering
from methframe.plans.pipeline import Conf, Pipeline
from methframe.sources import text

DIR = "/root/testdata/sf0.001"


def row(name, flag, chr_="chr1", pos=10, mapq=30, seq="ACGT"):
    return (name, flag, chr_, pos, mapq, f"{len(seq)}M", "*", 0, 0, seq, "I" * len(seq), ["AS:i:-1", "XG:Z:CT" if flag & 16 == 0 else "XG:Z:GA"])


def test_link_mates(spark):
    rows = [
        row("a/1", 99), row("a/2", 147, pos=40), row("b", 147, pos=7), row("b", 99, pos=3), row("b", 99 | 256, pos=99), row("b", 99 | 2048, pos=98),
        row("lone", 99), row("far", 99), row("far", 147, "chr2"), row("twice", 99), row("twice", 99, pos=11), row("twice", 147), row("single", 0), row("gone", 77, "*", 0), row("half", 73), row("half", 133, "*", 0), (None, 99, *row("x", 0)[2:]),
    ]
    df = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), S.SAM).repartition(3)
    pairs, orphans = merge.link_mates(df, text.strand_of())
    got = {r["name"]: (r["chr"], r["strand"], r["mapq"], r["pos1"], r["pos2"], r["seq1"], r["tags2"]) for r in pairs.collect()}
    assert got == {"a": ("chr1", "W", 30, 10, 40, "ACGT", ["AS:i:-1", "XG:Z:GA"]), "b": ("chr1", "W", 30, 3, 7, "ACGT", ["AS:i:-1", "XG:Z:GA"])}
    found = sorted((r["qname"] or "", r["flag"], r["pos"], r["missing"]) for r in orphans.collect())
    assert found == sorted([("lone", 99, 10, "mate"), ("far", 99, 10, "chromosome"), ("far", 147, 10, "chromosome"), ("twice", 99, 10, "repeated"), ("twice", 99, 11, "repeated"), ("twice", 147, 10, "repeated"), ("single", 0, 10, "single"), ("half", 73, 10, "mate"), ("", 99, 10, "mate")])
    fixed = {(r["qname"], r["flag"]): (r["rnext"], r["pnext"], r["tlen"]) for r in merge.fix_mates(df, text.strand_of()).collect()}
    assert fixed["b", 99] == ("=", 7, 8) and fixed["b", 147] == ("=", 3, -8) and fixed["lone", 99] == ("*", 0, 0)
    assert pairs.limit(0).count() == merge.link_mates(df.limit(0), text.strand_of())[0].count() == 0


def test_paired_sam_runs_through_the_pipeline(spark, tmp_path):
    """Pairs as SAM text in any order give the tables that the pairs give."""
    x = Fixtures(spark, DIR)
    lines = merge.to_sam(x.pairs).orderBy(F.md5("value"))
    lines.write.text(str(tmp_path / "sam"))
    p = Pipeline(spark, Conf())
    linked, orphans = p.from_sam(text.sam(spark, str(tmp_path / "sam")))
    assert orphans.count() == 0
    got, want = p.run(linked, x.genome), p.run(x.pairs, x.genome)
    for name in ("calls", "chr_log", "dedup_log", "sizes", "mbias_1", "mbias_2", "totals"):
        columns = sorted(want[name].columns)
        assert sorted(map(repr, got[name].select(*columns).collect())) == sorted(map(repr, want[name].select(*columns).collect())), name


def test_numbers_follow_the_order(spark):
    r = random.Random(2)
    rows = [(r.choice("abc"), r.randint(0, 50), k) for k in range(3000)]
    df = spark.createDataFrame(rows, "chr string, pos long, id long").repartition(7)
    got = sorted(map(tuple, ordering.numbered(df, "chr", "pos", "id", start=1).select("n", "chr", "pos", "id").collect()))
    assert got == [(k, *x) for k, x in enumerate(sorted(rows), 1)]
    assert ordering.numbered(df.limit(0), "chr").count() == 0
    a = ordering.numbered(df, "chr", "pos", "id")
    same = ordering.digest(a, "n", "chr", "pos", "id").first()
    swapped = ordering.digest(a.withColumn("n", F.when(F.col("n") == 5, 6).when(F.col("n") == 6, 5).otherwise(F.col("n"))), "n", "chr", "pos", "id").first()
    assert same["rows"] == swapped["rows"] == 3000 and same["digest"] != swapped["digest"]


def test_hot_keys_are_one_range_at_most(spark):
    df = spark.range(10_000).withColumn("k", F.when(F.col("id") < 9000, 1).otherwise(F.col("id")))
    got = ordering.numbered(df, "k", "id").agg(F.count_distinct("n"), F.min("n"), F.max("n")).first()
    assert tuple(got) == (10_000, 0, 9_999)
