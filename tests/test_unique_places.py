"""The log of duplicates counts places; it moves no qualities and joins no rows to their winners."""

from pyspark.sql import functions as F

from methframe.fixtures import Fixtures
from methframe.operators import dedup, genome
from methframe.queries import QUERIES

DIR = "/root/testdata/sf0.001"


def test_as_many_places_as_unique_pairs(spark):
    x = Fixtures(spark, DIR)
    many = x.pairs.unionByName(x.pairs.withColumn("read_no", F.col("read_no") + 5000))
    info = genome.chr_info(x.genome)
    assert dedup.unique_places(many, info).count() == dedup.dedup_pairs(many, info).count() == dedup.unique_places(x.pairs, info).count() < many.count() / 2 + 1


def test_log_reads_no_qualities(spark):
    plan = QUERIES["dedup_log"](spark, DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "md5(" not in plan and "LeftSemi, (read_no" not in plan
