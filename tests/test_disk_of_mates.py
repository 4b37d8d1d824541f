"""What linking mates moves and leaves on disk."""

import re
import time

from pyspark.sql import functions as F

from methframe import queries
from methframe.operators import merge
from methframe.sources import text


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_")}


def test_bases_move_once_and_what_nobody_asks_for_stays(spark, tmp_path):
    (tmp_path / "x.sam").write_text("")
    pairs, orphans = merge.link_mates(text.sam(spark, str(tmp_path / "x.sam")), text.strand_of())
    plan = pairs.select("name", "pos1", "seq1", "qual1", "seq2", "qual2")._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning") :].split("\n")[1]
    moved = re.findall(r"(\w+)#\d+L?(?=[,\]])", re.sub(r"CASE .*? END|\w+\([^()]*\)", "", below))
    assert sorted(set(moved) - {"_strand"}) == ["_apart", "_mate", "_name", "chr", "pos", "qual", "seq"] and len(moved) == len(set(moved))
    assert orphans.count() == 0


def test_shuffles_of_a_written_text_go_and_its_lines_stay(spark):
    before = _shuffle_files(spark)
    lines = spark.range(20_000).select(F.concat_ws("\t", F.lit("r"), "id").alias("value")).repartition(F.md5("value"))
    path = queries._written(type("X", (), {"spark": spark}), lines, **queries.GZIP)
    for _ in range(50):
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    again = spark.read.text(path)
    assert again.count() == 20_000 and again.distinct().count() == 20_000
    assert all(f.endswith(".gz") for f in again.inputFiles())
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
