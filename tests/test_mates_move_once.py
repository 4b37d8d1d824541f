"""Mates are linked by one exchange of their rows, whatever is asked of them."""

import random

from pyspark.sql import functions as F

from methframe import schemas as S
from methframe.operators import merge
from methframe.sources import text


def _row(name, flag, chr_="chr1", pos=10):
    return (name, flag, chr_, pos, 30, "4M", "*", 0, 0, "ACGT", "IIII", ["XG:Z:CT" if flag & 16 == 0 else "XG:Z:GA"])


def test_one_exchange_and_every_row_once(spark):
    r = random.Random(3)
    rows, want, pairs = [], [], 0
    for k in range(300):
        n1, n2, far = r.randint(0, 3), r.randint(0, 3), r.random() < 0.2
        own = [_row(f"n{k}", 99, pos=k + i) for i in range(n1)] + [_row(f"n{k}", 147, "chr2" if far else "chr1", k + 50 + i) for i in range(n2)]
        rows += own
        why = "repeated" if n1 > 1 or n2 > 1 else "mate" if n1 + n2 == 1 else "chromosome" if far else None
        pairs += why is None and n1 + n2 == 2
        want += [(x[0], x[1], x[3], why) for x in own if why]
    rows += [_row(None, 99, pos=k) for k in range(40)] + [_row("n1", 0, pos=k) for k in range(40)]
    want += [("", 99, k, "mate") for k in range(40)] + [("n1", 0, k, "single") for k in range(40)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, S.SAM)
    linked, orphans = merge.link_mates(df, text.strand_of())
    fixed = merge.fix_mates(df, text.strand_of())
    for table in (linked, orphans, fixed):
        assert table._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert linked.count() == pairs > 0
    assert sorted((x["qname"] or "", x["flag"], x["pos"], x["missing"]) for x in orphans.collect()) == sorted(want)
    assert fixed.count() == len(rows) and fixed.where(F.col("rnext") == "=").count() == 2 * pairs
