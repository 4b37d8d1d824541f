"""Intervals of any width, rows packed by stretches."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from methframe.operators import intervals, view


def some(r, n, top):
    out = []
    for _ in range(n):
        start = r.randrange(0, top)
        out.append((r.choice(["chr1", "chr2"]), start, start + r.choice([0, 1, 5, 40, 300, 5000, top])))
    return out


@pytest.mark.parametrize("tile", [16, 1 << 14])
def test_joins_of_wide_intervals(spark, tmp_path, tile):
    r = random.Random(tile)
    a, b = some(r, 60, 4000), some(r, 60, 4000)
    points = [(r.choice(["chr1", "chr2"]), r.randrange(0, 9000), k) for k in range(300)]
    frame = lambda x: spark.createDataFrame(x, "chr string, start long, end long").repartition(3)
    p = spark.createDataFrame(points, "chr string, locus long, id long")
    got = intervals.points_in(p, frame(a), tile=tile).select("chr", "start", "end", "locus", "id").collect()
    assert Counter(map(tuple, got)) == Counter((c, s, e, x, k) for c, s, e in a for d, x, k in points if c == d and s < x <= e)
    left = intervals.points_in(p, frame(a), "left", tile=tile)
    assert {tuple(x) for x in left.select("chr", "start", "end").collect()} == set(a)
    pairs = intervals.overlaps(frame(a), frame(b), tile).select("chr_a", "start_a", "end_a", "chr_b", "start_b", "end_b").collect()
    assert Counter(map(tuple, pairs)) == Counter((*x, *y) for x in a for y in b if x[0] == y[0] and x[1] <= y[2] and x[2] >= y[1])
    few = b[:6]
    semi = intervals.overlapping(frame(a + a[:5]), frame(few), tile).collect()
    assert Counter(map(tuple, semi)) == Counter(x for x in a + a[:5] if any(x[0] == y[0] and x[1] <= y[2] and x[2] >= y[1] for y in few))


def test_a_chromosome_makes_a_handful_of_rows(spark):
    whole = spark.createDataFrame([("chr1", 0, 250_000_000), ("chr1", 5, 200_000), ("chr1", 7, 9)], "chr string, start long, end long")
    levels = whole.withColumn("level", intervals.level_of("start", "end", intervals.TILE)).withColumn("size", F.expr(f"{intervals.TILE} * pow(8, level)"))
    rows = levels.select("level", (F.floor(F.col("end") / F.col("size")) - F.floor(F.col("start") / F.col("size")) + 1).alias("n")).collect()
    assert [x["level"] for x in rows] == [4, 1, 0] and all(x["n"] <= intervals.WIDE for x in rows)
    assert intervals.overlaps(whole, whole).count() == 9


def plain_pack(rows, gap):
    todo, lines = [row for _, _, row in sorted(rows)], []
    while todo:
        line, rest = todo[0], []
        for row in todo[1:]:
            if len(row) - len(row.lstrip(" ")) >= len(line) + gap:
                line += row[len(line) :]
            else:
                rest.append(row)
        lines.append(line)
        todo = rest
    return lines


@pytest.mark.parametrize("reach", [300, 5000])
def test_packing_by_stretches(spark, reach):
    r = random.Random(reach)
    rows = [(at, f"r{k}", " " * at + "M" * r.randint(1, 20)) for k, at in enumerate(r.randrange(0, reach) for _ in range(250))]
    df = spark.createDataFrame(rows, "pos long, name string, row string").repartition(4)
    got = {x["line"]: x["row"] for x in view.packed(df).collect()}
    assert [got[k] for k in sorted(got)] == plain_pack(rows, view.PACK_GAP) and sorted(got) == list(range(len(got)))
    assert view.packed(df.limit(0)).count() == 0


def test_paper():
    assert [view.paper(w, n) for w, n in ((160, 80), (161, 90), (281, 200), (401, 300), (200, 10), (241, 10), (401, 10), (601, 10))] == [
        ("A4", "Portrait"), ("A3", "Portrait"), ("A2", "Portrait"), ("A1", "Portrait"), ("A4", "Landscape"), ("A3", "Landscape"), ("A2", "Landscape"), ("A1", "Landscape"),
    ]
    assert view.pdf_command("x", 700, 3) == "wkhtmltopdf -s A1 -O Landscape x.html x.pdf"
