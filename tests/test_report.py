"""The report's rows and page, and charts, on tables with nulls, nothing in them, and names that need escapes."""

import xml.etree.ElementTree as ET

from methframe.operators import charts, report

LOG = "chr string, reads long, wC long, wT long, cC long, cT long"
SVG = "{http://www.w3.org/2000/svg}"


def counters(spark, log, none=False):
    trimmed = spark.createDataFrame([] if none else [(1000, 100, 5, 3)], "total long, dropped long, adapter long, tail long")
    strands = spark.createDataFrame([] if none else [("W", 300)], "strand string, reads long")
    dups = spark.createDataFrame([] if none else [(300, 296, 3, 1)], "all long, unique long, duplicate long, discard long")
    return trimmed, strands, dups, spark.createDataFrame(log, LOG)


def shown(df):
    return {r["item"]: (r["value"], r["share"]) for r in df.orderBy("n").collect()}


def test_rows(spark):
    log = [("chr1", 5, 1, 3, 0, 0), ("chr2", 2, 1, 0, 2, 1), ("chrL", 7, 1, 199, 0, 0)]
    got = shown(report.table(*counters(spark, log)))
    assert got["After trimming"] == ("900", "90.00 %") and got["Aligned"] == ("300", "33.33 %")
    assert got["Reverse strand"] == ("0", "0.00 %") and got["Duplicate"] == ("3", "1.00 %")
    assert got["Methylation, watson"] == ("5", "40.00 %") and got["Methylation, total"] == ("8", "50.00 %")
    assert got["Control reads"] == ("7", "") and got["Control conversion"] == ("200", "99.50 %")
    assert shown(report.table(*counters(spark, log), protocol="TAPS"))["Methylation, watson"] == ("5", "60.00 %")


def test_rows_of_nothing(spark):
    got = shown(report.table(*counters(spark, [], none=True)))
    assert got["Total reads"] == ("0", "") and got["Aligned"] == ("0", "NA")
    assert got["Methylation, total"] == ("", "NA") and got["Control conversion"] == ("", "NA")


def test_half_is_rounded_up(spark):
    trimmed = spark.createDataFrame([(800, 799)], "total long, dropped long")
    _, strands, dups, log = counters(spark, [])
    assert shown(report.table(trimmed, strands, dups, log))["After trimming"] == ("1", "0.13 %")  # 0.125


def test_page(spark):
    rows = report.table(*counters(spark, [("chr1", 5, 1, 3, 0, 0)]))
    conf = spark.createDataFrame([("b", "<1>"), ("a", None), ("c", 'x & "y"')], "key string, value string")
    drawn = spark.createDataFrame([("tss", "<svg/>")], "chart string, svg string")
    (page,) = report.page(rows, conf, "A & B", drawn).collect()
    text = page["page"]
    assert text.startswith("<!DOCTYPE html>") and "<title>A &amp; B</title>" in text and text.endswith("</body></html>")
    assert "<tr><td>a</td><td></td></tr><tr><td>b</td><td>&lt;1&gt;</td></tr><tr><td>c</td><td>x &amp; &quot;y&quot;</td></tr>" in text
    assert text.index("Total reads") < text.index("Control conversion") < text.index("Settings") < text.index("<h2>tss</h2><svg/>")
    assert report.page(rows.limit(0)).count() == 1


def drawing(df):
    return {r["chart"]: ET.fromstring(r["svg"]) for r in df.collect()}


def test_lines_break_off_at_nulls_and_axes(spark):
    table = spark.createDataFrame([(1, 1, 1, 0, 0, 0, 0), (3, 1, 3, 0, 0, 0, 0), (2, 0, 0, 9, 1, 1, 0)], "cycle int, wC long, wT long, wO long, cC long, cT long, cO long")
    svg = drawing(charts.mbias(table, 2))["mbias_2"]
    lines = {x.get("stroke"): x.get("points") for x in svg.iter(f"{SVG}polyline")}
    assert lines == {"red": "70,190 730,265", "blue": "400,190"}
    assert [x.text for x in svg.iter(f"{SVG}text")].count("Watson") == 1
    percent = spark.createDataFrame([(-200, 0.4, None), (0, 0.9, 0.2)], "distance long, watson double, crick double")
    lines = {x.get("stroke"): x.get("points") for x in drawing(charts.tss(percent))["tss"].iter(f"{SVG}polyline")}
    assert lines == {"red": "70,190", "blue": "730,265"}  # 90 % lies above the axis


def test_composition_has_a_chart_for_each_mate(spark):
    counts = spark.createDataFrame([(1, 1, 4, 0, 0, 0, 0), (2, 1, 1, 1, 1, 1, 0), (2, 2, 1, 1, 1, 0, 1)], "mate int, cycle long, A long, C long, G long, T long, N long")
    got = drawing(charts.composition(counts))
    assert sorted(got) == ["composition_1", "composition_2"]
    one = {x.get("stroke"): x.get("points") for x in got["composition_1"].iter(f"{SVG}polyline")}
    assert one["green"] == "70,40" and one["black"] == "70,340"


def test_chromosomes(spark):
    log = spark.createDataFrame([("chr2", 1, 0, 4, 1, 1), ("a<b", 1, 1, 1, 0, 0)], LOG)
    svg = drawing(charts.chromosomes(log))["chromosomes"]
    bars = [(x.get("fill"), x.get("y"), x.get("height")) for x in svg.iter(f"{SVG}rect")][1:]
    assert bars == [("blue", "190", "150"), ("red", "190", "150")] or bars == [("red", "190", "150"), ("blue", "190", "150")]
    assert {"a<b", "chr2", "Watson", "Crick"} <= {x.text for x in svg.iter(f"{SVG}text")}


def test_charts_of_nothing(spark):
    sizes = spark.createDataFrame([], "size long, count long, proportion double")
    log = spark.createDataFrame([], LOG)
    got = drawing(charts.of({"sizes": sizes, "chr_log": log, "totals": log}))
    assert sorted(got) == ["chromosomes", "sizes"]
    assert not list(got["sizes"].iter(f"{SVG}polyline"))
    assert charts.of({"totals": log}) is None
