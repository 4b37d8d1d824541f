"""Charts of a run's tables as SVG: (chart, svg), one row a chart.

The tables have a row for each cycle, size, chromosome or distance.  Points are scaled and joined to
lines by grouped strings, so a chart is a table like the others.  Points outside the axes and null
values are left out; a chart without points has its frame alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import reads as R
from . import calls, dedup, ordering, preprocess
from .report import escaped

WIDTH, HEIGHT = 760, 420
LEFT, TOP, ACROSS, DOWN = 70, 40, 660, 300  # the frame: its corner, width and height
TICKS = 4  # steps between the ends of an axis
STRANDS = {"watson": ("Watson", "red"), "crick": ("Crick", "blue")}
BASES = {"A": ("A", "green"), "C": ("C", "blue"), "G": ("G", "orange"), "T": ("T", "red"), "N": ("N", "black")}
TSS_TOP = 80  # percent, fixed upper end of the profile's axis


def points(table: DataFrame, x: str, series: dict[str, tuple[str, str]], chart: Column | str) -> DataFrame:
    """(chart, part, label, colour, x, y) of a table's columns: series gives each column's label and colour."""
    name = F.lit(chart) if isinstance(chart, str) else chart
    each = F.array(*[F.struct(F.lit(k).alias("part"), F.lit(label).alias("label"), F.lit(colour).alias("colour"), F.col(c).cast("double").alias("y")) for k, (c, (label, colour)) in enumerate(series.items())])
    return table.select(name.alias("chart"), F.col(x).cast("double").alias("x"), F.explode(each).alias("s")).select("chart", "s.part", "s.label", "s.colour", "x", "s.y")


def _at_x(value: Column) -> Column:
    span = F.when(F.col("x_max") > F.col("x_min"), F.col("x_max") - F.col("x_min")).otherwise(1.0)
    return F.floor(LEFT + (value - F.col("x_min")) * ACROSS / span + 0.5).cast("string")


def _at_y(value: Column) -> Column:
    span = F.when(F.col("y_max") > F.col("y_min"), F.col("y_max") - F.col("y_min")).otherwise(1.0)
    return F.floor(TOP + DOWN - (value - F.col("y_min")) * DOWN / span + 0.5).cast("string")


def _text(x: Column | int, y: Column | int, shown: Column, more: str = "") -> Column:
    plain = [v.cast("string") if isinstance(v, Column) else F.lit(str(v)) for v in (x, y)]
    return F.concat(F.lit('<text x="'), plain[0], F.lit('" y="'), plain[1], F.lit(f'"{more}>'), escaped(shown), F.lit("</text>"))


def _frame(numbers: bool) -> Column:
    """Outline, labels and numbers of a row of axes."""
    out = [F.lit(f'<rect x="{LEFT}" y="{TOP}" width="{ACROSS}" height="{DOWN}" fill="none" stroke="black"/>')]
    out.append(_text(LEFT + ACROSS // 2, HEIGHT - 20, F.col("x_label"), ' text-anchor="middle"'))
    out.append(_text(20, TOP + DOWN // 2, F.col("y_label"), f' text-anchor="middle" transform="rotate(-90 20 {TOP + DOWN // 2})"'))
    for k in range(TICKS + 1):
        across, up = (F.col(f"{a}_min") + (F.col(f"{a}_max") - F.col(f"{a}_min")) * k / TICKS for a in "xy")
        if numbers:
            out.append(_text(LEFT + ACROSS * k // TICKS, TOP + DOWN + 20, F.floor(across + 0.5).cast("string"), ' text-anchor="middle"'))
        out.append(_text(LEFT - 8, TOP + DOWN - DOWN * k // TICKS + 5, F.format_string("%.1f", F.floor(up * 10 + 0.5) / 10), ' text-anchor="end"'))
    return F.concat(*out)


def _legend() -> Column:
    return F.concat(F.lit('<text x="'), (LEFT + 90 * F.col("part")).cast("string"), F.lit(f'" y="{TOP - 12}" fill="'), "colour", F.lit('">'), escaped(F.col("label")), F.lit("</text>"))


def _joined(of: Column, by: str, what: str) -> Column:
    """Strings *what* of structs, in the order of the structs."""
    return F.array_join(F.transform(F.sort_array(F.collect_list(of)), lambda s: s[what]), by)


def _whole(axes: DataFrame, pieces: DataFrame, numbers: bool = True) -> DataFrame:
    """The SVG of each row of axes with its pieces (chart, part, piece) inside."""
    inside = pieces.groupBy("chart").agg(_joined(F.struct("part", "piece"), "", "piece").alias("inside"))
    head = F.lit(f'<svg xmlns="http://www.w3.org/2000/svg" width="{WIDTH}" height="{HEIGHT}" font-family="sans-serif" font-size="14">')
    return axes.join(inside, "chart", "left").select("chart", F.concat(head, _frame(numbers), F.coalesce("inside", F.lit("")), F.lit("</svg>")).alias("svg"))


def lines(drawn: DataFrame, axes: DataFrame) -> DataFrame:
    """Points (as of points()) as lines over axes (chart, x_label, y_label, x_min, x_max, y_min, y_max)."""
    inner = drawn.join(axes, "chart").where("x between x_min and x_max and y between y_min and y_max")
    placed = inner.select("chart", "part", "label", "colour", "x", F.concat_ws(",", _at_x(F.col("x")), _at_y(F.col("y"))).alias("at"))
    one = placed.groupBy("chart", "part", "label", "colour").agg(_joined(F.struct("x", "at"), " ", "at").alias("at"))
    line = F.concat(F.lit('<polyline fill="none" stroke-width="2" stroke="'), "colour", F.lit('" points="'), "at", F.lit('"/>'), _legend())
    return _whole(axes, one.select("chart", "part", line.alias("piece")))


def _axes(row: DataFrame, x_label: str, y_label: str) -> DataFrame:
    """A row of ends with its labels; ends become doubles, and missing ones those of an empty chart."""
    ends = [F.coalesce(F.col(c).cast("double"), F.lit(0.0 if c.endswith("min") else 1.0)).alias(c) for c in ("x_min", "x_max", "y_min", "y_max")]
    return row.select("chart", F.lit(x_label).alias("x_label"), F.lit(y_label).alias("y_label"), *ends)


def composition(counts: DataFrame) -> DataFrame:
    """Shares of the bases by cycle, a chart for each mate: composition_1, composition_2."""
    percents = preprocess.composition_percent(counts).withColumn("chart", F.concat(F.lit("composition_"), "mate"))
    top = F.least(F.lit(100.0), F.max(F.greatest(*"ACGTN")) + 10)
    ends = percents.groupBy("chart").agg(F.lit(1).alias("x_min"), F.max("cycle").alias("x_max"), F.lit(0).alias("y_min"), top.alias("y_max"))
    return lines(points(percents, "cycle", BASES, F.col("chart")), _axes(ends, "Sequencing cycle", "Frequency (%)"))


def sizes(distribution: DataFrame) -> DataFrame:
    """Shares of the fragment sizes: sizes."""
    shown = points(distribution, "size", {"proportion": ("All", "black")}, "sizes")
    top = distribution.agg(F.max("proportion").alias("y_max"), F.min("size").alias("low"))
    ends = dedup.size_axis(distribution).crossJoin(top)  # two rows of ends
    return lines(shown, _axes(ends.withColumns({"chart": F.lit("sizes"), "y_min": F.lit(0)}), "Fragment size (bp)", "Frequency (%)"))


def mbias(table: DataFrame, mate: int = 1, protocol: str = "BS") -> DataFrame:
    """Levels of both strands by cycle: mbias_1 or mbias_2."""
    levels, name = calls.mbias_levels(table, protocol), f"mbias_{mate}"
    ends = levels.agg(F.lit(1).alias("x_min"), F.max("cycle").alias("x_max"), F.lit(0).alias("y_min"), F.lit(100).alias("y_max"))
    return lines(points(levels, "cycle", STRANDS, name), _axes(ends.withColumn("chart", F.lit(name)), "Sequencing cycle", "Methylation level (%)"))


def tss(profile: DataFrame) -> DataFrame:
    """Levels around transcription starts by gene strand: tss."""
    percent = profile.select("distance", *[(F.col(c) * 100).alias(c) for c in STRANDS])
    ends = percent.agg(F.min("distance").alias("x_min"), F.max("distance").alias("x_max"), F.lit(0).alias("y_min"), F.lit(TSS_TOP).alias("y_max"))
    return lines(points(percent, "distance", STRANDS, "tss"), _axes(ends.withColumn("chart", F.lit("tss")), "Distance from transcription start (bp)", "Methylation level (%)"))


def chromosomes(log: DataFrame, protocol: str = "BS") -> DataFrame:
    """Levels of both strands as a pair of bars for each chromosome, by name: chromosomes.  A level of zero or null has no bar."""
    numbered = ordering.numbered(log.select("chr", R.level(protocol, "wC", "wT").alias("watson"), R.level(protocol, "cC", "cT").alias("crick")), "chr")
    ends = numbered.agg(F.lit(0).alias("x_min"), F.count(F.lit(1)).alias("x_max"), F.lit(0).alias("y_min"), F.lit(100).alias("y_max"))
    axes = _axes(ends.withColumn("chart", F.lit("chromosomes")), "Chromosome", "Methylation level (%)")
    wide = numbered.withColumn("chart", F.lit("chromosomes")).join(axes.select("chart", "x_max"), "chart")
    step = ACROSS / F.col("x_max")
    bars = []
    for k, (c, (_, colour)) in enumerate(STRANDS.items()):
        x, high = F.floor((LEFT + step * (F.col("n") + (k + 0.5) / 3)) * 100 + 0.5) / 100, F.floor(F.col(c) * DOWN / 100 + 0.5)
        bar = F.concat(F.lit('<rect x="'), F.format_string("%.2f", x), F.lit('" y="'), (TOP + DOWN - high).cast("string"), F.lit('" width="'), F.format_string("%.2f", F.floor(step * 100 / 3 + 0.5) / 100), F.lit('" height="'), high.cast("string"), F.lit(f'" fill="{colour}"/>'))
        bars.append(F.coalesce(F.when(high > 0, bar), F.lit("")))
    middle = F.floor(LEFT + step * (F.col("n") + 0.5) + 0.5).cast("string")
    name = F.concat(F.lit('<text font-size="10" text-anchor="end" x="'), middle, F.lit(f'" y="{TOP + DOWN + 12}" transform="rotate(-45 '), middle, F.lit(f' {TOP + DOWN + 12})">'), escaped(F.col("chr")), F.lit("</text>"))
    pieces = wide.select("chart", F.col("n").alias("part"), F.concat(*bars, name).alias("piece"))
    legend = points(log.agg(F.lit(0).alias("x"), *[F.lit(0).alias(c) for c in STRANDS]), "x", STRANDS, "chromosomes").select("chart", (F.col("part") - len(STRANDS)).cast("long").alias("part"), _legend().alias("piece"))
    return _whole(axes, pieces.unionByName(legend), numbers=False)


def of(tables: dict[str, DataFrame], protocol: str = "BS") -> DataFrame | None:
    """Charts of those of a run's tables that have one (see Pipeline); None if there is none."""
    known = {
        "composition": composition, "sizes": sizes, "chr_log": lambda t: chromosomes(t, protocol), "tss_profile": tss,
        "mbias_1": lambda t: mbias(t, 1, protocol), "mbias_2": lambda t: mbias(t, 2, protocol),
    }
    found = [draw(tables[name]) for name, draw in known.items() if name in tables]
    out = found[0] if found else None
    for other in found[1:]:
        out = out.unionByName(other)
    return out
