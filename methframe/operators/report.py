"""Totals over a run's tables, and the HTML report made of them."""

from __future__ import annotations

import html

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import reads as R

CONTROL = "chrL"  # the control sequence: kept out of totals, alone in the conversion rate


def methylation_totals(log: DataFrame, protocol: str = "BS") -> DataFrame:
    """(strand, reads, c, t, level) of Watson, Crick and both over all chromosomes but the control."""
    body = log.where(F.col("chr") != CONTROL)
    sums = body.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("reads", "wC", "wT", "cC", "cT")])
    rows = F.array(
        F.struct(F.lit("watson").alias("strand"), F.col("wC").alias("c"), F.col("wT").alias("t")),
        F.struct(F.lit("crick").alias("strand"), F.col("cC").alias("c"), F.col("cT").alias("t")),
        F.struct(F.lit("total").alias("strand"), (F.col("wC") + F.col("cC")).alias("c"), (F.col("wT") + F.col("cT")).alias("t")),
    )
    out = sums.select("reads", F.explode(rows).alias("r")).select("r.strand", "reads", "r.c", "r.t")
    return out.withColumn("level", R.level(protocol, "c", "t"))


def control_conversion(log: DataFrame) -> DataFrame:
    """(reads, c, t, rate): share of control bases read as T, in percent; null without any."""
    rows = log.where(F.col("chr") == CONTROL)
    sums = rows.agg(F.coalesce(F.sum("reads"), F.lit(0)).cast("long").alias("reads"), F.coalesce(F.sum(F.col("wC") + F.col("cC")), F.lit(0)).cast("long").alias("c"), F.coalesce(F.sum(F.col("wT") + F.col("cT")), F.lit(0)).cast("long").alias("t"))
    return sums.withColumn("rate", F.when(F.col("c") + F.col("t") > 0, F.col("t").cast("double") * 100 / (F.col("c") + F.col("t"))))


def _facts(df: DataFrame, *columns: str, prefix: str = "") -> DataFrame:
    """(key, value) of the columns of a table of counters."""
    return df.select(F.explode(F.array(*[F.struct(F.lit(prefix + c).alias("key"), F.col(c).cast("long").alias("value")) for c in columns])).alias("f")).select("f.*")


def _share(part: str, whole: str) -> Column:
    """part of whole in percent with two places, rounded half up in whole numbers."""
    h = f"(({part}) * 20000 + ({whole})) div (2 * ({whole}))"
    return F.expr(f"case when ({whole}) > 0 then concat({h} div 100, '.', lpad(string({h} % 100), 2, '0'), ' %') else 'NA' end")


def table(trimmed: DataFrame, strands: DataFrame, dedup: DataFrame, log: DataFrame, protocol: str = "BS") -> DataFrame:
    """(n, item, value, share) of the report as text, in the order of n.

    Inputs are tables of counters: of trimming, reads per strand, duplicates, and per chromosome.  What they lack counts as 0,
    and a share of nothing is NA.
    """
    control = F.col("chr") == CONTROL
    sums = {c: (~control, c) for c in ("wC", "wT", "cC", "cT")} | {"control": (control, "reads"), "control_c": (control, "wC + cC"), "control_t": (control, "wT + cT")}
    called = log.agg(*[F.sum(F.when(of, F.expr(c))).alias(k) for k, (of, c) in sums.items()])
    facts = _facts(trimmed, "total", "dropped").unionByName(_facts(dedup, "all", "unique", "duplicate", "discard")).unionByName(_facts(called, *sums))
    facts = facts.unionByName(strands.select(F.concat(F.lit("strand_"), "strand").alias("key"), F.col("reads").cast("long").alias("value")))
    keys = ["total", "dropped", "all", "unique", "duplicate", "discard", "strand_W", "strand_C", *sums]
    one = facts.agg(*[F.coalesce(F.sum(F.when(F.col("key") == k, F.col("value"))), F.lit(0)).alias(k) for k in keys])
    one = one.withColumns({"kept": F.expr("total - dropped"), "aligned": F.expr("strand_W + strand_C"), "control_all": F.expr("control_c + control_t")})
    hit = "T" if protocol.upper() == "TAPS" else "C"
    strand = {"watson": (f"w{hit}", "wC + wT"), "crick": (f"c{hit}", "cC + cT"), "total": (f"w{hit} + c{hit}", "wC + wT + cC + cT")}

    def some(whole: str) -> Column:
        return F.expr(f"if(({whole}) > 0, format_number({whole}, 0), '')")

    rows = [
        ("Total reads", R.thousands("total"), F.lit("")),
        ("After trimming", R.thousands("kept"), _share("kept", "total")),
        ("Aligned", R.thousands("aligned"), _share("aligned", "kept")),
        ("Forward strand", R.thousands("strand_W"), _share("strand_W", "aligned")),
        ("Reverse strand", R.thousands("strand_C"), _share("strand_C", "aligned")),
        ("Unique", R.thousands("unique"), _share("unique", "`all`")),
        ("Duplicate", R.thousands("duplicate"), _share("duplicate", "`all`")),
        ("Discarded", R.thousands("discard"), _share("discard", "`all`")),
        *[(f"Methylation, {k}", some(whole), _share(part, whole)) for k, (part, whole) in strand.items()],
        ("Control reads", R.thousands("control"), F.lit("")),
        ("Control conversion", some("control_all"), _share("control_t", "control_all")),
    ]
    each = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(item).alias("item"), value.alias("value"), share.alias("share")) for n, (item, value, share) in enumerate(rows)])
    return one.select(F.explode(each).alias("r")).select("r.*")


def escaped(value: Column) -> Column:
    """Text as HTML and SVG show it."""
    for mark, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        value = F.replace(value, F.lit(mark), F.lit(name))
    return value


def _section(part: int, df: DataFrame, order: str, row: Column, before: str, after: str = "") -> DataFrame:
    """(part, html) of a small table: its rows' HTML in their order."""
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(F.col(order).alias("by"), row.alias("row")))), lambda r: r["row"]), "")
    return df.agg(F.concat(F.lit(before), body, F.lit(after)).alias("html")).select(F.lit(part).alias("part"), "html")


def _grid(part: int, df: DataFrame, order: str, title: str, **columns: str) -> DataFrame:
    cells = F.concat(*[F.concat(F.lit("<td>"), escaped(F.coalesce(F.col(c).cast("string"), F.lit(""))), F.lit("</td>")) for c in columns.values()])
    head = "".join(f"<th>{h}</th>" for h in columns)
    return _section(part, df, order, F.concat(F.lit("<tr>"), cells, F.lit("</tr>")), f"{title}<table><tr>{head}</tr>", "</table>")


def page(report: DataFrame, conf: DataFrame | None = None, title: str = "Methylation report", charts: DataFrame | None = None) -> DataFrame:
    """(page): one row, an HTML page of the report's rows (n, item, value, share), the run's settings (key, value) and its charts (chart, svg)."""
    shown = html.escape(title)
    sections = [_grid(0, report, "n", f"<h1>{shown}</h1>", Item="item", Value="value", Share="share")]
    if conf is not None:
        sections.append(_grid(1, conf, "key", "<h2>Settings</h2>", Key="key", Value="value"))
    if charts is not None:
        sections.append(_section(2, charts, "chart", F.concat(F.lit("<h2>"), escaped(F.col("chart")), F.lit("</h2>"), "svg"), ""))
    every = sections[0]
    for section in sections[1:]:
        every = every.unionByName(section)
    start, end = f'<!DOCTYPE html><html><head><meta charset="utf-8"><title>{shown}</title></head><body>', "</body></html>"
    return _section(0, every, "part", F.col("html"), start, end).select(F.col("html").alias("page"))
