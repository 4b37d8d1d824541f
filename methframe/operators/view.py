"""Nucleotide-level views of one region: fragments, glyphs, trimming, SNP order, dense forms, text and HTML.

The region bounds the rows, so the last steps (packing, rendering) may gather them.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cigar as C
from ..regions import parse_region
from . import intervals

PACK_GAP = 5  # columns between fragments packed into one row
RULER = 10  # sites between two numbers of the dense ruler
SNP_DEPTH, SNP_ALLELE = 10, 3
WARN_SPAN, MAX_SPAN = 10_000, 100_000


def region_warning(text: str) -> str | None:
    _, start, end = parse_region(text)
    span = end - start + 1
    return "the region is very large" if span > MAX_SPAN else "the region is large" if span > WARN_SPAN else None


def in_region(aligned: DataFrame, region: str, strand: str | None = None) -> DataFrame:
    """Single reads (or both mates' rows) that touch a region, of one strand if given."""
    chr_, start, end = parse_region(region)
    rows = aligned.where((F.col("chr") == chr_) & (F.col("pos") <= end) & (F.col("pos") + C.reference_length("cigar") - 1 >= start))
    return rows.where(F.col("strand") == strand) if strand else rows


def fragments(aligned: DataFrame) -> DataFrame:
    """(name, pos, seq, strand) per read name: mates joined, the better base where they overlap (the left mate's on ties), '.' in a gap.

    Rows: (name, chr, pos, cigar, seq, qual, strand); names lose a mate suffix; names of more than two rows are left out.
    A right mate that ends inside the left one adds nothing.  Deletions show as D.
    """
    rows = aligned.where(C.supported("cigar")).select(
        F.regexp_replace("name", "[_/]R?[12]$", "").alias("name"), "chr", "pos", "strand",
        C.projection("cigar", "seq", "D").alias("bases"), C.projection("cigar", "qual", C.NO_QUALITY).alias("quals"),
    )
    mates = rows.groupBy("name", "chr").agg(F.array_sort(F.collect_list(F.struct("pos", "bases", "quals", "strand"))).alias("m")).where("size(m) <= 2")
    shift = "cast(y.pos - x.pos as int)"
    two = (
        f"case when y.pos + length(y.bases) <= x.pos + length(x.bases) then x.bases "
        f"when {shift} >= length(x.bases) then concat(x.bases, repeat('.', {shift} - length(x.bases)), y.bases) "
        f"else array_join(transform(sequence(0, {shift} + length(y.bases) - 1), k -> case when k < {shift} then substr(x.bases, k + 1, 1) "
        f"when k >= length(x.bases) or ascii(substr(x.quals, k + 1, 1)) < ascii(substr(y.quals, k - {shift} + 1, 1)) then substr(y.bases, k - {shift} + 1, 1) "
        "else substr(x.bases, k + 1, 1) end), '') end"
    )
    split = mates.select("name", "chr", F.expr("m[0]").alias("x"), F.expr("try_element_at(m, 2)").alias("y"))
    return split.select("name", "chr", F.col("x.pos").alias("pos"), F.expr(f"case when y is null then x.bases else {two} end").alias("seq"), F.col("x.strand").alias("strand"))


def glyphs(frags: DataFrame, genome: DataFrame, protocol: str = "BS") -> DataFrame:
    """(name, pos, glyphs, strand): M and U at CpG sites, '-' for matches, the base otherwise.

    On C a site's call stands at its C and its mutation at its G; a site whose G lies beyond the
    fragment is left out.
    """
    from .genome import with_reference

    taps = protocol.upper() == "TAPS"
    wm, wu, cm, cu = ("T", "C", "A", "G") if taps else ("C", "T", "G", "A")
    rows = with_reference(frags, genome, "pos", "length(seq)").withColumn("up", F.upper("ref"))

    def ref(i: str) -> str:
        return f"substr(up, {i} + 3, 1)"

    def base(i: str) -> str:
        return f"substr(seq, {i} + 1, 1)"

    site = f"({ref('i')} = 'C' and {ref('i + 1')} = 'G')"
    second = f"({ref('i')} = 'G' and {ref('i - 1')} = 'C' and i > 0)"
    watson = (
        f"case when {site} then case {base('i')} when '{wm}' then 'M' when '{wu}' then 'U' else {base('i')} end "
        f"when {ref('i')} = 'C' then if({base('i')} in ('{wm}', '{wu}'), '-', {base('i')}) else if({base('i')} = {ref('i')}, '-', {base('i')}) end"
    )
    crick = (
        f"case when {site} and i + 1 = length(seq) then '' "
        f"when {site} then case {base('i + 1')} when '{cm}' then 'M' when '{cu}' then 'U' else {base('i + 1')} end "
        f"when {second} then if({base('i - 1')} = 'C', '-', {base('i - 1')}) "
        f"when {ref('i')} = 'C' then if({base('i')} in ('{wm}', '{wu}'), '-', {base('i')}) "
        f"when {ref('i')} = 'G' then if({base('i')} in ('{cm}', '{cu}'), '-', {base('i')}) else if({base('i')} = {ref('i')}, '-', {base('i')}) end"
    )
    line = f"transform(array(up), up -> array_join(transform(sequence(0, length(seq) - 1), i -> if(strand = 'W', {watson}, {crick})), ''))[0]"
    return rows.where("seq <> ''").select("name", "chr", "pos", F.expr(line).alias("glyphs"), "strand")


def padded(view: DataFrame) -> DataFrame:
    """Rows of the picture: (name, pos, left, row) with row padded from the leftmost position."""
    left = view.agg(F.min("pos").alias("left"))
    return view.join(F.broadcast(left)).select("name", "pos", "left", F.concat(F.expr("repeat(' ', cast(pos - left as int))"), "glyphs").alias("row"), "strand")


def trim(rows: DataFrame, start: int, end: int) -> DataFrame:
    """Rows cut to exact places; rows left without a call or mismatch go."""
    first = F.greatest(F.lit(start), F.col("left"))
    cut = F.expr(f"substr(row, cast(greatest({start}, left) - left as int) + 1, cast({end} - greatest({start}, left) as int) + 1)")
    return rows.where(F.col("left") <= end).select("name", "pos", first.cast("long").alias("left"), cut.alias("row"), "strand").where("row <> '' and not row rlike '^[ =-]+$'")


def allele_counts(rows: DataFrame) -> DataFrame:
    """(column, allele, n) of what is shown besides calls, blanks and gaps."""
    letters = rows.select(F.posexplode(F.split("row", "")).alias("column", "allele"))
    return letters.where("allele <> '' and allele not in ('.', ' ', 'U', 'M')").groupBy("column", "allele").agg(F.count(F.lit(1)).alias("n"))


def snp_column(rows: DataFrame, depth: int = SNP_DEPTH, allele: int = SNP_ALLELE) -> DataFrame:
    """(column): the first column deep enough whose second allele is frequent enough; null if there is none."""
    counts = allele_counts(rows).groupBy("column").agg(F.sum("n").alias("depth"), F.sort_array(F.collect_list("n"), asc=False).alias("n"))
    good = counts.where((F.col("depth") >= depth) & (F.expr("try_element_at(n, 2)") >= allele))
    return good.agg(F.min("column").alias("column"))


def snp_sorted(rows: DataFrame) -> DataFrame:
    """rows with an order: those that do not reach the SNP column first, then by their letter there."""
    column = snp_column(rows)
    key = F.expr("case when column is null or length(row) <= column then '' else substr(row, column + 1, 1) end")
    return rows.join(F.broadcast(column)).withColumn("allele", key).drop("column").orderBy("allele", "pos", "name")


def dense(rows: DataFrame, reference: str) -> DataFrame:
    """Only the CpG columns of every row; reference: the bases over the picture."""
    sites = [m.start() for m in re.finditer("CG", reference.upper())]
    if not sites:
        return rows.withColumn("row", F.lit("")).limit(0)
    marks = F.array(*[F.lit(s) for s in sites])
    kept = F.array_join(F.transform(F.filter(marks, lambda s: s <= F.length("row") - 2), lambda s: F.substr(F.col("row"), s + 1, F.lit(2))), "")
    out = rows.withColumn("row", F.regexp_replace(kept, "-$", ""))
    return out.where("trim(row) <> ''")


def packed(rows: DataFrame, gap: int = PACK_GAP) -> DataFrame:
    """(line, row): several dense rows to a line, each at least *gap* columns after the one before, in the order of pos and name.

    Each row goes to the first line with room.  Where a row begins that far after all before it, every line has room
    again, so the stretches between such columns are packed by themselves, each by a task; a line is put together from its stretches.
    """

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["pos", "name"], ignore_index=True)
        # The first line with room, by a tree over the lines' ends: a node holds the smallest end below it.
        size = 1 << max(0, (len(frame) - 1).bit_length())
        ends = [-gap] * (2 * size)
        lines = []
        for begin, end in zip(frame["begin"].tolist(), frame["end"].tolist(), strict=True):
            k = 1
            while k < size:
                k = 2 * k if ends[2 * k] + gap <= begin else 2 * k + 1
            lines.append(k - size)
            ends[k] = end
            while k > 1:
                k //= 2
                ends[k] = min(ends[2 * k], ends[2 * k + 1])
        return pd.DataFrame({"line": lines, "begin": frame["begin"], "row": frame["row"]})

    begin = (F.length("row") - F.length(F.ltrim("row"))).cast("long")
    one = rows.select(F.lit("").alias("chr"), "pos", "name", F.ltrim("row").alias("row"), begin.alias("begin"), F.length("row").cast("long").alias("end_at"), (begin + 1).alias("locus"))
    stretches = intervals.merge(one.select("chr", F.col("begin").alias("start"), F.col("end_at").alias("end")), gap - 1).select("chr", "start", "end")
    placed = intervals.points_in(one, stretches).select("start", "pos", "name", "row", "begin", F.col("end_at").alias("end"))
    parts = placed.groupBy("start").applyInPandas(lambda frame: pack(frame), "line long, begin long, row string")
    line = parts.groupBy("line").agg(F.sort_array(F.collect_list(F.struct("begin", "row"))).alias("parts"))
    return line.select("line", F.expr("aggregate(parts, '', (acc, x) -> concat(acc, repeat(' ', cast(x.begin - length(acc) as int)), x.row))").alias("row"))


def ruler(reference: str, left: int) -> str:
    """Numbers over every tenth CpG column of a dense picture."""
    sites = [m.start() for m in re.finditer("CG", reference.upper())]
    return "".join(str(left + s).ljust(2 * RULER) for s in sites[::RULER])


def text_lines(rows: list[str], region: str, chr_: str, left: int, reference: str) -> Iterator[str]:
    """The picture as text: three header lines, then one per row."""
    width = max((len(r) for r in rows), default=0)
    yield f"#region={region}"
    yield f"#position={chr_}:{left}-{left + width}"
    yield reference[: width + 2]
    yield from rows


def page(lines: list[str], title: str) -> str:
    """The picture as an HTML page whose letters shrink and whose ruler widens with its width."""
    width = max((len(x) for x in lines[2:]), default=0)
    pace, size = (50, 14) if width <= 200 else (80, 12) if width <= 500 else (100, 8)
    scale = "".join(str(i + 1).ljust(pace) for i in range(0, width, pace))
    colours = {"M": "red", "U": "blue"}

    def line(text: str) -> str:
        return "".join(f'<b style="color:{colours[c]}">{c}</b>' if c in colours else html.escape(c) for c in text)

    body = "\n".join([html.escape(scale), *map(html.escape, lines[2:3]), *map(line, lines[3:])])
    return f'<!DOCTYPE html><html><head><meta charset="utf-8"><title>{html.escape(title)}</title></head><body><h3>{html.escape(title)}</h3><pre style="font-size:{size}px">{body}</pre></body></html>'


# Widths (columns) from which a larger sheet is taken, fixed values.
SHEETS = {"Portrait": ((400, "A1"), (280, "A2"), (160, "A3")), "Landscape": ((600, "A1"), (400, "A2"), (240, "A3"))}


def paper(width: int, rows: int) -> tuple[str, str]:
    """(sheet, orientation) for a picture of so many columns and rows: landscape where it is more than twice as wide as high."""
    turned = "Landscape" if width > 2 * rows else "Portrait"
    return next((sheet for least, sheet in SHEETS[turned] if width > least), "A4"), turned


def pdf_command(name: str, width: int, rows: int, program: str = "wkhtmltopdf") -> str:
    """The command that turns the page name.html into name.pdf."""
    sheet, turned = paper(width, rows)
    return f"{program} -s {sheet} -O {turned} {name}.html {name}.pdf"


class Viewer:
    """Pictures of aligned reads (name, chr, pos, cigar, seq, qual, strand) over a genome (chr, seq)."""

    def __init__(self, aligned: DataFrame, genome: DataFrame, protocol: str = "BS"):
        self.aligned, self.genome, self.protocol = aligned, genome, protocol

    def rows(self, region: str, strand: str | None = None, exact: bool = False, snp_sort: bool = False) -> DataFrame:
        out = padded(glyphs(fragments(in_region(self.aligned, region, strand)), self.genome, self.protocol))
        if exact:
            out = trim(out, *parse_region(region)[1:])
        return snp_sorted(out) if snp_sort else out.orderBy("pos", "name")

    def render(self, region: str, strand: str | None = None, exact: bool = False, snp_sort: bool = False, level: int = 0) -> tuple[str, str]:
        """(text, HTML); level 1 keeps CpG columns, level 2 also packs rows."""
        chr_, start, _ = parse_region(region)
        rows = self.rows(region, strand, exact, snp_sort)
        head = rows.agg(F.min("left").alias("left"), F.max(F.length("row")).alias("width")).first()
        left, width = (head["left"], head["width"]) if head["left"] is not None else (start, 0)
        piece = self.genome.where(F.col("chr") == chr_).select(F.substring("seq", int(left), int(width) + 2).alias("s")).first()
        reference = piece["s"] if piece else ""
        if level:
            shown = dense(rows, reference)
            table = packed(shown).orderBy("line") if level == 2 else shown
            lines = [f"#region={region}", ruler(reference, int(left)), "CG" * reference.upper().count("CG"), *(r["row"] for r in table.select("row").collect())]
        else:
            lines = list(text_lines([r["row"] for r in rows.select("row").collect()], region, chr_, int(left), reference))
        return "\n".join(lines) + "\n", page(lines, region)
