"""CIGAR strings of M, I and D runs; anything else is unsupported."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SUPPORTED = "^([0-9]+[MID])+$"
#: Quality of a deleted base: below every quality character.
NO_QUALITY = " "


def supported(cigar: Column | str) -> Column:
    return F.col(cigar).rlike(SUPPORTED) if isinstance(cigar, str) else cigar.rlike(SUPPORTED)


def reference_length(cigar: str) -> Column:
    """Bases of the reference that a CIGAR covers; 0 if unsupported."""
    return F.expr(
        f"case when {cigar} rlike '{SUPPORTED}' then "
        f"aggregate(regexp_extract_all({cigar}, '([0-9]+)[MD]', 1), 0, (a, n) -> a + cast(n as int)) else 0 end"
    )


def projection(cigar: str, text: str, gap: str) -> Column:
    """text (bases or qualities) laid out along the reference: M copied, I left out, D filled with gap."""
    # The common case of one M run needs no walk along the operations.
    return F.expr(
        f"case when {cigar} rlike '^[0-9]+M$' then {text} else aggregate("
        f"zip_with(regexp_extract_all({cigar}, '([0-9]+)([MID])', 1), regexp_extract_all({cigar}, '([0-9]+)([MID])', 2), "
        "(n, o) -> named_struct('n', cast(n as int), 'o', o)), named_struct('s', '', 'p', 0), "
        f"(a, x) -> case x.o when 'M' then named_struct('s', concat(a.s, substr({text}, a.p + 1, x.n)), 'p', a.p + x.n) "
        "when 'I' then named_struct('s', a.s, 'p', a.p + x.n) "
        f"else named_struct('s', concat(a.s, repeat('{gap}', x.n)), 'p', a.p) end, a -> a.s) end"
    )


def bases(cigar: str, seq: str) -> Column:
    return projection(cigar, seq, "N")


def qualities(cigar: str, qual: str) -> Column:
    return projection(cigar, qual, NO_QUALITY)


def quality_sum(qual: str) -> Column:
    """Sum of the characters' codes."""
    return F.expr(f"aggregate(split({qual}, ''), 0L, (a, c) -> a + ascii(c))")


def fragment_size(strand: str, pos1: str, cigar1: str, pos2: str, cigar2: str) -> Column:
    """From the leftmost base to the end of the rightmost mate."""
    watson = F.col(pos2) + reference_length(cigar2) - F.col(pos1)
    return F.when(F.col(strand) == "W", watson).otherwise(F.col(pos1) + reference_length(cigar1) - F.col(pos2)).cast("long")


def extend_first(cigar: str, by: int = 1) -> Column:
    """The CIGAR with its first M run longer."""
    return F.expr(f"concat(cast(cast(regexp_extract({cigar}, '^([0-9]+)M', 1) as int) + {by} as string), regexp_replace({cigar}, '^[0-9]+', ''))")


def extend_last(cigar: str, by: int = 1) -> Column:
    """The CIGAR with its last M run longer."""
    return F.expr(f"concat(regexp_replace({cigar}, '[0-9]+M$', ''), cast(cast(regexp_extract({cigar}, '([0-9]+)M$', 1) as int) + {by} as string), 'M')")
