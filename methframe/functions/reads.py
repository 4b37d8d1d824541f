"""Expressions on reads: trimming, adapters, base conversion and its reversal, contexts, formats."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Adapter:
    read1: str
    read2: str
    length: int
    seed: str


# Sequencing adapters by kit (the last kit compares 19 of 20 bases).
ADAPTERS = {
    "illumina": Adapter("AGATCGGAAGAGC", "AGATCGGAAGAGC", 13, "AGA"),
    "nextera": Adapter("CTGTCTCTTATACACATCT", "CTGTCTCTTATACACATCT", 19, "CTG"),
    "bgi": Adapter("AAGTCGGAGGCCAAGCGGTC", "AAGTCGGATCGTAGCCATGT", 19, "AAG"),
}


def bound(body: str, **values: str) -> str:
    """body with names that stand for values, each worked out once a row.

    The optimizer puts a column that is named once into the lambda that names it, and would work it out anew for each element.
    """
    for name, value in reversed(values.items()):
        body = f"transform(array({value}), {name} -> {body})[0]"
    return body


def places_of(text: str, pattern: str) -> str:
    """0-based places of a pattern, overlapping ones included, without a walk over all places: text is split before each of them."""
    found = (
        f"aggregate(split(t_, '(?={pattern})'), named_struct('at', 0, 'found', cast(array() as array<int>)), "
        f"(a, x) -> named_struct('at', a.at + length(x), 'found', if(a.at > 0 or startswith(t_, '{pattern}'), array_append(a.found, a.at), a.found)), a -> a.found)"
    )
    return bound(found, t_=text)


def crop(text: str, cycle: int) -> Column:
    return F.expr(f"substr({text}, 1, {cycle})")


def quality_trim(min_qual: int, *quals: str) -> Column:
    """Length kept: up to the last position at which every quality reaches the threshold; at least 1, since the first is not tested."""
    # One quality string can be cut by its tail of low characters, without a walk over positions.
    low = f"[\\\\x00-\\\\x{min_qual - 1:02x}]+$"
    if len(quals) == 1:
        return F.expr(f"greatest(1, length(regexp_replace({quals[0]}, '{low}', '')))")
    names = [f"q{k}_" for k in range(len(quals))]
    good = " and ".join(f"ascii(substr({q}, i + 1, 1)) >= {min_qual}" for q in names)
    # No place after the shortest string without its tail counts; often its last one does, else those before are walked.
    ends = "least(length(q0_), " + ", ".join(f"length(regexp_replace({q}, '{low}', ''))" for q in names) + ")"
    before = f"coalesce(array_max(filter(sequence(0, n_ - 1), i -> {good})) + 1, 1)"
    found = f"case when n_ < 1 then 1 when {good.replace('i + 1', 'n_')} then n_ else {before} end"
    return F.expr(f"coalesce({bound(found, **dict(zip(names, quals, strict=True)), n_=ends)}, 1)")


def clean_id(name: str) -> Column:
    """A read's name without the leading @ and anything after white space."""
    return F.expr(f"regexp_extract({name}, '^@?(\\\\S+)', 1)")


def convert(seq: str, mate: int, mode: int) -> Column:
    """Bases with the conversion that aligners see: every C (mate 2: G) in mode 3, only those of CpG in mode 4."""
    if mode == 3:
        return F.expr(f"translate({seq}, 'C', 'T')" if mate == 1 else f"translate({seq}, 'G', 'A')")
    return F.expr(f"replace({seq}, 'CG', 'TG')" if mate == 1 else f"replace({seq}, 'CG', 'CA')")


def strip_open_cpg(seq: str, mate: int) -> Column:
    """Mode 4: mate 1 without a last C, mate 2 without a first G, whose CpG status is open."""
    if mate == 1:
        return F.expr(f"case when endswith({seq}, 'C') then substr({seq}, 1, length({seq}) - 1) else {seq} end")
    return F.expr(f"case when startswith({seq}, 'G') then substr({seq}, 2) else {seq} end")


def restore(seq: str, places: str, base: str) -> Column:
    """seq with *base* at the 0-based *places* (an array)."""
    inside = f"filter({places}, p -> p between 0 and length(s_) - 1)"
    return F.expr(bound(f"aggregate({inside}, s_, (s, p) -> overlay(s placing '{base}' from p + 1))", s_=seq))


def reverse_complement(seq: str) -> Column:
    return F.expr(f"reverse(translate({seq}, 'ACGT', 'TGCA'))")


def hex_join(places: str) -> Column:
    """Offsets as lower-case hexadecimal numbers with semicolons."""
    return F.expr(f"array_join(transform({places}, i -> lower(hex(i))), ';')")


def hex_split(text: str) -> Column:
    return F.expr(f"case when {text} = '' then array() else transform(split({text}, ';'), x -> cast(conv(x, 16, 10) as int)) end")


def level(protocol: str, c: str, t: str) -> Column:
    """Methylation in percent: methylated bases stay C in bisulfite data and become T in TAPS data; null without bases."""
    hit = t if protocol.upper() == "TAPS" else c
    return F.expr(f"case when {c} + {t} > 0 then cast({hit} as double) * 100 / ({c} + {t}) end")


def phred_error(qual: str) -> Column:
    """Probability of error of a quality character (offset 33)."""
    return F.expr(f"pow(10D, -(ascii({qual}) - 33) / 10D)")


def color_space(seq: str) -> Column:
    """Two-base encoding with a leading T: colours 0 to 3 by the pair of neighbouring bases."""
    number = "instr('ACGT', {}) - 1"
    pair = f"cast(({number.format('substr(s, i, 1)')}) ^ ({number.format('substr(s, i + 1, 1)')}) as string)"
    return F.expr(f"transform(array(concat('T', {seq})), s -> concat('T', array_join(transform(sequence(1, length(s) - 1), i -> {pair}), '')))[0]")


def percent_text(part: str, whole: str) -> Column:
    return F.expr(f"case when ({whole}) > 0 then format_string('%.2f %%', cast({part} as double) * 100 / ({whole})) else 'NA' end")


def thousands(value: str) -> Column:
    return F.format_number(F.col(value), 0)


def ct_ratio(seq: str) -> Column:
    """Share of C and T among the bases other than N."""
    clean = f"replace(upper({seq}), 'N', '')"
    return F.expr(f"cast(length({clean}) - length(translate({clean}, 'CT', '')) as double) / length({clean})")
