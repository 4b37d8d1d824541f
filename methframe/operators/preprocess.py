"""Reads before alignment: cropping, base composition, trimming, conversion and counters.

Reads are rows (read_no, id, seq, qual); pairs are rows (read_no, id1, seq1, qual1, id2, seq2, qual2).
All steps are projections, so a chain of them is one scan; only composition and counters aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import batches as B
from ..functions import reads as R


def zip_pairs(first: DataFrame, second: DataFrame) -> DataFrame:
    """Mates of equal read_no, both cut to the shorter one's length."""
    a = first.select("read_no", *[F.col(c).alias(f"{c}1") for c in ("id", "seq", "qual")])
    b = second.select("read_no", *[F.col(c).alias(f"{c}2") for c in ("id", "seq", "qual")])
    return equal_mates(a.join(b, "read_no"))


def equal_mates(pairs: DataFrame) -> DataFrame:
    n = "least(length(seq1), length(seq2))"
    return pairs.withColumns({c: F.expr(f"substr({c}, 1, {n})") for c in ("seq1", "qual1", "seq2", "qual2")})


def crop(df: DataFrame, cycle: int) -> DataFrame:
    """The first *cycle* bases and qualities of every mate; 0 leaves them."""
    names = [c for c in df.columns if c.startswith(("seq", "qual"))]
    return df.withColumns({c: R.crop(c, cycle) for c in names}) if cycle else df


def detect_cycle(reads: DataFrame, first: int = 9_999) -> DataFrame:
    """The longest of the first reads of the input."""
    return reads.where(F.col("read_no") < first).agg(F.max(F.length("seq")).alias("cycle"))


def composition(df: DataFrame) -> DataFrame:
    """(mate, cycle, A, C, G, T, N) of cropped, untrimmed reads; lower case counts, anything else is N.

    Bases are split within the row and added up in map tasks: the shuffle has five counts per cycle and task.
    """
    mates = [c for c in ("seq", "seq1", "seq2") if c in df.columns]
    both = F.array(*[F.struct(F.lit(1 if m == "seq" else int(m[-1])).alias("mate"), F.upper(m).alias("seq")) for m in mates])
    one = df.select(F.explode(both).alias("m")).select("m.mate", F.posexplode(F.split("m.seq", "")).alias("i", "base"))
    known = {b: F.count_if(F.col("base") == b) for b in "ACGT"}
    other = F.count_if(~F.col("base").isin(*"ACGT") & (F.col("base") != "")).alias("N")
    out = one.where("base <> ''").groupBy("mate", (F.col("i") + 1).alias("cycle"))
    return out.agg(*[e.cast("long").alias(b) for b, e in known.items()], other)


def composition_percent(counts: DataFrame) -> DataFrame:
    total = F.col("A") + F.col("C") + F.col("G") + F.col("T") + F.col("N")
    return counts.select("mate", "cycle", *[(F.col(b).cast("double") * 100 / total).alias(b) for b in "ACGTN"])


def composition_limit(percents: DataFrame) -> DataFrame:
    """Upper end of the drawn axis."""
    return percents.agg(F.least(F.lit(100.0), F.max(F.greatest(*"ACGTN")) + 10).alias("y_max"))


def trim(df: DataFrame, kit: str = "illumina", min_qual: int = 53, min_size: int = 20) -> DataFrame:
    """df with trimmed sequences and qualities and the columns

    trimmed_length (after the quality cut), adapter_at, tail (bases cut for a partial adapter) and
    dropped.  Rows are not filtered, so that counters can follow; min_qual is a character code.
    """
    pair = "seq2" in df.columns
    seqs, quals = (["seq1", "seq2"], ["qual1", "qual2"]) if pair else (["seq"], ["qual"])
    found = B.trimming(kit, min_qual, min_size, seqs, quals)
    out = df.withColumn("found_", found).withColumns({c: F.col(f"found_.{c}") for c in ("trimmed_length", "adapter_at", "tail")}).drop("found_")

    def cut(frame: DataFrame, length: str) -> DataFrame:
        return frame.withColumns({c: F.expr(f"substr({c}, 1, {length})") for c in (*seqs, *quals)})

    out = cut(out, "trimmed_length")
    kept = F.coalesce(F.col("adapter_at"), F.length(seqs[0]) - F.col("tail"))
    out = out.withColumn("kept_length", kept).withColumn("dropped", (F.col("trimmed_length") < min_size) | (F.col("kept_length") < min_size))
    return cut(out, "kept_length").drop("kept_length")


def trim_counters(trimmed: DataFrame) -> DataFrame:
    """(total, dropped, adapter, tail): adapter also counts reads it leaves too short; tail only cut reads that stay."""
    return trimmed.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("dropped").alias("dropped"),
        F.count_if(F.col("adapter_at").isNotNull()).alias("adapter"),
        F.count_if((F.col("tail") > 0) & ~F.col("dropped")).alias("tail"),
    )


def kept(trimmed: DataFrame) -> DataFrame:
    return trimmed.where(~F.col("dropped")).drop("trimmed_length", "adapter_at", "tail", "dropped")


def convert(df: DataFrame, mode: int = 3) -> DataFrame:
    """Converted sequences with what undoes the conversion: conv (places of converted bases) and, in mode 4, the quality of a stripped end.

    Places count in the read before anything is stripped.  For mate 2 they are those of G.
    """
    mates = [(s, 2 if s == "seq2" else 1) for s in ("seq", "seq1", "seq2") if s in df.columns]
    new = {}
    for seq, mate in mates:
        tag = seq[3:]
        base = "C" if mate == 1 else "G"
        if mode == 3:
            new |= {seq: R.convert(seq, mate, 3), f"conv{tag}": B.offsets(seq, base)}
            continue
        qual = f"qual{tag}"
        open_end = f"endswith({seq}, 'C')" if mate == 1 else f"startswith({seq}, 'G')"
        edge = f"substr({qual}, length({qual}), 1)" if mate == 1 else f"substr({qual}, 1, 1)"
        rest = f"substr({qual}, 1, length({qual}) - 1)" if mate == 1 else f"substr({qual}, 2)"
        places = B.offsets(seq, "CG", mate - 1)
        new |= {
            f"conv{tag}": places,
            f"end_qual{tag}": F.expr(f"case when {open_end} then {edge} end"),
            seq: F.expr(f"replace({_stripped(seq, mate)}, 'CG', '{'TG' if mate == 1 else 'CA'}')"),
            qual: F.expr(f"case when {open_end} then {rest} else {qual} end"),
        }
    return df.withColumns(new)


def _stripped(seq: str, mate: int) -> str:
    if mate == 1:
        return f"case when endswith({seq}, 'C') then substr({seq}, 1, length({seq}) - 1) else {seq} end"
    return f"case when startswith({seq}, 'G') then substr({seq}, 2) else {seq} end"


def packed_ids(converted: DataFrame, mode: int = 3) -> DataFrame:
    """(name1[, name2]): read names that carry line number and conversion for text interchange."""
    pair = "seq2" in converted.columns
    tag = "1" if pair else ""

    def body(t: str) -> str:
        edge = f"case when end_qual{t} is null then '' else concat(end_qual{t}, '|') end" if mode == 4 else "''"
        return f"concat({edge}, array_join(transform(conv{t}, i -> lower(hex(i))), ';'))"

    name = f"regexp_extract(id{tag}, '^@?(\\\\S+)', 1)"
    new = {"name1": F.expr(f"concat('@', lower(hex(read_no)), '+', {body(tag)}, '#', {name})")}
    if pair:
        other = "regexp_extract(id2, '^@?(\\\\S+)', 1)"
        new["name2"] = F.expr(f"concat('@', {body('2')}, '#', {other})")
    return converted.withColumns(new)


def unpack_ids(df: DataFrame, name: str = "name1") -> DataFrame:
    """line (of mate 1), end_qual and conv from a packed name."""
    head = f"regexp_extract({name}, '^@?([^#]*)#', 1)"
    line = f"regexp_extract({head}, '^([0-9a-f]+)[+]', 1)"
    rest = f"regexp_replace({head}, '^[0-9a-f]+[+]', '')"
    places = f"regexp_replace({rest}, '^.[|]', '')"
    return df.withColumns(
        {
            "line": F.expr(f"case when {line} <> '' then cast(conv({line}, 16, 10) as bigint) end"),
            "end_qual": F.expr(f"case when {rest} rlike '^.[|]' then substr({rest}, 1, 1) end"),
            "conv": R.hex_split(places),
            "id": F.expr(f"regexp_extract({name}, '#(.*)$', 1)"),
        }
    )
