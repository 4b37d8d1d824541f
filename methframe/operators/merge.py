"""Reconciling the alignments of a read under both strand hypotheses, and undoing its conversion.

Hypothesis rows: (read_no, chr, pos, mapq, cigar, seq, qual, as_score, has_xs) for single reads; pairs have
pos1, cigar1, ... pos2, ...; as_score is then the sum of both mates, has_xs true if any mate has it, mapq that of mate 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cigar as C
from ..functions import reads as R

MIN_MAPQ = 2  # fixed value: below it a hit is kept only without another candidate place


def score_of(tags: str = "tags") -> Column:
    """The alignment score among a read's tags."""
    return F.expr(f"cast(regexp_extract(array_join({tags}, '\\t'), 'AS:i:(-?[0-9]+)', 1) as int)")


def has_second(tags: str = "tags") -> Column:
    """Whether the second tag is the score of another candidate place."""
    return F.expr(f"coalesce(startswith(try_element_at({tags}, 2), 'XS'), false)")


def pair_scores(tags1: str = "tags1", tags2: str = "tags2") -> tuple[Column, Column]:
    return score_of(tags1) + score_of(tags2), has_second(tags1) | has_second(tags2)


def merge_hypotheses(watson: DataFrame, crick: DataFrame) -> DataFrame:
    """One row per read that a hypothesis wins: the winner's columns and strand ('W' or 'C').

    A read with one hit needs mapq of at least 2, or no other place.  With two, the better
    score wins if its mapq is at least 2, and mapq is halved; equal scores lose both.
    """
    names = [c for c in watson.columns if c != "read_no"]
    w = watson.select("read_no", F.struct(*names).alias("w"))
    c = crick.select("read_no", F.struct(*names).alias("c"))
    both = w.join(c, "read_no", "full_outer")

    def good(side: str) -> str:
        return f"{side}.mapq >= {MIN_MAPQ}"

    winner = F.expr(
        f"case when c is null then case when {good('w')} or not w.has_xs then 'W' end "
        f"when w is null then case when {good('c')} or not c.has_xs then 'C' end "
        f"when c.as_score > w.as_score then case when {good('c')} then 'C' end "
        f"when c.as_score < w.as_score then case when {good('w')} then 'W' end end"
    )
    won = both.withColumn("strand", winner).where("strand is not null")
    won = won.withColumn("hit", F.expr("if(strand = 'W', w, c)")).withColumn("ambiguous", F.expr("w is not null and c is not null"))
    mapq = F.expr("if(ambiguous, shiftright(hit.mapq, 1), hit.mapq)").alias("mapq")
    return won.select("read_no", "strand", *[mapq if n == "mapq" else F.col(f"hit.{n}").alias(n) for n in names])


def strand_counts(merged: DataFrame) -> DataFrame:
    return merged.groupBy("strand").agg(F.count(F.lit(1)).alias("reads"))


def deconvert(df: DataFrame, mate: int = 1) -> DataFrame:
    """The original bases of aligned, converted reads (seq, qual, cigar, pos, strand, conv, end_qual).

    seq is as aligned: mates on the reverse side are reverse-complemented, so places count from its end and their bases are
    complemented.  A stripped end base comes back with its quality and a longer CIGAR;
    it lies before the read's first base for mate 1 on C and mate 2 on C, which moves pos by one.
    """
    n, end = "length(seq)", "end_qual is not null"
    if mate == 1:
        places = {"W": "conv", "C": f"transform(conv, p -> {n} - 1 - p)"}
    else:  # the stripped G counts as place 0 of the read
        places = {"W": f"transform(conv, p -> {n} - 1 + if({end}, 1, 0) - p)", "C": f"transform(conv, p -> p - if({end}, 1, 0))"}
    bases = {"W": "C", "C": "G"}
    out = df
    for s in "WC":
        out = out.withColumn(f"places_{s}", F.expr(places[s]))
    fixed = F.when(F.col("strand") == "W", R.restore("seq", "places_W", bases["W"])).otherwise(R.restore("seq", "places_C", bases["C"]))
    out = out.withColumn("seq", F.when(F.size("conv") > 0, fixed).otherwise(F.col("seq")))
    at_end = F.expr(f"{end} and strand = 'W'")
    at_start = F.expr(f"{end} and strand = 'C'")
    return out.withColumns(
        {
            "seq": F.when(at_end, F.concat("seq", F.lit("C"))).when(at_start, F.concat(F.lit("G"), "seq")).otherwise(F.col("seq")),
            "qual": F.when(at_end, F.concat("qual", "end_qual")).when(at_start, F.concat("end_qual", "qual")).otherwise(F.col("qual")),
            "cigar": F.when(at_end, C.extend_last("cigar")).when(at_start, C.extend_first("cigar")).otherwise(F.col("cigar")),
            "pos": F.when(at_start, F.col("pos") - 1).otherwise(F.col("pos")),
        }
    ).drop("places_W", "places_C")


# Flags of SAM (fixed values).
PAIRED, PROPER, UNMAPPED, REVERSE, MATE_REVERSE, FIRST, SECOND, SECONDARY, FAILED, SUPPLEMENTARY = 1, 2, 4, 16, 32, 64, 128, 256, 512, 2048


def has_flag(bits: int, flag: str = "flag") -> Column:
    return F.col(flag).bitwiseAND(bits) != 0


MATE = ("flag", "pos", "cigar", "seq", "qual", "tags")  # what a pair holds of each mate


def _linked(rows: DataFrame, strand: Column, *fields: str) -> DataFrame:
    """Primary aligned rows with _name, _mate (0: single), _strand, _missing (null for rows of pairs) and _other_x: x of a pair's other row, for these fields.

    Rows move once, by name, and each is judged by the two before and the two after it among those of its name.  Single rows and
    those without a name are dealt by their content, so that they make no group.  What the neighbours hold is taken column by column:
    a struct of them would be made before the rows move, and would move beside the columns that it repeats.
    """
    primary = rows.where(~has_flag(SECONDARY | SUPPLEMENTARY) & ~has_flag(UNMAPPED) & (F.col("chr") != "*"))
    mate = F.when(~has_flag(PAIRED), 0).when(has_flag(FIRST), 1).otherwise(2)
    one = primary.withColumns({"_name": F.coalesce(F.regexp_replace("qname", "/[12]$", ""), F.lit("*")), "_mate": mate, "_strand": strand})
    alone = (F.col("_mate") == 0) | (F.col("_name") == "*")
    one = one.withColumn("_apart", F.when(alone, F.xxhash64("pos", "seq", "qual")).otherwise(F.lit(0)))
    by = Window.partitionBy("_name", "_apart").orderBy("_mate")
    held = ("_mate", "_strand", "chr", *fields)
    near = {"_b2": F.lag("_mate", 2).over(by), "_a2": F.lead("_mate", 2).over(by)}
    near |= {f"_b1{c}": F.lag(c).over(by) for c in held} | {f"_a1{c}": F.lead(c).over(by) for c in held}
    before, after = F.col("_b1_mate").isNotNull(), F.col("_a1_mate").isNotNull()
    met = one.withColumns(near).withColumns({f"_other_{c.removeprefix('_')}": F.when(before, F.col(f"_b1{c}")).otherwise(F.col(f"_a1{c}")) for c in held})
    several = F.col("_b2").isNotNull() | F.col("_a2").isNotNull() | (before & after)
    why = F.when(F.col("_mate") == 0, "single").when(alone, "mate").when(several | (F.col("_other_mate") == F.col("_mate")), "repeated").when(F.col("_other_mate").isNull(), "mate")
    return met.withColumn("_missing", why.when(F.col("_other_chr") != F.col("chr"), "chromosome")).drop(*near, "_apart")


def link_mates(rows: DataFrame, strand: Column) -> tuple[DataFrame, DataFrame]:
    """(pairs, orphans) of SAM rows in any order (qname, flag, chr, pos, mapq, cigar, seq, qual, tags, ...).

    Pairs have a row a name: (name, chr, strand, mapq, pos1, cigar1, seq1, qual1, tags1, pos2, ...), with mate 1's mapping quality
    and strand, which is an expression over a row's columns.  A name makes a pair if it has one primary aligned row of
    each mate and both lie on one chromosome; a suffix /1 or /2 is not part of it.  Other primary rows, single
    reads included, are orphans, as they came, with what is missing: 'mate', 'chromosome', 'repeated' (several
    primary rows of a mate) or 'single'; rows without a name ('*' or null) lack a mate.  Secondary, supplementary and unaligned rows are in neither.
    """
    held = [c for c in rows.columns if c in MATE]
    linked = _linked(rows, strand, *held)
    mates = [F.col(f"{side}{c}").alias(f"{c}{k}") for k, side in ((1, ""), (2, "_other_")) for c in held]
    pairs = linked.where("_missing is null and _mate = 1").select(F.col("_name").alias("name"), "chr", F.col("_strand").alias("strand"), "mapq", *mates)
    return pairs, linked.where("_missing is not null").select(*rows.columns, F.col("_missing").alias("missing"))


def _tags(tags: str, strand: Column) -> Column:
    """A row's tags with its strand's tag once, last."""
    mark = F.when(strand == "W", "XG:Z:CT").otherwise("XG:Z:GA")
    return F.array_append(F.filter(F.coalesce(F.col(tags), F.array().cast("array<string>")), lambda t: ~t.startswith("XG:Z:")), mark)


def _name(df: DataFrame) -> Column:
    return F.coalesce(*[F.col(c).cast("string") for c in ("name", "id", "read_no") if c in df.columns])


def single_rows(merged: DataFrame) -> DataFrame:
    """Rows of SAM of single reads, with the strand tag."""
    name = _name(merged)
    df = merged if "tags" in merged.columns else merged.withColumn("tags", F.lit(None).cast("array<string>"))
    return df.select(
        name.alias("qname"), F.when(F.col("strand") == "W", 0).otherwise(REVERSE).alias("flag"), "chr", F.col("pos").cast("long").alias("pos"), F.col("mapq").cast("int").alias("mapq"), "cigar",
        F.lit("*").alias("rnext"), F.lit(0).cast("long").alias("pnext"), F.lit(0).cast("long").alias("tlen"), "seq", "qual", _tags("tags", F.col("strand")).alias("tags"),
    )


def pair_rows(pairs: DataFrame) -> DataFrame:
    """Rows of SAM of pairs, two for each: flags of an oriented pair, the other mate's place, the signed template length, the strand tag.

    On W mate 1 lies on the forward and mate 2 on the reverse side, on C it is the other way round; both have mate 1's mapping quality.
    """
    name = _name(pairs)
    end1, end2 = (F.col(f"pos{k}") + C.reference_length(f"cigar{k}") - 1 for k in (1, 2))
    span = F.greatest(end1, end2) - F.least("pos1", "pos2") + 1
    left1 = F.col("pos1") <= F.col("pos2")

    def mate(k: int, other: int, left: Column) -> Column:
        forward = (F.col("strand") == "W") == F.lit(k == 1)
        flag = F.lit(PAIRED | PROPER | (FIRST if k == 1 else SECOND)) + F.when(forward, MATE_REVERSE).otherwise(REVERSE)
        tags = _tags(f"tags{k}", F.col("strand")) if f"tags{k}" in pairs.columns else F.array(F.when(F.col("strand") == "W", "XG:Z:CT").otherwise("XG:Z:GA"))
        return F.struct(
            flag.alias("flag"), "chr", F.col(f"pos{k}").cast("long").alias("pos"), F.col("mapq").cast("int").alias("mapq"), F.col(f"cigar{k}").alias("cigar"), F.lit("=").alias("rnext"),
            F.col(f"pos{other}").cast("long").alias("pnext"), F.when(left, span).otherwise(-span).cast("long").alias("tlen"), F.col(f"seq{k}").alias("seq"), F.col(f"qual{k}").alias("qual"), tags.alias("tags"),
        )

    return pairs.select(name.alias("qname"), F.explode(F.array(mate(1, 2, left1), mate(2, 1, ~left1))).alias("m")).select("qname", "m.*")


def fix_mates(rows: DataFrame, strand: Column) -> DataFrame:
    """Rows of SAM with mate fields: pairs are linked by name and get each other's place, orphans lose theirs."""
    linked = _linked(rows, strand, "pos", "cigar", "mapq")
    paired, first = F.col("_missing").isNull(), F.col("_mate") == 1
    side = F.when(first, F.col("_strand")).otherwise(F.col("_other_strand"))  # mate 1's, as in pair_rows
    forward = (side == "W") == first
    flag = F.lit(PAIRED | PROPER) + F.when(first, FIRST).otherwise(SECOND) + F.when(forward, MATE_REVERSE).otherwise(REVERSE)
    end1, end2 = (F.col(f"{at}pos") + C.reference_length(f"{at}cigar") - 1 for at in ("", "_other_"))
    span = F.greatest(end1, end2) - F.least("pos", "_other_pos") + 1
    left = F.when(first, F.col("pos") <= F.col("_other_pos")).otherwise(F.col("pos") < F.col("_other_pos"))
    new = {
        "qname": (F.col("_name"), F.col("qname")), "flag": (flag, F.col("flag")), "mapq": (F.when(first, F.col("mapq")).otherwise(F.col("_other_mapq")), F.col("mapq")),
        "rnext": (F.lit("="), F.lit("*")), "pnext": (F.col("_other_pos"), F.lit(0)), "tlen": (F.when(left, span).otherwise(-span), F.lit(0)), "tags": (_tags("tags", side), F.col("tags")),
    }
    kinds = {"pos": "long", "pnext": "long", "tlen": "long"}
    names = ("qname", "flag", "chr", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual", "tags")
    shown = {c: F.when(paired, new[c][0]).otherwise(new[c][1]) if c in new else F.col(c) for c in names}
    return linked.select(*[(e.cast(kinds[c]) if c in kinds else e).alias(c) for c, e in shown.items()])


def sam_lines(rows: DataFrame) -> DataFrame:
    """Rows of SAM as text."""
    fields = [F.col(c).cast("string") for c in ("qname", "flag", "chr", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual")]
    return rows.select(F.concat_ws("\t", *fields, F.col("tags")).alias("value"))


def to_sam(merged: DataFrame) -> DataFrame:
    """SAM lines of single reads, or of both mates of pairs, with the strand tag."""
    return sam_lines(pair_rows(merged) if "pos2" in merged.columns else single_rows(merged))


def mate_fields(df: DataFrame) -> DataFrame:
    """Both mates' rows of pairs with the other's place and the signed template length (positive for the left mate)."""
    end1 = F.col("pos1") + C.reference_length("cigar1") - 1
    end2 = F.col("pos2") + C.reference_length("cigar2") - 1
    left_is_1 = F.col("pos1") <= F.col("pos2")
    span = F.greatest(end1, end2) - F.least("pos1", "pos2") + 1

    def mate(k: int, other: int, left: Column) -> Column:
        return F.struct(
            F.lit(k).alias("mate"), F.col(f"pos{k}").alias("pos"), F.col(f"cigar{k}").alias("cigar"), F.lit("=").alias("rnext"),
            F.col(f"pos{other}").alias("pnext"), F.when(left, span).otherwise(-span).cast("long").alias("tlen"),
        )

    return df.select("read_no", "chr", "strand", "mapq", F.explode(F.array(mate(1, 2, left_is_1), mate(2, 1, ~left_is_1))).alias("m")).select("read_no", "chr", "strand", "mapq", "m.*")
