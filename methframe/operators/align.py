"""A seed-and-extend aligner of converted reads, single or paired, with gaps.

Runs normally take alignments from an external aligner.  This one serves where none is at hand.  Exact seeds of a read,
end to end, are looked up in a k-mer table of the converted genome; at each place the read is aligned end to end within a band by
dynamic programming with affine gaps, many reads and places at a time.  Scores follow the usual scheme: 0 for a match,
MISMATCH for a mismatch, AMBIGUOUS for a base that is not known, OPEN and EXTEND for gaps (none within BARRIER bases of an end), and at
least MIN_SCORE per base.  A valid alignment spoils at most one seed for each mismatch or gap, and a read of 40 bases or more has
more seeds of 20 than that (shorter ones with seeds of 15), so every valid place has an intact one.

A seed that occurs more than MAX_PLACES times gives its first MAX_PLACES places only, so that reads and places of a
repeat do not all meet.  What score a place may have that was not found for this is known, and counts as the second best;
with every_place all places of all seeds are checked.
The mapping quality only tells unique (42), better than another place (30) and ambiguous (1).
Reads of equal converted sequences have equal places: each sequence (of pairs, each pair of them) is aligned once, and its
places go to all reads that have it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cigar as C
from ..storage import stored
from .genome import LISTED, kmers, tiled, with_reference

MISMATCH, AMBIGUOUS, OPEN, EXTEND = 6, 1, 5, 3  # a gap of n bases costs OPEN + n * EXTEND
MIN_SCORE = -0.2
BARRIER = 4
SEED = 20
MAX_PLACES = 64
WIDE = 16  # places of a mate at most that meet those of the other within a row
CELLS = 1 << 22  # of the tables of a batch of alignments

_BEYOND = -1_000_000  # below any score


def longest_gap(length: int) -> int:
    """Bases of the longest gap that a valid alignment of a read can have."""
    return max(0, int((-MIN_SCORE * length - OPEN + 1e-9) // EXTEND))


def band_align(reads: np.ndarray, refs: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(scores, starts, CIGARs) of reads (n, L) within references (n, L + 2 * gap), given as codes of letters; 'X' lies beyond a chromosome.

    The best end-to-end alignment; of equal ones that which ends nearest to the middle of the band, with its gaps as far right as can be.
    """
    n, length = reads.shape
    width = 2 * gap + 1
    unknown, outside = ord("N"), ord("X")

    def cost(i: int) -> np.ndarray:
        here, there = reads[:, i, None], refs[:, i : i + width]
        out = np.where(here == there, 0, -MISMATCH)
        out = np.where((here == unknown) | (there == unknown), -AMBIGUOUS, out)
        return np.where(there == outside, _BEYOND, out)

    best, inserted = np.zeros((n, width), np.int64), np.full((n, width), _BEYOND * 4)
    ways = np.zeros((length, n, width), np.uint8)  # bits: 0-1 how a cell is reached (0 both advance, 1 insertion, 2 deletion), 2 insertion goes on, 3 deletion goes on
    for i in range(length):
        following = best + cost(i)
        way = np.zeros((n, width), np.uint8)
        opened = np.full((n, width), _BEYOND * 4)
        if BARRIER <= i < length - BARRIER:
            begin, go_on = best[:, 1:] - OPEN - EXTEND, inserted[:, 1:] - EXTEND
            opened[:, :-1] = np.maximum(begin, go_on)
            way[:, :-1] |= (go_on > begin).astype(np.uint8) << 2
            way |= (opened > following).astype(np.uint8)
            following = np.maximum(following, opened)
        if BARRIER <= i + 1 <= length - BARRIER:
            deleted = np.full(n, _BEYOND * 4)
            for k in range(1, width):
                begin, go_on = following[:, k - 1] - OPEN - EXTEND, deleted - EXTEND
                deleted = np.maximum(begin, go_on)
                way[:, k] |= (go_on > begin).astype(np.uint8) << 3
                better = deleted > following[:, k]
                way[better, k] = way[better, k] & 0b1100 | 2
                following[:, k] = np.maximum(following[:, k], deleted)
        best, inserted, ways[i] = following, opened, way
    columns = np.argsort(np.abs(np.arange(width) - gap), kind="stable")
    k = columns[np.argmax(best[:, columns], axis=1)]
    rows = np.arange(n)
    score = best[rows, k]
    i, state = np.full(n, length), np.zeros(n, np.uint8)
    steps: list[np.ndarray] = []
    while (i > 0).any():
        on = i > 0
        way = np.where(on, ways[np.maximum(i, 1) - 1, rows, k], 0)
        state = np.where(state == 0, way & 3, state)
        op = np.where(on, np.array([ord("M"), ord("I"), ord("D")])[state], 0).astype(np.uint8)
        steps.append(op)
        going = np.where(state == 1, way >> 2 & 1, np.where(state == 2, way >> 3 & 1, 0))
        i = i - (on & (state != 2))
        k = k + np.where(on & (state == 1), 1, np.where(on & (state == 2), -1, 0))
        state = np.where(going == 1, state, 0)
    lines = np.array(steps)[::-1].T
    cigars = ["".join(f"{len(list(run))}{chr(op)}" for op, run in groupby(line[line > 0].tolist())) for line in lines]
    return score, k - gap, cigars


def _extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """as_score, shift of the place and CIGAR for rows of (have, ..., want, ahead): converted read, reference around it, bases of it before the place."""
    for batch in batches:
        have, want, ahead = (batch.column(batch.schema.names.index(c)).to_pylist() for c in ("have", "want", "ahead"))
        lengths = np.array([len(h) for h in have])
        score, shift, cigar = np.full(len(have), _BEYOND, np.int64), np.zeros(len(have), np.int64), np.array([""] * len(have), object)
        for length in np.unique(lengths[lengths > 0]).tolist():
            gap = longest_gap(length)
            rows = np.flatnonzero(lengths == length)
            step = max(1, CELLS // (length * (2 * gap + 1)))
            for at in (rows[k : k + step] for k in range(0, len(rows), step)):
                reads = np.frombuffer("".join(have[r] for r in at).encode("latin-1"), np.uint8).reshape(len(at), length)
                around = ["X" * (gap - ahead[r]) + want[r] for r in at]
                refs = np.frombuffer("".join(w[: length + 2 * gap].ljust(length + 2 * gap, "X") for w in around).encode("latin-1"), np.uint8).reshape(len(at), length + 2 * gap)
                # Without gaps first: what loses less than the least gap costs cannot be bettered.
                score[at], shift[at], plain = band_align_ungapped(reads, refs[:, gap : gap + length])
                cigar[at] = f"{length}M"
                if gap:
                    more = np.flatnonzero(plain > OPEN + EXTEND)
                    if len(more):
                        score[at[more]], shift[at[more]], cigar[at[more]] = band_align(reads[more], refs[more], gap)
        names = [c for c in batch.schema.names if c not in ("want", "ahead")]
        kept = score >= MIN_SCORE * lengths - 1e-9
        out = pa.RecordBatch.from_arrays([*(batch.column(batch.schema.names.index(c)) for c in names), pa.array(score, pa.int32()), pa.array(shift), pa.array(cigar, pa.string())], names=[*names, "as_score", "shift", "cigar"])
        yield out.filter(pa.array(kept))


def band_align_ungapped(reads: np.ndarray, refs: np.ndarray) -> tuple[np.ndarray, int, np.ndarray]:
    """(scores, 0, losses) of reads against references of their length."""
    loss = np.where(reads == refs, 0, MISMATCH)
    loss = np.where((reads == ord("N")) | (refs == ord("N")), AMBIGUOUS, loss)
    total = np.where(refs == ord("X"), -_BEYOND, loss).sum(1)
    return np.maximum(-total, _BEYOND), 0, total


def _turned(strand: str, mate: int = 0) -> tuple[Column, Column]:
    """(seq, qual) as they lie on the forward sequence: single reads and mate 1 of hypothesis C, and mate 2 of W, are reverse-complemented."""
    tag = str(mate) if mate else ""
    if (strand == "W") == (mate < 2):
        return F.col(f"seq{tag}"), F.col(f"qual{tag}")
    return F.expr(f"reverse(translate(seq{tag}, 'ACGT', 'TGCA'))"), F.reverse(f"qual{tag}")


def oriented(reads: DataFrame, strand: str, mate: int = 0) -> DataFrame:
    """(read_no, seq, qual) of single reads or of one mate as they lie on the forward sequence."""
    seq, qual = _turned(strand, mate)
    return reads.select("read_no", seq.alias("seq"), qual.alias("qual"))


def _letters(strand: str) -> tuple[str, str]:
    return ("C", "T") if strand == "W" else ("G", "A")


def seed_index(genome: DataFrame, strand: str, seed: int = SEED) -> DataFrame:
    """(kmer, chr, pos) of the C-to-T (W) or G-to-A (C) converted genome."""
    letters = _letters(strand)
    if tiled(genome):
        return kmers(genome.withColumn("piece", F.translate(F.upper(F.col("piece").cast("string")), *letters).cast("binary")), seed)
    return kmers(genome.select("chr", F.translate(F.upper("seq"), *letters).alias("seq")), seed)


def seed_places(seeds: DataFrame, index: DataFrame, max_places: int = MAX_PLACES) -> DataFrame:
    """seeds (kmer, ...) with all their places (chr, pos) in the index; those of a frequent seed are dealt out in parts of about max_places."""
    often = index.groupBy("kmer").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_places).select("kmer", F.expr(f"cast(ceil(n / {max_places}) as int)").alias("parts"))
    rare = seeds.join(index.join(often, "kmer", "left_anti"), "kmer")
    dealt = index.join(often, "kmer").withColumn("part", F.expr("cast(pmod(xxhash64(chr, pos), parts) as int)")).drop("parts")
    asked = seeds.join(often, "kmer").withColumn("part", F.explode(F.expr("sequence(0, parts - 1)"))).drop("parts")
    return rare.unionByName(asked.join(dealt, ["kmer", "part"]).drop("part"))


def first_places(index: DataFrame, max_places: int = MAX_PLACES) -> DataFrame:
    """(kmer, places, crowded): the first places (chr, pos) of each k-mer, and whether there are more."""
    turn = F.row_number().over(Window.partitionBy("kmer").orderBy("chr", "pos"))
    few = index.withColumn("turn", turn).where(F.col("turn") <= max_places + 1)  # map tasks already leave out the rest
    held = few.groupBy("kmer").agg(F.collect_list(F.when(F.col("turn") <= max_places, F.struct("chr", "pos"))).alias("places"), F.max("turn").alias("turn"))
    return held.select("kmer", "places", (F.col("turn") > max_places).alias("crowded"))


def sequence_places(sequences: DataFrame, genome: DataFrame, strand: str, seed: int = SEED, max_places: int = MAX_PLACES, every_place: bool = False) -> DataFrame:
    """(have, chr, pos, cigar, as_score, unseen): all valid places found of oriented converted sequences (have), each given once.

    unseen is the best score that a place may have which was not found (null: none).  Places nearer to each other than the
    longest gap are one, of which the best stays (ties: the leftmost).
    """
    letters = _letters(strand)
    cut = sequences.where(F.length("have") >= seed).select("have", F.explode(F.expr(f"array_distinct(concat(sequence(0, length(have) - {seed}, {seed}), array(length(have) - {seed})))")).alias("at"))
    seeds = cut.select("have", "at", F.expr(f"substr(have, at + 1, {seed})").alias("kmer"))
    index = seed_index(genome, strand, seed)
    if every_place:
        one = seed_places(seeds, index, max_places).select("have", F.lit(None).cast("int").alias("unseen"), "chr", (F.col("pos") - F.col("at")).alias("pos")).distinct()
    else:
        met = seeds.join(first_places(index, max_places), "kmer")
        # A sequence's places are at most max_places for each of its seeds.
        at = F.expr("transform(places, p -> struct(p.chr as chr, p.pos - at as pos))")
        one = met.groupBy("have").agg(F.array_distinct(F.flatten(F.collect_list(at))).alias("places"), F.count_if("crowded").alias("crowds"))
        # A place that no other seed finds differs from the sequence in each of them.
        n = F.length("have")
        bound = (-MISMATCH * F.greatest(F.lit(0), F.floor(n / seed) - F.col("crowds"))).cast("int")
        unseen = F.when((F.col("crowds") > 0) & (bound >= MIN_SCORE * n), bound)
        one = one.select("have", unseen.alias("unseen"), F.explode("places").alias("p")).select("have", "unseen", "p.chr", "p.pos")
    gap = f"cast(greatest(0, floor(({-MIN_SCORE} * length(have) - {OPEN} + 1e-9) / {EXTEND})) as int)"
    rows = one.withColumn("gap", F.expr(gap)).withColumn("from", F.greatest(F.lit(1), F.col("pos") - F.col("gap"))).where("pos + length(have) + gap > 0")
    rows = with_reference(rows, genome, "from", "length(have) + 2 * gap").withColumn("ahead", (F.col("pos") - F.col("from")).cast("int"))
    rows = rows.select("have", "unseen", "chr", "pos", F.translate(F.upper(F.expr("substr(ref, 3, length(have) + 2 * gap)")), *letters).alias("want"), "ahead")
    found = rows.mapInArrow(_extended, "have string, unseen int, chr string, pos long, as_score int, shift long, cigar string").withColumn("pos", F.col("pos") + F.col("shift"))
    by = Window.partitionBy("have", "chr").orderBy("pos", "as_score", "cigar")
    near = F.col("pos") - F.lag("pos").over(by) <= F.expr(gap)
    island = F.sum(F.when(near, 0).otherwise(1)).over(by.rowsBetween(Window.unboundedPreceding, 0))
    best = Window.partitionBy("have", "chr", "island").orderBy(F.desc("as_score"), "pos", "cigar")
    kept = found.withColumn("island", island).withColumn("turn", F.row_number().over(best)).where("turn = 1")
    return kept.select("have", "chr", "pos", "cigar", "as_score", "unseen")


def _have(seq: str | Column, strand: str) -> Column:
    return F.replace(F.col(seq) if isinstance(seq, str) else seq, *(F.lit(c) for c in _letters(strand)))


def places(own: DataFrame, genome: DataFrame, strand: str, seed: int = SEED, max_places: int = MAX_PLACES, every_place: bool = False) -> DataFrame:
    """(read_no, seq, qual, chr, pos, cigar, as_score, unseen): all valid places found of oriented converted reads (read_no, seq, qual), as sequence_places finds them."""
    rows = own.withColumn("have", _have("seq", strand))
    found = sequence_places(rows.select("have").distinct(), genome, strand, seed, max_places, every_place)
    return rows.join(found, "have").select("read_no", "seq", "qual", "chr", "pos", "cigar", "as_score", "unseen")


def _best(rows: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The best of the rows of each of the keys, with its mapping quality and has_xs, by whether there is a second one or may be."""
    turns = Window.partitionBy(*keys).orderBy(F.desc("as_score"), *order)
    ranked = rows.withColumns({"turn": F.row_number().over(turns), "second": F.greatest("unseen", F.lead("as_score").over(turns))}).where("turn = 1")
    return ranked.withColumns(_quality()).drop("turn", "second", "unseen")


def _quality() -> dict[str, Column]:
    """The mapping quality and has_xs by the best score and the second one, if there is or may be any."""
    second = F.col("second")
    return {"mapq": F.when(second.isNull(), 42).when(second < F.col("as_score"), 30).otherwise(1), "has_xs": second.isNotNull()}


def align(reads: DataFrame, genome: DataFrame, strand: str, seed: int = SEED, max_places: int = MAX_PLACES, every_place: bool = False) -> DataFrame:
    """Hypothesis rows (read_no, chr, pos, mapq, cigar, seq, qual, as_score, has_xs) of converted reads (read_no, seq, qual).

    Of equal best places the smallest (chr, pos) is reported with has_xs.  Reads shorter than a seed have none.
    """
    rows = oriented(reads, strand).withColumn("have", _have("seq", strand))
    found = _best(sequence_places(rows.select("have").distinct(), genome, strand, seed, max_places, every_place), ["have"], "chr", "pos")
    return rows.join(found, "have").select("read_no", "chr", "pos", "mapq", "cigar", "seq", "qual", "as_score", "has_xs")


def align_pairs(pairs: DataFrame, genome: DataFrame, strand: str, min_ins: int = 0, max_ins: int = 1000, seed: int = SEED, max_places: int = MAX_PLACES, every_place: bool = False) -> DataFrame:
    """Hypothesis rows of converted pairs (read_no, seq1, qual1, seq2, qual2) whose mates lie on one chromosome, min_ins to max_ins bases apart.

    Mates lie opposite to one another; they may contain each other or reach beyond each other's start.  Pairs of which one
    mate has no place, or no places fit, have no row.  as_score is the sum of both.

    Sequences of both mates are aligned together, each once.  A pair whose mates have WIDE places at most takes them as two short
    lists, which are joined to it (by a broadcast where they are few) and meet within its row; places of other pairs meet by stretches of max_ins bases.
    """
    rows = stored(pairs.select("read_no", *[c.alias(f"{n}{mate}") for mate in (1, 2) for n, c in zip(("seq", "qual"), _turned(strand, mate), strict=True)]))
    rows = rows.withColumns({f"have{mate}": _have(f"seq{mate}", strand) for mate in (1, 2)})
    found = stored(sequence_places(rows.select(F.explode(F.array("have1", "have2")).alias("have")).distinct(), genome, strand, seed, max_places, every_place))
    found = found.withColumn("end", F.col("pos") + C.reference_length("cigar") - 1)
    lists = stored(_lists(found))
    n, crowds = lists.agg(F.sum(F.size("places")), F.max("crowded")).first()
    lists = F.broadcast(lists) if (n or 0) <= LISTED else lists
    met = rows
    for mate in (1, 2):
        met = met.join(lists.select(F.col("have").alias(f"have{mate}"), F.col("places").alias(f"places{mate}"), F.col("crowded").alias(f"crowded{mate}")), f"have{mate}")
    names = ["read_no", "chr", "mapq", *[f"{c}{k}" for k in (1, 2) for c in ("pos", "cigar", "seq", "qual")], "as_score", "has_xs"]
    out = _met_in_rows(met.where("not crowded1 and not crowded2"), min_ins, max_ins).select(names)
    if not crowds:
        return out
    hard = met.where("crowded1 or crowded2").drop("places1", "places2", "crowded1", "crowded2")
    keys = ["have1", "have2"]
    return out.unionByName(hard.join(_met_by_stretches(hard.select(keys).distinct(), found, min_ins, max_ins), keys).select(names))


def _lists(found: DataFrame) -> DataFrame:
    """(have, places, crowded): the places of each sequence, or none but a mark where they are more than WIDE."""
    turn = F.row_number().over(Window.partitionBy("have").orderBy("chr", "pos"))
    short = found.withColumn("turn", turn).where(F.col("turn") <= WIDE + 1)
    held = short.groupBy("have").agg(F.collect_list(F.struct("chr", "pos", "end", "cigar", "as_score", "unseen")).alias("places"))
    crowded = F.size("places") > WIDE
    return held.select("have", F.when(crowded, F.slice("places", 1, 0)).otherwise(F.col("places")).alias("places"), crowded.alias("crowded"))


def _met_in_rows(met: DataFrame, min_ins: int, max_ins: int) -> DataFrame:
    """The best pair of places of each row with the lists places1 and places2, as _best ranks them; rows without any go."""
    size = "greatest(a.end, b.end) - least(a.pos, b.pos) + 1"
    unseen = "greatest(a.unseen + b.as_score, a.as_score + b.unseen, a.unseen + b.unseen)"
    pair = f"struct(-(a.as_score + b.as_score) as loss, a.chr as chr, a.pos as pos1, b.pos as pos2, a.cigar as cigar1, b.cigar as cigar2, {unseen} as unseen)"
    fit = f"filter(places2, b -> b.chr = a.chr and {size} between {min_ins} and {max_ins})"
    pairs = F.expr(f"array_sort(flatten(transform(places1, a -> transform({fit}, b -> {pair}))))")
    ranked = met.withColumn("pairs", F.explode(F.array(pairs))).where(F.size("pairs") > 0)
    best = ranked.withColumns({"best": F.col("pairs")[0], "second": F.greatest(F.col("pairs")[0]["unseen"], -F.get("pairs", F.lit(1))["loss"])})
    return best.withColumns({"as_score": -F.col("best.loss"), **{c: F.col(f"best.{c}") for c in ("chr", "pos1", "pos2", "cigar1", "cigar2")}}).withColumns(_quality())


def _met_by_stretches(apart: DataFrame, found: DataFrame, min_ins: int, max_ins: int) -> DataFrame:
    """The best pair of places of each pair of sequences (have1, have2), whose places meet by stretches of max_ins bases."""
    keys = ["have1", "have2"]
    sides = []
    for mate in (1, 2):
        side = found.select(F.col("have").alias(f"have{mate}"), "chr", *[F.col(c).alias(f"{c}{mate}") for c in ("pos", "cigar", "as_score", "unseen", "end")])
        sides.append(apart.join(side, f"have{mate}"))
    stretch = lambda c: F.expr(f"{c} div {max(1, max_ins)}")
    first = sides[0].withColumn("near", stretch("pos1"))
    second = sides[1].withColumn("near", F.explode(F.array(*[stretch("pos2") + k for k in (-1, 0, 1)])))
    size: Column = F.greatest("end1", "end2") - F.least("pos1", "pos2") + 1
    met = first.join(second, [*keys, "chr", "near"]).where((size >= min_ins) & (size <= max_ins))
    summed = met.withColumns({"as_score": F.col("as_score1") + F.col("as_score2"), "unseen": F.greatest(F.col("unseen1") + F.col("as_score2"), F.col("as_score1") + F.col("unseen2"), F.col("unseen1") + F.col("unseen2"))})
    return _best(summed, keys, "chr", "pos1", "pos2")
