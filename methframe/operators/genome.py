"""Reference genomes: tiles for equi-joins, conversion, chromosome tables, TSS bins, CT-rich tiles."""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import reads as R

TILE = 1 << 16
SPAN = 1 << 12  # longest stretch of the reference that one row may look at
LEAD = 2  # bases before a tile that it also holds


#: Most names of a chromosome list that is broadcast.
LISTED = 100_000
_fit: weakref.WeakKeyDictionary[DataFrame, bool] = weakref.WeakKeyDictionary()


def few(listed: DataFrame) -> DataFrame:
    """A table of a row a chromosome, hinted for a broadcast if counted to have LISTED rows at most."""
    if listed not in _fit:
        _fit[listed] = len(listed.select(F.lit(1)).take(LISTED + 1)) <= LISTED
    return F.broadcast(listed) if _fit[listed] else listed


def tiled(genome: DataFrame) -> bool:
    """Whether a genome is given as tiles (chr, tile, piece, length) instead of whole sequences (chr, seq)."""
    return "piece" in genome.columns


def listed_names(genome: DataFrame) -> DataFrame:
    """(chr): every chromosome once."""
    return (genome.where("tile = 0") if tiled(genome) else genome).select("chr")


def names(genome: DataFrame) -> DataFrame:
    """The chromosomes' names; hinted for a broadcast if counted to be LISTED at most, or reads would be dealt by a few hot names."""
    listed = listed_names(genome)
    if genome not in _fit:
        _fit[genome] = len(listed.select(F.lit(1)).take(LISTED + 1)) <= LISTED
    return F.broadcast(listed) if _fit[genome] else listed


def tiles(genome: DataFrame, tile: int = TILE, span: int = SPAN) -> DataFrame:
    """(chr, tile, piece): piece (binary) starts LEAD bases before tile * TILE + 1 ('X' before the chromosome) and reaches span bases beyond the tile.

    Binary values are cut in time of the cut; strings would be walked from their start, a chromosome for each tile.

    A row at position pos joins on (chr, (pos - 1) div tile), so reads of one chromosome spread
    over its tiles and no task holds a genome.  The base at x is piece[x - tile * TILE + LEAD] (1-based).
    A genome that is read as tiles (sources.sequence.fasta_tiles) stays as it is, and must have been cut with this tile and span.
    """
    if tiled(genome):
        return genome.select("chr", "tile", "piece")
    padded = F.concat(F.lit("X" * LEAD), F.col("seq")).cast("binary")
    numbers = F.sequence(F.lit(0), F.expr(f"cast(greatest(0, (length(seq) - 1) div {tile}) as int)"))
    cut = genome.select("chr", F.explode(numbers).alias("tile"), padded.alias("padded"))
    return cut.select("chr", F.col("tile").cast("long").alias("tile"), F.expr(f"substr(padded, cast(tile * {tile} + 1 as int), {tile + span + 2 * LEAD})").alias("piece"))


def with_reference(df: DataFrame, genome: DataFrame, start: str, length: str, name: str = "ref", tile: int = TILE, span: int = SPAN) -> DataFrame:
    """df with the reference from LEAD bases before *start* to LEAD after its last base of *length*; rows on unknown chromosomes go.

    The planner broadcasts the tiles if they are small, else both sides are dealt by chromosome and tile.
    A row that reaches more than span bases beyond its tile raises: a larger span holds it.
    """
    joined = df.withColumn("tile", F.expr(f"({start} - 1) div {tile}")).join(tiles(genome, tile, span), ["chr", "tile"])
    far = f"{start} - tile * {tile} - 1 + {length} > {tile + span}"
    cut = f"cast(substr(piece, cast({start} - tile * {tile} as int), {length} + {2 * LEAD}) as string)"
    return joined.withColumn(name, F.expr(f"if({far}, raise_error('a row reaches more than {span} bases beyond its tile: raise span'), {cut})")).drop("piece", "tile")


def cpg_sites(genome: DataFrame, near: int, tile: int = TILE, span: int = SPAN) -> DataFrame:
    """(chr, near, locus, context): every CpG at its C, the stretch of so many bases in which it lies, and the reference from the base before to the base after it."""
    width = min(near, tile)
    parts = F.expr(f"sequence(0, cast(greatest(0, least({tile}, length(piece) - {LEAD}) - 1) div {width} as int))")
    cut = tiles(genome, tile, span).select("chr", "tile", "piece", F.explode(parts).alias("part"))
    # The base at o + 2 of a cut-out (1-based) is the o-th of its part.
    cut = cut.select("chr", F.expr(f"tile * {tile} + part * {width} + 1").alias("at"), F.expr(f"least({width}, {tile} - part * {width})").alias("own"), F.expr(f"cast(substr(piece, part * {width} + {LEAD}, {width + 3}) as string)").alias("cut"))
    each = cut.where("length(cut) > 2").select("chr", "at", "own", "cut", F.explode(F.expr("sequence(0, least(own - 1, length(cut) - 3))")).alias("o"))
    found = each.where("upper(substr(cut, o + 2, 2)) = 'CG'").withColumn("locus", F.col("at") + F.col("o"))
    return found.select("chr", F.expr(f"(locus - 1) div {near}").alias("near"), "locus", F.expr("substr(cut, o + 1, 4)").alias("context"))


def prepare(raw: DataFrame, control: DataFrame | None = None) -> DataFrame:
    """Names with the prefix 'chr', upper-case sequences, and the control sequence if given."""
    out = raw.unionByName(control) if control is not None else raw
    named = F.when(F.col("chr").startswith("chr"), F.col("chr")).otherwise(F.concat(F.lit("chr"), "chr"))
    return out.select(named.alias("chr"), F.upper("seq").alias("seq"))


def chr_info(genome: DataFrame) -> DataFrame:
    if tiled(genome):
        return genome.where("tile = 0").select("chr", F.col("length").cast("long").alias("length"))
    return genome.select("chr", F.length("seq").cast("long").alias("length"))


def converted(genome: DataFrame) -> DataFrame:
    """(chr, cg2tg, cg2ca, c2t, g2a): the four references that aligners index."""
    return genome.select(
        "chr",
        F.expr("replace(seq, 'CG', 'TG')").alias("cg2tg"),
        F.expr("replace(seq, 'CG', 'CA')").alias("cg2ca"),
        F.translate("seq", "C", "T").alias("c2t"),
        F.translate("seq", "G", "A").alias("g2a"),
    )


def conversion_counts(genome: DataFrame) -> DataFrame:
    """(cg, c, g): how many sites each conversion changes."""
    n = F.length("seq")
    return genome.agg(
        F.sum(((n - F.length(F.expr("replace(seq, 'CG', '')"))) / 2).cast("long")).alias("cg"),
        F.sum((n - F.length(F.translate("seq", "C", ""))).cast("long")).alias("c"),
        F.sum((n - F.length(F.translate("seq", "G", ""))).cast("long")).alias("g"),
    )


def kmers(genome: DataFrame, k: int = 20, tile: int = TILE) -> DataFrame:
    """(kmer, chr, pos): a seed index of the genome."""
    pieces = tiles(genome, tile, k)
    at = F.expr(f"sequence(0, least({tile}, length(piece) - {LEAD} - {k} + 1) - 1)")
    rows = pieces.where(f"length(piece) >= {LEAD + k}").select("chr", "tile", "piece", F.explode(at).alias("i"))
    return rows.select(F.expr(f"cast(substr(piece, i + {LEAD + 1}, {k}) as string)").alias("kmer"), "chr", F.expr(f"tile * {tile} + i + 1").alias("pos"))


def tss_bins(refgene: DataFrame, bins: int = 20, width: int = 200, min_length: int = 1000) -> DataFrame:
    """41 bins of 200 bp around every transcription start (chr, start, end, gene, distance, strand).

    Genes of named chromosomes only, at least 1 kb long and no small RNA; of genes that share chromosome, start and
    strand the last one by name stays.
    """
    named = refgene.where(F.col("chr").rlike("^chr[0-9XY]+$") & ~F.col("gene").rlike("^(MIR|SNO)") & (F.col("tx_end") - F.col("tx_start") >= min_length))
    tss = F.when(F.col("strand") == "+", F.col("tx_start")).otherwise(F.col("tx_end"))
    one = named.groupBy("chr", tss.alias("tss"), "strand").agg(F.max("gene").alias("gene"))
    steps = one.withColumn("s", F.explode(F.sequence(F.lit(-bins), F.lit(bins))))
    start = F.when(F.col("strand") == "+", F.col("tss") + width * F.col("s")).otherwise(F.col("tss") - width * F.col("s") - width)
    return steps.select("chr", start.cast("long").alias("start"), (start + width).cast("long").alias("end"), "gene", (F.col("s") * width).cast("int").alias("distance"), "strand")


def ct_rich(genome: DataFrame, width: int = 1000, threshold: float = 0.7) -> DataFrame:
    """(chr, start, end, ratio) of tiles rich in C and T, or in G and A: full to 90 % at least and with 10 % N at most."""
    cut = genome.select("chr", F.col("seq").cast("binary").alias("seq"), F.explode(F.sequence(F.lit(0), F.expr(f"cast((length(seq) - 1) div {width} as int)"))).alias("t"))
    cut = cut.select("chr", F.expr(f"cast(t * {width} as bigint)").alias("start"), F.expr(f"upper(cast(substr(seq, t * {width} + 1, {width}) as string))").alias("s"))
    n = F.length("s")
    known = F.length(F.expr("replace(s, 'N', '')"))
    cut = cut.where((n >= 0.9 * width) & (n - known <= 0.1 * n) & (known > 0)).withColumn("ratio", R.ct_ratio("s"))
    return cut.where((F.col("ratio") >= threshold) | (F.col("ratio") <= 1 - threshold)).select("chr", "start", (F.col("start") + n).alias("end"), "ratio")


def mirror(bed: DataFrame, info: DataFrame) -> DataFrame:
    """Intervals on the reverse complement of their chromosome (1-based inclusive places)."""
    joined = bed.join(few(info), "chr")
    return joined.select("chr", (F.col("length") + 1 - F.col("end")).alias("start"), (F.col("length") + 1 - F.col("start")).alias("end"))
