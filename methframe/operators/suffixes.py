"""A full-text index of a genome: its suffix array, built by prefix doubling, and backward search over it.

Suffixes get the rank of their first FIRST letters; those that share a rank are ranked by the rank of the suffix behind
their known letters, which doubles what is known, until every rank is one suffix's own.  A round is a join by place and a
sort of what still shares ranks, all over partitions; no task holds a chromosome.  The letters before the suffixes, in
their order, are kept in blocks with counts, from which a pattern's range of ranks is found letter by letter from its
end: how often any pattern occurs is known without listing its places.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import stored
from .genome import LEAD, TILE, tiled, tiles
from .ordering import cumulated

FIRST = 16  # letters of the first ranks
BLOCK = 1 << 8  # letters of a block, which a step of the search carries and counts
END = " "  # stands behind a chromosome, before every letter


def _starts(genome: DataFrame, first: int) -> DataFrame:
    """(chr, pos, key, before): every suffix, the empty one included, with its first letters and the letter before it."""
    cut = tiles(genome, TILE, first) if not tiled(genome) else tiles(genome)
    # The last tile of a chromosome is the one that its bases do not fill.
    last = F.expr(f"length(piece) - {LEAD} < {TILE}") | F.lit(False)
    upto = F.expr(f"least({TILE}, length(piece) - {LEAD})")
    rows = cut.withColumn("last", last).select("chr", "tile", "piece", F.explode(F.sequence(F.lit(0), F.when(F.col("last"), upto).otherwise(upto - 1))).alias("i"))
    letters = F.expr(f"upper(cast(substr(piece, i + {LEAD + 1}, {first}) as string))")
    before = F.when((F.col("tile") == 0) & (F.col("i") == 0), END).otherwise(F.expr(f"upper(cast(substr(piece, i + {LEAD}, 1) as string))"))
    return rows.select("chr", F.expr(f"tile * {TILE} + i + 1").alias("pos"), F.rpad(letters, first, END).alias("key"), before.alias("before"))


@dataclass
class SuffixIndex:
    """suffixes (rank, chr, pos), blocks (block, letters, counts), heads (key, lo, n), smaller: letters before each letter in the order of suffixes."""

    suffixes: DataFrame
    blocks: DataFrame
    heads: DataFrame
    smaller: dict[str, int]
    total: int
    first: int


def build(genome: DataFrame, first: int = FIRST) -> SuffixIndex:
    """The index of a genome (chr, seq) or its tiles, upper-cased; for converted reads give the converted genome.

    Of equal suffixes that end at the ends of chromosomes the one of the smaller name comes first.
    """
    known = stored(_starts(genome, first))
    heads = stored(cumulated(known.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "key", weight="n", name="lo"))
    ranks = stored(known.join(heads, "key").select("chr", "pos", "before", F.col("lo").alias("rank"), "n"))
    length = first
    while ranks.where("n > 1").take(1):
        tied = ranks.where("n > 1")
        behind = ranks.select("chr", (F.col("pos") - length).alias("pos"), F.col("rank").alias("second"))
        # Nothing is known to stand behind a suffix that ends: it comes before all others, by its chromosome's name.
        paired = stored(tied.join(behind, ["chr", "pos"], "left").withColumn("ended", F.when(F.col("second").isNull(), F.col("chr")).otherwise("")).withColumn("second", F.coalesce("second", F.lit(-1))))
        groups = paired.groupBy("rank", "second", "ended").agg(F.count(F.lit(1)).alias("m"))
        groups = stored(cumulated(groups, "rank", "second", "ended", weight="m", name="place"))
        base = groups.groupBy("rank").agg(F.min("place").alias("base"))
        moved = groups.join(base, "rank").select("rank", "second", "ended", "m", (F.col("rank") + F.col("place") - F.col("base")).alias("new"))
        settled = paired.join(moved, ["rank", "second", "ended"]).select("chr", "pos", "before", F.col("new").alias("rank"), F.col("m").alias("n"))
        ranks = stored(ranks.where("n = 1").unionByName(settled))
        length *= 2
    total = ranks.count()
    block = F.floor(F.col("rank") / BLOCK).alias("block")
    lines = ranks.groupBy(block).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "before"))), lambda x: x["before"]), "").alias("letters"))
    alphabet = sorted(r["before"] for r in ranks.select("before").distinct().collect() if r["before"] != END)  # letters
    lines = stored(lines)
    counts = lines.select("block", *[(F.length("letters") - F.length(F.replace("letters", F.lit(a)))).cast("long").alias(f"n_{k}") for k, a in enumerate(alphabet)])
    for k in range(len(alphabet)):
        counts = cumulated(counts, "block", weight=f"n_{k}", name=f"c_{k}")
    by_letter = F.create_map(*[x for k, a in enumerate(alphabet) for x in (F.lit(a), F.col(f"c_{k}"))]) if alphabet else F.create_map().cast("map<string,bigint>")
    blocks = stored(lines.join(counts.select("block", by_letter.alias("counts")), "block"))
    found = ranks.groupBy("before").agg(F.count(F.lit(1)).alias("n")).collect()  # a row a letter
    many = {r["before"]: r["n"] for r in found}
    smaller, so_far = {}, many.get(END, 0)  # as many empty suffixes as chromosomes
    for a in alphabet:
        smaller[a] = so_far
        so_far += many[a]
    return SuffixIndex(ranks.select("rank", "chr", "pos"), blocks, heads, smaller, total, first)


def ranges(index: SuffixIndex, patterns: DataFrame) -> DataFrame:
    """patterns (pattern, ...) with lo and hi: the range of ranks of the suffixes that begin with the pattern; its length is how often it occurs.

    A pattern with a letter that the genome lacks occurs nowhere; null and empty patterns are left out.
    """
    names = patterns.columns
    k = index.first
    rows = patterns.where("pattern <> ''")
    tail = F.when(F.length("pattern") >= k, F.expr(f"substr(pattern, -{k})"))
    begun = rows.withColumn("key", tail).join(index.heads, "key", "left")
    whole = F.length("pattern") >= k
    state = begun.select(
        *names, F.when(whole, F.coalesce("lo", F.lit(0))).otherwise(0).cast("long").alias("lo"), F.when(whole, F.coalesce(F.col("lo") + F.col("n"), F.lit(0))).otherwise(index.total).cast("long").alias("hi"),
        F.when(whole, F.length("pattern") - k).otherwise(F.length("pattern")).alias("left"),
    )
    before = F.create_map(*[x for a, n in index.smaller.items() for x in (F.lit(a), F.lit(n).cast("long"))]) if index.smaller else F.create_map().cast("map<string,bigint>")
    steps = state.agg(F.max("left")).first()[0] or 0
    blocks = index.blocks

    def occurs(side: str, letters: Column, counts: Column) -> Column:
        """How often the letter stands among the first `side` ranks."""
        part = F.substring(letters, F.lit(1), ((F.col(side) - 1) % BLOCK + 1).cast("int"))
        return F.when(F.col(side) == 0, 0).otherwise(F.coalesce(counts[F.col("c")], F.lit(0)) + F.length(part) - F.length(F.replace(part, F.col("c"))))

    for step in range(steps):
        going = (F.col("left") > 0) & (F.col("hi") > F.col("lo"))
        state = state.withColumn("c", F.when(going, F.expr("substr(pattern, left, 1)")))  # null: done, meets no block
        for side in ("lo", "hi"):
            there = blocks.select(F.col("block").alias("_block"), F.col("letters").alias(f"letters_{side}"), F.col("counts").alias(f"counts_{side}"))
            state = state.withColumn("_block", F.when(F.col("c").isNotNull(), F.expr(f"greatest(0, {side} - 1) div {BLOCK}"))).join(there, "_block", "left").drop("_block")
        start = before[F.col("c")]
        low, high = (F.when(F.col("c").isNull(), F.col(s)).otherwise(F.coalesce(start + occurs(s, F.col(f"letters_{s}"), F.col(f"counts_{s}")), F.lit(0))) for s in ("lo", "hi"))
        state = state.select(*names, low.alias("lo"), high.alias("hi"), (F.col("left") - 1).alias("left"))
        if step % 8 == 7:
            state = stored(state)
    hit = F.col("hi") > F.col("lo")
    return state.select(*names, F.when(hit, F.col("lo")).otherwise(0).alias("lo"), F.when(hit, F.col("hi")).otherwise(0).alias("hi"))


def places(index: SuffixIndex, found: DataFrame, most: int | None = None) -> DataFrame:
    """found (lo, hi, ...) with chr and pos of every occurrence, or of the first `most` in the order of suffixes."""
    hi = F.least(F.col("hi"), F.col("lo") + most) if most else F.col("hi")
    return found.where("hi > lo").withColumn("rank", F.explode(F.sequence(F.col("lo"), hi - 1))).join(index.suffixes, "rank").drop("rank")
