"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

Each document is repeated by a Poisson number whose mean is its source's target
repetition rate.  The number is drawn by inversion: a hash of seed and id gives
a uniform value, and the number is the count of cumulative probabilities at or
below it.  A mean above PART_MEAN is the sum of that many equal parts as keep each below it,
drawn one by one with a hash of seed, id and part: sums of Poisson numbers are Poisson numbers,
and table and work stay in proportion to the copies, whatever the mean.
Copies are then dealt out by a hash, which shuffles them globally.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import at_most, fresh, partitions, stash, without

_HEX = 13  # hexadecimal digits: 52 bits, exact in a double
PART_MEAN = 32.0
STRIDE = 256  # more than a part's table of cumulative probabilities is long
SOURCES = 4096  # broadcast tables have as many rows at most, of 131 numbers at most
HOT_SHARE = 1000  # a source with at least one in so many rows is broadcast in any case
_BLOCK = 4096  # parts of a draw that one array holds


def _uniform(*parts: Column) -> Column:
    """A value in [0, 1) from the MD5 of the parts joined by a colon."""
    digits = F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, _HEX)
    return F.conv(digits, 16, 10).cast("long").cast("double") / F.lit(float(1 << (4 * _HEX)))


def _cumulative(rate: Column) -> Column:
    """P(X <= k) for k from 0 to far beyond the mean (PART_MEAN at most) of a Poisson distribution, summed in logarithms."""
    top = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    start = F.struct(F.lit(0.0).alias("log_factorial"), F.exp(-rate).alias("total"), F.array(F.exp(-rate)).alias("cdf"))

    def step(s: Column, k: Column) -> Column:
        log_factorial = s["log_factorial"] + F.log(k.cast("double"))
        total = s["total"] + F.exp(-rate + k * F.log(rate) - log_factorial)
        return F.struct(log_factorial.alias("log_factorial"), total.alias("total"), F.concat(s["cdf"], F.array(total)).alias("cdf"))

    return F.aggregate(F.sequence(F.lit(1), top), start, step)["cdf"]


def source_rates(df: DataFrame, source_col: str, text_col: str, weights: dict[str, float] | None, epochs: float) -> DataFrame:
    """(name, rate, documents): mean repetitions of a source's documents so that its share of characters meets its weight, and their number.

    weights: by source name, sources left out get none; null: proportional to the square root of a source's characters.
    """
    sizes = df.groupBy(F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("name")).agg(F.sum(F.coalesce(F.length(text_col), F.lit(0)).cast("long")).alias("chars"), F.count(F.lit(1)).alias("documents"))
    if weights is None:
        weighted = sizes.withColumn("weight", F.sqrt(F.col("chars").cast("double")))
    else:
        named = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair]) if weights else F.lit(None).cast("map<string,double>")
        weighted = sizes.withColumn("weight", F.coalesce(named[F.col("name")].cast("double"), F.lit(0.0)))
    totals = weighted.agg(F.sum("weight").alias("all_weight"), F.sum("chars").alias("all_chars"))
    share = F.col("weight") / F.col("all_weight") * F.col("all_chars") * F.lit(float(epochs)) / F.col("chars")
    rate = F.when((F.col("chars") > 0) & (F.col("weight") > 0), share).otherwise(F.lit(0.0))
    return weighted.join(F.broadcast(totals)).select("name", rate.alias("rate"), "documents")  # totals: one row


def _with_tables(df: DataFrame, name: str, tables: DataFrame, rate_name: str, documents: str) -> DataFrame:
    """df joined with the tables of its rows' sources; rows of other sources go.

    Few tables are broadcast.  Of more, those of hot sources are (HOT_SHARE at most), and the other sources, none of
    which has a larger share of the rows, meet theirs by a shuffle.
    """
    on = F.col(name) == F.col(rate_name)
    if at_most(tables, SOURCES):
        return df.join(F.broadcast(tables), on)
    whole = tables.agg(F.sum(documents)).first()[0]
    hot = F.broadcast(tables.where(F.col(documents) * HOT_SHARE >= whole))
    cold = tables.where(F.col(documents) * HOT_SHARE < whole)
    return df.join(hot, on).unionByName(df.join(hot, on, "left_anti").join(cold.hint("shuffle_hash"), on))


def mix_sources(
    df: DataFrame,
    weights: dict[str, float] | None = None,
    epochs: float = 1.0,
    seed: int = 17,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    order_col: str = "order_key",
    copy_col: str = "replica",
) -> DataFrame:
    """The documents, each as often as its draw says, dealt out by order_col.

    All columns of df stay; copy_col (long) numbers a document's copies: from 1 on in the first part of its draw (the only
    one where the mean is at most PART_MEAN), from STRIDE + 1 on in the second, and so on.  order_col
    (32 hexadecimal digits) is sorted within partitions that are dealt by it, so reading
    the partitions in any order gives a random order.  Columns of these two names are replaced.
    A null source is the source ''.  A null id draws like the text 'null'.  Rows that repeat
    an id get the same draw.  Sources without characters or weight give no rows, null and empty
    texts of other sources are drawn like the rest; an empty table gives none.
    """
    df = without(df, order_col, copy_col)
    name, draw, cdf, rate_name, parts, block, part, documents = fresh(df, "mix_source", "mix_draw", "mix_cdf", "mix_name", "mix_parts", "mix_block", "mix_part", "mix_documents")
    rates = source_rates(df, source_col, text_col, weights, epochs).filter("rate > 0")
    rates = rates.withColumn(parts, F.greatest(F.ceil(F.col("rate") / PART_MEAN).cast("long"), F.lit(1).cast("long")))
    tables = stash(rates.select(F.col("name").alias(rate_name), parts, F.col("documents").alias(documents), _cumulative(F.col("rate") / F.col(parts)).alias(cdf)))
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    known = _with_tables(df.withColumn(name, F.coalesce(F.col(source_col).cast("string"), F.lit(""))), name, tables, rate_name, documents)
    # The parts of each draw, at most _BLOCK to an array.
    known = known.withColumn(block, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(parts) - 1) / _BLOCK))))
    known = known.withColumn(part, F.explode(F.sequence(F.col(block) * _BLOCK, F.least((F.col(block) + 1) * _BLOCK, F.col(parts)) - 1)))
    u = _uniform(F.lit(str(seed)), key, F.when(F.col(part) > 0, F.col(part).cast("string")))
    known = known.withColumn(draw, u)
    drawn = known.withColumn(draw, F.size(F.filter(F.col(cdf), lambda p: p <= F.col(draw)))).filter(F.col(draw) > 0)
    copies = drawn.select(*[df[c] for c in df.columns], F.explode(F.sequence(F.col(part) * STRIDE + 1, F.col(part) * STRIDE + F.col(draw))).alias(copy_col))
    order = F.md5(F.concat_ws(":", F.lit(f"order-{seed}"), key, F.col(copy_col).cast("string")).cast("binary"))
    dealt = copies.withColumn(order_col, order).repartition(partitions(df.sparkSession), order_col)
    return dealt.sortWithinPartitions(order_col)
