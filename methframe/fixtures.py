"""Sequencing inputs derived from the driver's business tables, by SQL that Spark and DuckDB both run.

Only the genome needs one text per engine (their array functions differ).  Everything is a function of keys and
MD5 texts, so both engines see equal inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# 64 pieces of 32 bases for each of 25 nations.
GENOME_SPARK = """
SELECT {name} AS chr, concat_ws('', transform(sequence(0, 63), i -> translate(md5(n_name || '-' || i), '0123456789abcdef', 'ACGTACGTACGTACGT'))) AS seq
FROM nation
"""
GENOME_DUCKDB = """
SELECT {name} AS chr, array_to_string(list_transform(range(0, 64), lambda i: translate(md5(n_name || '-' || i), '0123456789abcdef', 'ACGTACGTACGTACGT')), '') AS seq
FROM nation
"""


def chr_name(k: str) -> str:
    return f"CASE WHEN {k} < 22 THEN 'chr' || ({k} + 1) WHEN {k} = 22 THEN 'chrX' WHEN {k} = 23 THEN 'chrY' WHEN {k} = 24 THEN 'chrL' ELSE 'chrU' || {k} END"


KEYED = f"""
SELECT ((l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey % 1000000) * 10000 + l_suppkey % 10000 AS read_no,
  l_orderkey, l_partkey, l_linenumber, l_returnflag, l_suppkey % 27 AS k, CAST(l_quantity AS INT) AS q,
  {chr_name('(l_suppkey % 27)')} AS chr, {chr_name('(l_suppkey % 25)')} AS base_chr,
  CASE WHEN (l_partkey + l_orderkey) % 2 = 0 THEN 'W' ELSE 'C' END AS strand,
  l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS name,
  20 + 5 * l_linenumber AS len, 25 + 5 * ((l_linenumber + 2) % 5) AS len2,
  (l_partkey * 37 + l_orderkey * 11 + l_linenumber) % 1900 + 1 AS place
FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, min(l_quantity) AS l_quantity, min(l_returnflag) AS l_returnflag FROM lineitem GROUP BY l_orderkey, l_linenumber, l_partkey, l_suppkey) l
"""


def _converted(seq: str) -> str:
    return (
        f"CASE WHEN l_returnflag = 'R' AND strand = 'W' THEN translate({seq}, 'C', 'T') WHEN l_returnflag = 'R' THEN translate({seq}, 'G', 'A') "
        f"WHEN l_returnflag = 'A' AND strand = 'W' THEN replace({seq}, 'CG', 'TG') WHEN l_returnflag = 'A' THEN replace({seq}, 'CG', 'CA') ELSE {seq} END"
    )


def _spoilt(seq: str, at: str) -> str:
    return f"substr({seq}, 1, {at}) || 'N' || substr({seq}, {at} + 2)"


SINGLE = f"""
SELECT read_no, name, chr, pos, mapq, strand, cigar, {_spoilt('c', '(q % len)')} AS seq, qual FROM (
  SELECT k.read_no, k.name, k.chr, k.strand, k.q, k.len, k.q AS mapq, least(place, 2049 - len) AS pos, {_converted('substr(g.seq, CAST(least(place, 2049 - len) AS INT), len)')} AS c,
    substr(repeat(md5(name), 2), 1, len) AS qual,
    CASE q % 10 WHEN 0 THEN '10M2D' || (len - 10) || 'M' WHEN 1 THEN '8M1I' || (len - 9) || 'M' WHEN 2 THEN (len - 5) || 'M5S' ELSE len || 'M' END AS cigar
  FROM keyed k JOIN genome g ON g.chr = k.base_chr
) s
"""

# Mate 1 is the left one on W and the right one on C.
PAIRS = f"""
SELECT read_no, name, chr, strand, mapq,
  CASE WHEN strand = 'W' THEN l_pos ELSE r_pos END AS pos1, CASE WHEN strand = 'W' THEN l_cigar ELSE r_cigar END AS cigar1,
  CASE WHEN strand = 'W' THEN l_seq ELSE r_seq END AS seq1, CASE WHEN strand = 'W' THEN l_qual ELSE r_qual END AS qual1,
  CASE WHEN strand = 'W' THEN r_pos ELSE l_pos END AS pos2, CASE WHEN strand = 'W' THEN r_cigar ELSE l_cigar END AS cigar2,
  CASE WHEN strand = 'W' THEN r_seq ELSE l_seq END AS seq2, CASE WHEN strand = 'W' THEN r_qual ELSE l_qual END AS qual2
FROM (
  SELECT read_no, name, chr, strand, q AS mapq, l_pos, r_pos, l_qual, r_qual, {_spoilt('lc', '(q % len)')} AS l_seq, {_spoilt('rc', '(q % len2)')} AS r_seq,
    CASE q % 10 WHEN 0 THEN '10M2D' || (len - 10) || 'M' WHEN 2 THEN (len - 5) || 'M5S' ELSE len || 'M' END AS l_cigar,
    CASE q % 10 WHEN 1 THEN '8M1I' || (len2 - 9) || 'M' ELSE len2 || 'M' END AS r_cigar
  FROM (
    SELECT k.*, place AS l_pos, place + l_partkey % 60 AS r_pos,
      {_converted('substr(g.seq, CAST(place AS INT), len)')} AS lc, {_converted('substr(g.seq, CAST(place + l_partkey % 60 AS INT), len2)')} AS rc,
      substr(repeat(md5(name || 'L'), 2), 1, len) AS l_qual, substr(repeat(md5(name || 'R'), 2), 1, len2) AS r_qual
    FROM keyed k JOIN genome g ON g.chr = k.base_chr
  ) p
) s
"""

# Sequenced pairs: a fragment of 24 to 60 bases, then adapter, then other bases, read for 50 to 52 cycles.
RAW = f"""
SELECT read_no, '@' || name || ' 1' AS id1, s1 AS seq1, substr(repeat(md5(name || '1'), 2), 1, length(s1) - q % 7) || repeat('#', q % 7) AS qual1,
  '@' || name || ' 2' AS id2, {_spoilt('s2', '(q % 45)')} AS seq2, substr(repeat(md5(name || '2'), 2), 1, length(s2) - q % 5) || repeat('#', q % 5) AS qual2
FROM (
  SELECT k.*, substr(f || 'AGATCGGAAGAGC' || seq, 1, 50 + l_linenumber % 3) AS s1,
    substr(reverse(translate(f, 'ACGT', 'TGCA')) || 'AGATCGGAAGAGC' || seq, 1, 50) AS s2
  FROM (SELECT k.*, g.seq, substr(g.seq, CAST(place AS INT), CAST(24 + l_partkey % 37 AS INT)) AS f FROM keyed k JOIN genome g ON g.chr = k.base_chr) k
) s
"""


# Converted reads whose place is known: two bases missing, one too many, or none; and pairs of mates.
PLACED = """
SELECT read_no, base_chr AS chr, CAST(place AS BIGINT) AS pos, q % 3 AS kind, translate(CASE q % 3 WHEN 0 THEN substr(seq, CAST(place AS INT), 35) || substr(seq, CAST(place AS INT) + 37, 35)
  WHEN 1 THEN substr(seq, CAST(place AS INT), 35) || 'A' || substr(seq, CAST(place AS INT) + 35, 34) ELSE substr(seq, CAST(place AS INT), 70) END, 'C', 'T') AS seq, repeat('I', 70) AS qual
FROM keyed k JOIN genome g ON g.chr = k.base_chr
"""
PLACED_PAIRS = """
SELECT read_no, base_chr AS chr, CAST(place AS BIGINT) AS pos1, CAST(place + 20 + l_partkey % 60 AS BIGINT) AS pos2, translate(substr(seq, CAST(place AS INT), 40), 'C', 'T') AS seq1, repeat('I', 40) AS qual1,
  reverse(translate(translate(substr(seq, CAST(place + 20 + l_partkey % 60 AS INT), 40), 'C', 'T'), 'ACGT', 'TGCA')) AS seq2, repeat('#', 40) AS qual2
FROM keyed k JOIN genome g ON g.chr = k.base_chr
"""


def _hypothesis(condition: str) -> str:
    return f"""
SELECT l_orderkey AS read_no, chr, place AS pos, CAST(l_partkey % 43 AS INT) AS mapq, CAST(-(q % 7) AS INT) AS as_score, l_returnflag = 'R' AS has_xs FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY read_no) AS rn FROM keyed WHERE {condition}
) h WHERE rn = 1
"""


HYP_W, HYP_C = _hypothesis("l_linenumber <= 4"), _hypothesis("l_linenumber >= 3")

BED = f"""
SELECT {chr_name('(p_partkey % 27)')} AS chr, p_partkey * 53 % 1900 AS start, p_partkey * 53 % 1900 + 4 * p_size AS "end" FROM part
"""

REFGENE = f"""
SELECT {chr_name('(c_custkey % 25)')} AS chr, CASE WHEN c_custkey % 2 = 0 THEN '+' ELSE '-' END AS strand, c_custkey * 91 % 900 AS tx_start,
  c_custkey * 91 % 900 + 900 + c_custkey % 300 AS tx_end,
  CASE WHEN c_custkey % 11 = 0 THEN 'MIR' || c_custkey WHEN c_custkey % 13 = 0 THEN 'SNO' || c_custkey ELSE c_mktsegment || c_custkey END AS gene
FROM customer
"""

#: Fixture tables in the order in which they build on each other.
DUCKDB = {
    "genome": GENOME_DUCKDB.format(name=chr_name("n_nationkey")),
    "keyed": KEYED, "single": SINGLE, "pairs": PAIRS, "raw": RAW, "hyp_w": HYP_W, "hyp_c": HYP_C, "placed": PLACED, "placed_pairs": PLACED_PAIRS, "bed": BED, "refgene": REFGENE,
}
NEEDS = {"single": ["genome", "keyed"], "pairs": ["genome", "keyed"], "raw": ["genome", "keyed"], "hyp_w": ["keyed"], "hyp_c": ["keyed"], "placed": ["genome", "keyed"], "placed_pairs": ["genome", "keyed"]}


class Fixtures:
    """The derived tables as DataFrames over one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _sql(self, text: str, **frames: DataFrame) -> DataFrame:
        """text over frames, whose names it uses as table names."""
        for name in frames:
            text = text.replace(f"FROM {name}", f"FROM {{{name}}}").replace(f"JOIN {name}", f"JOIN {{{name}}}")
        return self.spark.sql(text.replace('"end"', "`end`"), **frames)

    @property
    def genome(self) -> DataFrame:
        return self._sql(GENOME_SPARK.format(name=chr_name("n_nationkey")), nation=self.table("nation"))

    @property
    def keyed(self) -> DataFrame:
        return self._sql(KEYED, lineitem=self.table("lineitem"))

    @property
    def single(self) -> DataFrame:
        return self._sql(SINGLE, keyed=self.keyed, genome=self.genome)

    @property
    def pairs(self) -> DataFrame:
        return self._sql(PAIRS, keyed=self.keyed, genome=self.genome)

    @property
    def raw(self) -> DataFrame:
        return self._sql(RAW, keyed=self.keyed, genome=self.genome)

    @property
    def placed(self) -> DataFrame:
        return self._sql(PLACED, keyed=self.keyed, genome=self.genome)

    @property
    def placed_pairs(self) -> DataFrame:
        return self._sql(PLACED_PAIRS, keyed=self.keyed, genome=self.genome)

    @property
    def hyp_w(self) -> DataFrame:
        return self._sql(HYP_W, keyed=self.keyed)

    @property
    def hyp_c(self) -> DataFrame:
        return self._sql(HYP_C, keyed=self.keyed)

    @property
    def bed(self) -> DataFrame:
        return self._sql(BED, part=self.table("part"))

    @property
    def refgene(self) -> DataFrame:
        return self._sql(REFGENE, customer=self.table("customer"))
