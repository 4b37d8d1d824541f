"""DuckDB SQL of the registered queries, written against single bases and plain range joins."""

from __future__ import annotations

from .fixtures import DUCKDB, NEEDS

ORACLES: dict[str, str] = {}

# Views that oracles build on: name -> (SQL, what it needs).
VIEWS: dict[str, tuple[str, list[str]]] = {n: (q, NEEDS.get(n, [])) for n, q in DUCKDB.items()}


def _laid_out(source: str, tag: str = "") -> str:
    """Bases along the reference, one row each, by running sums over CIGAR operations."""
    return f"""
SELECT read_no, chr, strand, mapq, pos, x, x - pos AS i, count(*) OVER (PARTITION BY read_no) AS n, base, code FROM (
  SELECT read_no, chr, strand, mapq, pos, o, pos + ref_at + j AS x, CASE WHEN o = 'M' THEN substr(seq, read_at + j + 1, 1) ELSE 'N' END AS base,
    CASE WHEN o = 'M' THEN ascii(substr(qual, read_at + j + 1, 1)) ELSE 32 END AS code
  FROM (
    SELECT *, unnest(range(0, n)) AS j FROM (
      SELECT *, (sum(CASE WHEN o IN ('M', 'I') THEN n ELSE 0 END) OVER w - CASE WHEN o IN ('M', 'I') THEN n ELSE 0 END)::BIGINT AS read_at,
        (sum(CASE WHEN o IN ('M', 'D') THEN n ELSE 0 END) OVER w - CASE WHEN o IN ('M', 'D') THEN n ELSE 0 END)::BIGINT AS ref_at
      FROM (
        SELECT read_no, chr, strand, mapq, pos{tag} AS pos, seq{tag} AS seq, qual{tag} AS qual, unnest(regexp_extract_all(cigar{tag}, '([0-9]+)([MID])', 1))::BIGINT AS n,
          unnest(regexp_extract_all(cigar{tag}, '([0-9]+)([MID])', 2)) AS o, generate_subscripts(regexp_extract_all(cigar{tag}, '([0-9]+)([MID])'), 1) AS part
        FROM {source}
      ) ops WINDOW w AS (PARTITION BY read_no ORDER BY part)
    ) placed WHERE o <> 'I'
  ) bases
) laid
"""


VIEWS["known_single"] = ("SELECT * FROM single WHERE chr IN (SELECT chr FROM genome) AND regexp_full_match(cigar, '([0-9]+[MID])+')", ["single"])
VIEWS["known_pairs"] = (
    "SELECT * FROM pairs WHERE chr IN (SELECT chr FROM genome) AND regexp_full_match(cigar1, '([0-9]+[MID])+') AND regexp_full_match(cigar2, '([0-9]+[MID])+')",
    ["pairs"],
)
VIEWS["base_single"] = ("SELECT *, 1 AS mate, true AS apart FROM (" + _laid_out("known_single") + ") b", ["known_single"])
VIEWS["base_1"] = (_laid_out("known_pairs", "1"), ["known_pairs"])
VIEWS["base_2"] = (_laid_out("known_pairs", "2"), ["known_pairs"])
VIEWS["spans"] = (
    """
SELECT *, CASE WHEN pos1 <= pos2 THEN 1 ELSE 2 END AS left_mate, CASE WHEN x0 + nx <= y0 THEN 'apart' WHEN y0 + ny >= x0 + nx THEN 'joined' ELSE 'first' END AS how FROM (
  SELECT read_no, pos1, pos2, CASE WHEN pos1 <= pos2 THEN pos1 ELSE pos2 END AS x0, CASE WHEN pos1 <= pos2 THEN pos2 ELSE pos1 END AS y0,
    CASE WHEN pos1 <= pos2 THEN n1 ELSE n2 END AS nx, CASE WHEN pos1 <= pos2 THEN n2 ELSE n1 END AS ny
  FROM known_pairs JOIN (SELECT read_no, any_value(n) AS n1 FROM base_1 GROUP BY 1) a USING (read_no) JOIN (SELECT read_no, any_value(n) AS n2 FROM base_2 GROUP BY 1) b USING (read_no)
) s
""",
    ["base_1", "base_2"],
)
VIEWS["base_pairs"] = (
    """
SELECT b.read_no, chr, strand, mapq, x, i, base, 1 AS mate, how = 'apart' AS apart FROM base_1 b JOIN spans s USING (read_no) WHERE how <> 'joined'
UNION ALL SELECT b.read_no, chr, strand, mapq, x, i, base, 2, true FROM base_2 b JOIN spans s USING (read_no) WHERE how = 'apart'
UNION ALL SELECT read_no, chr, strand, mapq, x, x - x0, base, 1, false FROM (
  SELECT u.*, x0, row_number() OVER (PARTITION BY u.read_no, x ORDER BY code DESC, CASE WHEN m = left_mate THEN 0 ELSE 1 END) AS best
  FROM (SELECT *, 1 AS m FROM base_1 UNION ALL SELECT *, 2 FROM base_2) u JOIN spans s USING (read_no) WHERE how = 'joined'
) j WHERE best = 1
""",
    ["spans"],
)


def _observed(bases: str) -> str:
    return f"""
SELECT b.chr, CASE WHEN strand = 'W' THEN x ELSE x - 1 END AS locus, strand, mate, apart, i, base, mapq FROM {bases} b JOIN genome g USING (chr)
WHERE (strand = 'W' AND substr(seq, x, 2) = 'CG') OR (strand = 'C' AND x > 1 AND substr(seq, x - 1, 2) = 'CG')
"""


def _cph(strict: bool) -> str:
    crick = "strand = 'C' AND substr(seq, x, 1) = 'G'" + (" AND NOT (x > 1 AND substr(seq, x - 1, 1) = 'C')" if strict else "")
    return f"""
SELECT b.chr, x AS locus, strand, base FROM base_single b JOIN genome g USING (chr)
WHERE (strand = 'W' AND substr(seq, x, 1) = 'C' AND substr(seq, x + 1, 1) <> 'G') OR ({crick})
"""


COUNTERS = """count(*) FILTER (strand = 'W' AND base = 'C') AS wC, count(*) FILTER (strand = 'W' AND base = 'T') AS wT, count(*) FILTER (strand = 'W' AND base NOT IN ('C', 'T')) AS wO,
  count(*) FILTER (strand = 'C' AND base = 'G') AS cC, count(*) FILTER (strand = 'C' AND base = 'A') AS cT, count(*) FILTER (strand = 'C' AND base NOT IN ('G', 'A')) AS cO"""


def _called(observed: str) -> str:
    return f"""
SELECT chr, locus, total, wC, wT, wO, substr('X' || seq, locus, 4) AS context, cC, cT, cO
FROM (SELECT chr, locus, count(*) AS total, {COUNTERS} FROM {observed} o GROUP BY chr, locus) c JOIN genome USING (chr)
"""


VIEWS["seen_single"] = (_observed("base_single"), ["base_single"])
VIEWS["seen_pairs"] = (_observed("base_pairs"), ["base_pairs"])
VIEWS["calls"] = (_called("seen_single"), ["seen_single"])
VIEWS["calls_pairs"] = (_called("seen_pairs"), ["seen_pairs"])
VIEWS["info"] = ("SELECT chr, length(seq)::BIGINT AS length FROM genome", ["genome"])
VIEWS["log"] = (
    """
SELECT g.chr, coalesce(reads, 0) AS reads, coalesce(wC, 0)::BIGINT AS wC, coalesce(wT, 0)::BIGINT AS wT, coalesce(cC, 0)::BIGINT AS cC, coalesce(cT, 0)::BIGINT AS cT FROM genome g
LEFT JOIN (SELECT chr, count(*) AS reads FROM known_single GROUP BY 1) r ON r.chr = g.chr
LEFT JOIN (SELECT chr, sum(wC) AS wC, sum(wT) AS wT, sum(cC) AS cC, sum(cT) AS cT FROM calls GROUP BY 1) c ON c.chr = g.chr
""",
    ["calls"],
)
REFLEN = "coalesce(list_sum(list_transform(regexp_extract_all({c}, '([0-9]+)[MD]', 1), lambda n: n::INT)), 0)"


def _reflen(c: str) -> str:
    return f"CASE WHEN regexp_full_match({c}, '([0-9]+[MID])+') THEN {REFLEN.format(c=c)} ELSE 0 END"


VIEWS["sized"] = (
    f"""
SELECT *, CASE WHEN strand = 'W' THEN pos1 ELSE pos2 END AS "left",
  (CASE WHEN strand = 'W' THEN pos2 + {_reflen('cigar2')} - pos1 ELSE pos1 + {_reflen('cigar1')} - pos2 END)::BIGINT AS frag_size FROM pairs
""",
    ["pairs"],
)
SCORE = "list_sum(list_transform(range(1, length({q}) + 1), lambda i: ascii(substr({q}, i, 1))))::BIGINT"
VIEWS["unique_pairs"] = (
    f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY chr, strand, "left", frag_size ORDER BY {SCORE.format(q='qual1')} + {SCORE.format(q='qual2')} DESC, read_no) AS rn
FROM sized WHERE chr IN (SELECT chr FROM genome)) d WHERE rn = 1
""",
    ["sized", "genome"],
)
VIEWS["sizes"] = ("SELECT frag_size AS size, count(*) AS count, count(*)::DOUBLE * 100 / (SELECT count(*) FROM unique_pairs) AS proportion FROM unique_pairs WHERE frag_size BETWEEN 1 AND 1000 GROUP BY 1", ["unique_pairs"])
VIEWS["merged"] = (
    """
SELECT read_no, strand, CASE WHEN strand = 'W' THEN w_chr ELSE c_chr END AS chr, CASE WHEN strand = 'W' THEN w_pos ELSE c_pos END AS pos,
  CASE WHEN both_hit THEN (CASE WHEN strand = 'W' THEN w_mapq ELSE c_mapq END) // 2 ELSE CASE WHEN strand = 'W' THEN w_mapq ELSE c_mapq END END AS mapq,
  CASE WHEN strand = 'W' THEN w_as ELSE c_as END AS as_score, CASE WHEN strand = 'W' THEN w_xs ELSE c_xs END AS has_xs
FROM (
  SELECT *, CASE WHEN c_as IS NULL THEN CASE WHEN w_mapq >= 2 OR NOT w_xs THEN 'W' END WHEN w_as IS NULL THEN CASE WHEN c_mapq >= 2 OR NOT c_xs THEN 'C' END
    WHEN c_as > w_as THEN CASE WHEN c_mapq >= 2 THEN 'C' END WHEN c_as < w_as THEN CASE WHEN w_mapq >= 2 THEN 'W' END END AS strand, w_as IS NOT NULL AND c_as IS NOT NULL AS both_hit
  FROM (SELECT read_no, chr AS w_chr, pos AS w_pos, mapq AS w_mapq, as_score AS w_as, has_xs AS w_xs FROM hyp_w) w
  FULL JOIN (SELECT read_no, chr AS c_chr, pos AS c_pos, mapq AS c_mapq, as_score AS c_as, has_xs AS c_xs FROM hyp_c) c USING (read_no)
) m WHERE strand IS NOT NULL
""",
    ["hyp_w", "hyp_c"],
)

# --- preprocessing
VIEWS["pe"] = (
    "SELECT read_no, id1, id2, substr(seq1, 1, n) AS seq1, substr(qual1, 1, n) AS qual1, substr(seq2, 1, n) AS seq2, substr(qual2, 1, n) AS qual2 FROM (SELECT *, least(length(seq1), length(seq2), 50) AS n FROM raw) r",
    ["raw"],
)
VIEWS["se"] = ("SELECT read_no, substr(seq1, 1, 50) AS seq, substr(qual1, 1, 50) AS qual FROM raw", ["raw"])
VIEWS["fq"] = (
    """
SELECT mate, cycle, count(*) FILTER (b = 'A') AS "A", count(*) FILTER (b = 'C') AS "C", count(*) FILTER (b = 'G') AS "G", count(*) FILTER (b = 'T') AS "T", count(*) FILTER (b NOT IN ('A', 'C', 'G', 'T')) AS "N"
FROM (SELECT mate, i::INTEGER AS cycle, upper(substr(s, i, 1)) AS b FROM (SELECT 1 AS mate, seq1 AS s, unnest(range(1, length(seq1) + 1)) AS i FROM pe UNION ALL SELECT 2, seq2, unnest(range(1, length(seq2) + 1)) FROM pe) x) y
GROUP BY mate, cycle
""",
    ["pe"],
)
AD = "AGATCGGAAGAGC"


def _wrong(s: str) -> str:
    return f"len(list_filter(range(0, least(13, length({s}) - p)), lambda k: substr({s}, p + k + 1, 1) <> substr('{AD}', k + 1, 1)))"


LENGTH = "least(13, length({s}) - p)"
VIEWS["cut_se"] = (
    f"""
WITH q AS (SELECT read_no, seq AS s0, greatest(1, coalesce(list_max(list_filter(range(1, length(qual)), lambda i: ascii(substr(qual, i + 1, 1)) >= 53)) + 1, 1)) AS trimmed_length FROM se),
t AS (SELECT read_no, trimmed_length, substr(s0, 1, trimmed_length) AS seq FROM q),
seeds AS (SELECT read_no, seq, unnest(range(0, length(seq) - 2)) AS p FROM t WHERE trimmed_length >= 20),
hits AS (SELECT read_no, min(p) AS adapter_at FROM seeds WHERE substr(seq, p + 1, 3) = 'AGA' AND {_wrong('seq')} <= ceil({LENGTH.format(s='seq')} / 4.0) GROUP BY 1),
u AS (SELECT *, CASE WHEN trimmed_length >= 20 AND adapter_at IS NULL AND right(seq, 2) = 'AG' THEN 2 ELSE 0 END AS tail FROM t LEFT JOIN hits USING (read_no))
SELECT read_no, trimmed_length::INTEGER AS trimmed_length, adapter_at::INTEGER AS adapter_at, tail, trimmed_length < 20 OR coalesce(adapter_at, length(seq) - tail) < 20 AS dropped,
  substr(seq, 1, coalesce(adapter_at, length(seq) - tail)) AS seq FROM u
""",
    ["se"],
)


def _pair(a: str, b: str) -> str:
    return f"({a}, {b}) IN (('A', 'T'), ('C', 'G'), ('G', 'C'), ('T', 'A'))"


def _evidence(i: int, j: str) -> str:
    return f"{_pair(f'substr(seq1, {i} + 1, 1)', f'substr(seq2, {j} + 1, 1)')} AND {_pair(f'substr(seq2, {i} + 1, 1)', f'substr(seq1, {j} + 1, 1)')}"


VIEWS["cut_pe"] = (
    f"""
WITH q AS (SELECT *, greatest(1, coalesce(list_max(list_filter(range(1, length(qual1)), lambda i: ascii(substr(qual1, i + 1, 1)) >= 53 AND ascii(substr(qual2, i + 1, 1)) >= 53)) + 1, 1)) AS trimmed_length FROM pe),
t AS (SELECT read_no, trimmed_length, substr(seq1, 1, trimmed_length) AS seq1, substr(seq2, 1, trimmed_length) AS seq2 FROM q),
seeds AS (SELECT read_no, seq1, seq2, unnest(range(0, length(seq1) - 2)) AS p FROM t WHERE trimmed_length >= 20),
tests AS (SELECT read_no, p, {_wrong('seq1')} AS e1, {_wrong('seq2')} AS e2, {LENGTH.format(s='seq1')} AS n FROM seeds WHERE substr(seq1, p + 1, 3) = 'AGA' OR substr(seq2, p + 1, 3) = 'AGA'),
hits AS (SELECT read_no, min(p) AS adapter_at FROM tests WHERE e1 <= ceil(n / 4.0) AND e2 <= ceil(n / 4.0) AND e1 + e2 <= (n + 1) // 2 GROUP BY 1),
u AS (SELECT *, CASE WHEN trimmed_length < 20 OR adapter_at IS NOT NULL THEN 0
  WHEN right(seq1, 2) = 'AG' AND right(seq2, 2) = 'AG' THEN CASE WHEN {_evidence(5, '(length(seq1) - 8)')} THEN 2 ELSE 0 END
  WHEN right(seq1, 1) = 'A' AND right(seq2, 1) = 'A' AND {_evidence(5, '(length(seq1) - 7)')} AND {_evidence(6, '(length(seq1) - 8)')} THEN 1 ELSE 0 END AS tail FROM t LEFT JOIN hits USING (read_no))
SELECT read_no, trimmed_length::INTEGER AS trimmed_length, adapter_at::INTEGER AS adapter_at, tail, trimmed_length < 20 OR coalesce(adapter_at, length(seq1) - tail) < 20 AS dropped,
  substr(seq1, 1, coalesce(adapter_at, length(seq1) - tail)) AS seq1, substr(seq2, 1, coalesce(adapter_at, length(seq1) - tail)) AS seq2 FROM u
""",
    ["pe"],
)


def _count_cut(view: str) -> str:
    return f"SELECT count(*) AS total, count(*) FILTER (dropped) AS dropped, count(*) FILTER (adapter_at IS NOT NULL) AS adapter, count(*) FILTER (tail > 0 AND NOT dropped) AS tail FROM {view}"


def _places(s: str, test: str, to: str = "p") -> str:
    return f"array_to_string(list_transform(list_filter(range(0, length({s})), lambda p: {test}), lambda p: ({to})::VARCHAR), ';')"


C1 = _places("seq1", "substr(seq1, p + 1, 1) = 'C'")
G2 = _places("seq2", "substr(seq2, p + 1, 1) = 'G'")
CG1 = _places("seq1", "substr(seq1, p + 1, 2) = 'CG'")
CG2 = _places("seq2", "p > 0 AND substr(seq2, p, 2) = 'CG'")
HEX1 = _places("seq1", "substr(seq1, p + 1, 2) = 'CG'", "lower(printf('%x', p))")
HEX2 = _places("seq2", "p > 0 AND substr(seq2, p, 2) = 'CG'", "lower(printf('%x', p))")

VIEWS["bins"] = (
    """
WITH named AS (SELECT chr, strand, CASE WHEN strand = '+' THEN tx_start ELSE tx_end END AS tss, gene FROM refgene
  WHERE regexp_full_match(chr, 'chr[0-9XY]+') AND gene NOT LIKE 'MIR%' AND gene NOT LIKE 'SNO%' AND tx_end - tx_start >= 1000),
one AS (SELECT chr, tss, strand, max(gene) AS gene FROM named GROUP BY ALL)
SELECT chr, CASE WHEN strand = '+' THEN tss + 200 * s ELSE tss - 200 * s - 200 END AS start, CASE WHEN strand = '+' THEN tss + 200 * s + 200 ELSE tss - 200 * s END AS "end", gene, (s * 200)::INTEGER AS distance, strand
FROM one, range(-20, 21) r(s)
""",
    ["refgene"],
)
VIEWS["mates"] = (
    "SELECT name, 1 AS m, chr, strand, pos1 AS pos, cigar1 AS cigar, seq1 AS seq, qual1 AS qual FROM pairs UNION ALL SELECT name, 2, chr, strand, pos2, cigar2, seq2, qual2 FROM pairs",
    ["pairs"],
)
VIEWS["region"] = (
    f"SELECT * FROM mates WHERE chr = 'chr3' AND pos <= 900 AND regexp_full_match(cigar, '([0-9]+[MID])+') AND pos + {_reflen('cigar')} - 1 >= 201",
    ["mates"],
)
# Both mates' bases along the reference; ref_no numbers rows for the layout.
VIEWS["region_rows"] = ("SELECT row_number() OVER (ORDER BY name, m) AS read_no, 0 AS mapq, * FROM region", ["region"])
VIEWS["region_bases"] = (
    "SELECT r.name, r.m, b.chr, b.strand, b.pos, b.x, b.n, CASE WHEN b.base = 'N' AND b.code = 32 THEN 'D' ELSE b.base END AS base, b.code FROM (" + _laid_out("region_rows") + ") b JOIN region_rows r USING (read_no)",
    ["region_rows"],
)
VIEWS["ends"] = (
    """
SELECT name, any_value(chr) AS chr, min(pos) AS pos, min_by(strand, (pos, s)) AS strand, arg_min(m, (pos, s)) AS left_m, arg_min(pos + n, (pos, s)) AS left_end, max(pos + n) AS all_end, count(*) AS k FROM (
  SELECT name, m, any_value(chr) AS chr, any_value(strand) AS strand, any_value(pos) AS pos, any_value(n) AS n, string_agg(base, '' ORDER BY x) AS s FROM region_bases GROUP BY name, m) q GROUP BY name
""",
    ["region_bases"],
)
VIEWS["shown"] = (
    """
SELECT name, e.chr, e.strand, e.pos, x, base FROM (
  SELECT b.name, x, base, row_number() OVER (PARTITION BY b.name, x ORDER BY CASE WHEN all_end > left_end THEN code ELSE 0 END DESC, CASE WHEN m = left_m THEN 0 ELSE 1 END) AS best
  FROM region_bases b JOIN ends USING (name) WHERE all_end > left_end OR m = left_m) c JOIN ends e USING (name) WHERE best = 1
""",
    ["ends"],
)
VIEWS["view_rows"] = (
    """
SELECT e.name, e.chr, e.pos, e.strand, string_agg(coalesce(base, '.'), '' ORDER BY g.x) AS seq FROM ends e
JOIN (SELECT name, unnest(range(pos, all_end)) AS x FROM ends) g USING (name) LEFT JOIN shown s ON s.name = e.name AND s.x = g.x GROUP BY ALL
""",
    ["shown"],
)


def _glyphs(wm: str, wu: str, cm: str, cu: str) -> str:
    return f"""
SELECT name, chr, pos, strand, string_agg(g, '' ORDER BY i) AS glyphs FROM (
  SELECT name, chr, pos, strand, i, CASE
    WHEN r = 'C' AND r_next = 'G' AND strand = 'W' THEN CASE b WHEN '{wm}' THEN 'M' WHEN '{wu}' THEN 'U' ELSE b END
    WHEN r = 'C' AND r_next = 'G' THEN CASE WHEN i = n - 1 THEN '' ELSE CASE b_next WHEN '{cm}' THEN 'M' WHEN '{cu}' THEN 'U' ELSE b_next END END
    WHEN r = 'C' THEN CASE WHEN b IN ('{wm}', '{wu}') THEN '-' ELSE b END
    WHEN r = 'G' AND strand = 'C' AND r_last = 'C' AND i > 0 THEN CASE WHEN b_last = 'C' THEN '-' ELSE b_last END
    WHEN r = 'G' AND strand = 'C' THEN CASE WHEN b IN ('{cm}', '{cu}') THEN '-' ELSE b END
    WHEN b = r THEN '-' ELSE b END AS g
  FROM (SELECT v.name, v.chr, v.pos, v.strand, i, length(v.seq) AS n, substr(v.seq, i + 1, 1) AS b, substr(v.seq, i + 2, 1) AS b_next, CASE WHEN i > 0 THEN substr(v.seq, i, 1) END AS b_last,
      substr(g.seq, v.pos + i, 1) AS r, substr(g.seq, v.pos + i + 1, 1) AS r_next, CASE WHEN v.pos + i > 1 THEN substr(g.seq, v.pos + i - 1, 1) END AS r_last
    FROM (SELECT *, unnest(range(0, length(seq))) AS i FROM view_rows) v JOIN genome g ON g.chr = v.chr) x) y
GROUP BY ALL
"""


VIEWS["drawn"] = (_glyphs("C", "T", "G", "A"), ["view_rows", "genome"])
VIEWS["picture"] = ("""SELECT name, pos, (SELECT min(pos) FROM drawn) AS "left", repeat(' ', (pos - (SELECT min(pos) FROM drawn))::INTEGER) || glyphs AS row, strand FROM drawn""", ["drawn"])
VIEWS["alleles"] = (
    """
SELECT col, allele, count(*) AS n FROM (SELECT unnest(range(0, length(row))) AS col, row FROM picture) p, LATERAL (SELECT substr(row, col + 1, 1) AS allele) a WHERE allele NOT IN ('.', ' ', 'U', 'M') GROUP BY ALL
""",
    ["picture"],
)
VIEWS["snp"] = (
    """SELECT min(col)::INTEGER AS "column" FROM (SELECT col, sum(n) AS depth, list_sort(list(n), 'DESC') AS ns FROM alleles GROUP BY 1) a WHERE depth >= 10 AND len(ns) > 1 AND ns[2] >= 3""",
    ["alleles"],
)


def oracle(name: str, body: str, *needs: str) -> None:
    """Registers body with the views it needs, in order of their dependence."""
    order: list[str] = []

    def visit(n: str) -> None:
        for m in VIEWS[n][1]:
            visit(m)
        if n not in order:
            order.append(n)

    for n in needs:
        visit(n)
    views = ", ".join(f"{n} AS MATERIALIZED ({VIEWS[n][0]})" for n in order)
    ORACLES[name] = f"WITH {views} {body}" if views else body


oracle("cpg_calls", "SELECT * FROM calls", "calls")
VIEWS["good"] = ("SELECT * FROM seen_single WHERE mapq >= 30", ["seen_single"])
oracle("cpg_calls_mapq", _called("good"), "good")
oracle("cpg_calls_pe", "SELECT * FROM calls_pairs", "calls_pairs")
for _name, _strict in (("cph_calls", False), ("cph_calls_strict", True)):
    VIEWS[f"seen_{_name}"] = (_cph(_strict), ["base_single"])
    oracle(_name, _called(f"seen_{_name}"), f"seen_{_name}")
for _name, _hit in (("bs", "C"), ("taps", "T")):
    oracle(f"cpg_bedgraph_{_name}", f'SELECT chr, locus - 1 AS start, locus AS "end", (w{_hit} + c{_hit})::DOUBLE * 100 / (wC + cC + wT + cT) AS level FROM calls WHERE wC + cC + wT + cT > 0', "calls")
oracle("chr_log", "SELECT * FROM log", "log")
oracle("chr_levels", "SELECT chr, CASE WHEN wC + wT > 0 THEN wC::DOUBLE * 100 / (wC + wT) END AS watson, CASE WHEN cC + cT > 0 THEN cC::DOUBLE * 100 / (cC + cT) END AS crick FROM log", "log")
VIEWS["totals"] = ("SELECT sum(reads)::BIGINT AS reads, sum(wC)::BIGINT AS wC, sum(wT)::BIGINT AS wT, sum(cC)::BIGINT AS cC, sum(cT)::BIGINT AS cT FROM log WHERE chr <> 'chrL'", ["log"])
VIEWS["by_strand"] = (
    """
SELECT *, CASE WHEN c + t > 0 THEN c::DOUBLE * 100 / (c + t) END AS level FROM (SELECT 'watson' AS strand, reads, wC AS c, wT AS t FROM totals UNION ALL SELECT 'crick', reads, cC, cT FROM totals UNION ALL SELECT 'total', reads, wC + cC, wT + cT FROM totals) s
""",
    ["totals"],
)
oracle("overall_level", "SELECT * FROM by_strand", "by_strand")
oracle("report_table", "SELECT strand, format('{:,}', c) AS c, format('{:,}', t) AS t, CASE WHEN c + t > 0 THEN printf('%.2f %%', c::DOUBLE * 100 / (c + t)) ELSE 'NA' END AS level FROM by_strand", "by_strand")
oracle("lambda_conversion", "SELECT sum(reads)::BIGINT AS reads, sum(wC + cC)::BIGINT AS c, sum(wT + cT)::BIGINT AS t, CASE WHEN sum(wC + cC + wT + cT) > 0 THEN sum(wT + cT)::DOUBLE * 100 / sum(wC + cC + wT + cT)::DOUBLE END AS rate FROM log WHERE chr = 'chrL'", "log")


def _mbias(seen: str, mate: int) -> str:
    ahead = "W" if mate == 1 else "C"
    return f"""
SELECT c::INTEGER AS cycle, {COUNTERS.replace("FILTER (", "FILTER (x.chr IS NOT NULL AND ")} FROM range(1, 51) r(c)
LEFT JOIN (SELECT *, CASE WHEN strand = '{ahead}' THEN i + 1 ELSE 50 - i END AS cycle FROM {seen} WHERE apart AND mate = {mate}) x ON x.cycle = c GROUP BY c
"""


oracle("mbias_se", _mbias("seen_single", 1), "seen_single")
oracle("mbias_r1", _mbias("seen_pairs", 1), "seen_pairs")
oracle("mbias_r2", _mbias("seen_pairs", 2), "seen_pairs")
VIEWS["mbias"] = (_mbias("seen_single", 1), ["seen_single"])
oracle("mbias_level", "SELECT cycle, CASE WHEN wC + wT > 0 THEN wC::DOUBLE * 100 / (wC + wT) END AS watson, CASE WHEN cC + cT > 0 THEN cC::DOUBLE * 100 / (cC + cT) END AS crick FROM mbias", "mbias")

oracle(
    "dedup_se",
    f"SELECT read_no, chr, strand, pos FROM (SELECT *, row_number() OVER (PARTITION BY chr, strand, pos ORDER BY {SCORE.format(q='qual')} DESC, read_no) AS rn FROM single WHERE chr IN (SELECT chr FROM genome)) d WHERE rn = 1",
    "single",
)
oracle("dedup_pe", 'SELECT read_no, chr, strand, "left", frag_size FROM unique_pairs', "unique_pairs")
oracle(
    "dedup_log",
    'SELECT "all", "unique", "all" - "unique" - discard AS duplicate, discard FROM (SELECT count(*) AS "all", count(*) FILTER (chr NOT IN (SELECT chr FROM genome)) AS discard FROM pairs) a, (SELECT count(*) AS "unique" FROM unique_pairs) u',
    "unique_pairs",
)
oracle("discard_unknown_chr", "SELECT read_no, chr FROM pairs WHERE chr NOT IN (SELECT chr FROM genome)", "pairs")
oracle("size_dist", "SELECT * FROM sizes", "sizes")
oracle("size_axis", "SELECT (CASE WHEN min(size) > 100 THEN 100 WHEN min(size) > 50 THEN 50 ELSE 0 END)::BIGINT AS x_min, greatest(300, coalesce(max(size) FILTER (proportion > 0.01), 300))::BIGINT AS x_max FROM sizes", "sizes")
oracle("merge_hypotheses", "SELECT read_no, strand, chr, pos, mapq::INTEGER AS mapq, as_score, has_xs FROM merged", "merged")
oracle("merge_strand_counts", "SELECT strand, count(*) AS reads FROM merged GROUP BY 1", "merged")
VIEWS["ended"] = (f"SELECT *, pos1 + {REFLEN.format(c='cigar1')} - 1 AS e1, pos2 + {REFLEN.format(c='cigar2')} - 1 AS e2 FROM pairs WHERE regexp_full_match(cigar1, '([0-9]+[MID])+') AND regexp_full_match(cigar2, '([0-9]+[MID])+')", ["pairs"])
VIEWS["mated"] = (
    """
SELECT read_no, chr, strand, mapq, 1 AS mate, pos1 AS pos, cigar1 AS cigar, '=' AS rnext, pos2 AS pnext, ((greatest(e1, e2) - least(pos1, pos2) + 1) * CASE WHEN pos1 <= pos2 THEN 1 ELSE -1 END)::BIGINT AS tlen FROM ended
UNION ALL SELECT read_no, chr, strand, mapq, 2, pos2, cigar2, '=', pos1, ((greatest(e1, e2) - least(pos1, pos2) + 1) * CASE WHEN pos1 <= pos2 THEN -1 ELSE 1 END)::BIGINT FROM ended
""",
    ["ended"],
)
oracle("mate_fields", "SELECT * FROM mated", "mated")
oracle("pe_bed", 'SELECT chr, pos - 1 AS start, pos - 1 + tlen AS "end" FROM mated WHERE tlen > 0', "mated")
oracle(
    "se_bed",
    f"""SELECT chr, start::BIGINT AS start, (start + 200)::BIGINT AS "end" FROM (SELECT chr, CASE WHEN strand = 'W' THEN pos - 1 ELSE pos - 1 + {REFLEN.format(c='cigar')} - 200 END AS start FROM single WHERE regexp_full_match(cigar, '([0-9]+[MID])+')) s""",
    "single",
)
oracle("cigar_reflen", f"SELECT read_no, ({_reflen('cigar')})::BIGINT AS ref_length FROM single", "single")
VIEWS["any_single"] = ("SELECT * FROM single WHERE regexp_full_match(cigar, '([0-9]+[MID])+')", ["single"])
oracle("cigar_projection", "SELECT read_no, string_agg(base, '' ORDER BY x) AS bases FROM (" + _laid_out("any_single") + ") b GROUP BY 1", "any_single")
oracle("qual_sum", f"SELECT read_no, {SCORE.format(q='qual')} AS score FROM single", "single")
oracle("fragment_sizes", "SELECT read_no, frag_size FROM sized", "sized")
oracle("clean_ids", "SELECT read_no, split_part(substr(id1, 2), ' ', 1) AS id FROM raw", "raw")
oracle("reverse_complement", "SELECT read_no, reverse(translate(seq1, 'ACGT', 'TGCA')) AS seq FROM raw", "raw")
oracle(
    "hex_offsets",
    "SELECT read_no, array_to_string(list_transform(places, lambda p: printf('%x', p)), ';') AS packed, len(places)::BIGINT AS n, list_max(places)::BIGINT AS last FROM (SELECT read_no, list_filter(range(0, length(seq1)), lambda p: substr(seq1, p + 1, 1) = 'C') AS places FROM raw) r",
    "raw",
)
oracle(
    "colour_space",
    "SELECT chr, 'T' || array_to_string(list_transform(range(1, length(s)), lambda i: xor(instr('ACGT', substr(s, i, 1)) - 1, instr('ACGT', substr(s, i + 1, 1)) - 1)::VARCHAR), '') AS colours FROM (SELECT chr, 'T' || seq AS s FROM genome) g",
    "genome",
)
oracle("phred_error", "SELECT read_no, round(pow(10.0::DOUBLE, -(ascii(qual) - 33)::DOUBLE / 10), 9) AS error FROM single", "single")
oracle("number_format", "SELECT chr, format('{:,}', wT) AS wT, CASE WHEN wC + wT > 0 THEN printf('%.2f %%', wC::DOUBLE * 100 / (wC + wT)) ELSE 'NA' END AS share FROM log", "log")

oracle("cycle_detect", "SELECT max(length(seq1))::INTEGER AS cycle FROM (SELECT seq1 FROM raw ORDER BY read_no LIMIT 9999) f", "raw")
oracle("fqstat", "SELECT * FROM fq", "fq")
VIEWS["fq_share"] = ('SELECT mate, cycle, "A"::DOUBLE * 100 / s AS "A", "C"::DOUBLE * 100 / s AS "C", "G"::DOUBLE * 100 / s AS "G", "T"::DOUBLE * 100 / s AS "T", "N"::DOUBLE * 100 / s AS "N" FROM (SELECT *, "A" + "C" + "G" + "T" + "N" AS s FROM fq) f', ["fq"])
oracle("fqstat_pct", "SELECT * FROM fq_share", "fq_share")
oracle("fqstat_axis", 'SELECT least(100.0::DOUBLE, max(greatest("A", "C", "G", "T", "N")) + 10) AS y_max FROM fq_share', "fq_share")
oracle("quality_trim_se", "SELECT read_no, greatest(1, coalesce(list_max(list_filter(range(1, length(qual1)), lambda i: ascii(substr(qual1, i + 1, 1)) >= 53)) + 1, 1))::INTEGER AS kept FROM raw", "raw")
oracle("quality_trim_pe", "SELECT read_no, greatest(1, coalesce(list_max(list_filter(range(1, length(qual1)), lambda i: ascii(substr(qual1, i + 1, 1)) >= 53 AND ascii(substr(qual2, i + 1, 1)) >= 53)) + 1, 1))::INTEGER AS kept FROM pe", "pe")
oracle("adapter_cut_se", "SELECT * FROM cut_se", "cut_se")
oracle("adapter_cut_pe", "SELECT * FROM cut_pe", "cut_pe")
oracle("trim_counters", _count_cut("cut_pe"), "cut_pe")
oracle("trim_counters_se", _count_cut("cut_se"), "cut_se")
oracle("convert_mode3", f"SELECT read_no, translate(seq1, 'C', 'T') AS seq1, qual1, translate(seq2, 'G', 'A') AS seq2, qual2, {C1} AS conv1, {G2} AS conv2 FROM pe", "pe")
MODE4 = f"""
SELECT read_no, replace(CASE WHEN c THEN substr(seq1, 1, length(seq1) - 1) ELSE seq1 END, 'CG', 'TG') AS seq1, CASE WHEN c THEN substr(qual1, 1, length(qual1) - 1) ELSE qual1 END AS qual1,
  replace(CASE WHEN g THEN substr(seq2, 2) ELSE seq2 END, 'CG', 'CA') AS seq2, CASE WHEN g THEN substr(qual2, 2) ELSE qual2 END AS qual2, {CG1} AS conv1, {CG2} AS conv2,
  CASE WHEN c THEN right(qual1, 1) END AS end_qual1, CASE WHEN g THEN substr(qual2, 1, 1) END AS end_qual2
FROM (SELECT *, right(seq1, 1) = 'C' AS c, substr(seq2, 1, 1) = 'G' AS g FROM pe) p
"""
oracle("convert_mode4", MODE4, "pe")
oracle(
    "packed_names",
    f"""SELECT read_no, '@' || printf('%x', read_no) || '+' || CASE WHEN right(seq1, 1) = 'C' THEN right(qual1, 1) || '|' ELSE '' END || {HEX1} || '#' || split_part(substr(id1, 2), ' ', 1) AS name1,
  '@' || CASE WHEN substr(seq2, 1, 1) = 'G' THEN substr(qual2, 1, 1) || '|' ELSE '' END || {HEX2} || '#' || split_part(substr(id2, 2), ' ', 1) AS name2 FROM pe""",
    "pe",
)
oracle(
    "deconvert_roundtrip",
    """SELECT read_no, 'W' AS strand, seq1 AS seq, qual1 AS qual, length(seq1) || 'M' AS cigar, 100::BIGINT AS pos FROM pe
UNION ALL SELECT read_no, 'C', reverse(translate(seq1, 'ACGT', 'TGCA')), reverse(qual1), length(seq1) || 'M', CASE WHEN right(seq1, 1) = 'C' THEN 99 ELSE 100 END FROM pe""",
    "pe",
)

STATS = """
SELECT b.chr, b.start, b."end", count(s.locus) AS sites, coalesce(sum(s.c), 0)::BIGINT AS c, coalesce(sum(s.t), 0)::BIGINT AS t FROM (SELECT row_number() OVER () AS id, * FROM bed WHERE chr IN (SELECT chr FROM genome)) b
LEFT JOIN (SELECT chr, locus, wC + cC AS c, wT + cT AS t FROM {calls} WHERE wC + cC + wT + cT > 0) s ON s.chr = b.chr AND s.locus > b.start AND s.locus <= b."end" GROUP BY b.id, b.chr, b.start, b."end"
"""
VIEWS["clean"] = ("SELECT * FROM calls WHERE NOT (wO + cO >= 5 AND (wO + cO) * 100 // total >= 10)", ["calls"])
oracle("region_stats", STATS.format(calls="calls"), "calls", "bed")
oracle("region_stats_clean", STATS.format(calls="clean"), "clean", "bed")
oracle("clean_sites", "SELECT chr, locus, total, wO, cO FROM clean", "clean")
oracle(
    "binned_methylome",
    """SELECT chr, bin, c, t, c::DOUBLE * 100 / (c + t) AS level FROM (SELECT 'hs' || substr(chr, 4) AS chr, locus // 100 AS bin, sum(wC + cC)::BIGINT AS c, sum(wT + cT)::BIGINT AS t FROM calls
WHERE regexp_matches(chr, '[0-9XY]$') AND NOT contains(chr, '_') GROUP BY 1, 2) b WHERE c + t > 0""",
    "calls",
)
oracle(
    "merge_calls",
    """SELECT chr, locus, sum(total)::BIGINT AS total, sum(wC)::BIGINT AS wC, sum(wT)::BIGINT AS wT, sum(wO)::BIGINT AS wO, max(context) AS context, sum(cC)::BIGINT AS cC, sum(cT)::BIGINT AS cT, sum(cO)::BIGINT AS cO
FROM (SELECT * FROM calls UNION ALL SELECT * FROM calls_pairs) a GROUP BY chr, locus""",
    "calls", "calls_pairs",
)
oracle("tss_bins", "SELECT * FROM bins", "bins")
TSS = """
SELECT d.distance, max(level) FILTER (strand = '+') AS watson, max(level) FILTER (strand = '-') AS crick FROM (SELECT DISTINCT distance FROM bins WHERE strand = '+') d LEFT JOIN (
  SELECT distance, b.strand, CASE WHEN sum(wC + cC + wT + cT) > 0 THEN sum(wC + cC)::DOUBLE / sum(wC + cC + wT + cT)::DOUBLE END AS level
  FROM bins b JOIN calls c ON c.chr = b.chr AND c.locus > b.start AND c.locus <= b."end" GROUP BY 1, 2) p USING (distance) GROUP BY d.distance
"""
oracle("tss_profile", TSS, "bins", "calls")
WIG = """
SELECT b.chr, least(p // 100 * 100 + 1, length) AS pos, count(*) * {weight} AS value FROM (SELECT chr, unnest(range(start + 1, "end" + 1)) AS p, "end" FROM bed) b JOIN info i ON i.chr = b.chr
WHERE "end" // 100 < length // 100 + 1 GROUP BY b.chr, length, p // 100
"""
oracle("bed_wig", WIG.format(weight="1.0::DOUBLE"), "bed", "info")
oracle("bed_wig_norm", WIG.format(weight="(10000000.0::DOUBLE / (SELECT count(*) FROM bed))"), "bed", "info")
VIEWS["mirrored"] = ('SELECT chr, length + 1 - "end" AS start, length + 1 - start AS "end" FROM bed JOIN info USING (chr)', ["bed", "info"])
oracle(
    "interval_overlap",
    """SELECT a.chr AS chr_a, a.start AS start_a, a."end" AS end_a, b.chr AS chr_b, b.start AS start_b, b."end" AS end_b FROM bed a JOIN mirrored b ON a.chr = b.chr AND a.start <= b."end" AND a."end" >= b.start""",
    "mirrored",
)
oracle("interval_semijoin", """SELECT * FROM bed a WHERE EXISTS (SELECT 1 FROM mirrored b WHERE a.chr = b.chr AND a.start <= b."end" AND a."end" >= b.start)""", "mirrored")
oracle(
    "merge_intervals",
    """
SELECT chr, min(start) AS start, max("end") AS "end", count(*) AS count FROM (SELECT *, sum(new) OVER (PARTITION BY chr ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS island FROM (
  SELECT *, CASE WHEN start <= max("end") OVER (PARTITION BY chr ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM bed) a) b GROUP BY chr, island
""",
    "bed",
)
oracle("mirror_bed", 'SELECT chr, length + 1 - "end" AS start, length + 1 - start AS "end" FROM bed JOIN info USING (chr)', "bed", "info")
oracle("chr_info", "SELECT * FROM info", "info")
oracle("genome_convert", "SELECT chr, replace(seq, 'CG', 'TG') AS cg2tg, replace(seq, 'CG', 'CA') AS cg2ca, replace(seq, 'C', 'T') AS c2t, replace(seq, 'G', 'A') AS g2a FROM genome", "genome")
oracle(
    "genome_convert_counts",
    "SELECT sum(len(list_filter(range(1, length(seq)), lambda i: substr(seq, i, 2) = 'CG')))::BIGINT AS cg, sum(len(list_filter(range(1, length(seq) + 1), lambda i: substr(seq, i, 1) = 'C')))::BIGINT AS c, sum(len(list_filter(range(1, length(seq) + 1), lambda i: substr(seq, i, 1) = 'G')))::BIGINT AS g FROM genome",
    "genome",
)
oracle(
    "ct_rich_tiles",
    """
SELECT chr, start, start + length(s) AS "end", ratio FROM (SELECT *, length(regexp_replace(s, '[^CT]', '', 'g'))::DOUBLE / length(replace(s, 'N', '')) AS ratio FROM (
  SELECT chr, t * 50 AS start, substr(seq, t * 50 + 1, 50) AS s FROM (SELECT chr, seq, unnest(range(0, (length(seq) - 1) // 50 + 1)) AS t FROM genome) g) a WHERE length(s) >= 45) b WHERE ratio >= 0.6 OR ratio <= 0.4
""",
    "genome",
)
oracle("genome_kmers", "SELECT substr(seq, p, 12) AS kmer, chr, p AS pos FROM (SELECT chr, seq, unnest(range(1, length(seq) - 10)) AS p FROM genome) g", "genome")
oracle("sam_header", "SELECT 0 AS n, '@HD' || chr(9) || 'VN:1.0' || chr(9) || 'SO:coordinate' AS value UNION ALL SELECT 1, '@SQ' || chr(9) || 'SN:' || i.chr || chr(9) || 'LN:' || length FROM info i UNION ALL SELECT 2, '@PG' || chr(9) || 'ID:methframe' || chr(9) || 'VN:1.0' || chr(9) || 'CL:mode=3'", "info")
oracle("accuracy_se", "SELECT count(*) AS total, count(*) FILTER (mapq >= 30) AS q30, count(*) FILTER (read_no % 3 <> 0) AS correct, count(*) FILTER (read_no % 3 <> 0)::DOUBLE * 100 / count(*) AS percent FROM single", "single")
oracle("accuracy_pe", "SELECT count(*) AS total, count(*) FILTER (mapq >= 30) AS q30, count(*) FILTER (mapq % 4 <> 0) AS correct, count(*) FILTER (mapq % 4 <> 0)::DOUBLE * 100 / count(*) AS percent FROM pairs", "pairs")
oracle("viewer_fragments", "SELECT name, chr, pos, seq, strand FROM view_rows", "view_rows")
oracle("viewer_glyphs", "SELECT * FROM drawn", "drawn")
VIEWS["drawn_taps"] = (_glyphs("T", "C", "A", "G"), ["view_rows", "genome"])
oracle("viewer_glyphs_taps", "SELECT * FROM drawn_taps", "drawn_taps")
oracle(
    "viewer_trim",
    """SELECT name, pos, greatest(301, "left")::BIGINT AS "left", substr(row, (greatest(301, "left") - "left" + 1)::BIGINT, (600 - greatest(301, "left") + 1)::BIGINT) AS row, strand FROM picture
WHERE "left" <= 600 AND length(row) > greatest(301, "left") - "left" AND NOT regexp_full_match(substr(row, (greatest(301, "left") - "left" + 1)::BIGINT, (600 - greatest(301, "left") + 1)::BIGINT), '[ =-]+')""",
    "picture",
)
oracle("viewer_snp_column", "SELECT * FROM snp", "snp")
oracle("viewer_snp_sorted", """SELECT name, pos, CASE WHEN "column" IS NULL OR length(row) <= "column" THEN '' ELSE substr(row, "column" + 1, 1) END AS allele FROM picture, snp""", "snp")
DENSE = """
SELECT name, row FROM (SELECT name, regexp_replace(string_agg(substr(row, s + 1, 2), '' ORDER BY s), '-$', '') AS row FROM picture JOIN (
  SELECT unnest(list_filter(range(0, 999), lambda i: substr(piece, i + 1, 2) = 'CG')) AS s FROM (SELECT substr(seq, (SELECT any_value("left") FROM picture), 1000) AS piece FROM genome WHERE chr = 'chr3') g) c ON s <= length(row) - 2 GROUP BY name) d WHERE trim(row) <> ''
"""
oracle("viewer_dense1", DENSE, "picture", "genome")
oracle("sim_bisulfite", "SELECT read_no, replace(seq1, 'C', 'T') AS seq FROM raw", "raw")

# Rows in the order of pos and name each go to the first line with room: the state is the lines' ends so far.
VIEWS["dense_rows"] = (f"SELECT d.row, pos, length(d.row) - length(ltrim(d.row)) AS b, row_number() OVER (ORDER BY pos, d.name) AS k FROM ({DENSE}) d JOIN picture p ON p.name = d.name", ["picture", "genome"])
oracle(
    "viewer_dense2",
    """SELECT (line - 1)::BIGINT AS line, string_agg(repeat(' ', (b - before)::INTEGER) || ltrim(row), '' ORDER BY k) AS row FROM (
  SELECT w.k, w.line, b, d.row, coalesce(lag(length(d.row)) OVER (PARTITION BY w.line ORDER BY w.k), 0) AS before FROM walk w JOIN dense_rows d ON d.k = w.k) x GROUP BY line""",
    "dense_rows",
)
ORACLES["viewer_dense2"] = ORACLES["viewer_dense2"].replace("WITH ", "WITH RECURSIVE ", 1).replace(
    ") SELECT (line - 1)",
    """), walk AS (
  SELECT 0::BIGINT AS k, 0::BIGINT AS line, []::BIGINT[] AS ends
  UNION ALL SELECT k, line, CASE WHEN line > len(ends) THEN list_append(ends, e) ELSE list_concat(list_append(ends[1:line - 1], e), ends[line + 1:]) END FROM (
    SELECT d.k, length(d.row)::BIGINT AS e, w.ends, coalesce(list_position(list_transform(w.ends, lambda e: e + 5 <= d.b), true), len(w.ends) + 1)::BIGINT AS line FROM walk w JOIN dense_rows d ON d.k = w.k + 1) step
) SELECT (line - 1)""",
    1,
)

# --- report and charts ----------------------------------------------------------------

SHARE = "CASE WHEN {w} > 0 THEN (({p}) * 20000 + {w}) // (2 * {w}) // 100 || '.' || lpad(((({p}) * 20000 + {w}) // (2 * {w}) % 100)::VARCHAR, 2, '0') || ' %' ELSE 'NA' END"
COMMAS = "format('{{:,}}', ({0})::BIGINT)"
REPORT = [
    ("Total reads", "total", None), ("After trimming", "kept", ("kept", "total")), ("Aligned", "aligned", ("aligned", "kept")), ("Forward strand", "w", ("w", "aligned")), ("Reverse strand", "c", ("c", "aligned")),
    ("Unique", '"unique"', ('"unique"', '"all"')), ("Duplicate", "dup", ("dup", '"all"')), ("Discarded", "discard", ("discard", '"all"')),
    ("Methylation, watson", "w_all", ("wC", "w_all")), ("Methylation, crick", "c_all", ("cC", "c_all")), ("Methylation, total", "(w_all + c_all)", ("wC + cC", "(w_all + c_all)")),
    ("Control reads", "control", None), ("Control conversion", "control_all", ("control_t", "control_all")),
]
VIEWS["facts"] = (
    f"""
SELECT t.total, t.dropped, t.total - t.dropped AS kept, s.*, u.*, "all" - "unique" - discard AS dup, m.*, k.* FROM ({_count_cut('cut_pe')}) t,
  (SELECT count(*) AS aligned, count(*) FILTER (strand = 'W') AS w, count(*) FILTER (strand = 'C') AS c, count(*) AS "all", count(*) FILTER (chr NOT IN (SELECT chr FROM genome)) AS discard FROM pairs) s,
  (SELECT count(*) AS "unique" FROM unique_pairs) u,
  (SELECT coalesce(sum(wC), 0)::BIGINT AS wC, coalesce(sum(wC + wT), 0)::BIGINT AS w_all, coalesce(sum(cC), 0)::BIGINT AS cC, coalesce(sum(cC + cT), 0)::BIGINT AS c_all FROM calls_pairs WHERE chr <> 'chrL') m,
  (SELECT coalesce(sum(wT + cT), 0)::BIGINT AS control_t, coalesce(sum(wC + wT + cC + cT), 0)::BIGINT AS control_all, (SELECT count(*) FROM known_pairs WHERE chr = 'chrL') AS control FROM calls_pairs WHERE chr = 'chrL') k
""",
    ["cut_pe", "pairs", "unique_pairs", "calls_pairs", "known_pairs", "genome"],
)


def _reported(n: int, item: str, value: str, share: tuple[str, str] | None) -> str:
    shown = COMMAS.format(value)
    if share and n > 7:  # a level of nothing has no number of bases
        shown = f"CASE WHEN {value} > 0 THEN {shown} ELSE '' END"
    part = SHARE.format(p=share[0], w=share[1]) if share else "''"
    return f"SELECT {n} AS n, '{item}' AS item, {shown} AS value, {part} AS share FROM facts"


VIEWS["report"] = (" UNION ALL ".join(_reported(n, *row) for n, row in enumerate(REPORT)), ["facts"])
oracle("report_rows", "SELECT n, item, value, share FROM report", "report")
oracle(
    "html_report",
    """SELECT '<!DOCTYPE html><html><head><meta charset="utf-8"><title>Methylation report</title></head><body><h1>Methylation report</h1><table><tr><th>Item</th><th>Value</th><th>Share</th></tr>'
|| string_agg('<tr><td>' || item || '</td><td>' || value || '</td><td>' || share || '</td></tr>', '' ORDER BY n) || '</table></body></html>' AS page FROM report""",
    "report",
)


def _text(x: str, y: str, shown: str, more: str = "") -> str:
    return f"""'<text x="' || {x} || '" y="' || {y} || '"{more}>' || {shown} || '</text>'"""


def _svg(inside: str, ends: str, x_label: str, y_label: str, numbers: bool = True) -> str:
    """SQL of charts: inside gives (chart, inside), ends gives (chart, x0, x1, y0, y1)."""
    marks = [f"""'<rect x="70" y="40" width="660" height="300" fill="none" stroke="black"/>'""", _text("400", "400", f"'{x_label}'", ' text-anchor="middle"'), _text("20", "190", f"'{y_label}'", ' text-anchor="middle" transform="rotate(-90 20 190)"')]
    for k in range(5):
        if numbers:
            marks.append(_text(str(70 + 165 * k), "360", f"floor(x0 + (x1 - x0) * {k} / 4 + 0.5)::BIGINT", ' text-anchor="middle"'))
        marks.append(_text("62", str(345 - 75 * k), f"printf('%.1f', floor((y0 + (y1 - y0) * {k} / 4) * 10 + 0.5) / 10)", ' text-anchor="end"'))
    head = """'<svg xmlns="http://www.w3.org/2000/svg" width="760" height="420" font-family="sans-serif" font-size="14">'"""
    return f"SELECT e.chart, {head} || {' || '.join(marks)} || coalesce(inside, '') || '</svg>' AS svg FROM ({ends}) e LEFT JOIN ({inside}) i ON i.chart = e.chart"


def _lines(series: list[tuple[str, str, str]], table: str, chart: str, x: str, ends: str, x_label: str, y_label: str) -> str:
    """series: (expression, label, colour) of each line."""
    points = " UNION ALL ".join(f"SELECT {chart} AS chart, {k} AS part, '{label}' AS label, '{colour}' AS colour, ({x})::DOUBLE AS x, ({y})::DOUBLE AS y FROM {table}" for k, (y, label, colour) in enumerate(series))
    placed = f"""
SELECT chart, part, '<polyline fill="none" stroke-width="2" stroke="' || colour || '" points="' || string_agg(px || ',' || py, ' ' ORDER BY x, px || ',' || py) || '"/><text x="' || 70 + 90 * part || '" y="28" fill="' || colour || '">' || label || '</text>' AS piece FROM (
  SELECT p.*, floor(70 + (x - x0) * 660 / CASE WHEN x1 > x0 THEN x1 - x0 ELSE 1 END + 0.5)::BIGINT AS px, floor(340 - (y - y0) * 300 / CASE WHEN y1 > y0 THEN y1 - y0 ELSE 1 END + 0.5)::BIGINT AS py
  FROM ({points}) p JOIN ({ends}) e ON e.chart = p.chart WHERE x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1) q GROUP BY chart, part, label, colour"""
    return _svg(f"SELECT chart, string_agg(piece, '' ORDER BY part) AS inside FROM ({placed}) l GROUP BY chart", ends, x_label, y_label)


def _ends(chart: str, x0: str, x1: str, y0: str, y1: str, source: str) -> str:
    return f"SELECT {chart} AS chart, ({x0})::DOUBLE AS x0, coalesce(({x1})::DOUBLE, 1) AS x1, ({y0})::DOUBLE AS y0, coalesce(({y1})::DOUBLE, 1) AS y1 FROM {source}"


_PLACES = [("watson", "Watson", "red"), ("crick", "Crick", "blue")]
_MATE = "'composition_' || mate"
oracle(
    "chart_composition",
    _lines(
        [('"A"', "A", "green"), ('"C"', "C", "blue"), ('"G"', "G", "orange"), ('"T"', "T", "red"), ('"N"', "N", "black")], "fq_share", _MATE, "cycle",
        _ends(_MATE, "1", "max(cycle)", "0", 'least(100.0::DOUBLE, max(greatest("A", "C", "G", "T", "N")) + 10)', "fq_share GROUP BY mate"), "Sequencing cycle", "Frequency (%)",
    ),
    "fq_share",
)
oracle(
    "chart_sizes",
    _lines([("proportion", "All", "black")], "sizes", "'sizes'", "size", _ends("'sizes'", "CASE WHEN min(size) > 100 THEN 100 WHEN min(size) > 50 THEN 50 ELSE 0 END", "greatest(300, coalesce(max(size) FILTER (proportion > 0.01), 300))", "0", "max(proportion)", "sizes"), "Fragment size (bp)", "Frequency (%)"),
    "sizes",
)
VIEWS["by_cycle"] = ("SELECT cycle, CASE WHEN wC + wT > 0 THEN wC::DOUBLE * 100 / (wC + wT) END AS watson, CASE WHEN cC + cT > 0 THEN cC::DOUBLE * 100 / (cC + cT) END AS crick FROM mbias", ["mbias"])
oracle("chart_mbias", _lines(_PLACES, "by_cycle", "'mbias_1'", "cycle", _ends("'mbias_1'", "1", "max(cycle)", "0", "100", "by_cycle"), "Sequencing cycle", "Methylation level (%)"), "by_cycle")
VIEWS["around"] = (f"SELECT distance, watson * 100 AS watson, crick * 100 AS crick FROM ({TSS}) t", ["bins", "calls"])
oracle("chart_tss", _lines(_PLACES, "around", "'tss'", "distance", _ends("'tss'", "min(distance)", "max(distance)", "0", "80", "around"), "Distance from transcription start (bp)", "Methylation level (%)"), "around")
_BAR = """coalesce(CASE WHEN {h} > 0 THEN '<rect x="' || printf('%.2f', floor((70 + w * (n + {at})) * 100 + 0.5) / 100) || '" y="' || 340 - {h} || '" width="' || printf('%.2f', floor(w * 100 / 3 + 0.5) / 100) || '" height="' || {h} || '" fill="{colour}"/>' END, '')"""
VIEWS["bars"] = (
    """SELECT chr, row_number() OVER (ORDER BY chr) - 1 AS n, 660 / (count(*) OVER ())::DOUBLE AS w, floor(wC::DOUBLE * 100 / nullif(wC + wT, 0) * 300 / 100 + 0.5)::BIGINT AS hw, floor(cC::DOUBLE * 100 / nullif(cC + cT, 0) * 300 / 100 + 0.5)::BIGINT AS hc FROM log""",
    ["log"],
)
_LEGEND = "".join(f'<text x="{70 + 90 * k}" y="28" fill="{colour}">{label}</text>' for k, (_, label, colour) in enumerate(_PLACES))
_NAME = """'<text font-size="10" text-anchor="end" x="' || floor(70 + w * (n + 0.5) + 0.5)::BIGINT || '" y="352" transform="rotate(-45 ' || floor(70 + w * (n + 0.5) + 0.5)::BIGINT || ' 352)">' || chr || '</text>'"""
oracle(
    "chart_chromosomes",
    _svg(
        f"SELECT 'chromosomes' AS chart, '{_LEGEND}' || string_agg({_BAR.format(h='hw', at='0.5::DOUBLE / 3', colour='red')} || {_BAR.format(h='hc', at='1.5::DOUBLE / 3', colour='blue')} || {_NAME}, '' ORDER BY n) AS inside FROM bars",
        _ends("'chromosomes'", "0", "count(*)", "0", "100", "bars"), "Chromosome", "Methylation level (%)", False,
    ),
    "bars",
)

# --- text forms, selections, certain outcomes of the simulator --------------------------

oracle("fastq_roundtrip", "SELECT id1 AS id, seq1 AS seq, qual1 AS qual FROM raw", "raw")
for _name in ("fastq_pairs_roundtrip", "fastq_blocks"):
    oracle(
        _name,
        "SELECT row_number() OVER (ORDER BY read_no) - 1 AS read_no, id1, substr(seq1, 1, n) AS seq1, substr(qual1, 1, n) AS qual1, id2, substr(seq2, 1, n) AS seq2, substr(qual2, 1, n) AS qual2 FROM (SELECT *, least(length(seq1), length(seq2)) AS n FROM raw) r",
        "raw",
    )
oracle("fasta_roundtrip", "SELECT chr, seq FROM genome", "genome")
oracle("genome_with_control", "SELECT chr, seq FROM genome UNION ALL SELECT 'chrlambda', seq FROM genome WHERE chr = 'chrL'", "genome")
oracle("chr_info_roundtrip", "SELECT * FROM info", "info")
oracle("calls_roundtrip", "SELECT * FROM calls", "calls")
oracle("bed_roundtrip", 'SELECT chr, start, "end" FROM bed', "bed")
oracle("refgene_roundtrip", "SELECT chr, strand, tx_start, tx_end, gene FROM refgene", "refgene")
oracle("conf_roundtrip", "SELECT n_name AS key, n_regionkey::VARCHAR AS value FROM nation")
oracle(
    "sam_roundtrip",
    "SELECT name AS qname, (CASE WHEN strand = 'W' THEN 0 ELSE 16 END)::INTEGER AS flag, chr, pos::BIGINT AS pos, mapq, cigar, seq, qual, strand, (-(mapq % 7))::INTEGER AS as_score, mapq % 3 = 0 AS has_xs FROM single",
    "single",
)
oracle("alignments_roundtrip", "SELECT read_no, chr, pos, cigar, seq, qual, strand FROM single", "single")
oracle("metrics_roundtrip", f"SELECT unnest(['Dropped', 'Aadaptor', 'Tail Hit']) AS key, unnest([dropped, adapter, tail]) AS value FROM ({_count_cut('cut_pe')}) t", "cut_pe")
oracle(
    "log_lines",
    """SELECT unnest(['All', 'Unique', 'Duplicate', 'Discard']) || chr(9) || unnest(["all", "unique", "all" - "unique" - discard, discard]) AS value
FROM (SELECT count(*) AS "all", count(*) FILTER (chr NOT IN (SELECT chr FROM genome)) AS discard FROM pairs) a, (SELECT count(*) AS "unique" FROM unique_pairs) u
UNION ALL SELECT CASE WHEN strand = 'W' THEN 'WATSON' ELSE 'CRICK' END || chr(9) || count(*) FROM merged GROUP BY strand""",
    "unique_pairs",
    "merged",
)
oracle("mbias_lines", "SELECT '#' || concat_ws(chr(9), 'cycle', 'wC', 'wT', 'wO', 'cC', 'cT', 'cO') AS value UNION ALL SELECT concat_ws(chr(9), cycle, wC, wT, wO, cC, cT, cO) FROM (" + _mbias("seen_single", 1) + ") m", "seen_single")
oracle("bedgraph_lines", "SELECT concat_ws(chr(9), chr, locus - 1, locus, round((wC + cC)::DOUBLE * 100 / (wC + cC + wT + cT))::INTEGER) AS value FROM calls WHERE wC + cC + wT + cT > 0", "calls")
oracle(
    "wig_lines",
    """SELECT 'track type=''wiggle_0'' name=''depth'' description=''depth, bin=100''' AS value UNION ALL SELECT 'variableStep chrom=' || i.chr || ' span=100' FROM info i WHERE substr(i.chr, 4, 1) <> 'M'
UNION ALL SELECT pos || chr(9) || printf('%.4f', value) FROM ("""
    + WIG.format(weight="1.0::DOUBLE")
    + ") w",
    "bed",
    "info",
)
oracle("annotated_bed", 'SELECT concat_ws(chr(9), t.chr, t.start, t."end", sites, c, t.t) AS value FROM (' + STATS.format(calls="calls") + ") t", "calls", "bed")
oracle("concordant_pairs", "SELECT read_no FROM sized WHERE frag_size BETWEEN 40 AND 80", "sized")
oracle("viewer_one_strand", "SELECT name || '_R' || m AS name, pos, strand FROM region WHERE strand = 'C'", "region")
oracle("sim_errors", "SELECT read_no, length(seq1)::BIGINT AS changed, length(seq1)::BIGINT AS n FROM raw", "raw")
oracle("sim_snps", "SELECT read_no, 3::BIGINT AS changed FROM raw", "raw")
oracle("sim_adapter", "SELECT read_no, substr(seq1, 1, length(seq1) - 10) || 'AGATCGGAAG' AS seq FROM raw", "raw")
oracle("sim_random", "SELECT r AS read_no, 40::BIGINT AS n, true AS pure FROM range(200) t(r)")

# --- binary files, mates as rows of their own, total orders ------------------------------


def _digest(rows: str, order: str, *columns: str) -> str:
    """Number and digest of rows in an order."""
    text = " || '|' || ".join([f"(row_number() OVER (ORDER BY {order}) - 1)", *columns])
    return f"SELECT count(*) AS rows, coalesce(sum(('0x' || substr(md5(t), 1, 12))::BIGINT % 1000000007), 0)::BIGINT AS digest FROM (SELECT {text} AS t FROM ({rows}) o) d"


ORACLES["bam_roundtrip"] = ORACLES["sam_roundtrip"]
oracle(
    "bam_region",
    f"""SELECT name AS qname, (CASE WHEN strand = 'W' THEN 0 ELSE 16 END)::INTEGER AS flag, chr, pos::BIGINT AS pos, mapq, cigar, seq, qual, strand, (-(mapq % 7))::INTEGER AS as_score, mapq % 3 = 0 AS has_xs
FROM any_single WHERE chr = 'chr3' AND pos <= 900 AND pos + {REFLEN.format(c='cigar')} - 1 >= 201""",
    "any_single",
)
oracle("bam_order", _digest("SELECT * FROM single WHERE regexp_full_match(chr, 'chr[0-9XYL]+')", "chr, pos, name", "chr", "pos", "name"), "single")
oracle("sam_pairs", "SELECT name, chr, strand, mapq, pos1::BIGINT AS pos1, cigar1, seq1, qual1, pos2::BIGINT AS pos2, cigar2, seq2, qual2 FROM pairs", "pairs")
VIEWS["mate_rows"] = (
    """
SELECT p.name, (3 + CASE WHEN mate = 1 THEN 64 ELSE 128 END + CASE WHEN (p.strand = 'W') = (mate = 1) THEN 32 ELSE 16 END)::INTEGER AS flag, m.*, CASE WHEN mate = 1 THEN seq1 ELSE seq2 END AS seq,
  CASE WHEN mate = 1 THEN qual1 ELSE qual2 END AS qual FROM mated m JOIN pairs p USING (read_no)
""",
    ["mated", "pairs"],
)
oracle("sam_pair_lines", "SELECT concat_ws(chr(9), name, flag, chr, pos, mapq, cigar, rnext, pnext, tlen, seq, qual, CASE WHEN strand = 'W' THEN 'XG:Z:CT' ELSE 'XG:Z:GA' END) AS value FROM mate_rows", "mate_rows")
oracle(
    "mate_fixup",
    """SELECT name AS qname, flag, chr, pos::BIGINT AS pos, mapq, CASE WHEN mapq >= 3 THEN '=' ELSE '*' END AS rnext, CASE WHEN mapq >= 3 THEN pnext ELSE 0 END::BIGINT AS pnext, CASE WHEN mapq >= 3 THEN tlen ELSE 0 END::BIGINT AS tlen
FROM mate_rows WHERE mate = 1 OR mapq >= 3""",
    "mate_rows",
)
oracle("calls_order", _digest("SELECT concat_ws(chr(9), chr, locus, total, wC, wT, wO, context, cC, cT, cO) AS line, * FROM calls", "chr, locus", "line"), "calls")
oracle("genome_order", _digest("SELECT concat_ws(chr(9), chr, length) AS line, * FROM info", "chr", "line"), "info")
oracle(
    "bins_order",
    _digest(
        """SELECT concat_ws(chr(9), chr, bin, c, t) AS line, * FROM (SELECT 'hs' || substr(chr, 4) AS chr, locus // 100 AS bin, sum(wC + cC)::BIGINT AS c, sum(wT + cT)::BIGINT AS t FROM calls
WHERE regexp_matches(chr, '[0-9XY]$') AND NOT contains(chr, '_') GROUP BY 1, 2) b WHERE c + t > 0""",
        "chr, bin", "line",
    ),
    "calls",
)
oracle("name_order", _digest("SELECT name, 0 AS second, pos1 AS pos FROM pairs UNION ALL SELECT name, 128, pos2 FROM pairs", "name, second", "name", "second", "pos"), "pairs")
ORACLES["fqstat_file"] = ORACLES["fqstat"]
oracle(
    "logs_roundtrip",
    """SELECT 'merge' AS log, CASE WHEN strand = 'W' THEN 'WATSON' ELSE 'CRICK' END AS key, count(*) AS value FROM merged GROUP BY strand
UNION ALL SELECT 'duplicates', unnest(['All', 'Unique', 'Duplicate', 'Discard']), unnest(["all", "unique", "all" - "unique" - discard, discard])
FROM (SELECT count(*) AS "all", count(*) FILTER (chr NOT IN (SELECT chr FROM genome)) AS discard FROM pairs) a, (SELECT count(*) AS "unique" FROM unique_pairs) u
UNION ALL SELECT 'calls', chr || ':' || unnest(['reads', 'wC', 'wT', 'cC', 'cT']), unnest([reads, wC, wT, cC, cT]) FROM log""",
    "unique_pairs",
    "merged",
    "log",
)
oracle("align_gapped", "SELECT read_no, chr, pos, (CASE kind WHEN 0 THEN -11 WHEN 1 THEN -8 ELSE 0 END)::INTEGER AS as_score, (CASE kind WHEN 0 THEN 72 WHEN 1 THEN 69 ELSE 70 END)::BIGINT AS spanned, kind < 2 AS gapped FROM placed", "placed")
oracle("align_paired", "SELECT read_no, chr, pos1, pos2, 0::INTEGER AS as_score, '40M' AS cigar1, '40M' AS cigar2 FROM placed_pairs", "placed_pairs")
ORACLES["cpg_calls_tiled"] = ORACLES["cpg_calls"]
oracle(
    "suffix_places",
    """SELECT pattern, chr, p AS pos FROM (SELECT DISTINCT substr(seq, 1, 20) AS pattern FROM placed) s
JOIN (SELECT chr, p, substr(translate(seq, 'C', 'T'), p, 20) AS part FROM (SELECT chr, seq, unnest(range(1, length(seq) - 18)) AS p FROM genome) g) k ON part = pattern""",
    "placed",
    "genome",
)
oracle(
    "viewer_paper",
    """SELECT chr, width, rows, CASE WHEN width > 2 * rows THEN CASE WHEN width > 600 THEN 'A1' WHEN width > 400 THEN 'A2' WHEN width > 240 THEN 'A3' ELSE 'A4' END
ELSE CASE WHEN width > 400 THEN 'A1' WHEN width > 280 THEN 'A2' WHEN width > 160 THEN 'A3' ELSE 'A4' END END AS sheet, CASE WHEN width > 2 * rows THEN 'Landscape' ELSE 'Portrait' END AS orientation
FROM (SELECT chr, (max(pos) - min(pos))::INTEGER AS width, count(*)::INTEGER AS rows FROM single GROUP BY chr) s""",
    "single",
)
