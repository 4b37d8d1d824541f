"""DuckDB SQL of the corpus queries that SQL can express on whole tables."""

OP2 = """
WITH sizes AS (
  SELECT coalesce(source, '') AS name, sum(coalesce(length(text), 0))::BIGINT AS chars FROM documents GROUP BY 1
), totals AS (
  SELECT sum(sqrt(chars::DOUBLE)) AS all_weight, sum(chars)::BIGINT AS all_chars FROM sizes
), rates AS (
  SELECT name, sqrt(chars::DOUBLE) / all_weight * all_chars * 1.0::DOUBLE / chars AS rate
  FROM sizes, totals WHERE chars > 0
), parts AS (
  SELECT name, ceil(rate / 32.0::DOUBLE)::BIGINT AS parts, rate / ceil(rate / 32.0::DOUBLE)::BIGINT AS rate FROM rates WHERE rate > 0
), steps AS (
  SELECT name, k, exp(-rate + k * ln(rate) - lgamma(k + 1)) AS p
  FROM parts, range(0, 256) AS r(k) WHERE k <= ceil(rate + 12 * sqrt(rate) + 30)
), cdfs AS (
  SELECT name, k, sum(p) OVER (PARTITION BY name ORDER BY k) AS cdf FROM steps
), pieces AS (
  SELECT d.*, coalesce(d.doc_id::VARCHAR, 'null') AS key, p.name, unnest(range(0, p.parts)) AS part
  FROM documents d JOIN parts p ON p.name = coalesce(d.source, '')
), draws AS (
  SELECT *, ('0x' || substr(md5('17:' || key || CASE WHEN part > 0 THEN ':' || part ELSE '' END), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE AS u FROM pieces
), copies AS (
  SELECT doc_id, text, lang, source, n_chars, key,
         unnest(range(part * 256 + 1, part * 256 + 1 + (SELECT count(*) FROM cdfs c WHERE c.name = d.name AND c.cdf <= d.u))) AS replica
  FROM draws d
)
SELECT doc_id, text, lang, source, n_chars, replica, md5('order-17:' || key || ':' || replica) AS order_key FROM copies
"""

OP9 = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS content FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(content) AS text_sha256
FROM t WINDOW w AS (PARTITION BY content)
"""

OP12 = r"""
WITH found AS (
  SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), docs AS (
  SELECT d, doc_id, terms, len(terms)::BIGINT AS n FROM found WHERE len(terms) > 0
), sizes AS (
  SELECT count(*)::BIGINT AS all_docs, sum(n)::BIGINT AS all_terms FROM docs
), postings AS (
  SELECT d, term, count(*)::BIGINT AS tf FROM (SELECT d, unnest(terms) AS term FROM docs) GROUP BY 1, 2
), weights AS (
  SELECT term, floor(1000 * ln((2 * all_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM postings, sizes GROUP BY term, all_docs
), asked AS (
  SELECT i, item_id, term, count(*)::BIGINT AS times FROM (
    SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
  ) GROUP BY 1, 2, 3
), scored AS (
  SELECT i, item_id, d, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * all_docs) // all_terms))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN docs USING (d), sizes GROUP BY 1, 2, 3, 4
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

ORACLES = {"op2_mix_sources": OP2, "op9_exact_dedup": OP9, "op12_lexical_search": OP12}
