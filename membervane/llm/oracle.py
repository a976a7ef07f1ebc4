"""SQL counterparts of the queries of this folder that SQL can express."""

OP8 = r"""
WITH d AS (
  SELECT doc_id, source, COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), s AS (
  SELECT source, SUM(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, [5, 2, 1][((ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM s
), k AS (
  SELECT *, 3 * source_size / weight::DOUBLE AS limit_at FROM w
), r AS (
  SELECT *, (SUM(source_size) OVER () - 3 * COALESCE(SUM(source_size) OVER o, 0))::DOUBLE
            / (SUM(weight) OVER () - COALESCE(SUM(weight) OVER o, 0))::DOUBLE AS level
  FROM k WINDOW o AS (ORDER BY limit_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
  SELECT MIN(limit_at) AS first_open FROM r WHERE limit_at > level
), o AS (
  SELECT (SELECT SUM(source_size) FROM k)::DOUBLE - 3 * COALESCE((SELECT SUM(source_size) FROM k, l WHERE limit_at < first_open OR first_open IS NULL), 0) AS rest,
         COALESCE((SELECT SUM(weight) FROM k, l WHERE limit_at >= first_open), 1)::DOUBLE AS weights
), t AS (
  SELECT k.*, CASE WHEN first_open IS NULL OR limit_at < first_open THEN 3.0 * source_size
                   ELSE weight * rest / weights END::DOUBLE AS target
  FROM k, l, o
), e AS (
  SELECT d.*, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN LEAST(3.0::DOUBLE, t.target / t.source_size) ELSE 0 END AS expected,
         (('0x' || substr(md5('mix:' || COALESCE(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), f AS (
  SELECT *, FLOOR(expected)::BIGINT AS whole, expected - FLOOR(expected) AS share FROM e
), q AS (
  SELECT *, CASE WHEN share > 0 AND size > 0 THEN (u / (1 - u)) / (share / (1 - share)) END AS place,
         target - SUM(whole * size) OVER (PARTITION BY source) AS missing
  FROM f
), c AS (
  SELECT *, SUM(size) OVER (PARTITION BY source ORDER BY place, doc_id) AS words FROM q WHERE place IS NOT NULL
), g AS (
  SELECT *, missing - COALESCE(MAX(words) FILTER (words <= missing) OVER (PARTITION BY source), 0) AS gap FROM c
), n AS (
  SELECT *, CASE WHEN words > missing AND ABS(gap - size) < gap
                 THEN ROW_NUMBER() OVER (PARTITION BY source ORDER BY words <= missing OR ABS(gap - size) >= gap, ABS(gap - size), place, doc_id) END AS turn
  FROM g
), x AS (
  SELECT doc_id, size, source_size, target, (whole + (words <= missing OR COALESCE(turn = 1, FALSE))::INT) * size AS taken FROM n
  UNION ALL
  SELECT doc_id, size, source_size, target, whole * size FROM q WHERE place IS NULL
)
SELECT doc_id, size, source_size, ROUND(target, 6) AS target, taken::BIGINT AS taken FROM x
"""

OP1 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, o.vec_id, list_inner_product(q.vector, o.vector)::BIGINT AS score
  FROM v q JOIN v o ON q.vec_id % 20 = 0 AND q.vec_id <> o.vec_id
), r AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

# The checksum of a decimal number, byte by byte and bit by bit.
CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda x, b: list_reduce(list_prepend(xor(x, b), range(8)),
                             lambda y, i: xor(y >> 1, CASE WHEN y % 2 = 1 THEN 3988292384 ELSE 0 END)::BIGINT)))::BIGINT"""

OP13 = rf"""
WITH t AS (
  SELECT conv_id::BIGINT AS conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), g AS (
  SELECT *, md5(length(role) || ':' || role || text) AS digest, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))::BIGINT AS words FROM t
), o AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, digest) AS place FROM g
), h AS (
  SELECT conv_id, conv_id - conv_id % 20 AS giver, {CRC32} % 4 AS head FROM (SELECT DISTINCT conv_id FROM t)
), r AS (
  SELECT h.conv_id, o.place, o.digest, o.words FROM h JOIN o ON o.conv_id = h.giver AND o.place <= h.head
  UNION ALL
  SELECT conv_id, place, digest, words FROM o JOIN h USING (conv_id) WHERE place > head
), p AS (
  SELECT conv_id, words, ROW_NUMBER() OVER w AS depth, md5(string_agg(digest, '') OVER w) AS node
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY place)
), q AS (
  SELECT conv_id, words, depth, node, COALESCE(lag(node) OVER (PARTITION BY conv_id ORDER BY depth), '') AS parent FROM p
  UNION ALL SELECT conv_id, 0, 0, '', NULL FROM h
), n AS (
  SELECT node, parent, depth, words, MIN(conv_id) AS conv_id, COUNT(*) AS n_convs FROM q GROUP BY ALL
), c AS (
  SELECT parent AS node, COUNT(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY ALL
), m AS (
  SELECT n.*, COALESCE(n_children, 0) AS n_children FROM n LEFT JOIN c USING (node)
), s AS (
  SELECT q.node, SUM((m.n_convs - 1) * m.words)::BIGINT AS saved_tokens, COUNT(*) FILTER (m.n_children = 0) AS n_leaves
  FROM m JOIN q ON q.conv_id = m.conv_id AND q.depth <= m.depth GROUP BY ALL
), e AS (
  SELECT node, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256
  FROM (SELECT conv_id, arg_max(node, depth) AS node FROM q GROUP BY ALL) GROUP BY ALL
)
SELECT m.conv_id, m.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, m.n_convs, m.n_children, n_leaves, saved_tokens, COALESCE(ends_sha256, sha256('')) AS ends_sha256
FROM m JOIN s USING (node) LEFT JOIN e USING (node) LEFT JOIN n u ON u.node = m.parent
"""


def llm_oracles() -> dict[str, str]:
    return {"op1_mtree": OP1, "op8_pareto_mix": OP8, "op13_prefix_trie": OP13}
