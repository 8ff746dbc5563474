"""The operators that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLE: dict[str, str] = {}

ORACLE["op3_line_dedup"] = f"""
WITH cut AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n
  FROM documents
), keyed AS (
  SELECT doc_id, n, line, translate(trim(line, {BLANKS}), {UPPER}) AS k FROM cut
), frequent AS (
  SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT doc_id, n, line, last IS NOT NULL AND doc_id <> last AS dropped FROM keyed LEFT JOIN frequent USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

ORACLE["op4_curriculum_mix"] = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix:' || doc_id) AS rank
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS n
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, [5.0, 2.0, 1.0][n % 3 + 1]::DOUBLE AS weight, [0.5, 0.0, -0.5][n % 3 + 1]::DOUBLE AS lean FROM sources
), shared AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - 2 * coalesce(sum(source_size) OVER filled, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER filled, 0)) AS level
  FROM weighed WINDOW filled AS (ORDER BY source_size / weight, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), rest AS (
  SELECT level FROM shared WHERE level * weight < 2 * source_size ORDER BY source_size / weight, n LIMIT 1
), goals AS (
  SELECT source, source_size, lean,
         coalesce(least(2 * source_size::DOUBLE, (SELECT level FROM rest) * weight), 2 * source_size::DOUBLE) AS target
  FROM shared
), ran AS (
  SELECT s.doc_id, s.size, g.source_size, g.target, g.lean,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY ('0x' || substr(s.rank, 1, 8))::BIGINT % 4096, s.rank, s.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
), used AS (
  SELECT *, before + size / 2 < target AS once, before + source_size + size / 2 < target AS twice,
         CASE WHEN before + size / 2 < target THEN before / target END AS f
  FROM ran
)
SELECT doc_id, size, source_size, target, ((once::INT + twice::INT) * size)::BIGINT AS taken,
       2 * f / ((1 - lean) + sqrt((1 - lean) * (1 - lean) + 4 * lean * f)) AS first_position
FROM used
"""

# Classes of equal shingle sets keep the joins small; reachability runs over their links.
ORACLE["op1_minhash_dedup"] = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), cut AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM split
), sized AS (
  SELECT doc_id, len(s)::BIGINT AS n_shingles FROM cut
), shingle AS (
  SELECT doc_id, unnest(s) AS g FROM cut
), pair AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM shingle a JOIN shingle b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
), link AS (
  SELECT a, b FROM pair JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b
  WHERE 100 * shared >= 75 * (x.n_shingles + y.n_shingles - shared)
), way AS (
  SELECT a, b FROM link UNION ALL SELECT b, a FROM link
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM sized UNION SELECT r.a, w.b FROM reach r JOIN way w ON w.a = r.b
), least AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM sized JOIN least USING (doc_id)
"""

ORACLE["op9_embedding_dedup"] = """
WITH RECURSIVE sound AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), way AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.vec_id <> b.vec_id
  WHERE len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, w.b FROM reach r JOIN way w ON w.a = r.b
), least AS (
  SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT vec_id, (SELECT count(*) FROM way WHERE a = vec_id)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM least
"""


ORACLE["op11_best_position_search"] = rf"""
WITH word AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, {UPPER}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), posting AS (
  SELECT doc_id, term, count(*)::BIGINT AS tf FROM word GROUP BY doc_id, term
), sized AS (
  SELECT doc_id, sum(tf)::BIGINT AS n FROM posting GROUP BY doc_id
), whole AS (
  SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM sized
), weighed AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM posting, whole GROUP BY term, docs
), asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, {UPPER}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), query AS (
  SELECT item_id, term, count(*)::BIGINT AS times FROM asked GROUP BY item_id, term
), impact AS (
  SELECT p.doc_id, p.term,
         w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms))) AS points
  FROM posting p JOIN sized USING (doc_id) JOIN weighed USING (term), whole
), scored AS (
  SELECT item_id, doc_id, sum(times * points)::BIGINT AS score
  FROM query JOIN impact USING (term) GROUP BY item_id, doc_id
), placed AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, rank::INT AS rank, doc_id, score FROM placed WHERE rank <= 20
"""


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
