"""The registered queries of this subpackage and, where SQL can express one, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from scfsweep.llm import decontaminate, kneser_ney, mixing, near_duplicates, pseudonyms, rules, sharding, signature_join, suffix_dedup, text_search, toxicity, urls, vector_codes

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_toxicity": toxicity.op1_toxicity,
        "op2_kneser_ney": kneser_ney.op2_kneser_ney,
        "op3_winnowing": decontaminate.op3_winnowing,
        "op4_suffix_array": suffix_dedup.op4_suffix_array,
        "op5_pseudonyms": pseudonyms.op5_pseudonyms,
        "op6_jaccard_join": near_duplicates.op6_jaccard_join,
        "op7_rules": rules.op7_rules,
        "op8_mixing": mixing.op8_mixing,
        "op9_url_filter": urls.op9_url_filter,
        "op10_sharding": sharding.op10_sharding,
        "op11_signature_join": signature_join.op11_signature_join,
        "op12_term_scan": text_search.op12_term_scan,
        "op13_bounded_codes": vector_codes.op13_bounded_codes,
    }


_OP3 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM documents
), items AS (
  SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM (SELECT *, least(10, len(w)) AS n FROM items WHERE len(w) > 0))
), grams AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
), found AS (SELECT r, n, i, item_id FROM grams JOIN windows USING (n, g)),
hit AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM found) GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""

_OP7 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), grams AS (
  SELECT r, i, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM docs)
), twice AS (SELECT r, i FROM grams QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
repeats AS (SELECT r, count(DISTINCT k) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS k FROM twice) GROUP BY r),
lines AS (
  SELECT r, count(*) - count(DISTINCT l) AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM docs)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r
), measured AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    coalesce(lines.n, 0) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words
  FROM docs LEFT JOIN lines USING (r) LEFT JOIN repeats USING (r)
), judged AS (
  SELECT *, CAST((n_words < 10)::INT + 2 * (100 * n_repeat_words > 20 * n_words)::INT + 4 * (10 * n_symbols > 3 * n_words)::INT
    + 8 * (word_chars > 20 * n_words)::INT + 16 * (2 * word_chars < 3 * n_words)::INT + 32 * (n_dup_lines > 50)::INT AS BIGINT) AS failed
  FROM measured
)
SELECT *, failed & 3 <> 0 AS base_failed, failed & 31 = 0 AS kept FROM judged
"""


_OP11 = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), grams AS (
  SELECT DISTINCT r, array_to_string(w[i:i + 3], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM docs WHERE len(w) > 0)
), sizes AS (SELECT r, count(*) AS n FROM grams GROUP BY r),
links AS (
  SELECT a, b FROM (SELECT x.r AS a, y.r AS b, count(*) AS common FROM grams x JOIN grams y USING (g) WHERE x.r <> y.r GROUP BY ALL)
  JOIN sizes p ON p.r = a JOIN sizes q ON q.r = b WHERE 100 * common >= 80 * (p.n + q.n - common)
), reach AS (
  SELECT r AS a, r AS b FROM docs UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), least AS (SELECT reach.a AS r, min(d.doc_id) AS component_id FROM reach JOIN docs d ON d.r = reach.b GROUP BY ALL)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM docs LEFT JOIN sizes USING (r) JOIN least USING (r)
"""

_OP12 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM documents
), items AS (
  SELECT row_number() OVER () AS i, item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM benchmark
), sums AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM docs WHERE len(w) > 0),
tfs AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM docs) GROUP BY ALL),
asked AS (SELECT i, item_id, t, count(*) AS n FROM (SELECT i, item_id, unnest(w) AS t FROM items) GROUP BY ALL),
dfs AS (SELECT t, count(*) AS df FROM tfs GROUP BY t),
weights AS (SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS weight FROM dfs, sums),
lengths AS (SELECT r, doc_id, 75 + (25 * len(w) * n_docs) // n_terms AS m FROM docs, sums WHERE len(w) > 0),
scores AS (
  SELECT i, item_id, doc_id, r, CAST(sum(n * weight * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM asked JOIN tfs USING (t) JOIN weights USING (t) JOIN lengths USING (r) GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, r) AS INT) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 20
"""


def _op13() -> str:
    """Rounds of assignment and update one after another; sums stay whole, as doubles hold them."""
    assigned = """a{k} AS MATERIALIZED (
      SELECT vec_id, p, q, CAST(least % 256 AS BIGINT) AS e, CAST(least // 256 AS BIGINT) AS d FROM (
        SELECT vec_id, p, any_value(x.q) AS q, min(256 * CAST(x.s - 2 * list_inner_product(x.q, c.q) + list_inner_product(c.q, c.q) AS HUGEINT) + c.e) AS least
        FROM parts x JOIN c{k} c USING (p) GROUP BY vec_id, p))"""
    updated = """c{n} AS MATERIALIZED (
      SELECT p, e, coalesce(m.q, c.q) AS q FROM c{k} c LEFT JOIN (
        SELECT p, e, list(v ORDER BY i) AS q FROM (
          SELECT p, e, i, floor(sum(v) / count(*)) AS v FROM (SELECT p, e, unnest(q) AS v, generate_subscripts(q, 1) AS i FROM a{k}) GROUP BY ALL
        ) GROUP BY p, e) m USING (p, e))"""
    rounds = ", ".join(x.format(k=k, n=k + 1) for k in range(4) for x in (assigned, updated))
    return f"""
    WITH kept AS (
      SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS q FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), parts AS MATERIALIZED (
      SELECT *, list_inner_product(q, q) AS s FROM (
        SELECT vec_id, CAST(p AS INT) AS p, list_slice(q, CAST(p * len(q) // 4 + 1 AS BIGINT), CAST((p + 1) * len(q) // 4 AS BIGINT)) AS q FROM kept, range(4) t(p))
    ), c0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, q FROM parts QUALIFY e < 256),
    {rounds}, {assigned.format(k=4)},
    coded AS (SELECT vec_id, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a4 GROUP BY vec_id),
    labelled AS (SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error FROM coded JOIN kept USING (vec_id))
    SELECT *, (SELECT sha256(string_agg(array_to_string(list_transform(q, lambda x: CAST(x AS BIGINT)), ','), ',' ORDER BY p, e)) FROM c4) AS codebooks_sha256
    FROM labelled
    """


def oracle_sql() -> dict[str, str]:
    return {"op3_winnowing": _OP3, "op7_rules": _OP7, "op11_signature_join": _OP11, "op12_term_scan": _OP12, "op13_bounded_codes": _op13()}
