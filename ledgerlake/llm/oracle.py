"""DuckDB SQL for the queries that SQL can express on whole tables, written without the operators."""

WORDS = r"'[^\x20\x09-\x0D]+'"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Every pair of documents that share a shingle is counted; components are closed by recursion.
JACCARD = f"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all({LOWER}, {WORDS}) AS words FROM documents
), numbered AS (
  SELECT doc_id, len(words) AS n, generate_subscripts(words, 1) AS i, unnest(words) AS word FROM texts
), shingles AS (
  SELECT DISTINCT doc_id, shingle FROM (
    SELECT doc_id, n, i, word
      || coalesce(' ' || lead(word, 1) OVER (PARTITION BY doc_id ORDER BY i), '')
      || coalesce(' ' || lead(word, 2) OVER (PARTITION BY doc_id ORDER BY i), '') AS shingle
    FROM numbered
  ) WHERE i + 2 <= n OR i = 1
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared.n >= 90 * (x.n + y.n - shared.n)
), reached AS (
  SELECT a AS doc_id, a AS other FROM links
  UNION
  SELECT reached.doc_id, links.b FROM reached JOIN links ON links.a = reached.other
), components AS (
  SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
)
SELECT texts.doc_id, coalesce(sizes.n, 0) AS n_shingles,
  coalesce(components.component_id, texts.doc_id) AS component_id
FROM texts LEFT JOIN sizes ON sizes.doc_id = texts.doc_id
  LEFT JOIN components ON components.doc_id = texts.doc_id
"""

# Windows as strings, all of them.
REPEATED_WINDOWS = f"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), {WORDS}) AS words FROM documents
), numbered AS (
  SELECT doc_id, len(words) AS n, generate_subscripts(words, 1) AS i, unnest(words) AS word FROM texts
), windows AS (
  SELECT doc_id, i, word, CASE WHEN i + 34 <= n THEN string_agg(word, ' ') OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING) END AS span
  FROM numbered
), judged AS (
  SELECT doc_id, i, word, span IS NOT NULL AND count(*) OVER (PARTITION BY span) > 1 AS again FROM windows
), covered AS (
  SELECT doc_id, i, word, bool_or(again) OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
  FROM judged
), kept AS (
  SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE gone) AS gone,
    string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS rest
  FROM covered GROUP BY doc_id
)
SELECT texts.doc_id, coalesce(kept.n, 0) AS n_words, coalesce(kept.gone, 0) AS n_removed,
  sha256(coalesce(kept.rest, '')) AS kept_sha256
FROM texts LEFT JOIN kept ON kept.doc_id = texts.doc_id
"""

# All 50-byte strings as hexadecimal digits, each with the smallest document it starts in.
REPEATED_BYTES = """
WITH texts AS (
  SELECT doc_id, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS bytes FROM documents
), places AS (
  SELECT doc_id, len(bytes) AS n, generate_subscripts(bytes, 1) AS i, unnest(bytes) AS byte FROM texts
), strings AS (
  SELECT doc_id, i, byte, CASE WHEN i + 49 <= n THEN string_agg(byte, '') OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING) END AS span
  FROM places
), firsts AS (
  SELECT span, min(doc_id) AS first FROM strings WHERE span IS NOT NULL GROUP BY span
), judged AS (
  SELECT doc_id, i, byte, coalesce(first < doc_id, false) AS again
  FROM strings LEFT JOIN firsts ON firsts.span = strings.span
), covered AS (
  SELECT doc_id, i, byte, bool_or(again) OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
  FROM judged
), runs AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS begins FROM covered
), kept AS (
  SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE gone) AS gone, count(*) FILTER (WHERE begins) AS spans,
    string_agg(byte, '' ORDER BY i) FILTER (WHERE NOT gone) AS rest
  FROM runs GROUP BY doc_id
)
SELECT texts.doc_id, coalesce(kept.n, 0) AS n_bytes, coalesce(kept.gone, 0) AS n_removed,
  coalesce(kept.spans, 0) AS n_spans, sha256(unhex(coalesce(kept.rest, ''))) AS kept_sha256
FROM texts LEFT JOIN kept ON kept.doc_id = texts.doc_id
"""

ORACLE: dict[str, str] = {
    "op1_jaccard_join": JACCARD,
    "op7_substring_dedup": REPEATED_WINDOWS,
    "op8_suffix_dedup": REPEATED_BYTES,
}
