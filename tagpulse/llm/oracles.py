"""SQL of another engine for the queries that it can express."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SUBSTRING_DEDUP = f"""
WITH w AS (SELECT doc_id, {WORDS} AS words FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS line
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w WHERE len(words) >= 13)),
firsts AS (SELECT line, min(doc_id) AS first FROM windows GROUP BY line),
gone AS (
  SELECT DISTINCT doc_id, i + k AS place
  FROM (SELECT doc_id, i, unnest(range(13)) AS k FROM windows JOIN firsts USING (line) WHERE doc_id > first)),
kept AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY place) AS line
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM w) ANTI JOIN gone USING (doc_id, place)
  GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(line, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id"""

ORACLES = {"op7_substring_dedup": SUBSTRING_DEDUP}
