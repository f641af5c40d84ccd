"""DuckDB SQL for the queries that SQL can express."""

SQL = {
    "op4_warc": r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT payload_digest, min(page_id) AS keep FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id > keep THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > keep THEN keep END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
""",
    "op10_line_dedup": r"""
WITH l AS (
  SELECT doc_id, generate_subscripts(a, 1) AS i, unnest(a) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents)
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), c AS (
  SELECT key, max(doc_id) AS keep FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), m AS (
  SELECT doc_id, i, line, coalesce(doc_id < keep, false) AS gone FROM k LEFT JOIN c USING (key)
), s AS (
  SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INT)) AS BIGINT) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS kept FROM m GROUP BY doc_id
)
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256, CAST(length(kept) AS BIGINT) AS kept_chars FROM s
""",
}
