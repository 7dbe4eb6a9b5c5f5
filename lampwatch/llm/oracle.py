"""DuckDB SQL of the operators that SQL can express."""

SQL = {
    "op4_chat": r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
e AS (
  SELECT *, replace(replace(text, '\', '\\'), '<|', '<\|') AS etext,
         replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n') AS erole
  FROM r)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<|im_start|>') + length(erole) + 1 + length(etext) + length('<|im_end|>') + 1) AS BIGINT)
         AS formatted_chars
FROM e GROUP BY conv_id""",
    "op5_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
w AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, text_sha256
FROM w""",
    "op12_divergence": r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS (
  SELECT lang, source, id, translate(term, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT lang, source, row_number() OVER () AS id,
               unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d)),
k AS (
  SELECT lang, term, count(*)::HUGEINT AS total FROM t GROUP BY ALL HAVING count(DISTINCT id) >= 3),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(total)::HUGEINT AS whole FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM t GROUP BY ALL),
dense AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n, k.total
  FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (
  SELECT dense.*, 1 + (1000000000 * (n + 1)) // (sum(n) OVER (PARTITION BY dense.lang, source) + v.v) AS p,
         1 + (1000000000 * (total + 1)) // (v.whole + v.v) AS q
  FROM dense JOIN v ON v.lang = dense.lang),
f AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q),
o AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM o WHERE part = 'pair' OR rank <= 200""",
    "op3_repeats": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT r, doc_id, i, array_to_string(w[i:i + 12], ' ') AS k
  FROM (SELECT *, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
least AS (SELECT k, min(doc_id) AS least FROM win GROUP BY k),
gone AS (
  SELECT DISTINCT r, p
  FROM (SELECT r, unnest(range(i, i + 13)) AS p FROM win JOIN least USING (k) WHERE least < doc_id)),
word AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
kept AS (
  SELECT word.r, count(gone.p) AS n_removed,
         string_agg(word, ' ' ORDER BY word.p) FILTER (WHERE gone.p IS NULL) AS kept
  FROM word LEFT JOIN gone ON gone.r = word.r AND gone.p = word.p GROUP BY word.r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)""",
    "op10_warc": r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
q AS (
  SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes,
         array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                                 1 + CAST(((CAST('0x' || substr(h, CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS BIGINT)
                                            >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) AS BIGINT), 1)
                          for i in range(32)], '') AS payload_digest,
         min(page_id) OVER (PARTITION BY h) AS first
  FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM q""",
}
