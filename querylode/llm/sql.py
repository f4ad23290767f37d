"""DuckDB SQL that must give the rows of the queries."""

EXACT_DEDUP = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept,
       sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm)
"""

QUALITY = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), w AS (
  SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM t WHERE len(words) >= 8)
), r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS c FROM w) WHERE c > 1),
c AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, range(0, 8) AS o(k) GROUP BY doc_id),
m AS (
  SELECT t.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         len(lines)::BIGINT AS n_lines,
         len(list_filter(words, lambda x: regexp_matches(x, '\p{Lu}{2,}[^\p{Ll}]*$')))::BIGINT AS n_shouted
  FROM t LEFT JOIN c USING (doc_id)
), b AS (
  SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END) + (CASE WHEN n_dup_lines > 3 AND 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END)
    + (CASE WHEN word_chars < 2 * n_words OR word_chars > 20 * n_words THEN 16 ELSE 0 END)
    + (CASE WHEN 2 * n_shouted > n_words AND n_words > 0 THEN 32 ELSE 0 END)::BIGINT AS failed_bits FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed_bits & 3) <> 0 AS base_failed,
       failed_bits = 0 AS kept, n_lines, n_shouted, failed_bits::BIGINT AS failed_bits FROM b
"""
