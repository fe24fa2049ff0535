"""SQL for the queries that it can express."""

from __future__ import annotations

# Control strings hold no first character of another, so they are counted one by one.
OP4 = r"""
WITH c AS (
  SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), e AS (
  SELECT *,
    len(text) + len(regexp_extract_all(text, '\\|\[/?INST\]|</s>|<\|(?:role|text)\|>')) AS text_chars,
    len(role) + len(regexp_extract_all(role, '\\|\[/?INST\]|</s>|<\|(?:role|text)\|>')) AS role_chars
  FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(len(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(text_chars + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 4 ELSE role_chars + 20 END)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

OP6 = """
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), g AS (
  SELECT text, max(doc_id) AS keep_id, count(*) AS group_size, sha256(text) AS text_sha256
  FROM t GROUP BY text
)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, g.text_sha256
FROM t JOIN g USING (text)
"""

OP7 = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), g AS (
  SELECT doc_id, unnest(generate_series(1, len(ws) - 12)) AS i, ws FROM w WHERE len(ws) > 12
), h AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS gram FROM g
), f AS (
  SELECT gram, min(doc_id) AS first_id FROM h GROUP BY gram
), gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(i, i + 12)) AS i
  FROM h JOIN f USING (gram) WHERE first_id < doc_id
), lost AS (
  SELECT doc_id, list(i) AS places, count(*) AS n_removed FROM gone GROUP BY doc_id
)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
  sha256(coalesce(array_to_string(
    list_filter(ws, lambda x, i: NOT coalesce(list_contains(places, i), false)), ' '), '')) AS kept_sha256
FROM w LEFT JOIN lost USING (doc_id)
"""

OP10 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents
), g AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(ws) >= 3 THEN list_transform(generate_series(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 2], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS gram FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id
), p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS same
  FROM g x JOIN g y USING (gram) WHERE x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM p JOIN n u ON u.doc_id = a JOIN n v ON v.doc_id = b
  WHERE 100 * same >= 90 * (u.n + v.n - same)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM w
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM w LEFT JOIN n USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
"""

OP12 = r"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents
), s AS (
  SELECT count(*) AS nn, sum(len(ts))::BIGINT AS ll FROM w WHERE len(ts) > 0
), p AS (
  SELECT r, doc_id, len(ts) AS n, unnest(ts) AS term FROM w
), tf AS (
  SELECT r, doc_id, n, term, count(*) AS tf FROM p GROUP BY ALL
), df AS (
  SELECT term, count(*) AS df FROM tf GROUP BY term
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), hit AS (
  SELECT item_id, r, doc_id, sum(
    floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * df + 1)))::BIGINT
      * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * nn) // ll))))::BIGINT AS score
  FROM q JOIN df USING (term) JOIN tf USING (term), s GROUP BY ALL
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, r) AS rank FROM hit WHERE score > 0
) WHERE rank <= 10
"""


def llm_oracle_sql() -> dict[str, str]:
    return {
        "op4_chat_format": OP4,
        "op6_exact_dedup": OP6,
        "op7_substring_dedup": OP7,
        "op10_jaccard_join": OP10,
        "op12_ranked_search": OP12,
    }
