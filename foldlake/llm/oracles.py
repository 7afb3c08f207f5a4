"""SQL for DuckDB of queries whose results SQL can express."""

from __future__ import annotations

from foldlake.llm import chat
from foldlake.llm.quality import OP4_SQL
from foldlake.llm.repeats import OP12_SQL
from foldlake.llm.spelling import OP11_SQL

_CONTROLS = "|".join("".join(f"\\{c}" if c in "|[]" else c for c in s) for s in chat.CONTROLS)
_ESCAPED = "length(regexp_replace(replace({0}, '\\', '\\\\'), '(" + _CONTROLS + ")', '\\1+', 'g'))"
_MARKS = len(chat.START) + len(chat.MIDDLE) + len(chat.END)

OP6_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, h, max(page_id) OVER (PARTITION BY h) AS keeper,
      list_aggregate(list_transform(string_split(sha1(h), ''), lambda c: ['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001',
        '1010','1011','1100','1101','1110','1111'][strpos('0123456789abcdef', c)]), 'string_agg', '') AS bits FROM p)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(1 + 16 * CAST(substr(bits, 5 * i + 1, 1) AS INTEGER) + 8 * CAST(substr(bits, 5 * i + 2, 1) AS INTEGER) + 4 * CAST(substr(bits, 5 * i + 3, 1) AS INTEGER)
         + 2 * CAST(substr(bits, 5 * i + 4, 1) AS INTEGER) + CAST(substr(bits, 5 * i + 5, 1) AS INTEGER) AS BIGINT), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM d
"""

OP7_SQL = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
), g AS (
  SELECT conv_id, count(*) AS n, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS whole,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS learned,
         sum({_MARKS} + {_ESCAPED.format('role')} + {_ESCAPED.format('text')}) AS chars
  FROM c GROUP BY conv_id
)
SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(n AS BIGINT) AS n_turns, sha256(whole) AS turns_sha256, CAST(length(learned) AS BIGINT) AS loss_chars,
       sha256(learned) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars FROM g
"""

OP8_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS ws FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, hash(array_to_string(ws[i:i + 3], ' ')) AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM w WHERE len(ws) > 0)
), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), e AS MATERIALIZED (
  SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)
), sides AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r(a, b) AS (
  SELECT a, b FROM sides UNION SELECT r.a, sides.b FROM r JOIN sides ON r.b = sides.a
)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, CAST(least(w.doc_id, coalesce(m.b, w.doc_id)) AS BIGINT) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a, min(b) AS b FROM r GROUP BY a) m ON m.a = w.doc_id
"""

ORACLE_SQL = {
    "op4_quality_rules": OP4_SQL,
    "op6_warc_segments": OP6_SQL,
    "op7_chat_format": OP7_SQL,
    "op8_jaccard_join": OP8_SQL,
    "op11_spelling_variants": OP11_SQL,
    "op12_repeat_removal": OP12_SQL,
}
