"""DuckDB SQL of the queries that SQL can express, in the literal form of their definitions."""

from __future__ import annotations

import string

#: A word, as in ``common.WORD``.
_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"


def _components(width: int, percent: int, kept: bool) -> str:
    """All pairs of documents that share a shingle, their overlap, and what links reach."""
    lower = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    return f"""WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS k, doc_id, {_WORDS.format(text=lower)} AS w FROM documents
),
sets AS (
  SELECT k, doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []
      WHEN len(w) < {width} THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - {width} + 2), lambda i: array_to_string(w[i:i + {width - 1}], ' ')) END) AS s
  FROM words
),
shingles AS (SELECT k, md5_number(g) AS g FROM (SELECT k, unnest(s) AS g FROM sets)),
common_counts AS (
  SELECT a.k AS a, b.k AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.g = b.g AND a.k <> b.k GROUP BY a.k, b.k
),
links AS (
  SELECT o.a, o.b FROM common_counts o JOIN sets x ON o.a = x.k JOIN sets y ON o.b = y.k
  WHERE 100 * o.n >= {percent} * (len(x.s) + len(y.s) - o.n)
),
reached AS (
  SELECT k AS a, k AS b FROM sets UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
),
component AS (SELECT r.a AS k, min(s.doc_id) AS component_id FROM reached r JOIN sets s ON r.b = s.k GROUP BY r.a)
SELECT s.doc_id, len(s.s) AS n_shingles, c.component_id{", s.doc_id = c.component_id AS kept" if kept else ""}
FROM sets s JOIN component c USING (k)"""


#: Bytes in strings of ``length`` bytes that also start elsewhere; a byte is covered if such a string
#: starts at it or fewer than ``length`` bytes before it.
def _repeated_bytes(length: int) -> str:
    return f"""WITH texts AS (
  SELECT row_number() OVER () AS k, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
),
bytes AS (
  SELECT k, i, substr(x, 2 * i + 1, 2) AS b,
         CASE WHEN 2 * (i + {length}) <= len(x) THEN md5_number(substr(x, 2 * i + 1, {2 * length})) END AS h
  FROM (SELECT k, x, unnest(range(0, len(x) // 2)) AS i FROM texts)
),
starts AS (SELECT k, i, b, h IS NOT NULL AND count(*) OVER (PARTITION BY h) > 1 AS again FROM bytes),
covered AS (
  SELECT k, i, b, bool_or(again) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN {length - 1} PRECEDING AND CURRENT ROW) AS gone
  FROM starts
),
runs AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY k ORDER BY i), false) AS first FROM covered),
found AS (
  SELECT k, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE first) AS n_spans,
         string_agg(b, '' ORDER BY i) FILTER (WHERE NOT gone) AS kept
  FROM runs GROUP BY k
)
SELECT t.doc_id, len(t.x) // 2 AS n_bytes, coalesce(f.n_removed, 0) AS n_removed, coalesce(f.n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(f.kept, ''))) AS kept_sha256
FROM texts t LEFT JOIN found f USING (k)"""


def _repeated_words(window: int) -> str:
    return f"""WITH texts AS (
  SELECT row_number() OVER () AS k, doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents
),
words AS (
  SELECT k, doc_id, i, w[i] AS word,
         CASE WHEN i + {window - 1} <= len(w) THEN md5_number(array_to_string(w[i:i + {window - 1}], ' ')) END AS h
  FROM (SELECT k, doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM texts)
),
starts AS (
  SELECT k, i, word, h IS NOT NULL AND row_number() OVER (PARTITION BY h ORDER BY doc_id, k, i) > 1 AS again FROM words
),
covered AS (
  SELECT k, i, word, bool_or(again) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW)
    AS gone FROM starts
),
found AS (
  SELECT k, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept
  FROM covered GROUP BY k
)
SELECT t.doc_id, len(t.w) AS n_words, coalesce(f.n_removed, 0) AS n_removed, sha256(coalesce(f.kept, '')) AS kept_sha256
FROM texts t LEFT JOIN found f USING (k)"""


#: CRC-32 of the decimal id, bit by bit (3988292384 is its reversed polynomial).
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda a, z: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::BIGINT) ELSE a // 2 END)), 4294967295::BIGINT)"""

_TRIE = f"""WITH turns AS (
  SELECT conv_id AS c, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role,
      md5(len(role)::VARCHAR || ':' || role || text)) - 1 AS i
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        WHERE conv_id IS NOT NULL)
),
convs AS (SELECT c, c - c % 20 AS lead, {_CRC} % 4 AS h FROM (SELECT DISTINCT c FROM turns)),
sizes AS (SELECT c AS lead, count(*) AS n FROM turns GROUP BY c),
rebuilt AS (
  SELECT v.c, t.i + 1 AS d, t.role, t.text FROM convs v JOIN turns t ON t.c = v.lead WHERE t.i < v.h
  UNION ALL
  SELECT v.c, t.i - v.h + least(v.h, coalesce(s.n, 0)) + 1 AS d, t.role, t.text
  FROM convs v JOIN turns t ON t.c = v.c LEFT JOIN sizes s ON s.lead = v.lead WHERE t.i >= v.h
),
paths AS (
  SELECT c, d, text, string_agg(len(role)::VARCHAR || ':' || role || len(text)::VARCHAR || ':' || text, '')
    OVER (PARTITION BY c ORDER BY d) AS path FROM rebuilt
  UNION ALL SELECT c, 0, '', '' FROM convs
),
lengths AS (SELECT c, max(d) AS last FROM paths GROUP BY c),
nodes AS (
  SELECT p.d, p.path, min(p.c) AS conv_id, count(*) AS n_convs, len({_WORDS.format(text="any_value(p.text)")}) AS words,
         string_agg(p.c::VARCHAR, ',' ORDER BY p.c) FILTER (WHERE p.d = l.last) AS ends
  FROM paths p JOIN lengths l USING (c) GROUP BY p.d, p.path
),
with_parent AS (
  SELECT n.*, u.path AS parent_path, u.conv_id AS parent_conv_id
  FROM nodes n LEFT JOIN paths q ON q.c = n.conv_id AND q.d = n.d - 1 LEFT JOIN nodes u ON u.d = q.d AND u.path = q.path
),
children AS (SELECT d - 1 AS d, parent_path AS path, count(*) AS n FROM with_parent WHERE d > 0 GROUP BY d, parent_path),
counted AS (SELECT w.*, coalesce(k.n, 0) AS n_children FROM with_parent w LEFT JOIN children k USING (d, path)),
below AS (
  SELECT a.d, a.path, count(*) FILTER (WHERE u.n_children = 0) AS n_leaves, sum((u.n_convs - 1) * u.words) AS saved
  FROM counted u JOIN paths a ON a.c = u.conv_id AND a.d <= u.d GROUP BY a.d, a.path
)
SELECT c.conv_id, c.d AS depth, c.parent_conv_id, c.n_convs, c.n_children, b.n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens,
       sha256(coalesce(c.ends, '')) AS ends_sha256
FROM counted c JOIN below b USING (d, path)"""

ORACLES: dict[str, str] = {
    "op4_near_duplicates": _components(3, 85, kept=True),
    "op5_suffix_array": _repeated_bytes(200),
    "op6_suffix_tree": _repeated_words(20),
    "op11_conversation_trie": _TRIE,
    "op13_jaccard_join": _components(4, 85, kept=False),
}
