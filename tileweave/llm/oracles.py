"""DuckDB SQL of operators 11 and 12."""

from __future__ import annotations

from tileweave.llm import licenses

#: Unsigned crc32 of c's decimal form: a byte is added, and then eight bits are shifted out.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT,
    flatten(list_transform(string_split(c::VARCHAR, ''), lambda x: [ascii(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda a, x: xor(xor(a, x) >> 1, CASE WHEN xor(a, x) & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END)), 4294967295::BIGINT)"""

CONVERSATION_TRIE = f"""
WITH turns AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS role, strlen(coalesce(text, '')) AS size,
         sha256(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS digest
  FROM conversations WHERE conv_id IS NOT NULL),
placed AS (SELECT c, digest, size, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, size, digest) - 1 AS p FROM turns),
convs AS (SELECT DISTINCT c, c - c % 5 AS head, {_CRC} % 9 AS h FROM placed),
rebuilt AS (
  SELECT convs.c, 0 AS own, p, digest, size FROM convs JOIN placed ON placed.c = head AND p < h
  UNION ALL SELECT convs.c, 1, p, digest, size FROM convs JOIN placed ON placed.c = convs.c AND p >= h),
numbered AS (SELECT c, digest, size, row_number() OVER (PARTITION BY c ORDER BY own, p) AS d FROM rebuilt),
prefixes AS (
  SELECT c, d, size, list(digest) OVER (PARTITION BY c ORDER BY d) AS path FROM numbered
  UNION ALL SELECT c, 0, 0, []::VARCHAR[] FROM convs),
nodes AS (SELECT d, path, any_value(size) AS size, min(c) AS conv_id, count(*) AS n FROM prefixes GROUP BY d, path),
kids AS (SELECT d - 1 AS d, path[1:d - 1] AS path, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
shown AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (d, path)),
below AS (
  SELECT k AS d, path[1:k] AS path, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n - 1) * size) AS saved_tokens
  FROM (SELECT shown.*, unnest(range(0, d + 1)) AS k FROM shown) GROUP BY ALL),
lasts AS (SELECT c, arg_max(path, d) AS path FROM prefixes GROUP BY c),
ends AS (SELECT path, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS hash FROM lasts GROUP BY path)
SELECT s.conv_id, s.d AS depth, up.conv_id AS parent_conv_id, s.n AS n_convs, s.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, coalesce(hash, sha256('')) AS ends_sha256
FROM shown s JOIN below USING (d, path) LEFT JOIN ends ON ends.path = s.path
LEFT JOIN nodes up ON s.d > 0 AND up.d = s.d - 1 AND up.path = s.path[1:s.d - 1]"""


def _list(items: list[str]) -> str:
    return "[" + ", ".join(f"'{x}'" for x in items) + "]"


def _license_sql() -> str:
    span = licenses.SPAN
    rows = []
    for label, text in licenses.TEMPLATES:
        words = sorted(set(licenses.words_of(text)))
        rows.append(f"('{label}', {_list(words)}, {licenses.needed(len(words), licenses.THRESHOLD)})")
    places = []
    for phrase, label in licenses.PHRASES:
        test = " AND ".join(f"words[i + {k + 1}] = '{w}'" for k, w in enumerate(phrase.split()))
        places.append(f"SELECT r, '{label}' AS label, i FROM (SELECT r, words, unnest(range(len(words))) AS i FROM docs WHERE list_contains(words, '{phrase.split()[0]}')) WHERE {test}")
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{licenses.WORD}') AS words FROM documents),
templates(label, tokens, need) AS (VALUES {", ".join(rows)}),
places AS ({" UNION ALL ".join(places)}),
base AS (SELECT r, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word FROM places GROUP BY r),
blocks AS (SELECT r, list_distinct(words[b * {span} + 1 : b * {span} + {2 * span}]) AS block
           FROM (SELECT r, words, unnest(range(CAST(ceil(len(words) / {span}) AS BIGINT))) AS b FROM docs)),
met AS (SELECT r, label, len(list_intersect(block, tokens)) / len(tokens) AS share
        FROM blocks, templates WHERE len(list_intersect(block, tokens)) >= need),
named AS (
  SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE fixed) AS base_labels, max(share) AS score
  FROM (SELECT r, label, true AS fixed, 1.0 AS share FROM places UNION ALL SELECT r, label, false, share FROM met) GROUP BY r)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
       coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM docs LEFT JOIN base USING (r) LEFT JOIN named USING (r)"""


LICENSE_SCAN = _license_sql()
