"""SQL of the training-data queries, for another engine over the same tables."""

from __future__ import annotations

import re

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"[^\x20\x09-\x0D]+"


def near_duplicates(width: int = 2, percent: int = 80, documents: str = "documents") -> str:
    """doc_id, n_shingles, component_id, kept by comparing all sets that share a shingle."""
    parts = " || ' ' || ".join(f"w[i + {k}]" for k in range(width))
    return rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
         '{_WORDS}') AS w FROM {documents}
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {width} THEN [array_to_string(w, ' ')]
         ELSE list_sort(list_distinct([{parts} for i in range(1, len(w) - {width} + 2)])) END AS s
  FROM words
), classes AS (
  SELECT s, min(doc_id) AS node, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s
), posts AS (
  SELECT node, n, unnest(s) AS shingle FROM classes
), links AS (
  SELECT a.node AS a, b.node AS b FROM posts a JOIN posts b
  ON a.shingle = b.shingle AND a.node < b.node
  AND 100 * b.n >= {percent} * a.n AND 100 * a.n >= {percent} * b.n
  GROUP BY a.node, b.node, a.n, b.n
  HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))
), steps AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), reached AS (
  SELECT node, node AS other FROM classes
  UNION SELECT r.node, t.b FROM reached r JOIN steps t ON r.other = t.a
), components AS (
  SELECT node, min(other) AS component_id FROM reached GROUP BY node
)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles,
  coalesce(k.component_id, d.doc_id) AS component_id,
  d.doc_id = coalesce(k.component_id, d.doc_id) AS kept
FROM sets d LEFT JOIN classes c ON d.s = c.s LEFT JOIN components k ON k.node = c.node
"""

WEB_ARCHIVES = """
WITH payloads AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), sized AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest
  FROM payloads
), named AS (
  SELECT *, CASE WHEN payload_bytes >= 100
            THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM sized
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first < page_id THEN first END AS refers_to
FROM named
"""


def license_notices(documents: str = "documents") -> str:
    """All windows of all documents against all templates, by shared shingles."""
    from lendscope.llm.licenses import NOTICES, PERCENT, WIDTH, window_words

    def words(text: str) -> str:
        return f"regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{M}}\\p{{N}}]+')"

    def shingles(array: str) -> str:
        parts = " || ' ' || ".join(f"{array}[i + {k}]" for k in range(WIDTH))
        return f"list_distinct([{parts} for i in range(1, len({array}) - {WIDTH} + 2)])"

    rows = ", ".join(
        "('{}', '{}')".format(name, notice.replace("'", "''")) for name, notice in NOTICES.items()
    )
    sizes = {len(re.findall("[a-z0-9]+", n.lower())) for n in NOTICES.values()}
    cases = " ".join(f"WHEN {n} THEN {window_words(n)}" for n in sorted(sizes))
    return f"""
WITH given(license, notice) AS (VALUES {rows}
), cut AS (
  SELECT license, {words("notice")} AS t FROM given
), known AS (
  SELECT license, CASE len(t) {cases} END AS size, {shingles("t")} AS wanted FROM cut
), texts AS (
  SELECT doc_id, {words("text")} AS w FROM {documents} WHERE text IS NOT NULL
), windows AS (
  SELECT doc_id, size, unnest(range(0, len(w), size // 2)) AS first_word, w
  FROM texts, (SELECT DISTINCT size FROM known)
), parts AS (
  SELECT doc_id, size, first_word, w[first_word + 1 : first_word + size] AS p FROM windows
), matches AS (
  SELECT doc_id, license, first_word, len(p) AS n_words, len(wanted) AS wanted,
    len(list_intersect(wanted, {shingles("p")})) AS matched
  FROM parts JOIN known USING (size)
)
SELECT doc_id, license, CAST(first(first_word ORDER BY matched DESC, first_word, n_words DESC) AS INT) AS first_word,
  CAST(first(n_words ORDER BY matched DESC, first_word, n_words DESC) AS INT) AS n_words,
  count(*) AS n_windows, CAST(max(matched) AS INT) AS matched, CAST(wanted AS INT) AS wanted
FROM matches WHERE 100 * matched >= {PERCENT} * wanted
GROUP BY doc_id, license, wanted
"""

FILTER_AUDIT = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body FROM documents
), firsts AS (
  SELECT body, min(doc_id) AS first_id FROM texts GROUP BY body
), judged AS (
  SELECT doc_id, part, t.body, regexp_extract_all(t.body, '[^\x20\x09-\x0D]+') AS w,
    f.first_id IS NOT NULL AND (doc_id IS NULL OR doc_id > f.first_id) AS copy
  FROM texts t JOIN firsts f ON t.body = f.body
), flags AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), fails AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    map {
      'A': len(w) < 200,
      'B': 100 * len(list_distinct(w)) < 50 * len(w),
      'C': 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 3 * length(body),
      'D': regexp_matches(body, '[#$%&*|]'),
      'E': copy
    } AS f
  FROM judged LEFT JOIN flags USING (doc_id)
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter
), orders AS (
  SELECT '' AS filter_order
  UNION ALL
  SELECT filter_order || letter FROM orders, letters WHERE NOT contains(filter_order, letter)
), steps AS (
  SELECT filter_order, i AS step, substr(filter_order, i, 1) AS letter,
    string_split(substr(filter_order, 1, i - 1), '') AS earlier
  FROM orders, range(1, 6) r(i) WHERE length(filter_order) = 5
), patterns AS (
  SELECT part, f, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM fails GROUP BY part, f
), seen AS (
  SELECT part, filter_order, step, letter, n, good, toxic, f[letter] AS failing,
    len(list_filter(earlier, lambda x: x <> '' AND f[x])) > 0 AS gone,
    len(list_filter(map_values(f), lambda x: x)) = 1 AND f[letter] AS alone
  FROM patterns, steps
), counted AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, letter,
    CAST(coalesce(sum(n) FILTER (NOT gone AND NOT failing), 0) AS BIGINT) AS kept,
    CAST(coalesce(sum(n) FILTER (NOT gone AND failing), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (gone AND failing), 0) AS BIGINT) AS redundant,
    CAST(coalesce(sum(n) FILTER (alone), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(good) FILTER (NOT gone AND failing), 0) AS BIGINT) AS good_lost,
    CAST(coalesce(sum(toxic) FILTER (NOT gone AND failing), 0) AS BIGINT) AS toxic_lost
  FROM seen GROUP BY part, filter_order, step, letter
)
SELECT * EXCLUDE (letter),
  CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM counted
"""

# The reflected polynomial of CRC-32 is a fixed value.
CONVERSATION_TRIE = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS body,
    row_number() OVER (
      PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))
    ) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
    xor(list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT),
        [CAST(ord(x) AS BIGINT) FOR x IN string_split(CAST(conv_id AS VARCHAR), '')]),
      lambda c, b: list_reduce(list_prepend(xor(c, b), [CAST(i AS BIGINT) FOR i IN range(8)]),
        lambda r, i: xor(r >> 1, (r & 1) * 3988292384))
    ), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
  SELECT i.conv_id, 0 AS own, pos, role, body
  FROM ids i JOIN turns t ON t.conv_id = i.base AND t.pos <= i.h
  UNION ALL
  SELECT i.conv_id, 1, pos, role, body
  FROM ids i JOIN turns t ON t.conv_id = i.conv_id AND t.pos > i.h
), members AS (
  SELECT conv_id, length(body) AS chars,
    list(struct_pack(role := role, body := body)) OVER (
      PARTITION BY conv_id ORDER BY own, pos ROWS UNBOUNDED PRECEDING) AS path
  FROM rebuilt
  UNION ALL
  SELECT conv_id, 0, [] FROM ids
), last AS (
  SELECT conv_id, max(len(path)) AS depth FROM members GROUP BY conv_id
), nodes AS (
  SELECT path, min(m.conv_id) AS conv_id, len(path) AS depth, count(*) AS n_convs,
    (count(*) - 1) * any_value(chars) AS saved,
    sha256(coalesce(string_agg(CAST(m.conv_id AS VARCHAR), ',' ORDER BY m.conv_id)
      FILTER (l.depth = len(path)), '')) AS ends_sha256
  FROM members m JOIN last l ON m.conv_id = l.conv_id GROUP BY path
), kids AS (
  SELECT path[1:len(path) - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1
), counted AS (
  SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k ON n.path = k.path
), below AS (
  SELECT path[1:d.i] AS path, saved, n_children FROM counted, range(0, depth + 1) d(i)
), totals AS (
  SELECT path, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
  FROM below GROUP BY path
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs,
  n.n_children, t.n_leaves, CAST(t.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM counted n JOIN totals t ON n.path = t.path
LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[1:n.depth - 1]
"""

# The forms of personal data, and what is cut from the ends of words.
_FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_EDGES = "0123456789!\"#$%&''()*+,-./:;<=>?@[\\]^_`{|}~“”‘’«»‹›„¿¡…–—·•。、，！？（）"


def personal_data(near: int = 8, support: int = 3) -> str:
    """Spans of values, and of terms that tell 3/4 or 7/8 of a value's information."""
    byte = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    luhn = f"""list_sum([CASE WHEN (length({digits}) - i) % 2 = 0 THEN d
        WHEN d > 4 THEN 2 * d - 9 ELSE 2 * d END
        FOR d, i IN [CAST(x AS INTEGER) FOR x IN string_split({digits}, '')]]) % 10 = 0"""
    valid = f"""CASE kind WHEN 'email' THEN true
      WHEN 'ip' THEN regexp_full_match(m, '{byte}(?:\\.{byte}){{3}}')
      WHEN 'card' THEN length({digits}) BETWEEN 13 AND 19 AND {luhn}
      ELSE length({digits}) BETWEEN 9 AND 15 END"""

    def cut(name: str, source: str, column: str) -> str:
        """CTE: (key, kind, matches, gaps) of each source row and kind."""
        return f"{name} AS (" + " UNION ALL ".join(
            f"SELECT key, {k} AS rank, '{kind}' AS kind, regexp_extract_all({column}, '{form}') AS ms,"
            f" string_split_regex({column}, '{form}') AS gaps FROM {source}"
            for k, (kind, form) in enumerate(_FORMS.items())
        ) + ")"

    def words(gap: str) -> str:
        return (
            f"list_filter([trim(x, '{_EDGES}') FOR x IN regexp_extract_all({gap}, '{_WORDS}')],"
            " lambda t: regexp_full_match(t, '[\\p{L}\\p{M}''’-]{2,}'))"
        )

    start = "list_sum([length(x) FOR x IN gaps[1:i]]) + coalesce(list_sum([length(x) FOR x IN ms[1:i - 1]]), 0)"
    return rf"""
WITH texts AS (
  SELECT row_number() OVER () AS key, doc_id, coalesce(text, '') AS body FROM documents
), lines AS (
  SELECT row_number() OVER () AS key, line
  FROM (SELECT DISTINCT unnest(string_split(body, chr(10))) AS line FROM texts) WHERE line <> ''
), {cut("line_cuts", "lines", "line")}, near AS (
  SELECT DISTINCT key, kind, m, unnest(list_concat([''], right_terms, left_terms)) AS term
  FROM (
    SELECT key, kind, ms[i] AS m,
      list_reverse({words("gaps[i]")})[1:{near}] AS left_terms,
      {words("gaps[i + 1]")}[1:{near}] AS right_terms
    FROM line_cuts, range(1, len(ms) + 1) r(i)
  ) WHERE {valid}
), pairs AS (
  SELECT kind, m, term, count(*) AS n_pair FROM near GROUP BY ALL HAVING count(*) >= {support}
), held AS (
  SELECT term, count(DISTINCT key) AS n_term FROM (
    SELECT key, unnest([trim(x, '{_EDGES}') FOR x IN regexp_extract_all(line, '{_WORDS}')]) AS term
    FROM lines
  ) GROUP BY term
), shares AS (
  SELECT p.term, p.n_pair::DOUBLE / h.n_term::DOUBLE AS r, v.n_pair AS n_value,
    (SELECT count(*)::DOUBLE FROM lines) AS n
  FROM pairs p JOIN held h ON p.term = h.term
  JOIN pairs v ON v.kind = p.kind AND v.m = p.m AND v.term = ''
  WHERE p.term <> ''
), telling AS (
  SELECT term, bool_or(((r * r) * (r * r)) * ((r * r) * (r * r)) * n >= n_value) AS removed
  FROM shares WHERE (r * r) * (r * r) * n >= n_value GROUP BY term
), {cut("cuts", "texts", "body")}, found AS (
  SELECT key, rank, kind, CAST({start} AS BIGINT) AS start, ms[i] AS m
  FROM cuts, range(1, len(ms) + 1) r(i)
), good AS (
  SELECT key, rank, kind, start, start + length(m) AS stop FROM found WHERE {valid}
), tokens AS (
  SELECT key, regexp_extract_all(body, '{_WORDS}') AS ms, string_split_regex(body, '{_WORDS}') AS gaps
  FROM texts
), places AS (
  SELECT key, ms[i] AS token, trim(ms[i], '{_EDGES}') AS bare, CAST({start} AS BIGINT) AS start
  FROM tokens, range(1, len(ms) + 1) r(i)
  WHERE trim(ms[i], '{_EDGES}') IN (SELECT term FROM telling)
), added AS (
  SELECT key, CASE WHEN removed THEN 5 ELSE 4 END AS rank,
    CASE WHEN removed THEN 'removed' ELSE 'general' END AS kind,
    start + position(bare IN token) - 1 AS start,
    start + position(bare IN token) - 1 + length(bare) AS stop
  FROM places JOIN telling ON bare = term
), listed AS (
  SELECT key, rank, start, kind || ':' || start || ':' || stop AS span
  FROM (SELECT * FROM good UNION ALL SELECT * FROM added)
), joined AS (
  SELECT key, string_agg(span, ',' ORDER BY rank, start) AS spans,
    string_agg(span, ',' ORDER BY rank, start) FILTER (rank < 4) AS base,
    count(*) FILTER (rank = 0) AS n_email, count(*) FILTER (rank = 1) AS n_ip,
    count(*) FILTER (rank = 2) AS n_card, count(*) FILTER (rank = 3) AS n_phone
  FROM listed GROUP BY key
)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip,
  coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN joined USING (key)
"""
