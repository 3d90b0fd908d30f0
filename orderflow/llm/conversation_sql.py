"""DuckDB SQL of the queries on conversations: their repair and their prefix trie."""

from __future__ import annotations

#: crc32 of the strings in ``keys(key)`` as ``hashes(key, h)``, from the tables of the polynomial.
CRC = """
bits(b, k, v) AS (
    SELECT b, 0, b FROM range(256) AS t(b)
    UNION ALL SELECT b, k + 1, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8
),
one_byte AS (SELECT b, v FROM bits WHERE k = 8),
zeros(n, v) AS (
    SELECT 0, CAST(4294967295 AS BIGINT)
    UNION ALL SELECT n + 1, xor(z.v >> 8, o.v) FROM zeros z JOIN one_byte o ON o.b = z.v % 256 WHERE n < 48
),
shifted(k, b, v) AS (
    SELECT 0, b, v FROM one_byte
    UNION ALL SELECT k + 1, s.b, xor(s.v >> 8, o.v) FROM shifted s JOIN one_byte o ON o.b = s.v % 256 WHERE k < 47
),
letters AS (SELECT key, unnest(range(1, length(key) + 1)) AS i FROM keys),
hashes AS (
    SELECT l.key, xor(xor(any_value(z.v), bit_xor(s.v)), 4294967295) AS h
    FROM letters l JOIN shifted s ON s.k = length(l.key) - l.i AND s.b = ascii(substr(l.key, CAST(l.i AS INT), 1))
    JOIN zeros z ON z.n = length(l.key) GROUP BY l.key
)"""


def _paid(path: str, cost: str, letter: str) -> str:
    """A path (twelve digits of cost, then letters) with one edit more; null stays null."""
    return f"lpad(CAST(CAST(substr({path}, 1, 12) AS BIGINT) + {cost} AS VARCHAR), 12, '0') || substr({path}, 13) || '{letter}'"


def _inserts(source: str) -> str:
    """Up to two turns inserted from each state: x and then y."""
    one = f"SELECT *, s0 AS x0, s1 AS x1, least(s2, {_paid('s0', '5', 'I')}, {_paid('s1', '5', 'I')}, {_paid('s3', '5', 'I')}) AS x2, least(s3, {_paid('s2', '5', 'I')}) AS x3 FROM ({source})"
    return f"SELECT *, x0 AS y0, x1 AS y1, least(x2, {_paid('x3', '5', 'I')}) AS y2, least(x3, {_paid('x2', '5', 'I')}) AS y3 FROM ({one})"


def _keep(state: str, initial: str, letter: str, extra: int) -> str:
    allowed = "fault IN ('', 'truncated')" + (f" AND initial = '{initial}'" if initial else "")
    cost = f"(CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END + {extra})"
    return f"CASE WHEN {allowed} THEN {_paid(state, cost, letter)} END"


REPAIR = rf"""
WITH RECURSIVE told AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
    FROM conversations
),
keys AS (SELECT DISTINCT key FROM told),
{CRC},
damaged AS (
    SELECT conv_id, turn, CASE WHEN h % 20 = 4 THEN 'user' ELSE role END AS role,
        CASE h % 20 WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE WHEN h % 20 = 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM told JOIN hashes USING (key) WHERE h % 20 <> 0
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen
    FROM damaged
),
flagged AS (
    SELECT *, left(role, 1) AS initial,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) AS two,
        CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
            WHEN seen > 1 THEN 'duplicate'
            WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault
    FROM ranked
),
walk(conv_id, pos, s0, s1, s2, s3) AS (
    SELECT DISTINCT conv_id, CAST(0 AS BIGINT), '000000000000', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR)
    FROM flagged
    UNION ALL
    SELECT conv_id, pos,
        {_paid("y0", "2", "D")},
        least({_paid("y1", "2", "D")}, {_keep("y0", "s", "K", 0)}),
        least({_paid("y2", "2", "D")}, {", ".join(_keep(y, "u", "K", 0) for y in ("y0", "y1", "y3"))},
            {", ".join(_keep(y, "", "R", 1) for y in ("y0", "y1", "y3"))}),
        least({_paid("y3", "2", "D")}, {_keep("y2", "a", "K", 0)}, {_keep("y2", "", "R", 1)})
    FROM ({_inserts("SELECT f.conv_id, f.pos, f.fault, f.initial, w.s0, w.s1, w.s2, w.s3 FROM walk w JOIN flagged f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.pos = w.pos + 1")})
),
ends AS (SELECT conv_id, max(pos) AS pos FROM walk GROUP BY conv_id),
best AS (
    SELECT conv_id, least(y0, y3) AS path
    FROM ({_inserts("SELECT w.* FROM walk w JOIN ends e ON w.conv_id IS NOT DISTINCT FROM e.conv_id AND w.pos = e.pos")})
),
steps AS (SELECT conv_id, path, unnest(range(13, length(path) + 1)) AS spot FROM best),
lettered AS (SELECT conv_id, spot, substr(path, CAST(spot AS INT), 1) AS edit FROM steps),
placed AS (
    SELECT *, sum(CASE WHEN edit = 'I' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY spot) AS pos FROM lettered
),
joined AS (
    SELECT p.conv_id, p.spot, p.edit, CASE WHEN p.edit = 'I' THEN '' ELSE f.text END AS text, f.role,
        CASE WHEN p.edit = 'K' AND f.initial = 's' THEN 0 WHEN p.edit = 'D' THEN 0 ELSE 1 END AS speaks
    FROM placed p LEFT JOIN flagged f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.pos = p.pos
),
spoken AS (SELECT *, sum(speaks) OVER (PARTITION BY conv_id ORDER BY spot) AS n FROM joined),
repaired AS (
    SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN n % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text,
        chr(10) ORDER BY spot) AS whole
    FROM spoken WHERE edit <> 'D' GROUP BY conv_id
),
counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (pos > 1 AND two NOT IN ('su', 'ua', 'au')) AS illegal
    FROM flagged GROUP BY conv_id
)
SELECT c.conv_id, CAST(coalesce(n.gaps, 0) AS BIGINT) AS gaps, coalesce(n.blank, 0) AS blank,
    coalesce(n.duplicate, 0) AS duplicate, coalesce(n.truncated, 0) AS truncated, coalesce(n.illegal, 0) AS illegal,
    CAST(coalesce(substr(b.path, 1, 12), '0') AS BIGINT) AS cost, coalesce(substr(b.path, 13), '') AS audit,
    sha256(coalesce(r.whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counts n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM c.conv_id
"""

TRIE = f"""
WITH RECURSIVE told AS (
    SELECT conv_id, turn, coalesce(text, '') AS text,
        md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS said
    FROM conversations WHERE conv_id IS NOT NULL
),
keys AS (SELECT DISTINCT CAST(conv_id AS VARCHAR) AS key FROM told),
{CRC},
own AS (
    SELECT conv_id, said, strlen(text) AS bytes, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, said) AS pos
    FROM told
),
convs AS (
    SELECT conv_id, conv_id - conv_id % 5 AS base, h % 9 AS h
    FROM (SELECT DISTINCT conv_id FROM told) JOIN hashes ON key = CAST(conv_id AS VARCHAR)
),
pieces AS (
    SELECT c.conv_id, 0 AS piece, o.pos, o.said, o.bytes FROM convs c JOIN own o ON o.conv_id = c.base AND o.pos <= c.h
    UNION ALL
    SELECT c.conv_id, 1, o.pos, o.said, o.bytes FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.pos > c.h
),
members AS (
    SELECT conv_id, row_number() OVER in_order AS depth, string_agg(said, '') OVER in_order AS path, bytes
    FROM pieces WINDOW in_order AS (PARTITION BY conv_id ORDER BY piece, pos)
    UNION ALL SELECT conv_id, 0, '', 0 FROM convs
),
nodes AS (
    SELECT path, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs, any_value(bytes) AS bytes
    FROM members GROUP BY path
),
below AS (SELECT left(path, (depth - 1) * 32) AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
costs AS (
    SELECT n.*, coalesce(b.n, 0) AS n_children, (n.n_convs - 1) * n.bytes AS saved FROM nodes n LEFT JOIN below b USING (path)
),
upward AS (SELECT path, saved, n_children, unnest(range(depth + 1)) AS level FROM costs),
sums AS (
    SELECT left(path, level * 32) AS path, sum(saved) AS saved, count(*) FILTER (n_children = 0) AS leaves
    FROM upward GROUP BY 1
),
lengths AS (SELECT conv_id, max(depth) AS depth FROM members GROUP BY conv_id),
ends AS (
    SELECT m.path, string_agg(CAST(m.conv_id AS VARCHAR), ',' ORDER BY m.conv_id) AS ids
    FROM members m JOIN lengths l ON l.conv_id = m.conv_id AND l.depth = m.depth GROUP BY m.path
)
SELECT c.conv_id, CAST(c.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children,
    s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM costs c JOIN sums s USING (path) LEFT JOIN ends e USING (path)
LEFT JOIN nodes p ON c.depth > 0 AND p.path = left(c.path, (c.depth - 1) * 32)
"""
