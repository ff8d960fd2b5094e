"""The corpus queries as DuckDB SQL, where SQL can express them.

Models (1, 7), pieces (2), page text (5), and the window and alignment rules of 4 and 10 are beyond plain
SQL; tests hold those against brute force, a round trip or held-out labels.
"""

from __future__ import annotations

from murmura.llm.pii import CONTEXT, CONTEXT_REACH, IBAN_LENGTHS

_WORD = r"[^\x20\x09-\x0D]+"

#: Smallest id reachable over ``links`` (a, b), both directions, for every id of ``nodes``.
_REACH = """reach(id, other) AS (
    SELECT id, id FROM nodes
    UNION SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other),
component AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)"""

MINHASH = rf"""WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w
    FROM documents),
sets AS MATERIALIZED (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [hash(array_to_string(w, ' '))]
        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: hash(array_to_string(w[i:i + 4], ' ')))) END AS s
    FROM words),
nodes AS MATERIALIZED (SELECT doc_id AS id, len(s) AS n FROM sets),
items AS MATERIALIZED (SELECT doc_id AS id, unnest(s) AS item FROM sets),
pairs AS (
    SELECT x.id AS a, y.id AS b, count(*) AS c FROM items x JOIN items y ON x.item = y.item AND x.id < y.id GROUP BY x.id, y.id),
half AS MATERIALIZED (
    SELECT a, b FROM pairs JOIN nodes p ON p.id = a JOIN nodes q ON q.id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
links AS (SELECT a, b FROM half UNION ALL SELECT b, a FROM half),
{_REACH}
SELECT id AS doc_id, n AS n_shingles, component_id, component_id = id AS kept FROM nodes JOIN component USING (id)"""

EMBEDDINGS = f"""WITH RECURSIVE vectors AS (
    SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
nodes AS (SELECT id FROM vectors),
usable AS (
    SELECT id, v FROM vectors WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (
    SELECT x.id AS a, y.id AS b FROM usable x JOIN usable y ON x.id <> y.id AND len(x.v) = len(y.v)
    WHERE list_cosine_similarity(x.v, y.v) >= 0.9),
counts AS (SELECT a AS id, count(*) AS n FROM links GROUP BY a),
{_REACH}
SELECT id AS vec_id, coalesce(n, 0) AS n_links, component_id, component_id = id AS kept
FROM nodes JOIN component USING (id) LEFT JOIN counts USING (id)"""

SUBSTRINGS = rf"""WITH words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
items AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words),
windows AS (
    SELECT doc_id, i, CASE WHEN count(*) OVER f = 20 THEN md5(string_agg(word, ' ') OVER f) END AS k
    FROM items WINDOW f AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
repeats AS (
    SELECT doc_id, i, k IS NOT NULL AND row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1 AS again FROM windows),
covered AS (
    SELECT doc_id, i, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
    FROM repeats),
kept AS (
    SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed,
           string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS rest
    FROM items JOIN covered USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)"""

_KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}\b",
}


def _pii() -> str:
    found = " UNION ALL ".join(
        f"SELECT doc_id, t, '{kind}' AS kind, {rank} AS rank, regexp_extract_all(t, '{pattern}') AS m, "
        f"regexp_split_to_array(t, '{pattern}') AS g FROM texts"
        for rank, (kind, pattern) in enumerate(_KINDS.items())
    )
    lengths = ", ".join(f"('{c}', {n})" for c, n in IBAN_LENGTHS.items())
    return rf"""WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
lengths(country, size) AS (VALUES {lengths}),
found AS ({found}),
parts AS (SELECT doc_id, t, kind, rank, unnest(m) AS v, unnest(g[1:len(m)]) AS gap, generate_subscripts(m, 1) AS i FROM found),
placed AS (
    SELECT doc_id, t, kind, rank, v, CAST(sum(length(gap) + length(v)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS BIGINT) AS stop,
           regexp_replace(v, '[^0-9]', '', 'g') AS d, replace(v, ' ', '') AS p FROM parts),
spans AS (
    SELECT *, stop - length(v) AS start FROM placed LEFT JOIN lengths ON country = p[1:2]
    WHERE CASE kind WHEN 'email' THEN TRUE
        WHEN 'ip' THEN len(list_filter(string_split(v, '.'), lambda x: length(ltrim(x, '0')) > 3
                                       OR coalesce(try_cast(ltrim(x, '0') AS INT), 0) > 255)) = 0
        WHEN 'phone' THEN length(d) BETWEEN 10 AND 15
        WHEN 'card' THEN length(d) BETWEEN 14 AND 19 AND list_sum(list_transform(range(1, length(d) + 1),
            lambda i: CASE WHEN i % 2 = 1 THEN CAST(d[length(d) + 1 - i] AS INT)
                 ELSE CAST(d[length(d) + 1 - i] AS INT) * 2 - CASE WHEN CAST(d[length(d) + 1 - i] AS INT) > 4 THEN 9 ELSE 0 END END)) % 10 = 0
        ELSE length(p) BETWEEN 15 AND 34 AND list_reduce(list_transform(string_split(p[5:] || p[1:4], ''),
            lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN CAST(ascii(c) - 48 AS BIGINT) ELSE ascii(c) - 55 END),
            lambda a, b: (a * CASE WHEN b > 9 THEN 100 ELSE 10 END + b) % 97, CAST(0 AS BIGINT)) = 1 END),
kept AS (
    SELECT *, kind || ':' || start || ':' || stop AS label FROM spans
    WHERE kind <> 'iban' OR coalesce(length(p) = size, FALSE) OR regexp_matches(
        lower(t[greatest(start - {CONTEXT_REACH}, 0) + 1:start] || ' ' || t[stop + 1:stop + {CONTEXT_REACH}]),
        '\b(?:{CONTEXT["iban"]})\b'))
SELECT doc_id, count(*) FILTER (WHERE kind = 'email') AS n_email, count(*) FILTER (WHERE kind = 'ip') AS n_ip,
       count(*) FILTER (WHERE kind = 'card') AS n_card, count(*) FILTER (WHERE kind = 'phone') AS n_phone,
       sha256(coalesce(string_agg(label, ',' ORDER BY start, rank) FILTER (WHERE kind <> 'iban'), '')) AS base_sha256,
       coalesce(string_agg(label, ',' ORDER BY start, rank), '') AS spans
FROM texts LEFT JOIN kept USING (doc_id) GROUP BY doc_id"""


#: crc32 of an ASCII string ``s``, bit by bit.
_CRC = """xor(list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(string_split(s, ''), lambda c: CAST(ascii(c) AS BIGINT)),
    lambda c, b: list_reduce([xor(c, b)] || list_transform(range(8), lambda z: CAST(0 AS BIGINT)),
        lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""

#: Every path of edits, the best one of each state kept row after row; nothing is final before the last row.
CONVERSATIONS = rf"""WITH RECURSIVE source AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS s FROM conversations),
kinds AS (SELECT *, {_CRC} % 20 AS kind FROM source),
damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM kinds WHERE kind <> 0),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS nth,
           rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM damaged),
faults AS MATERIALIZED (
    SELECT conv_id, turn, role, text, left(role, 1) AS initial,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, nth) AS i,
           CASE WHEN body = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault
    FROM numbered),
counts AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
           count(*) FILTER (WHERE fault = 'truncated') AS truncated FROM faults GROUP BY conv_id),
pairs AS (SELECT conv_id, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM faults),
illegal AS (SELECT conv_id, count(*) AS illegal FROM pairs WHERE pair NOT IN ('su', 'ua', 'au') GROUP BY conv_id),
written(was, initial, state) AS (VALUES ('', 's', 's'), ('', 'u', 'u'), ('s', 'u', 'u'), ('a', 'u', 'u'), ('u', 'a', 'a')),
inserted(was, state, cost, edits, made) AS (VALUES
    ('', '', 0, '', ''), ('s', 's', 0, '', ''), ('u', 'u', 0, '', ''), ('a', 'a', 0, '', ''),
    ('', 'u', 5, 'I', 'user:' || chr(10)), ('s', 'u', 5, 'I', 'user:' || chr(10)), ('a', 'u', 5, 'I', 'user:' || chr(10)),
    ('u', 'a', 5, 'I', 'assistant:' || chr(10)), ('', 'a', 10, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)),
    ('s', 'a', 10, 'II', 'user:' || chr(10) || 'assistant:' || chr(10))),
edits AS MATERIALIZED (
    SELECT f.conv_id, f.i, w.was, w.state, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS cost, 'K' AS edit, role || ':' || text || chr(10) AS made
    FROM faults f JOIN written w USING (initial) WHERE coalesce(fault, '') NOT IN ('blank', 'duplicate')
    UNION ALL SELECT f.conv_id, f.i, w.was, w.state, 1 + CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END, 'R',
           CASE w.initial WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || text || chr(10)
    FROM faults f JOIN written w ON w.initial <> 's' WHERE coalesce(fault, '') NOT IN ('blank', 'duplicate')
    UNION ALL SELECT f.conv_id, f.i, s.was, s.was, 2, 'D', '' FROM faults f, (SELECT DISTINCT was FROM inserted) s),
paths AS (
    SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, '' AS state, {{'cost': CAST(0 AS BIGINT), 'audit': '', 'made': ''}} AS best FROM conversations
    UNION ALL
    SELECT p.conv_id, e.i, e.state, min({{'cost': CAST(p.best.cost + x.cost + e.cost AS BIGINT), 'audit': p.best.audit || x.edits || e.edit,
           'made': p.best.made || x.made || e.made}})
    FROM paths p JOIN inserted x ON x.was = p.state
    JOIN edits e ON e.conv_id IS NOT DISTINCT FROM p.conv_id AND e.i = p.i + 1 AND e.was = x.state
    GROUP BY p.conv_id, e.i, e.state),
ends AS (
    SELECT p.conv_id, min({{'cost': CAST(p.best.cost + x.cost AS BIGINT), 'audit': p.best.audit || x.edits, 'made': p.best.made || x.made}}) AS best
    FROM paths p LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM p.conv_id JOIN inserted x ON x.was = p.state AND x.state IN ('', 'a')
    WHERE p.i = coalesce(c.n, 0) GROUP BY p.conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.cost AS cost, best.audit AS audit,
       sha256(CASE WHEN best.made = '' THEN '' ELSE left(best.made, length(best.made) - 1) END) AS repaired_sha256
FROM ends e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN illegal l ON l.conv_id IS NOT DISTINCT FROM e.conv_id"""

EXACT = """WITH texts AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY t)"""


#: Equal words at every distance, stretches of them as islands; of one stretch the smallest period counts.
RUNS = rf"""WITH source AS (
    SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS s, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
hashed AS (SELECT doc_id, w, len(w) AS n, {_CRC} AS h FROM source),
placed AS (SELECT *, CASE WHEN n > 0 THEN (h // 10) % n END AS a FROM hashed),
texts AS MATERIALIZED (
    SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i:
        CASE WHEN i >= a THEN w[a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) + 1] ELSE w[i + 1] END) ELSE w END AS w FROM placed),
items AS MATERIALIZED (SELECT doc_id, n, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM texts),
pairs AS (
    SELECT x.doc_id, x.i, y.i - x.i AS q FROM items x JOIN items y ON x.doc_id = y.doc_id AND x.word = y.word
    WHERE y.i > x.i AND 3 * (y.i - x.i) <= x.n),
islands AS (SELECT doc_id, i, q, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS g FROM pairs),
stretches AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY doc_id, q, g
    HAVING count(*) + q >= greatest(24, 3 * q)),
runs AS MATERIALIZED (SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY doc_id, start, length),
listed AS (
    SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS spans
    FROM runs GROUP BY doc_id),
best AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) AS nth FROM runs),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS rest FROM items ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
       sha256(coalesce(spans, '')) AS runs_sha256, sha256(coalesce(rest, '')) AS collapsed_sha256
FROM texts LEFT JOIN listed USING (doc_id) LEFT JOIN (SELECT * FROM best WHERE nth = 1) USING (doc_id) LEFT JOIN kept USING (doc_id)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_minhash": MINHASH,
        "op6_embeddings": EMBEDDINGS,
        "op8_pii": _pii(),
        "op9_substrings": SUBSTRINGS,
        "op11_conversations": CONVERSATIONS,
        "op12_exact": EXACT,
        "op13_runs": RUNS,
    }
