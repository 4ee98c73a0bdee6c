"""SQL of the operators' queries, where SQL can express them.

The others: op3 (SQL here has no CRC-32), op5 and op6 (token ids), op7 (components of a graph) and op9 (learned rules).
"""

from __future__ import annotations

import re

WORDS = r"'[^\x20\x09-\x0D]+'"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _either_case(pattern: str) -> str:
    return re.sub(r"[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", pattern)


_NAMES = _either_case("password") + "|" + _either_case("passwd") + "|" + _either_case("secret") + "|" + _either_case("token") + "|" + _either_case("api") + "_?" + _either_case("key")
_QUOTE = "[\"'']?"
_SPACE = r"[^\x20\x09-\x0D/:@]+"
#: Kind, pattern, group that is measured, least length.
_KINDS = [
    ("assign", rf"({_NAMES}){_QUOTE}\x20*[:=]\x20*{_QUOTE}([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
    ("bearer", _either_case("bearer") + r"\x20+[A-Za-z0-9._~+/=-]{16,}", 0, 1),
    ("login", rf"://{_SPACE}:{_SPACE}@", 0, 1),
]


def _matches(number: int, kind: str, pattern: str, group: int, least: int) -> str:
    """Matches of a kind; a match starts after the texts between matches and the matches before it."""
    return f"""
      SELECT doc_id, {number} AS no, '{kind}' AS kind, length(w) AS n, length(g) >= {least} AS good,
             sum(length(p) + length(w)) OVER (PARTITION BY doc_id ORDER BY i) AS stop
      FROM (SELECT doc_id, unnest(regexp_extract_all(t, '{pattern}')) AS w, unnest(regexp_extract_all(t, '{pattern}', {group})) AS g,
                   unnest(regexp_split_to_array(t, '{pattern}')[:-2]) AS p, generate_subscripts(regexp_extract_all(t, '{pattern}'), 1) AS i
            FROM d WHERE regexp_matches(t, '{pattern}'))"""


_OP1 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join(_matches(i, *k) for i, k in enumerate(_KINDS))}),
s AS (SELECT doc_id, no, kind, stop - n AS start, kind || ':' || (stop - n)::BIGINT || ':' || stop::BIGINT AS span FROM m WHERE good),
a AS (SELECT doc_id, count(*) FILTER (no = 0) AS n_assign, count(*) FILTER (no = 1) AS n_access, count(*) FILTER (no = 2) AS n_hex,
             string_agg(span, ',' ORDER BY start, no) FILTER (no <= 2) AS base, string_agg(span, ',' ORDER BY start, no) AS spans
      FROM s GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (doc_id)
"""

_OP2 = f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {WORDS}))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, sum(size::DOUBLE * size) AS squares, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS no
      FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][(no % 3 + 1)::INT] AS w, 2 * source_size AS cap FROM s),
o AS (SELECT *, row_number() OVER r AS k, sum(source_size) OVER () AS total, coalesce(sum(cap) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
             sum(w) OVER (r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
      FROM w WINDOW r AS (ORDER BY cap / w, no)),
v AS (SELECT *, (1.5::DOUBLE * total::DOUBLE - capped::DOUBLE) / free::DOUBLE AS level FROM o),
l AS (SELECT coalesce(min_by(level, k) FILTER (level * w <= cap), 0) AS level FROM v),
t AS (SELECT source, source_size, squares, no, CASE WHEN l.level * w > cap THEN cap::DOUBLE ELSE l.level * w END AS target FROM w, l),
q AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
e AS (SELECT *, target - whole * source_size AS rest FROM q),
j AS (SELECT d.doc_id, d.size, e.*, CASE WHEN d.size > 0 AND rest > 0 THEN least(1.0::DOUBLE, rest * d.size / squares) END AS chance,
             (('0x' || substr(md5('mix|' || coalesce(e.source, '') || '|' || coalesce(d.doc_id::VARCHAR, '')), 1, 12))::BIGINT + 0.5::DOUBLE) / 281474976710656::DOUBLE AS unit
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source),
r AS (SELECT *, CASE WHEN chance >= 1 THEN 0 WHEN chance > 0 THEN (unit / (1 - unit)) / (chance / (1 - chance)) END AS place FROM j),
c AS (SELECT *, CASE WHEN place IS NOT NULL THEN sum(size) OVER (PARTITION BY no, place IS NULL ORDER BY place, doc_id) - rest END AS beyond FROM r),
x AS (SELECT *, whole::BIGINT + CASE WHEN beyond <= 0 OR 2 * beyond < size THEN 1 ELSE 0 END AS copies FROM c)
SELECT doc_id, size, source_size, target, copies * size AS taken, source, copies FROM x
"""

_ESCAPED = "length(replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'))"
_OP4 = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, turn, role, '\\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role)),
n AS (SELECT *, len(regexp_extract_all(text, {WORDS})) + 4 AS tokens FROM c),
u AS (SELECT *, sum(tokens) OVER o AS upto, row_number() OVER o = 1 AND role = 'system' AS leads
      FROM n WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)),
s AS (SELECT *, greatest(1024 - 256 - coalesce(max(tokens) FILTER (leads) OVER (PARTITION BY conv_id), 0), 1) AS room FROM u),
w AS (SELECT *, 2 * ((upto - tokens)::BIGINT // room) + ((upto - tokens)::BIGINT // room < (upto - 1)::BIGINT // room)::BIGINT AS win FROM s),
g AS (SELECT conv_id, win, sum(tokens) AS size, max(upto) AS stop, any_value(room) AS room, max(tokens) FILTER (leads) AS lead_tokens FROM w GROUP BY conv_id, win),
h AS (SELECT * EXCLUDE lead_tokens, max(lead_tokens) OVER (PARTITION BY conv_id) AS lead_tokens,
             coalesce(win % 2 = 1 AND lag(win) OVER o = win - 1 AND lag(size) OVER o + size <= room, false) AS back
      FROM g WINDOW o AS (PARTITION BY conv_id ORDER BY win)),
j AS (SELECT *, CASE WHEN back THEN win - 1
                     WHEN win % 2 = 1 AND lead(win) OVER o % 2 = 0
                          AND size + lead(size) OVER o + CASE WHEN lead(back, 2) OVER o THEN lead(size, 2) OVER o ELSE 0 END <= room THEN lead(win) OVER o
                     ELSE win END AS whole
      FROM h WINDOW o AS (PARTITION BY conv_id ORDER BY win)),
k AS (SELECT conv_id, whole, sum(size) AS size, max(stop) AS stop, any_value(lead_tokens) AS lead_tokens FROM j GROUP BY conv_id, whole),
e AS (SELECT conv_id, whole, stop, least(256, 1024 - coalesce(lead_tokens, 0) - lead(size) OVER o) AS history, lead(whole) OVER o AS next, count(*) OVER (PARTITION BY conv_id) AS wins
      FROM k WINDOW o AS (PARTITION BY conv_id ORDER BY whole)),
p AS (SELECT w.*, CASE WHEN leads THEN wins WHEN next IS NOT NULL AND e.stop - upto + tokens <= history THEN 2 ELSE 1 END AS times
      FROM w JOIN j ON w.conv_id IS NOT DISTINCT FROM j.conv_id AND w.win = j.win
      JOIN e ON j.conv_id IS NOT DISTINCT FROM e.conv_id AND j.whole = e.whole)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY upto)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY upto) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(times * (6 + {_ESCAPED.format("role")} + 1 + {_ESCAPED.format("text")} + 8))::BIGINT AS formatted_chars
FROM p GROUP BY conv_id
"""

_OP8 = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents),
l AS (SELECT doc_id, unnest(x) AS line, generate_subscripts(x, 1) AS i FROM d),
k AS (SELECT *, {LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM l),
s AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
m AS (SELECT k.*, coalesce(s.first <> k.doc_id, false) AS gone FROM k LEFT JOIN s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

_OP10 = f"""
WITH d AS (SELECT doc_id, {LOWER.format("coalesce(text, '')")} AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)
"""

ORACLES: dict[str, str] = {
    "op1_secrets": _OP1,
    "op2_mix": _OP2,
    "op4_chat": _OP4,
    "op8_lines": _OP8,
    "op10_copies": _OP10,
}
