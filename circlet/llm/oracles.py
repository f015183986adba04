"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from circlet.llm.license_rules import RULES

OP1 = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""

OP5 = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, coalesce(html, '') AS body FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS last_id FROM p)
SELECT page_id, payload_bytes, sha1(body) AS payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN last_id END AS refers_to
FROM g
"""

OP6 = r"""
WITH l AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
k AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
m AS (SELECT doc_id, pos, line, length(key) >= 10 AND doc_id > min(doc_id) OVER (PARTITION BY key) AS gone FROM k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

# Costs of the rest from the last row back (b: from each of the four states), then one edit after another from the first row on.
OP12 = r"""
WITH RECURSIVE names AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')) AS name
  FROM conversations),
crc AS (
  SELECT conv_id, turn, role, text,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, octet_length(name) + 1), lambda k: ord(decode(name)[k])::BIGINT)),
             lambda c, x: list_reduce(list_prepend(xor(c, x), range(8)), lambda a, k: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END)),
             4294967295) % 20 AS kind
  FROM names),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS twin
  FROM crc WHERE kind <> 0),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), twin) AS i,
         trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS core
  FROM damaged),
judged AS (
  SELECT *, role[1] AS ini, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS before_ini,
         CASE WHEN core = '' THEN 2 WHEN i > min(i) OVER (PARTITION BY conv_id, role, text) THEN 3
              WHEN core[-1] IN ('.', '!', '?') THEN 0 ELSE 1 END AS fault
  FROM numbered),
sizes AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 2) AS blank, count(*) FILTER (fault = 3) AS duplicate, count(*) FILTER (fault = 1) AS truncated,
         count(*) FILTER (before_ini IS NOT NULL AND before_ini || ini NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id),
back AS (
  SELECT conv_id, n + 1 AS i, [0, 6, 3, 0] AS b FROM sizes
  UNION ALL
  SELECT conv_id, i, [least(r0, 3 + least(r2, 3 + r3)), least(r1, 3 + least(r2, 3 + r3)), least(r2, 3 + r3), least(r3, 3 + r2)]
  FROM (
    SELECT j.conv_id, j.i, CASE WHEN j.fault < 2 THEN 3 * (j.fault = 1)::INT END AS e,
           least(4 + b[1], CASE j.ini WHEN 's' THEN e + b[2] WHEN 'u' THEN e + b[3] END, 3 + e + b[3]) AS r0,
           least(4 + b[2], CASE j.ini WHEN 'u' THEN e + b[3] END, 3 + e + b[3]) AS r1,
           least(4 + b[3], CASE j.ini WHEN 'a' THEN e + b[4] END, 3 + e + b[4]) AS r2,
           least(4 + b[4], CASE j.ini WHEN 'u' THEN e + b[3] END, 3 + e + b[3]) AS r3
    FROM back JOIN judged j ON j.conv_id IS NOT DISTINCT FROM back.conv_id AND j.i = back.i - 1)),
walk AS (
  SELECT conv_id, 1::BIGINT AS i, 0 AS s, '' AS audit, []::VARCHAR[] AS lines, 0::BIGINT AS cost, false AS done FROM sizes
  UNION ALL
  SELECT conv_id, CASE WHEN letter IN ('', 'I') THEN i ELSE i + 1 END,
         CASE WHEN letter IN ('', 'D') THEN s WHEN letter = 'K' THEN keep ELSE after END, audit || letter,
         CASE letter WHEN 'K' THEN list_append(lines, role || ':' || text) WHEN 'R' THEN list_append(lines, given || ':' || text)
                     WHEN 'I' THEN list_append(lines, given || ':') ELSE lines END,
         cost + CASE letter WHEN 'D' THEN 4 WHEN 'I' THEN 3 WHEN 'K' THEN e WHEN 'R' THEN 3 + e ELSE 0 END, letter = ''
  FROM (
    SELECT w.*, j.role, j.text, CASE WHEN s = 2 THEN 3 ELSE 2 END AS after, CASE WHEN s = 2 THEN 'assistant' ELSE 'user' END AS given,
           CASE WHEN j.fault < 2 THEN 3 * (j.fault = 1)::INT END AS e,
           CASE WHEN j.ini = 's' AND s = 0 THEN 1 WHEN j.ini = 'u' AND s <> 2 THEN 2 WHEN j.ini = 'a' AND s = 2 THEN 3 END AS keep,
           CASE WHEN j.i IS NULL THEN CASE WHEN s IN (1, 2) THEN 'I' ELSE '' END
                WHEN 4 + nb.b[s + 1] = cb.b[s + 1] THEN 'D'
                WHEN 3 + cb.b[CASE WHEN s = 2 THEN 4 ELSE 3 END] = cb.b[s + 1] THEN 'I'
                WHEN e + nb.b[keep + 1] = cb.b[s + 1] THEN 'K' ELSE 'R' END AS letter
    FROM walk w LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.i = w.i
    JOIN back cb ON cb.conv_id IS NOT DISTINCT FROM w.conv_id AND cb.i = w.i
    LEFT JOIN back nb ON nb.conv_id IS NOT DISTINCT FROM w.conv_id AND nb.i = w.i + 1
    WHERE NOT w.done))
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN sizes z ON z.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN walk w ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.done
"""

_RULE_ROWS = ",\n".join(f"({i}, '{r.label}', {r.priority}, '{r.stem}', '{r.keyword}', '{r.pattern}', {str(r.base).lower()})" for i, r in enumerate(RULES))

# Word numbers are those of marks set around each place of a rule; a place is suppressed by a stronger or earlier one that contains it.
OP13 = rf"""
WITH rules(rule, label, priority, stem, keyword, pattern, base) AS (VALUES
{_RULE_ROWS}),
words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
plain AS (SELECT doc_id, w, regexp_replace(array_to_string(w, ' '), '[^\x00-\x7F]', 'z', 'g') AS t, array_to_string(w, ' ') AS whole FROM words),
marked AS (
  SELECT doc_id, rule, label, priority, base, string_split(regexp_replace(t, '\b(' || pattern || ')\b', chr(1) || '\1' || chr(2), 'g'), ' ') AS m
  FROM plain JOIN rules ON contains(whole, stem) AND contains(whole, keyword)),
each AS (SELECT doc_id, rule, label, priority, base, unnest(m) AS x, generate_subscripts(m, 1) - 1 AS i FROM marked),
starts AS (SELECT *, row_number() OVER (PARTITION BY doc_id, rule ORDER BY i) AS k FROM each WHERE starts_with(x, chr(1))),
ends AS (SELECT doc_id, rule, i, row_number() OVER (PARTITION BY doc_id, rule ORDER BY i) AS k FROM each WHERE ends_with(x, chr(2))),
hits AS (SELECT s.doc_id, s.rule, s.label, s.priority, s.base, s.i AS a, e.i AS z FROM starts s JOIN ends e USING (doc_id, rule, k)),
kept AS (
  SELECT * FROM hits h WHERE NOT EXISTS (
    SELECT 1 FROM hits g WHERE g.doc_id = h.doc_id AND g.a <= h.a AND g.z >= h.z AND g.priority >= h.priority
      AND (g.a < h.a OR g.z > h.z OR g.priority > h.priority OR g.rule < h.rule))),
found AS (
  SELECT doc_id, count(*) FILTER (base) AS n_base, min(a) FILTER (base) AS first_word, max(a) FILTER (base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels
  FROM hits GROUP BY doc_id),
named AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(priority) AS top
  FROM (SELECT doc_id, label, priority FROM kept UNION ALL SELECT doc_id, label, 0 FROM hits WHERE base) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE top WHEN 4 THEN 0.99::DOUBLE WHEN 3 THEN 0.9::DOUBLE WHEN 2 THEN 0.7::DOUBLE WHEN 1 THEN 0.4::DOUBLE ELSE 0.0::DOUBLE END AS score
FROM words LEFT JOIN found USING (doc_id) LEFT JOIN named USING (doc_id)
"""

ORACLES = {"op1_exact_dedup": OP1, "op5_warc": OP5, "op6_line_dedup": OP6, "op12_conversation_repair": OP12, "op13_license_scan": OP13}
