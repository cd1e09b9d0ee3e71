"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
esc AS (SELECT *, replace(replace(text, '\', '\\'), '<|', '<\|') AS etext,
               replace(replace(role, '\', '\\'), '<|', '<\|') AS erole FROM rows)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(erole) + length(etext) + length('<|start|><|text|><|end|>'))::BIGINT AS formatted_chars
FROM esc GROUP BY conv_id
"""

OP10 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, html,
             CAST(unhex(sha1(html)) AS BIT)::VARCHAR AS bits,
             min(page_id) OVER (PARTITION BY html) AS first_id FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + (16 * (substr(bits, (5 * i + 1)::INT, 1) = '1')::INT + 8 * (substr(bits, (5 * i + 2)::INT, 1) = '1')::INT
    + 4 * (substr(bits, (5 * i + 3)::INT, 1) = '1')::INT + 2 * (substr(bits, (5 * i + 4)::INT, 1) = '1')::INT
    + (substr(bits, (5 * i + 5)::INT, 1) = '1')::INT)::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to, true AS digest_verified
FROM d
"""

OP7 = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS size,
         array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win
  FROM iw, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
occ AS (
  SELECT doc_id, i, s.size, array_to_string(w[i:i + s.size - 1], ' ') AS win
  FROM dw, (SELECT DISTINCT size FROM windows) s, unnest(range(1, len(w) - s.size + 2)) AS t(i)),
hits AS (SELECT o.doc_id, o.i, o.size, x.item_id FROM occ o JOIN windows x ON o.size = x.size AND o.win = x.win),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
          SELECT doc_id, unnest(range(i, i + size)) AS p FROM (SELECT DISTINCT doc_id, i, size FROM hits)) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (
          SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT dw.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""

OP12 = r"""
WITH lines AS (
  SELECT r, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT r, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM (
    SELECT row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
often AS (SELECT k FROM lines WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT r) >= 10),
kept AS (SELECT r, count(*)::BIGINT AS n_lines, count(o.k)::BIGINT AS n_dropped,
         sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (o.k IS NULL), '')) AS kept_sha256
         FROM lines LEFT JOIN often o USING (k) GROUP BY r)
SELECT doc_id, n_lines, n_dropped, kept_sha256
FROM (SELECT row_number() OVER () AS r, doc_id FROM documents) JOIN kept USING (r)
"""

OP11 = r"""
WITH RECURSIVE named AS (
  SELECT coalesce(conv_id::VARCHAR, 'null') AS k, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                   lambda c: ascii(c)::BIGINT) AS bytes FROM conversations),
summed AS (
  SELECT k, turn, role, text, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, b:
    list_reduce(list_prepend(xor(c, b), range(8)), lambda x, n:
      CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))) % 20 AS d FROM named),
damaged AS (
  SELECT k, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
    CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM summed, range(CASE d WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END) WHERE d <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, text, again) AS i,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS whole
  FROM (SELECT *, row_number() OVER (PARTITION BY k, role, text ORDER BY turn NULLS FIRST) > 1 AS again FROM damaged)),
faults AS (
  SELECT k, i, turn, role, text, substr(role, 1, 1) AS initial, whole = '' AS blank, whole <> '' AND again AS dup,
    whole <> '' AND NOT again AND substr(whole, length(whole), 1) NOT IN ('.', '!', '?') AS cut FROM placed),
ins(a, q, edits, lines) AS (VALUES (0, 0, '', ''), (0, 2, 'I', 'user:|'), (0, 3, 'II', 'user:|assistant:|'), (1, 1, '', ''),
  (1, 2, 'I', 'user:|'), (1, 3, 'II', 'user:|assistant:|'), (2, 2, '', ''), (2, 3, 'I', 'assistant:|'), (3, 3, '', ''), (3, 2, 'I', 'user:|')),
fits(q, initial, b) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
fresh(q, role, b) AS (VALUES (0, 'user', 2), (1, 'user', 2), (2, 'assistant', 3), (3, 'user', 2)),
moves AS (
  SELECT a, b, 'K' AS edit, initial, NULL AS role, edits || 'K' AS edits, 3 * length(edits) AS cost, lines FROM ins JOIN fits USING (q)
  UNION ALL SELECT a, b, 'R', NULL, role, edits || 'R', 3 * length(edits) + 3, lines FROM ins JOIN fresh USING (q)
  UNION ALL SELECT a, a, 'D', NULL, NULL, 'D', 4, '' FROM (VALUES (0), (1), (2), (3)) t(a)),
dp AS (
  SELECT DISTINCT k, 0::BIGINT AS i, 0 AS st, 0::BIGINT AS cost, '' AS audit, '' AS lines FROM named
  UNION ALL
  SELECT k, i, st, cost, audit, lines FROM (
    SELECT *, row_number() OVER (PARTITION BY k, st ORDER BY cost, audit) AS best FROM (
      SELECT dp.k, f.i, m.b AS st, dp.cost + m.cost + CASE WHEN f.cut AND m.edit <> 'D' THEN 3 ELSE 0 END AS cost,
        dp.audit || m.edits AS audit, dp.lines || replace(m.lines, '|', chr(10)) ||
        CASE WHEN m.edit = 'D' THEN '' ELSE coalesce(m.role, f.role) || ':' || f.text || chr(10) END AS lines
      FROM dp JOIN faults f ON f.k = dp.k AND f.i = dp.i + 1
      JOIN moves m ON m.a = dp.st AND (m.edit = 'D' OR NOT (f.blank OR f.dup)) AND (m.edit <> 'K' OR m.initial = f.initial)))
  WHERE best = 1),
counts AS (
  SELECT k, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (blank)::BIGINT AS blank, count(*) FILTER (dup)::BIGINT AS duplicate, count(*) FILTER (cut)::BIGINT AS truncated,
    count(*) FILTER (i > 1 AND pair NOT IN ('su', 'ua', 'au'))::BIGINT AS illegal
  FROM (SELECT *, lag(initial) OVER (PARTITION BY k ORDER BY i) || initial AS pair FROM faults) GROUP BY k),
ends(st, cost, edits, lines) AS (VALUES (0, 0, '', ''), (3, 0, '', ''), (2, 3, 'I', 'assistant:|'), (1, 6, 'II', 'user:|assistant:|')),
done AS (
  SELECT dp.k, dp.cost + e.cost AS cost, audit || e.edits AS audit, dp.lines || replace(e.lines, '|', chr(10)) AS lines,
    row_number() OVER (PARTITION BY dp.k ORDER BY dp.cost + e.cost, audit || e.edits) AS best
  FROM dp JOIN ends e USING (st) LEFT JOIN counts c ON c.k = dp.k WHERE dp.i = coalesce(c.n, 0))
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost::BIGINT AS cost, audit,
  sha256(CASE WHEN lines = '' THEN '' ELSE left(lines, length(lines) - 1) END) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o JOIN done ON done.k = coalesce(o.conv_id::VARCHAR, 'null') AND best = 1
LEFT JOIN counts c ON c.k = done.k
"""

OP13 = r"""
WITH dt AS (
  SELECT r, doc_id, unnest(w) AS term, len(w) AS n FROM (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents)),
tf AS (SELECT r, doc_id, term, n, count(*) AS tf FROM dt GROUP BY ALL),
whole AS (SELECT count(DISTINCT r) AS n_docs, count(*) AS l FROM dt),
w AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, whole GROUP BY term),
it AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
scores AS (
  SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // l))))::BIGINT AS score
  FROM it JOIN tf USING (term) JOIN w USING (term), whole GROUP BY item_id, r, doc_id),
ranked AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank
  FROM scores WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

ORACLES = {"op1_chat_format": OP1, "op7_decontaminate": OP7, "op10_warc": OP10, "op11_conversation_repair": OP11, "op12_line_dedup": OP12, "op13_ball_search": OP13}
