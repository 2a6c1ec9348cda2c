"""DuckDB statements of the text queries that SQL can express on whole tables."""

from __future__ import annotations

OP2 = r"""
WITH t AS (
  SELECT CAST(floor(conv_id / 2) AS BIGINT) AS pair, coalesce(conv_id, 0) % 2 = 0 AS chosen, conv_id,
         coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY CAST(floor(conv_id / 2) AS BIGINT), coalesce(conv_id, 0) % 2 = 0
                            ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')) AS no
  FROM conversations),
p AS (
  SELECT a.pair, a.no FROM t a JOIN t b ON a.pair IS NOT DISTINCT FROM b.pair AND a.no = b.no
  WHERE a.chosen AND NOT b.chosen AND a.role = b.role AND a.text = b.text),
n AS (SELECT pair, max(no) AS n_turns FROM t GROUP BY pair),
e AS (
  SELECT n.pair, min(s.no) AS stop
  FROM n, LATERAL (SELECT unnest(generate_series(1, n.n_turns)) AS no) s
  WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.pair IS NOT DISTINCT FROM n.pair AND p.no = s.no) GROUP BY n.pair),
r AS (
  SELECT t.*, coalesce(e.stop - 1, n.n_turns) AS prefix,
         '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS shown
  FROM t JOIN n ON t.pair IS NOT DISTINCT FROM n.pair LEFT JOIN e ON t.pair IS NOT DISTINCT FROM e.pair),
s AS (
  SELECT *, sum(CASE WHEN no > prefix THEN length(shown) ELSE 0 END)
              OVER (PARTITION BY pair, chosen ORDER BY no ROWS UNBOUNDED PRECEDING) AS upto
  FROM r)
SELECT pair, max(conv_id) FILTER (chosen) AS chosen_id, max(conv_id) FILTER (NOT chosen) AS rejected_id,
       CAST(max(prefix) AS INT) AS prompt_turns,
       coalesce(string_agg(shown, '' ORDER BY no) FILTER (chosen AND no <= prefix), '') AS prompt,
       coalesce(string_agg(shown, '' ORDER BY no) FILTER (chosen AND no > prefix), '') AS chosen,
       coalesce(string_agg((upto - length(text) - 11) || '-' || upto, ',' ORDER BY no)
                FILTER (chosen AND no > prefix AND role = 'assistant'), '') AS chosen_spans,
       coalesce(string_agg(shown, '' ORDER BY no) FILTER (NOT chosen AND no > prefix), '') AS rejected,
       coalesce(string_agg((upto - length(text) - 11) || '-' || upto, ',' ORDER BY no)
                FILTER (NOT chosen AND no > prefix AND role = 'assistant'), '') AS rejected_spans
FROM s GROUP BY pair
"""

OP7 = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id,
         sha1(coalesce(html, '')) AS hex
  FROM pages)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes,
       list_reduce(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31)::INT, 1)),
         lambda a, b: a || b) AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first_id OR first_id IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN NULL ELSE first_id END AS refers_to
FROM p
"""

OP8 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS gram
  FROM w),
n AS (SELECT w.doc_id, count(g.gram) AS n FROM w LEFT JOIN g ON w.doc_id = g.doc_id GROUP BY w.doc_id),
m AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id
      GROUP BY 1, 2),
l AS (SELECT u, v FROM m JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 80 * (x.n + y.n - c)),
r AS (SELECT u AS id, v AS reached FROM l UNION SELECT r.id, l.v FROM r JOIN l ON r.reached = l.u)
SELECT n.doc_id, n.n AS n_shingles, least(n.doc_id, coalesce(min(r.reached), n.doc_id)) AS component_id,
       n.doc_id <= coalesce(min(r.reached), n.doc_id) AS kept
FROM n LEFT JOIN r ON r.id = n.doc_id GROUP BY n.doc_id, n.n
"""


#: CRC-32 of a text's UTF-8 bytes: the table by its rule, then a fold over the bytes.
CRC_TABLE = """
crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""
CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda b: CAST('0x' || b AS BIGINT))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"""

OP11 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
u AS (
  SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS x, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS y,
         CASE WHEN n = 0 OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 OR contains(text, '<P>')
                OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
              WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
c AS (
  SELECT *, substr(text, 1, least(x, y)) AS pre, substr(text, least(x, y) + 1, greatest(x, y) - least(x, y)) AS mid,
         substr(text, greatest(x, y) + 1) AS post
  FROM u)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN least(x, y) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN greatest(x, y) - least(x, y) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || post || '<M>' || mid
              ELSE '<S>' || post || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM c
"""

OP12 = rf"""
WITH {CRC_TABLE.strip()},
d AS (
  SELECT doc_id, strlen(coalesce(text, ''))::BIGINT + 1 AS size, {CRC.format(text="coalesce(text, '')")} AS text_crc32,
         coalesce(doc_id::VARCHAR, '') AS key, row_number() OVER () AS row
  FROM documents, crc_table),
s AS (SELECT unnest(range(17)) AS shard),
grown AS (SELECT shard, CASE WHEN shard < 16 THEN shard // 4 ELSE 4 END AS rack,
                 CASE WHEN shard < 16 THEN shard // 8 ELSE 2 END AS region, b AS shards
          FROM s, (VALUES (16), (17)) AS v(b) WHERE shard < b),
nodes AS (
  SELECT shards, 'region' AS level, region AS id, -1 AS parent, count(*) AS weight FROM grown GROUP BY shards, region
  UNION ALL SELECT shards, 'rack', rack, region, count(*) FROM grown GROUP BY shards, rack, region
  UNION ALL SELECT shards, 'shard', shard, rack, 1 FROM grown),
draws AS (
  SELECT row, shards, level, id, parent,
         ln((CAST('0x' || substr(md5('1:' || level || ':' || id || ':' || key), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496) / weight AS score
  FROM d, nodes),
best AS (SELECT row, shards, level, parent, arg_max(id, score) AS id FROM draws GROUP BY row, shards, level, parent),
placed AS (
  SELECT a.row, a.shards, c.id AS shard
  FROM best a JOIN best b ON a.row = b.row AND a.shards = b.shards AND b.level = 'rack' AND b.parent = a.id
       JOIN best c ON a.row = c.row AND a.shards = c.shards AND c.level = 'shard' AND c.parent = b.id
  WHERE a.level = 'region')
SELECT doc_id, size, text_crc32, 'key' AS law, p.shard::INT AS shard,
       row_number() OVER (PARTITION BY p.shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot,
       g.shard::INT AS grown_shard
FROM d JOIN placed p ON p.row = d.row AND p.shards = 16 JOIN placed g ON g.row = d.row AND g.shards = 17
"""

OP13 = rf"""
WITH RECURSIVE {CRC_TABLE.strip()},
src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {CRC.format(text="coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
  FROM conversations, crc_table),
r AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM src),
o AS (
  SELECT *, substr(role, 1, 1) AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         regexp_replace(text, '[ 	-]+$', '') AS body
  FROM r),
f AS (
  SELECT *, CASE WHEN body = '' THEN 'blank'
                 WHEN min(i) OVER (PARTITION BY conv_id, role, text) < i THEN 'duplicate'
                 WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(c) OVER (PARTITION BY conv_id ORDER BY i) AS above, count(*) OVER (PARTITION BY conv_id) AS n
  FROM o),
e AS (SELECT *, fault IN ('blank', 'duplicate') AS go, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS x FROM f),
back AS (
  SELECT DISTINCT conv_id, n + 1 AS i, [0, 6, 3, 0]::BIGINT[] AS v FROM e
  UNION ALL
  SELECT conv_id, i, [least(b0, 3 + b2, 6 + b3), least(b1, 3 + b2, 6 + b3), least(b2, 3 + b3), least(b3, 3 + b2)]
  FROM (
    SELECT e.conv_id, e.i,
      least(4 + v[1], CASE WHEN go THEN 1000000000 ELSE x + least(3 + v[3], CASE c WHEN 's' THEN v[2] WHEN 'u' THEN v[3] ELSE 1000000000 END) END) AS b0,
      least(4 + v[2], CASE WHEN go THEN 1000000000 ELSE x + least(3 + v[3], CASE c WHEN 'u' THEN v[3] ELSE 1000000000 END) END) AS b1,
      least(4 + v[3], CASE WHEN go THEN 1000000000 ELSE x + least(3 + v[4], CASE c WHEN 'a' THEN v[4] ELSE 1000000000 END) END) AS b2,
      least(4 + v[4], CASE WHEN go THEN 1000000000 ELSE x + least(3 + v[3], CASE c WHEN 'u' THEN v[3] ELSE 1000000000 END) END) AS b3
    FROM back JOIN e ON e.conv_id IS NOT DISTINCT FROM back.conv_id AND e.i = back.i - 1) s),
walk AS (
  SELECT conv_id, 1::BIGINT AS i, 1 AS q, '' AS audit, NULL::VARCHAR AS shown, FALSE AS over FROM back WHERE i = 1
  UNION ALL
  SELECT conv_id, CASE WHEN letter IN ('I', '') THEN i ELSE i + 1 END, CASE WHEN letter IN ('D', '') THEN q ELSE to_q END, audit || letter,
         CASE WHEN letter IN ('D', '') THEN shown ELSE concat(shown || chr(10), CASE WHEN letter = 'K' THEN role ELSE new_role END,
              ':', CASE WHEN letter = 'I' THEN '' ELSE text END) END, letter = ''
  FROM (
    SELECT s.*, CASE WHEN letter = 'K' AND c = 's' THEN 2 WHEN q = 3 THEN 4 ELSE 3 END AS to_q,
           CASE WHEN q = 3 THEN 'assistant' ELSE 'user' END AS new_role
    FROM (
      SELECT w.conv_id, w.i, w.q, w.audit, w.shown, e.role, e.text, e.c,
        CASE WHEN e.i IS NULL THEN CASE WHEN w.q IN (1, 4) THEN '' ELSE 'I' END
             WHEN 4 + a.v[w.q] = b.v[w.q] THEN 'D'
             WHEN 3 + b.v[CASE w.q WHEN 3 THEN 4 ELSE 3 END] = b.v[w.q] THEN 'I'
             WHEN x + CASE WHEN w.q = 1 AND c = 's' THEN a.v[2] WHEN w.q <> 3 AND c = 'u' THEN a.v[3]
                           WHEN w.q = 3 AND c = 'a' THEN a.v[4] ELSE 1000000000 END = b.v[w.q] THEN 'K'
             ELSE 'R' END AS letter
      FROM walk w JOIN back b ON b.conv_id IS NOT DISTINCT FROM w.conv_id AND b.i = w.i
           LEFT JOIN back a ON a.conv_id IS NOT DISTINCT FROM w.conv_id AND a.i = w.i + 1
           LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM w.conv_id AND e.i = w.i
      WHERE NOT w.over) s) z),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (i > 1 AND above || c NOT IN ('su', 'ua', 'au')) AS illegal
  FROM e GROUP BY conv_id)
SELECT k.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
       coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, coalesce(b.v[1], 0) AS cost,
       coalesce(w.audit, '') AS audit, sha256(coalesce(w.shown, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) k
     LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM k.conv_id
     LEFT JOIN back b ON b.conv_id IS NOT DISTINCT FROM k.conv_id AND b.i = 1
     LEFT JOIN walk w ON w.conv_id IS NOT DISTINCT FROM k.conv_id AND w.over
"""


def statements() -> dict[str, str]:
    return {
        "op2_preference_pairs": OP2, "op7_warc_store": OP7, "op8_near_dedup": OP8, "op11_fill_middle": OP11,
        "op12_hash_tree_shards": OP12, "op13_conversation_repair": OP13,
    }  # fmt: skip
