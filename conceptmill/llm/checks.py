"""SQL that says what registered queries return."""

from __future__ import annotations

from conceptmill.llm import licenses

_BYTE_STEPS = """list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]),
  lambda x, i: xor(x >> 1, (x & 1) * 3988292384))"""


def crc32(codes: str) -> str:
    """crc32 of a list of byte values."""
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda c, b: {_BYTE_STEPS}), 4294967295)"


def utf8(text: str) -> str:
    """UTF-8 byte values of a text."""
    digits = f"string_split(hex(encode({text})), '')"
    return (
        f"CASE WHEN {text} = '' THEN []::BIGINT[] ELSE list_transform(range(0, strlen({text})), lambda i: "
        f"16 * (instr('0123456789ABCDEF', {digits}[2 * i + 1]) - 1) + instr('0123456789ABCDEF', {digits}[2 * i + 2]) - 1) END"
    )


_SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

CONVERSATIONS = f"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
      lambda ch: unicode(ch)::BIGINT) AS codes
  FROM conversations
), hit AS (
  SELECT conv_id, turn, role, text, {crc32('codes')} % 20 AS kind FROM keyed
), turns AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM hit WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
    rtrim(text, {_SPACES}) AS spoken
  FROM turns
), faulty AS (
  SELECT *, CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE '-' END AS initial,
    CASE WHEN spoken = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
      WHEN right(spoken, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'fine' END AS fault
  FROM placed
), paired AS (
  SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || initial AS pair FROM faulty
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
    max(pos) AS n
  FROM paired GROUP BY conv_id
), moves(p, role, q) AS (
  VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)
), inserts(p, q, cost, edits) AS (
  VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 3, 'I'), (0, 3, 6, 'II'),
    (1, 2, 3, 'I'), (1, 3, 6, 'II'), (2, 3, 3, 'I'), (3, 2, 3, 'I')
), initials(initial) AS (
  VALUES ('s'), ('u'), ('a'), ('-')
), edits AS (
  SELECT initial, fault, p, p AS q, 4 AS cost, 'D' AS edit
  FROM initials, (VALUES (0), (1), (2), (3)) AS states(p), (VALUES ('blank'), ('duplicate'), ('truncated'), ('fine')) AS f(fault)
  UNION ALL
  SELECT initial, fault, p, q, more + CASE WHEN initial = role THEN 0 ELSE 3 END, CASE WHEN initial = role THEN 'K' ELSE 'R' END
  FROM initials, moves, (VALUES ('truncated', 3), ('fine', 0)) AS f(fault, more) WHERE initial = role OR role <> 's'
), steps AS (
  SELECT e.initial, e.fault, e.p, i.q, e.cost + i.cost AS cost, e.edit || i.edits AS edits
  FROM edits e JOIN inserts i ON i.p = e.q
), best AS (
  SELECT conv_id, 0::BIGINT AS pos, q, '0000000' || cost || edits AS cell FROM counted, inserts WHERE p = 0
  UNION ALL
  SELECT b.conv_id, f.pos, s.q, min(lpad((left(b.cell, 8)::BIGINT + s.cost)::VARCHAR, 8, '0') || substr(b.cell, 9) || s.edits)
  FROM best b JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.pos = b.pos + 1
    JOIN steps s ON s.initial = f.initial AND s.fault = f.fault AND s.p = b.q
  GROUP BY b.conv_id, f.pos, s.q
), parsed AS (
  SELECT c.conv_id, min(b.cell) AS cell
  FROM counted c JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id AND b.pos = c.n AND b.q IN (0, 3)
  GROUP BY c.conv_id
), letters AS (
  SELECT conv_id, unnest(range(1, length(cell) - 7)) AS nth, unnest(string_split(substr(cell, 9), '')) AS edit
  FROM parsed WHERE length(cell) > 8
), lined AS (
  SELECT *, count(*) FILTER (edit <> 'I') OVER (PARTITION BY conv_id ORDER BY nth) AS pos FROM letters
), kept AS (
  SELECT l.conv_id, l.nth, l.edit, f.role, CASE WHEN l.edit = 'I' THEN '' ELSE f.text END AS text,
    row_number() OVER (PARTITION BY l.conv_id ORDER BY l.nth) AS place, f.initial
  FROM lined l LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.pos = l.pos
  WHERE l.edit <> 'D'
), told AS (
  SELECT *, first_value(edit = 'K' AND initial = 's') OVER (PARTITION BY conv_id ORDER BY nth) AS by_system FROM kept
), sums AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role
      WHEN (place + by_system::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY nth)) AS digest
  FROM told GROUP BY conv_id
)
SELECT o.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
  coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, coalesce(left(p.cell, 8)::BIGINT, 0) AS cost,
  coalesce(substr(p.cell, 9), '') AS audit, coalesce(s.digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
  LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
  LEFT JOIN parsed p ON p.conv_id IS NOT DISTINCT FROM o.conv_id
  LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM o.conv_id
"""

_WORDS = r"""list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"""

RESAMPLING = f"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS words FROM documents
), doc_words AS (
  SELECT row, unnest(words) AS word FROM docs
), target_words AS (
  SELECT unnest({_WORDS}) AS word FROM benchmark
), vocabulary AS (
  SELECT word, {utf8('word')} AS codes FROM (SELECT word FROM doc_words UNION SELECT word FROM target_words)
), hashed AS (
  SELECT word, {crc32('codes')} % 10000 AS bucket FROM vocabulary
), raw AS (
  SELECT bucket, count(*) AS n FROM doc_words JOIN hashed USING (word) GROUP BY bucket
), target AS (
  SELECT bucket, count(*) AS n FROM target_words JOIN hashed USING (word) GROUP BY bucket
), totals AS (
  SELECT (SELECT count(*) FROM doc_words) AS raw_size, (SELECT count(*) FROM target_words) AS target_size
), gains AS (
  SELECT bucket, floor(1000 * ln(((coalesce(t.n, 0) + 1.0::DOUBLE) * (raw_size + 10000)) /
    ((r.n + 1.0::DOUBLE) * (target_size + 10000))))::BIGINT AS gain
  FROM raw r LEFT JOIN target t USING (bucket), totals
), weights AS (
  SELECT row, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM doc_words JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY row
), hexed AS (
  SELECT row, doc_id, string_split(substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8), '') AS digits FROM docs
), noise AS (
  SELECT row, doc_id, list_reduce(list_transform(digits, lambda c: (instr('0123456789abcdef', c) - 1)::BIGINT),
    lambda x, y: 16 * x + y) AS h FROM hexed
), scored AS (
  SELECT row, doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT)::BIGINT AS score
  FROM noise LEFT JOIN weights USING (row)
), ranked AS (
  SELECT row, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST, weight, n_features) AS place,
    count(*) OVER () * 10 // 100 AS n_drawn
  FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= n_drawn THEN place END AS rank
FROM scored LEFT JOIN ranked USING (row)
"""

LICENSES = f"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS words FROM documents
), phrases(label, phrase) AS (
  VALUES {licenses.sql_list(licenses.PHRASES)}
), templates(label, text) AS (
  VALUES {licenses.sql_list(licenses.TEMPLATES)}
), sets AS (
  SELECT label, list_distinct(string_split(text, ' ')) AS needed FROM templates
), places AS (
  SELECT row, words, unnest(range(len(words))) AS place FROM docs
), phrase_words AS (
  SELECT label, string_split(phrase, ' ') AS phrase FROM phrases
), hits AS (
  SELECT row, place, label FROM places JOIN phrase_words ON words[place + 1] = phrase[1]
    AND list_slice(words, place + 1, place + len(phrase)) = phrase
), base AS (
  SELECT row, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS labels
  FROM hits GROUP BY row
), blocks AS (
  SELECT row, list_slice(words, place + 1, place + {licenses.BLOCK_WORDS}) AS block FROM places
  WHERE place % {licenses.STEP} = 0 AND (place = 0 OR place + {licenses.BLOCK_WORDS - licenses.STEP} < len(words))
), shares AS (
  SELECT row, label, len(list_intersect(needed, block)) AS common, len(needed) AS size FROM blocks, sets
), notices AS (
  SELECT row, list(DISTINCT label) AS labels, max(common / size) AS share
  FROM shares WHERE 100 * common >= {licenses.THRESHOLD} * size GROUP BY row
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(n.labels, [])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0)::DOUBLE END AS score
FROM docs LEFT JOIN base b USING (row) LEFT JOIN notices n USING (row)
"""
