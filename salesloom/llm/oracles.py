"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

#: The quotients are ranked one by one here; the operator starts from rounded shares instead.
MIX = r"""
WITH sizes AS (
  SELECT doc_id, coalesce('=' || source, '~') AS key,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents),
sources AS (
  SELECT key, source_size, (row_number() OVER (ORDER BY key) - 1) % 3 + 1 AS weight,
    greatest(1, ceil(sqrt(source_size / 32768.0::DOUBLE)))::BIGINT AS n_shards
  FROM (SELECT key, sum(size)::BIGINT AS source_size FROM sizes GROUP BY key)),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(3 * sum(source_size) OVER (r ROWS BETWEEN
      UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS rest,
    (sum(weight) OVER (r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS weights
  FROM sources WINDOW r AS (ORDER BY source_size * 6 / weight, key)),
level AS (
  SELECT rest, weights FROM levels WHERE rest * weight <= 3 * source_size * weights
  ORDER BY weights DESC LIMIT 1),
aims AS (
  SELECT key, source_size, weight, n_shards, level.rest AS shared,
    3 * source_size * level.weights < level.rest * weight AS stopped,
    CASE WHEN 3 * source_size * level.weights < level.rest * weight THEN (3 * source_size)::DOUBLE
      ELSE (level.rest * weight)::DOUBLE / level.weights END AS target
  FROM sources, level),
quotients AS (
  SELECT key, shared, row_number() OVER (ORDER BY weight::DOUBLE / (2 * k + 1) DESC, key) AS place
  FROM (SELECT key, weight, shared, unnest(range(0, (shared + 8) // 16 + 1)) AS k FROM aims WHERE NOT stopped)),
quotas AS (
  SELECT key, count(*) AS seats FROM quotients WHERE place <= (shared + 8) // 16 GROUP BY key),
placed AS (
  SELECT doc_id, key, size, source_size, target, stopped, coalesce(seats, 0) AS seats,
    md5('mix-1:order:' || coalesce(doc_id::VARCHAR, 'null')) AS place,
    ('0x' || substr(md5('mix-1:shard:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT % n_shards AS shard
  FROM sizes JOIN aims USING (key) LEFT JOIN quotas USING (key)),
shards AS (
  SELECT key, shard, stopped, seats, sum(size)::BIGINT AS words, ((sum(size) + 15) // 16)::BIGINT AS blocks
  FROM placed GROUP BY ALL),
shard_quotients AS (
  SELECT key, shard, seats,
    row_number() OVER (PARTITION BY key ORDER BY words::DOUBLE / (2 * k + 1) DESC, shard) AS place
  FROM (SELECT key, shard, words, seats, unnest(range(0, seats + 1)) AS k FROM shards WHERE words > 0)),
shard_quotas AS (
  SELECT key, shard, count(*) AS quota FROM shard_quotients WHERE place <= seats GROUP BY ALL),
runs AS (
  SELECT key, shard, blocks,
    CASE WHEN stopped THEN 3 * blocks ELSE least(coalesce(quota, 0), 3 * blocks) END AS quota,
    CASE WHEN blocks > 0 THEN
      ('0x' || substr(md5('mix-1:start:' || key || ':' || shard), 1, 8))::BIGINT % blocks ELSE 0 END AS start
  FROM shards LEFT JOIN shard_quotas USING (key, shard)),
laid AS (
  SELECT *, sum(size) OVER (PARTITION BY key, shard ORDER BY place, doc_id, size
      ROWS UNBOUNDED PRECEDING)::BIGINT AS stop,
    CASE WHEN blocks > 0 THEN quota // blocks ELSE 0 END AS passes,
    CASE WHEN blocks > 0 THEN start + quota % blocks ELSE 0 END AS finish
  FROM placed JOIN runs USING (key, shard))
SELECT doc_id, size, source_size, target, (passes * size
  + greatest(0, least(stop, least(finish, blocks) * 16) - greatest(stop - size, start * 16))
  + greatest(0, least(stop, (finish - blocks) * 16) - (stop - size)))::BIGINT AS taken
FROM laid
"""

EXACT = r"""
WITH digests AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id IS NOT DISTINCT FROM min(doc_id) OVER w AS kept, text_sha256
FROM digests WINDOW w AS (PARTITION BY text_sha256)
"""

LINES = r"""
WITH lines AS (
  SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line,
    unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM documents WHERE text IS NOT NULL),
keyed AS (
  SELECT *, trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g')) AS plain FROM lines),
counted AS (SELECT * FROM keyed WHERE plain <> ''),
common AS (
  SELECT plain, min(struct_pack(a := doc_id, b := pos)) AS first FROM counted
  GROUP BY plain HAVING count(DISTINCT coalesce('=' || source, '~')) >= 3),
gone AS (
  SELECT doc_id, pos FROM counted JOIN common USING (plain) WHERE struct_pack(a := doc_id, b := pos) <> first),
kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text FROM lines ANTI JOIN gone USING (doc_id, pos)
  GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
  (SELECT count(*) FROM gone g WHERE g.doc_id = d.doc_id)::INTEGER AS lines_removed
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

IMATCH = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text,
    row_number() OVER (ORDER BY doc_id NULLS FIRST, coalesce(text, '')) AS place, count(*) OVER () AS n_docs
  FROM documents),
edits AS (
  SELECT d.doc_id, d.place, d.n_docs, d.text, length(d.text)::BIGINT AS n_chars,
    substr(d.text, 1, length(d.text) - length(d.text) // 4) || substr(e.text, 1, length(d.text) // 4) AS edited
  FROM docs d JOIN docs e ON e.place = d.place % d.n_docs + 1),
words AS (
  SELECT DISTINCT place, n_docs, kind,
    translate(unnest(regexp_extract_all(body, '[^ 	-
]+')),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT place, n_docs, 0 AS kind, text AS body FROM edits
    UNION ALL SELECT place, n_docs, 1, edited FROM edits)),
lexicon AS (
  SELECT term, ('0x' || substr(md5(term), 1, 8))::BIGINT AS draw FROM words WHERE kind = 0
  GROUP BY term, n_docs HAVING count(*) >= n_docs / 512.0 AND count(*) <= n_docs / 16.0 AND count(*) > 1),
known AS (SELECT place, kind, term, draw FROM words JOIN lexicon USING (term)),
levels AS (
  SELECT place, kind, floor(log2(count(*)))::INTEGER AS base FROM known GROUP BY ALL),
wanted AS (
  SELECT place, kind, base, base + step AS level, unnest(range(0, least(32, 1 << (base + step)))) AS cell
  FROM levels, (VALUES (0), (1)) s(step)),
cells AS (
  SELECT place, kind, level, draw % (1::BIGINT << level) AS cell,
    substr(md5(string_agg(term, ' ' ORDER BY term)), 1, 6) AS hash
  FROM known JOIN (SELECT DISTINCT place, kind, level FROM wanted) USING (place, kind)
  WHERE draw % (1::BIGINT << level) < 32 GROUP BY ALL),
prints AS (
  SELECT place, kind, level, any_value(base) AS base, list(coalesce(hash, '') ORDER BY cell) AS hashes
  FROM wanted LEFT JOIN cells USING (place, kind, level, cell) GROUP BY place, kind, level),
both_levels AS (
  SELECT a.place, a.kind, a.base, a.hashes AS coarse, b.hashes AS fine
  FROM prints a JOIN prints b ON a.place = b.place AND a.kind = b.kind AND a.level = a.base AND b.level = b.base + 1),
whole AS (
  SELECT e.place, k.kind, base, coarse, fine, md5(CASE k.kind WHEN 0 THEN e.text ELSE e.edited END) AS whole
  FROM edits e CROSS JOIN (VALUES (0), (1)) k(kind) LEFT JOIN both_levels b ON b.place = e.place AND b.kind = k.kind),
named AS (
  SELECT *, CASE WHEN base IS NULL THEN '-:' || whole
    ELSE base || ':' || array_to_string(coarse, ',') || ':' || array_to_string(fine, ',') END AS name FROM whole),
meetings AS (
  SELECT e.place, 'edited' AS what, a AS a, b AS b FROM edits e
    JOIN named a ON a.place = e.place AND a.kind = 0 JOIN named b ON b.place = e.place AND b.kind = 1
  UNION ALL SELECT e.place, 'next', a, b FROM edits e
    JOIN named a ON a.place = e.place AND a.kind = 0 JOIN named b ON b.place = e.place % e.n_docs + 1 AND b.kind = 0),
aligned AS (
  SELECT place, what, a.base AS p, b.base AS q, a.whole = b.whole AS same,
    CASE WHEN a.base < b.base THEN a.fine ELSE a.coarse END AS x,
    CASE WHEN a.base > b.base THEN b.fine ELSE b.coarse END AS y FROM meetings),
counted AS (
  SELECT *, len(x)::DOUBLE AS n,
    len([i FOR i IN range(1, len(x) + 1) IF x[i] = y[i]]) / len(x)::DOUBLE AS equal,
    greatest(len([i FOR i IN range(1, len(x) + 1) IF x[i] = '' AND y[i] = '']) / len(x)::DOUBLE,
      0.5::DOUBLE / len(x)) AS empty
  FROM aligned),
near AS (
  SELECT place, what, round(CASE WHEN p IS NULL OR q IS NULL THEN same::INTEGER::DOUBLE
    WHEN abs(p - q) > 1 THEN 0.0 WHEN equal = 1 THEN 1.0 WHEN equal <= empty THEN 0.0
    ELSE 1 - ln(equal) / ln(empty) END, 6)::DOUBLE AS likeness FROM counted)
SELECT e.doc_id, e.n_chars, sha256(e.edited) AS edited_sha256, a.name AS fingerprint, b.name AS edited_fingerprint,
  u.likeness AS near_edited, v.likeness AS near_next
FROM edits e JOIN named a ON a.place = e.place AND a.kind = 0 JOIN named b ON b.place = e.place AND b.kind = 1
  JOIN near u ON u.place = e.place AND u.what = 'edited' JOIN near v ON v.place = e.place AND v.what = 'next'
"""

#: What reading back must give; the lengths follow from the template and its escapes.
CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
sized AS (
  SELECT *, length(replace(replace(text, '\', '\\'), '<', '\<'))
    + length(replace(replace(replace(role, '\', '\\'), '<', '\<'), chr(10), '\n')) + 15 AS chars FROM turns),
joined AS (
  SELECT conv_id, count(*) AS n_turns, sum(chars)::BIGINT AS formatted_chars,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS body,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS said
  FROM sized GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(body) AS turns_sha256, length(said)::BIGINT AS loss_chars,
  sha256(said) AS loss_sha256, formatted_chars FROM joined
"""

DECONTAMINATED = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT coalesce(item_id::VARCHAR, 'null') AS item, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
cut AS (
  SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM items WHERE len(w) > 0),
terms AS (SELECT word, row_number() OVER () AS t FROM (SELECT DISTINCT unnest(w) AS word FROM items)),
phrases AS (
  SELECT DISTINCT item, least(len(w), 10) AS size, list_transform(w[s : s + 9], lambda x: m[x]) AS phrase
  FROM cut, (SELECT map(list(word), list(t)) AS m FROM terms)),
places AS (SELECT r, len(w) AS n, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM docs),
following AS (
  SELECT r, n, p, [t, lead(t, 1) OVER d, lead(t, 2) OVER d, lead(t, 3) OVER d, lead(t, 4) OVER d, lead(t, 5) OVER d,
    lead(t, 6) OVER d, lead(t, 7) OVER d, lead(t, 8) OVER d, lead(t, 9) OVER d] AS next
  FROM places LEFT JOIN terms USING (word) WINDOW d AS (PARTITION BY r ORDER BY p)),
met AS (
  SELECT r, p, s.size, item FROM (SELECT * FROM following WHERE next[1] IS NOT NULL), (SELECT DISTINCT size FROM phrases) s
    JOIN phrases ON phrases.size = s.size AND phrase = next[1 : s.size]
  WHERE p + s.size - 1 <= n),
hit AS (
  SELECT r, count(DISTINCT word) AS n_hit FROM (SELECT r, unnest(range(p, p + size)) AS word FROM met) GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM met) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""

RANKED = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents WHERE text IS NOT NULL),
sizes AS (SELECT r, doc_id, len(w)::BIGINT AS n FROM docs WHERE len(w) > 0),
stats AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes),
counted AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS term FROM docs) GROUP BY ALL),
weighted AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS weight
  FROM (SELECT term, count(*) AS df FROM counted GROUP BY term), stats),
wanted AS (
  SELECT i, item_id, term, count(*)::BIGINT AS repeats FROM (
    SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
scored AS (
  SELECT i, item_id, doc_id, r, sum(repeats * weight
    * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * n_docs) // n_terms)))))::BIGINT AS score
  FROM wanted JOIN counted USING (term) JOIN weighted USING (term) JOIN sizes USING (r), stats GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scored WHERE score > 0)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM ranked WHERE place <= 20
"""

#: CRC-32 by its table, which is computed; words one edit apart by the forms that lose one letter.
SPELT = r"""
WITH RECURSIVE steps AS (
  SELECT range::BIGINT AS b, 0 AS k, range::BIGINT AS v FROM range(256)
  UNION ALL SELECT b, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM steps WHERE k < 8),
crc AS (SELECT list(v ORDER BY b) AS t FROM steps WHERE k = 8),
runs AS (
  SELECT id, run, count(*) AS k, hex(id || ':' || run) AS bytes FROM (
    SELECT coalesce(doc_id::VARCHAR, 'null') AS id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents) GROUP BY ALL),
drawn AS (
  SELECT run, k, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(0, length(bytes) // 2),
    lambda i: ('0x' || substr(bytes, 2 * i + 1, 2))::BIGINT)), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) AS h
  FROM runs, crc WHERE length(run) >= 7),
spelt AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM drawn),
words AS (
  SELECT word, sum(k)::BIGINT AS n FROM spelt WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
lost AS (
  SELECT word, n, length(word) AS size, i, left(word, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)),
apart AS (
  SELECT a.word AS a, b.word AS b, b.n FROM lost a JOIN lost b ON a.size = b.size AND a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT l.word, w.word, w.n FROM lost l JOIN words w ON l.rest = w.word
  UNION SELECT w.word, l.word, l.n FROM lost l JOIN words w ON l.rest = w.word),
best AS (
  SELECT a AS word, count(*) AS n_near, max(n) AS form_n, first(b ORDER BY n DESC, b) AS form FROM apart GROUP BY a),
judged AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN form_n >= 10 * w.n THEN form END AS form,
    CASE WHEN form_n >= 10 * w.n THEN form_n END AS form_n
  FROM words w LEFT JOIN best ON best.word = w.word),
paths AS (
  SELECT word, word AS root, 0 AS depth FROM judged
  UNION ALL SELECT p.word, j.form, depth + 1 FROM paths p JOIN judged j ON j.word = p.root WHERE j.form IS NOT NULL),
ends AS (SELECT word, first(root ORDER BY depth DESC) AS root FROM paths GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM judged JOIN ends USING (word)
"""

ORACLES = {
    "op1_line_dedup": LINES,
    "op9_chat_tree": CHAT,
    "op5_imatch": IMATCH,
    "op2_mix_sources": MIX,
    "op8_exact_dedup": EXACT,
    "op11_decontaminate": DECONTAMINATED,
    "op12_reversed_search": RANKED,
    "op13_spelling": SPELT,
}
