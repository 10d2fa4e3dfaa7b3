"""DuckDB SQL for the queries whose rows SQL can express."""

from __future__ import annotations

_WORDS = "regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP6 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS.format(text="text")}, []) AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item_id, {_WORDS.format(text="text")} AS w FROM benchmark WHERE text IS NOT NULL),
p AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS s
  FROM b, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
lengths AS (SELECT DISTINCT n FROM p),
spots AS (
  SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS s
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n)),
hits AS (SELECT r, i, spots.n, item_id FROM spots JOIN p ON spots.s = p.s AND spots.n = p.n),
words AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM hits) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

OP4 = """
WITH RECURSIVE calls AS (
  SELECT conv_id, turn, role, text, coalesce(len(text), 1) AS size, count(*) OVER (PARTITION BY conv_id) AS n
  FROM conversations WHERE role IN ('user', 'system')),
wanted AS (
  SELECT conv_id, turn, CASE WHEN size % 4 = 0 THEN turn + 2 WHEN size % 4 IN (1, 2) THEN turn - 2 END AS parent FROM calls
  UNION SELECT conv_id, turn, 0 FROM calls),
needs AS (
  SELECT w.conv_id, w.turn, w.parent FROM wanted w JOIN calls c ON c.conv_id = w.conv_id AND c.turn = w.parent WHERE w.parent <> w.turn),
ahead AS (SELECT DISTINCT conv_id FROM needs WHERE parent >= turn),
-- Paths along dependencies; one as long as the conversation has calls runs in a cycle.
paths AS (
  SELECT conv_id, turn, turn AS at, 0 AS depth, n FROM calls WHERE conv_id IN (SELECT conv_id FROM ahead)
  UNION SELECT p.conv_id, p.turn, d.parent, p.depth + 1, p.n
  FROM paths p JOIN needs d ON d.conv_id = p.conv_id AND d.turn = p.at WHERE p.depth < p.n),
levels AS (SELECT conv_id, turn, max(depth) AS level FROM paths GROUP BY conv_id, turn, n HAVING max(depth) < n),
ranked AS (
  SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY level, turn) AS place
  FROM (SELECT * FROM levels UNION ALL SELECT conv_id, turn, 0 FROM calls WHERE conv_id NOT IN (SELECT conv_id FROM ahead))),
answers AS (SELECT conv_id, turn - 1 AS turn, text AS result FROM conversations WHERE role = 'assistant'),
checked AS (
  SELECT *, conv_id || '-' || turn AS call_id, CASE role WHEN 'user' THEN 'prompt' ELSE 'rules' END AS key,
    role = 'system' AND size % 3 = 0 AS bare FROM calls),
judged AS (
  SELECT *, list_filter([
      CASE WHEN bare THEN 'missing rules' END,
      CASE WHEN NOT bare AND size % 5 = 0 THEN 'turn is no integer' END,
      CASE WHEN NOT bare AND size % 7 = 0 THEN 'unknown note' END], lambda e: e IS NOT NULL) AS found,
    CASE WHEN bare THEN json_object('turn', turn)::VARCHAR ELSE '{' || CASE WHEN size % 7 = 0 THEN '"note":"as said",' ELSE '' END
      || '"' || key || '":' || to_json(text) || ',"turn":' || CASE WHEN size % 5 = 0 THEN '"' || turn || '"' ELSE turn::VARCHAR END || '}' END AS arguments
  FROM checked)
SELECT conv_id, call_id, place, result IS NOT NULL AS linked, len(found) = 0 AS valid, array_to_string(found, '; ') AS errors,
  '{"arguments":' || arguments || ',"errors":' || to_json(found) || ',' || substr(json_object(
    'id', call_id, 'name', CASE role WHEN 'user' THEN 'reply' ELSE 'configure' END, 'place', place, 'result', result,
    'turn', turn)::VARCHAR, 2) AS message
FROM judged LEFT JOIN ranked USING (conv_id, turn) LEFT JOIN answers USING (conv_id, turn)
"""

#: The sixteen rests of CRC-32 (reflected polynomial 0xEDB88320) by half byte.
_CRC_STEPS: list[int] = []
for _rest in range(16):
    for _ in range(4):
        _rest = (_rest >> 1) ^ (0xEDB88320 if _rest & 1 else 0)
    _CRC_STEPS.append(_rest)

#: Unsigned CRC-32 of the UTF-8 bytes of a text, half byte by half byte, the low one first.
_CRC = f"""CASE WHEN {{text}} = '' THEN 0 ELSE xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
  list_transform(string_split(regexp_replace(hex({{text}}), '(.)(.)', '\\2\\1', 'g'), ''),
    lambda d: (instr('0123456789ABCDEF', d) - 1)::BIGINT)),
  lambda c, d: xor(c >> 4, {_CRC_STEPS}[xor(c, d) % 16 + 1]))) END"""

OP11 = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, coalesce('=' || doc_id, '') AS k FROM documents),
scores AS (
  SELECT r, s, -1.0::DOUBLE / ln((('0x' || substr(md5(k || ':' || s), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE) AS score
  FROM d, range(25) AS shards(s)),
best AS (
  SELECT r, arg_max(s, score) FILTER (s < 24) AS shard, arg_max(s, score) AS grown_shard FROM scores GROUP BY r),
placed AS (
  SELECT doc_id, strlen(t) + 8 AS size, {_CRC.format(text="t")} AS text_crc32, shard, grown_shard,
    ('0x' || substr(md5(k), 1, 15))::BIGINT AS place
  FROM d JOIN best USING (r))
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard::INTEGER AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY place, doc_id, text_crc32, size) - 1 AS slot,
  grown_shard::INTEGER AS grown_shard
FROM placed
"""

OP13 = f"""
WITH runs AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(
      text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\u00c0-\u00ff]{{7,}}')) AS run
    FROM documents)
  GROUP BY ALL),
hashed AS (SELECT run, n, {_CRC.format(text="(coalesce(doc_id::VARCHAR, 'null') || ':' || run)")} AS h FROM runs),
v AS (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT n, CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2)
    ELSE run END AS word FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS part FROM v, unnest(range(length(word))) AS t(i)),
pairs AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.part = b.part AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN v b ON a.part = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM cut a JOIN v b ON a.part = b.word),
near AS (
  SELECT word, count(*) AS n_near, max(other_n) AS most, arg_min(other, struct_pack(m := -other_n, o := encode(other))) AS form
  FROM pairs GROUP BY word),
formed AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * v.n THEN form END AS form,
    CASE WHEN most >= 10 * v.n THEN most END AS form_n
  FROM v LEFT JOIN near USING (word)),
chain AS (
  WITH RECURSIVE c AS (
    SELECT word, word AS last, form AS next FROM formed
    UNION ALL SELECT c.word, c.next, f.form FROM c JOIN formed f ON f.word = c.next)
  SELECT word, last AS root FROM c WHERE next IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN chain USING (word)
"""

ORACLES = {
    "op4_tool_call_links": OP4,
    "op6_decontaminate": OP6,
    "op11_sharding": OP11,
    "op13_spelling_variants": OP13,
}
