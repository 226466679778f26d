"""SQL for the queries that SQL can express, written from the contracts and not from the plans."""

from __future__ import annotations

LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPACE_WORDS = rf"regexp_extract_all(coalesce({LOWER}, ''), '[^\x20\x09-\x0D]+')"
ALNUM_WORDS = rf"regexp_extract_all(coalesce({LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

# Five hexadecimal digits are 20 bits, four digits of base 32.
BASE32 = """list_aggregate(list_transform(range(0, 8), lambda i:
  list_aggregate(list_transform([32768, 1024, 32, 1], lambda b: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + (CAST('0x' || substr(sha1(payload), 1 + 5 * i, 5) AS BIGINT) // b) % 32, 1)),
    'string_agg', '')), 'string_agg', '')"""

ARCHIVE = f"""WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
f AS (SELECT *, MIN(page_id) OVER (PARTITION BY payload) AS first FROM p)
SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes,
  {BASE32} AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to FROM f"""

OVERLAP = f"""WITH d AS (SELECT doc_id, {ALNUM_WORDS} AS w FROM documents),
b AS (SELECT item_id, {ALNUM_WORDS} AS w FROM benchmark),
items AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, w[i:i + least(len(w), 10) - 1] AS gram
  FROM b, LATERAL (SELECT unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM items),
windows AS (
  SELECT doc_id, i, size, w[i:i + size - 1] AS gram
  FROM d, sizes, LATERAL (SELECT unnest(range(1, len(w) - size + 2)) AS i)),
hits AS (SELECT doc_id, i, windows.size, item_id FROM windows JOIN items USING (size, gram)),
marked AS (
  SELECT doc_id, COUNT(DISTINCT j) AS n FROM
    (SELECT DISTINCT doc_id, i, size FROM hits) h,
    LATERAL (SELECT unnest(range(h.i, h.i + h.size)) AS j) GROUP BY doc_id),
owners AS (
  SELECT doc_id, COUNT(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(marked.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(owners.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(marked.n, 0) > 0 AS contaminated
FROM d LEFT JOIN marked USING (doc_id) LEFT JOIN owners USING (doc_id)"""

COMPONENTS = f"""WITH RECURSIVE d AS (SELECT doc_id, {SPACE_WORDS} AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, w[i:i + 3] AS gram
  FROM d, LATERAL (SELECT unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, COUNT(*) AS n FROM grams GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, COUNT(*) AS n
  FROM grams x JOIN grams y ON x.gram = y.gram AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
  WHERE 100 * shared.n >= 85 * (s.n + t.n - shared.n)),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM d
  UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, MIN(b) AS component_id
FROM d LEFT JOIN sizes USING (doc_id) JOIN reached ON reached.a = doc_id GROUP BY doc_id, n"""

# CRC-32, byte by byte over a table of 256 entries.
CRC_TABLE = """list_transform(range(0, 256), lambda n: list_reduce(
  [CAST(n AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
  lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"""

SEEN = r"""regexp_replace(text, '[\x20\x09-\x0D]+$', '')"""

# States of a repair: v0 nothing, v1 system, v2 user, v3 assistant; each holds what the rows from
# here on cost at least, with the audit and the repaired lines.
REPAIR = f"""WITH RECURSIVE crc AS MATERIALIZED (SELECT {CRC_TABLE} AS tab),
named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
  FROM conversations),
kinds AS (
  SELECT *, xor(list_reduce([4294967295] || list_transform(string_split(name, ''), lambda x: CAST(ascii(x) AS BIGINT)),
    lambda c, b: xor(c >> 8, tab[CAST((xor(c, b) & 255) + 1 AS BIGINT)])), 4294967295) % 20 AS kind
  FROM named, crc),
rows AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM kinds, LATERAL (SELECT unnest(range(0, CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy)),
numbered AS (
  SELECT *, ROW_NUMBER() OVER w AS pos, left(role, 1) AS k,
    lag(left(role, 1)) OVER w || left(role, 1) AS pair, {SEEN} AS body
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
faults AS (
  SELECT *, CASE WHEN body = '' THEN 'blank'
    WHEN ROW_NUMBER() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
    WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM numbered),
stats AS (
  SELECT conv_id, COUNT(*) AS n, coalesce(MAX(turn) - MIN(turn) + 1 - COUNT(DISTINCT turn), 0) AS gaps,
    COUNT(*) FILTER (fault = 'blank') AS blank, COUNT(*) FILTER (fault = 'duplicate') AS duplicate,
    COUNT(*) FILTER (fault = 'truncated') AS truncated,
    COUNT(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id),
dp AS (
  SELECT conv_id, n AS i, {{'c': 0, 'a': '', 'r': CAST([] AS VARCHAR[])}} AS v0,
    {{'c': 10, 'a': 'II', 'r': ['user:', 'assistant:']}} AS v1,
    {{'c': 5, 'a': 'I', 'r': ['assistant:']}} AS v2, {{'c': 0, 'a': '', 'r': CAST([] AS VARCHAR[])}} AS v3
  FROM stats
  UNION ALL
  SELECT conv_id, i - 1, least(n0, {{'c': 5 + w2.c, 'a': 'I' || w2.a, 'r': ['user:'] || w2.r}}),
    least(n1, {{'c': 5 + w2.c, 'a': 'I' || w2.a, 'r': ['user:'] || w2.r}}), w2, w3
  FROM (
    SELECT *, least(n2, {{'c': 5 + n3.c, 'a': 'I' || n3.a, 'r': ['assistant:'] || n3.r}}) AS w2,
      least(n3, {{'c': 5 + n2.c, 'a': 'I' || n2.a, 'r': ['user:'] || n2.r}}) AS w3
    FROM (
      SELECT conv_id, i, least(del0, kept0, user) AS n0, least(del1, user1, user) AS n1,
        least(del2, kept2, assistant) AS n2, least(del3, user1, user) AS n3
      FROM (
        SELECT dp.conv_id, i, {{'c': v0.c + 2, 'a': 'D' || v0.a, 'r': v0.r}} AS del0,
          {{'c': v1.c + 2, 'a': 'D' || v1.a, 'r': v1.r}} AS del1,
          {{'c': v2.c + 2, 'a': 'D' || v2.a, 'r': v2.r}} AS del2,
          {{'c': v3.c + 2, 'a': 'D' || v3.a, 'r': v3.r}} AS del3,
          CASE WHEN ok AND k = 's' THEN {{'c': v1.c + extra, 'a': 'K' || v1.a, 'r': [line] || v1.r}}
            WHEN ok AND k = 'u' THEN {{'c': v2.c + extra, 'a': 'K' || v2.a, 'r': [line] || v2.r}} END AS kept0,
          CASE WHEN ok AND k = 'u' THEN {{'c': v2.c + extra, 'a': 'K' || v2.a, 'r': [line] || v2.r}} END AS user1,
          CASE WHEN ok AND k = 'a' THEN {{'c': v3.c + extra, 'a': 'K' || v3.a, 'r': [line] || v3.r}} END AS kept2,
          CASE WHEN ok THEN {{'c': v2.c + 1 + extra, 'a': 'R' || v2.a, 'r': ['user:' || text] || v2.r}} END AS user,
          CASE WHEN ok THEN {{'c': v3.c + 1 + extra, 'a': 'R' || v3.a, 'r': ['assistant:' || text] || v3.r}} END AS assistant
        FROM dp JOIN (
          SELECT conv_id, pos, k, text, role || ':' || text AS line, fault NOT IN ('blank', 'duplicate') AS ok,
            CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS extra FROM faults) f
        ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.pos = dp.i)))),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(v0.c, 0) AS BIGINT) AS cost,
  coalesce(v0.a, '') AS audit, sha256(coalesce(array_to_string(v0.r, chr(10)), '')) AS repaired_sha256
FROM ids LEFT JOIN stats ON stats.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN (SELECT * FROM dp WHERE i = 0) d ON d.conv_id IS NOT DISTINCT FROM ids.conv_id"""

NEGATIVES = """WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, id, score FROM scores WHERE same
  QUALIFY ROW_NUMBER() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id,
  CAST(ROW_NUMBER() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
  n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3"""

ORACLE: dict[str, str] = {
    "op3_content_archive": ARCHIVE,
    "op9_winnowing": OVERLAP,
    "op10_grouped_prefix_join": COMPONENTS,
    "op11_conversation_repair": REPAIR,
    "op12_hard_negatives": NEGATIVES,
}
