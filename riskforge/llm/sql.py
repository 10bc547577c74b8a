"""DuckDB SQL for the queries that SQL can express.

``crc32`` is built from its definition: the table of the 256 byte remainders,
then one step for each byte of the text.
"""

# crc32 of documents.text by its definition (reflected polynomial 0xEDB88320)
CRC_STEPS = """
crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)),
      lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS v
    FROM range(256) r(i))
),
bytes AS (
  SELECT DISTINCT coalesce(text, '') AS body, hex(encode(coalesce(text, ''))) AS h FROM documents
),
crcs AS (
  SELECT body, xor(list_reduce(
    list_prepend(4294967295::BIGINT, [('0x' || h[2 * i + 1 : 2 * i + 2])::BIGINT FOR i IN range(length(h) // 2)]),
    lambda x, b: xor(x >> 8, t[(xor(x, b) & 255) + 1])), 4294967295::BIGINT) AS crc
  FROM bytes, crc_table
)"""

SHARDING = f"""
WITH {CRC_STEPS.strip()},
base AS (
  SELECT doc_id, octet_length(encode(body)) + 1 AS size, crc AS text_crc32,
    coalesce('=' || source, 'null') AS s_key, md5('shards|' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents JOIN crcs ON coalesce(text, '') = body
),
ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY s_key ORDER BY h, doc_id NULLS FIRST, text_crc32, size)::DOUBLE
    - (('0x' || md5('shards|' || s_key)[1:8])::BIGINT::DOUBLE + 0.5) / 4294967296.0::DOUBLE)
    / count(*) OVER (PARTITION BY s_key)::DOUBLE AS frac
  FROM base
),
placed AS (
  SELECT *, row_number() OVER (ORDER BY frac, s_key, h, doc_id NULLS FIRST, text_crc32, size) - 1 AS place,
    count(*) OVER () AS n
  FROM ranked
),
cutted AS (SELECT *, (place * 8) // n AS shard FROM placed)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, shard::INTEGER AS shard,
  (place - ((shard * n + 7) // 8))::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM cutted
"""

MIXING = r"""
WITH base AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    coalesce('=' || source, 'null') AS s_key, md5('mix|' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
),
sources AS (
  SELECT s_key, any_value(source) AS source, sum(size)::BIGINT AS total FROM base GROUP BY s_key
),
weighed AS (
  SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w, total * 2 AS cap FROM sources
),
-- share again until none is above: a source is capped when it is above at the level of the others
rounds AS (
  SELECT *, row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS k FROM weighed
),
levels AS (
  SELECT *, ((SELECT sum(total) FROM sources) * 1.5
      - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level
  FROM rounds
),
height AS (SELECT level AS height FROM levels WHERE level * w <= cap ORDER BY k LIMIT 1),
targets AS (
  SELECT s_key, total, CASE WHEN height IS NULL OR height * w > cap THEN cap::DOUBLE ELSE height * w END AS target
  FROM levels LEFT JOIN height ON true
),
placed AS (
  SELECT b.*, t.total, t.target, sum(size) OVER (PARTITION BY s_key ORDER BY h, doc_id NULLS FIRST, size)::BIGINT - size AS bef
  FROM base b JOIN targets t USING (s_key)
),
taken AS (
  SELECT *, CASE WHEN size = 0 THEN 0 ELSE (2 * bef + size < 2 * target)::INTEGER + (2 * (bef + total) + size < 2 * target)::INTEGER END AS copies
  FROM placed
),
gaps AS (SELECT s_key, max(target) - sum(size * copies)::DOUBLE AS gap FROM taken GROUP BY s_key),
fix AS (
  SELECT s_key, arg_min(doc_id, (abs(abs(gap) - size), h)) AS f_id, any_value(sign(gap))::INTEGER AS f_step
  FROM taken JOIN gaps USING (s_key)
  WHERE size > 0 AND CASE WHEN gap > 0 THEN copies < 2 ELSE copies > 0 END AND abs(abs(gap) - size) < abs(gap)
  GROUP BY s_key
),
drawn AS (
  SELECT t.* EXCLUDE (copies), copies + CASE WHEN doc_id = f_id THEN f_step ELSE 0 END AS copies
  FROM taken t LEFT JOIN fix USING (s_key)
),
step AS (SELECT greatest(1, (sum(size * copies) + 511) // 512)::BIGINT AS step FROM drawn),
copied AS (
  SELECT s_key, doc_id, copy, (bef + total * copy) // step AS block
  FROM drawn, step, range(2) r(copy) WHERE copy < copies
),
balls0 AS (
  SELECT s_key, ball, 0 AS low FROM (SELECT s_key, max(block) + 1 AS n FROM copied GROUP BY s_key), range(2000) r(ball) WHERE ball < n
),
balls1 AS (
  SELECT s_key, ball, CASE WHEN row_number() OVER (PARTITION BY low ORDER BY md5('mix|node0|' || low || '|' || s_key || '|' || ball))
    <= round(count(*) OVER (PARTITION BY low) * 4 / 8::DOUBLE) THEN low ELSE low + 4 END AS low FROM balls0
),
balls2 AS (
  SELECT s_key, ball, CASE WHEN row_number() OVER (PARTITION BY low ORDER BY md5('mix|node1|' || low || '|' || s_key || '|' || ball))
    <= round(count(*) OVER (PARTITION BY low) * 2 / 4::DOUBLE) THEN low ELSE low + 2 END AS low FROM balls1
),
balls AS (
  SELECT s_key, ball, CASE WHEN row_number() OVER (PARTITION BY low ORDER BY md5('mix|node2|' || low || '|' || s_key || '|' || ball))
    <= round(count(*) OVER (PARTITION BY low) / 2::DOUBLE) THEN low ELSE low + 1 END AS low FROM balls2
),
places AS (
  SELECT o.s_key, o.ball AS block, q.low AS shard
  FROM (SELECT s_key, ball, row_number() OVER (PARTITION BY s_key ORDER BY md5('mix|block|' || s_key || '|' || ball)) AS place FROM balls) o
  JOIN (SELECT s_key, low, row_number() OVER (PARTITION BY s_key ORDER BY low, ball) AS place FROM balls) q USING (s_key, place)
),
dealt AS (
  SELECT doc_id, string_agg(shard::VARCHAR, ',' ORDER BY shard) AS shards FROM copied JOIN places USING (s_key, block) GROUP BY doc_id
)
SELECT doc_id, size, total::BIGINT AS source_size, target, (size * copies)::BIGINT AS taken, coalesce(shards, '') AS shards
FROM drawn LEFT JOIN dealt USING (doc_id)
"""

DECONTAMINATION = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
),
b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
),
windows AS (
  SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[k + 1 : k + least(13, len(w))], ' ') AS win
  FROM b, unnest(range(greatest(1, len(w) - 12))) r(k) WHERE len(w) > 0
),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, n, k, array_to_string(w[k + 1 : k + n], ' ') AS win
  FROM d, lengths, unnest(range(greatest(0, len(w) - n + 1))) r(k)
),
found AS (SELECT doc_id, p.n, k, item FROM places p JOIN windows USING (n, win)),
hit AS (
  SELECT doc_id, count(DISTINCT k + j) AS n_hit FROM (SELECT DISTINCT doc_id, n, k FROM found), unnest(range(n)) r(j) GROUP BY doc_id
),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

PASSAGES = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
windows AS (
  SELECT r, k, md5(array_to_string(w[k + 1 : k + 35], ' ')) AS win FROM d, unnest(range(greatest(0, len(w) - 34))) u(k)
),
repeated AS (SELECT win FROM windows GROUP BY win HAVING count(*) > 1),
gone AS (
  SELECT r, list(DISTINCT k + j) AS places FROM windows JOIN repeated USING (win), unnest(range(1, 36)) v(j) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(places), 0)::BIGINT AS n_removed,
  sha256(array_to_string(list_filter(w, lambda x, i: NOT list_contains(coalesce(places, []), i)), ' ')) AS kept_sha256
FROM d LEFT JOIN gone USING (r)
"""

COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
one AS (
  SELECT lang, x, count(*)::HUGEINT AS f FROM (SELECT lang, unnest(w) AS x FROM w) GROUP BY ALL
),
two AS (
  SELECT lang, x, y, count(*)::HUGEINT AS f FROM (SELECT lang, unnest(w[1 : len(w) - 1]) AS x, unnest(w[2 : len(w)]) AS y FROM w WHERE len(w) >= 2)
  GROUP BY ALL HAVING count(*) >= 10
),
three AS (
  SELECT lang, x, y, z, count(*)::HUGEINT AS f
  FROM (SELECT lang, unnest(w[1 : len(w) - 2]) AS x, unnest(w[2 : len(w) - 1]) AS y, unnest(w[3 : len(w)]) AS z FROM w WHERE len(w) >= 3)
  GROUP BY ALL HAVING count(*) >= 10
),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM one GROUP BY lang),
longer AS (
  SELECT lang, x, y, max(f) AS f FROM (SELECT lang, x, y, f FROM three UNION ALL SELECT lang, y AS x, z AS y, f FROM three) GROUP BY ALL
),
pairs AS (
  SELECT t.lang, t.x || ' ' || t.y AS phrase, t.f AS a, l.f AS l, r.f AS r, t.f * t.f * 1000000 // (l.f * r.f) AS score
  FROM two t JOIN one l ON l.lang = t.lang AND l.x = t.x JOIN one r ON r.lang = t.lang AND r.x = t.y
  LEFT JOIN longer i ON i.lang = t.lang AND i.x = t.x AND i.y = t.y
  WHERE coalesce(100 * i.f < 50 * t.f, true)
),
cuts AS (
  SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z AS phrase, t.f AS a, l1.f AS l1, r1.f AS r1, l2.f AS l2, r2.f AS r2,
    t.f * t.f * 1000000 // (l1.f * r1.f) AS s1, t.f * t.f * 1000000 // (l2.f * r2.f) AS s2
  FROM three t JOIN one l1 ON l1.lang = t.lang AND l1.x = t.x JOIN two r1 ON r1.lang = t.lang AND r1.x = t.y AND r1.y = t.z
  JOIN two l2 ON l2.lang = t.lang AND l2.x = t.x AND l2.y = t.y JOIN one r2 ON r2.lang = t.lang AND r2.x = t.z
),
phrases AS (
  SELECT * FROM pairs UNION ALL
  SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2) FROM cuts
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM phrases
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
