"""The registered queries as DuckDB SQL, where SQL can express them."""

ORACLE: dict[str, str] = {}

ORACLE["op1_exact_dedup"] = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
), r AS (
  SELECT doc_id, norm, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
         row_number() OVER (PARTITION BY norm ORDER BY doc_id NULLS LAST) AS place
  FROM n
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM r
"""

ORACLE["op2_url_filters"] = r"""
WITH p AS (
  SELECT page_id,
         CASE WHEN contains(url, '://') THEN translate(regexp_extract(url, '^[\s\S]*?://([^/?#]*)', 1),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
         CASE WHEN contains(url, '://') THEN regexp_extract(url, '^[\s\S]*?://[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages
), l AS (
  SELECT doc_id, count(*) AS n, sum(CASE WHEN quality = 1 AND toxic = 0 THEN 1 ELSE 0 END) AS good
  FROM labels WHERE quality IS NOT NULL AND toxic IS NOT NULL AND doc_id IS NOT NULL GROUP BY doc_id
), x AS (
  SELECT regexp_replace(text, '[^\p{L}\p{N}]+', '', 'g') AS letters, 2 * sum(l.good) > sum(l.n) AS good
  FROM documents JOIN l USING (doc_id) GROUP BY letters
), a AS (
  SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_extract(html, '(?s)<article>(.*?)</article>', 1),
         '(?s)<h1>.*?</h1>', '', 'g'), '<[^>]*>|&[A-Za-z]+;|&#[0-9]+;', ' ', 'g'), '[^\p{L}\p{N}]+', '', 'g') AS letters
  FROM pages WHERE page_id IS NOT NULL
), o AS (
  SELECT page_id, 1 AS n, min(x.good::INT) AS good FROM a JOIN x USING (letters) WHERE letters <> '' GROUP BY page_id
), h0 AS (
  SELECT host, regexp_extract(host, '^(?:.*@)?([^@:]*)(?::[0-9]*)?$', 1) AS bare,
         sum(coalesce(n, 0)) AS n, sum(coalesce(good, 0)) AS good
  FROM p LEFT JOIN o ON p.page_id = o.page_id GROUP BY host
), h1 AS (
  SELECT *, coalesce(nullif(regexp_extract(bare, '(?:^|\.)((?:ac|co|com|edu|gov|net|org)\.[a-z]{2})$', 1), ''),
                     regexp_extract(bare, '[^.]*$')) AS suffix FROM h0
), h2 AS (
  SELECT *, regexp_extract(left(bare, greatest(length(bare) - length(suffix) - 1, 0)), '[^.]*$') AS label FROM h1
), h AS (
  SELECT host, suffix, n, good, CASE WHEN regexp_matches(bare, '^[0-9.]+$') THEN bare WHEN label = '' THEN suffix
         ELSE label || '.' || suffix END AS domain FROM h2
), g AS (SELECT coalesce(sum(good) / nullif(sum(n), 0), 0.5)::DOUBLE AS mean FROM h
), s0 AS (SELECT suffix, sum(n) AS n, sum(good) AS good, (SELECT mean FROM g) AS mu FROM h GROUP BY suffix
), s1 AS (SELECT *, greatest(least(mu, 0.999), 0.001) AS c FROM s0
), sk AS (
  SELECT 1 / greatest(least(coalesce(CASE WHEN sum(n - 1) > 0
    THEN sum(n * (good / n - c) * (good / n - c) / (c * (1 - c)) - 1) / sum(n - 1) ELSE 0.1 END, 0.1), 0.5), 0.001) - 1 AS k
  FROM s1 WHERE n > 0
), s AS (SELECT suffix, ((SELECT k FROM sk) * mu + good) / ((SELECT k FROM sk) + n) AS mean FROM s1
), d0 AS (
  SELECT domain, h.suffix, sum(n) AS n, sum(good) AS good, any_value(s.mean) AS mu
  FROM h JOIN s ON h.suffix = s.suffix GROUP BY domain, h.suffix
), d1 AS (SELECT *, greatest(least(mu, 0.999), 0.001) AS c FROM d0
), dk AS (
  SELECT 1 / greatest(least(coalesce(CASE WHEN sum(n - 1) > 0
    THEN sum(n * (good / n - c) * (good / n - c) / (c * (1 - c)) - 1) / sum(n - 1) ELSE 0.1 END, 0.1), 0.5), 0.001) - 1 AS k
  FROM d1 WHERE n > 0
), d AS (SELECT domain, suffix, ((SELECT k FROM dk) * mu + good) / ((SELECT k FROM dk) + n) AS mean FROM d1
), e1 AS (
  SELECT h.*, d.mean AS mu, greatest(least(d.mean, 0.999), 0.001) AS c
  FROM h JOIN d ON h.domain = d.domain AND h.suffix = d.suffix
), ek AS (
  SELECT 1 / greatest(least(coalesce(CASE WHEN sum(n - 1) > 0
    THEN sum(n * (good / n - c) * (good / n - c) / (c * (1 - c)) - 1) / sum(n - 1) ELSE 0.1 END, 0.1), 0.5), 0.001) - 1 AS k
  FROM e1 WHERE n > 0
), ab AS (
  SELECT host, (SELECT k FROM ek) * mu + good AS a, (SELECT k FROM ek) * (1 - mu) + n - good AS b FROM e1
), low AS (SELECT host, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS low FROM ab
), r(verdict, rule, rhost, rpath) AS (
  VALUES ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'),
         ('block', 'example.org/en/1', 'example.org', '/en/1'), ('allow', 'com/fr/', 'com', '/fr/'),
         ('block', 'com/de/', 'com', '/de/')
), fit AS (
  SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM (SELECT DISTINCT host, path FROM p) q JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY host, path
)
SELECT page_id, p.host, p.path, fit.rule, coalesce(fit.verdict, CASE WHEN low >= 0.5 THEN 'allow' ELSE 'block' END) AS verdict
FROM p LEFT JOIN fit ON p.host = fit.host AND p.path = fit.path LEFT JOIN low ON p.host = low.host
"""

ORACLE["op7_sharding"] = r"""
WITH t AS (  -- the table of the checksum, by its rule
  SELECT list(list_reduce([n::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY n) AS tab FROM range(256) g(n)
), d AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(doc_id::VARCHAR, '') AS k FROM documents
), b AS (
  SELECT doc_id, k, octet_length(encode(text)) + 8 AS size, hex(encode(text)) AS h FROM d
), c AS (
  SELECT doc_id, k, size, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
      list_transform(regexp_extract_all(h, '..'), lambda x: ('0x' || x)::BIGINT)),
      lambda a, x: xor(tab[(xor(a, x) & 255) + 1], a >> 8))) AS text_crc32
  FROM b, t
), r AS (
  SELECT *, md5(k || '/r/0') AS m FROM c
), r2 AS (
  SELECT *, list_transform([1, 2, 3, 4], lambda i: ln((('0x' || substr(m, i * 8 - 7, 8))::BIGINT + 0.5) / 4294967296.0)) AS u FROM r
), r3 AS (
  SELECT *, CASE WHEN u[1] >= u[2] AND u[1] >= u[3] THEN 0 WHEN u[2] >= u[3] THEN 1 ELSE 2 END AS region,
         u[4] > greatest(u[1], u[2], u[3]) * 0.125 AS moves
  FROM r2
), k AS (
  SELECT *, md5(k || '/k/' || region || '/0') AS km FROM r3
), k2 AS (
  SELECT *, CASE WHEN substr(km, 1, 8) >= substr(km, 9, 8) THEN 0 ELSE 1 END AS rack FROM k
), p AS (
  SELECT *, md5(k || '/p/' || region || '/' || rack || '/0') AS pm FROM k2
), p2 AS (
  SELECT *, region * 8 + rack * 4
    + list_position([substr(pm, 1, 8), substr(pm, 9, 8), substr(pm, 17, 8), substr(pm, 25, 8)],
      greatest(substr(pm, 1, 8), substr(pm, 9, 8), substr(pm, 17, 8), substr(pm, 25, 8))) - 1 AS shard
  FROM p
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, CASE WHEN moves THEN 24 ELSE shard END AS grown_shard,
       row_number() OVER (PARTITION BY shard ORDER BY substr(md5('slot/' || k), 1, 3), doc_id NULLS LAST, text_crc32, size) - 1 AS slot
FROM p2
"""

ORACLE["op9_source_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         substr(md5('order/' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 3) AS bucket
  FROM documents
), s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), s1 AS (SELECT *, row_number() OVER (ORDER BY encode(source) NULLS LAST) AS rank FROM s0
), s2 AS (SELECT *, (rank - 1) % 3 + 1 AS weight, source_size * 3 AS most FROM s1
), s3 AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY most / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM s2
), s4 AS (SELECT *, max(CASE WHEN most / weight > level THEN level END) OVER () AS lev FROM s3
), s5 AS (SELECT *, least(most::DOUBLE, coalesce(lev * weight, most::DOUBLE)) AS target FROM s4
), s6 AS (
  SELECT *, coalesce(floor(target + 0.5)::BIGINT // nullif(source_size, 0), 0) AS epochs,
         coalesce(floor(target + 0.5)::BIGINT % nullif(source_size, 0), 0) AS rest, (source_size + 127) // 128 AS blocks
  FROM s5
), s7 AS (
  SELECT *, blocks * 128 - source_size AS lack,
         list_reduce([blocks - 1, 11, 10, 9, 8, 7, 6, 5, 4, 3, 2, 1, 0], lambda x, r:
           CASE WHEN substr(md5(rank || '/' || epochs || '/' || r || '/' || greatest(x,
             ((('0x' || substr(md5(rank || '/' || epochs || '/' || r), 1, 12))::BIGINT - x) % blocks + blocks) % blocks)), 1, 1) < '8'
           THEN ((('0x' || substr(md5(rank || '/' || epochs || '/' || r), 1, 12))::BIGINT - x) % blocks + blocks) % blocks ELSE x END) AS short
  FROM s6 WHERE source_size > 0
), s8 AS (
  SELECT *, CASE WHEN short < (rest + 127) // 128 THEN (rest + lack + 127) // 128 ELSE (rest + 127) // 128 END AS last_slots FROM s7
), w AS (
  SELECT rank, (epochs * blocks + last_slots)::BIGINT AS slots, sum(epochs * blocks + last_slots) OVER (ORDER BY rank)::BIGINT AS upto,
         sum(epochs * blocks + last_slots) OVER ()::BIGINT AS n FROM s8
), j AS (
  SELECT shard, n, unnest(range((n // 24 + CASE WHEN shard < n % 24 THEN 1 ELSE 0 END)::BIGINT)) AS i
  FROM (SELECT DISTINCT n FROM w), range(24) r(shard)
), dr AS (
  SELECT shard, ('0x' || substr(md5('draw/' || shard || '/' || i), 1, 12))::BIGINT % n AS drawn FROM j
), dc AS (
  SELECT w.rank, shard, count(*) AS c FROM dr JOIN w ON drawn >= w.upto - w.slots AND drawn < w.upto GROUP BY w.rank, shard
), dt AS (SELECT rank, sum(c) AS drawn FROM dc GROUP BY rank
), bounds AS (
  SELECT w.rank, r.shard, (sum(CASE WHEN drawn IS NULL THEN 1 ELSE coalesce(c, 0) END) OVER (PARTITION BY w.rank ORDER BY r.shard)::HUGEINT * slots)
         // coalesce(drawn, 24) AS upto
  FROM w CROSS JOIN range(24) r(shard) LEFT JOIN dt ON dt.rank = w.rank LEFT JOIN dc ON dc.rank = w.rank AND dc.shard = r.shard
), ub AS (SELECT rank, list(upto ORDER BY shard) AS upto FROM bounds GROUP BY rank
), k AS (
  SELECT rank, slot, epochs, rest, blocks, lack, short, slot // blocks AS epoch, slot % blocks AS turn
  FROM (SELECT *, unnest(range((epochs * blocks + last_slots)::BIGINT)) AS slot FROM s8)
), k2 AS (
  SELECT *, list_reduce([turn, 0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11], lambda x, r:
           CASE WHEN substr(md5(rank || '/' || epoch || '/' || r || '/' || greatest(x,
             ((('0x' || substr(md5(rank || '/' || epoch || '/' || r), 1, 12))::BIGINT - x) % blocks + blocks) % blocks)), 1, 1) < '8'
           THEN ((('0x' || substr(md5(rank || '/' || epoch || '/' || r), 1, 12))::BIGINT - x) % blocks + blocks) % blocks ELSE x END) AS idx
  FROM k
), k3 AS (
  SELECT rank, slot, idx, 128 - CASE WHEN idx = blocks - 1 THEN lack ELSE 0 END AS whole, epoch, epochs,
         rest - (turn * 128 - CASE WHEN turn > short THEN lack ELSE 0 END) AS remains FROM k2
), slots AS (
  SELECT rank, idx, len(list_filter(upto, lambda x: x <= slot)) AS shard,
         CASE WHEN epoch < epochs THEN whole ELSE least(whole, remains) END AS words
  FROM k3 JOIN ub USING (rank)
), p AS MATERIALIZED (
  SELECT doc_id, rank, size, sum(size) OVER (PARTITION BY rank ORDER BY bucket, doc_id NULLS LAST, size ROWS UNBOUNDED PRECEDING) - size AS start,
         row_number() OVER () AS line
  FROM d JOIN s1 ON d.source IS NOT DISTINCT FROM s1.source
), b AS (
  SELECT line, rank, start, size, unnest(range((start // 128)::BIGINT, ((start + size - 1) // 128 + 1)::BIGINT)) AS idx FROM p WHERE size > 0
), t0 AS (
  SELECT line, shard, sum(least(least(start + size, (idx + 1) * 128) - idx * 128, words) - (greatest(start, idx * 128) - idx * 128)) AS taken
  FROM b JOIN slots USING (rank, idx) WHERE words > greatest(start, idx * 128) - idx * 128 GROUP BY line, shard
), t AS (
  SELECT line, sum(taken) AS taken, string_agg(shard || ':' || taken, ',' ORDER BY shard) AS taken_by_shard FROM t0 GROUP BY line
)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken, coalesce(taken_by_shard, '') AS taken_by_shard
FROM p JOIN s5 USING (rank) LEFT JOIN t ON p.line = t.line
"""

ORACLE["op5_license_scan"] = r"""
WITH t(label, text, phrase) AS (
  VALUES ('agpl-3.0', 'gnu affero general public license version 3', 'gnu affero general public license'),
    ('apache-2.0', 'licensed under the apache license version 2 0', 'apache license version 2'),
    ('bsd', 'redistribution and use in source and binary forms with or without modification are permitted', 'source and binary forms'),
    ('cc-by-nc-4.0', 'licensed under cc by nc 4 0', 'cc by nc'),
    ('cc0-1.0', 'cc0 1 0 universal public domain dedication', 'cc0 1 0 universal'),
    ('gpl-3.0', 'this work is licensed under the gnu general public license version 3', 'gnu general public license version 3'),
    ('lgpl', 'gnu lesser general public license version', 'gnu lesser general public license'),
    ('mit', 'released under the mit license', 'mit license'),
    ('mit-grant', 'permission is hereby granted free of charge to any person obtaining a copy of this software',
     'permission is hereby granted free of charge'),
    ('mpl-2.0', 'mozilla public license version 2 0', 'mozilla public license'),
    ('unlicense', 'this is free and unencumbered software released into the public domain', 'free and unencumbered software')
), tw AS (
  SELECT label, unnest(string_split(text, ' ')) AS word, generate_subscripts(string_split(text, ' '), 1) AS j,
         len(string_split(split_part(text, phrase, 1), ' ')) AS key_at, string_split(phrase, ' ') AS key FROM t
), d AS (
  SELECT row_number() OVER () AS line, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), words AS MATERIALIZED (
  SELECT line, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d
), df AS (
  SELECT word, count(DISTINCT line) AS n FROM words WHERE word IN (SELECT word FROM tw) GROUP BY word
), total AS (SELECT count(*) AS n FROM documents
), x AS (
  SELECT tw.*, ln(1 + (total.n - coalesce(df.n, 0) + 0.5) / (coalesce(df.n, 0) + 0.5)) AS weight
  FROM tw LEFT JOIN df USING (word), total
), y AS (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY weight DESC, j) <= 3 AS rare, sum(weight) OVER (PARTITION BY label) AS mass FROM x
), sp AS (  -- starts where the first word of a key phrase stands in its place
  SELECT line, label, pos - key_at AS start, any_value(mass) AS mass FROM words JOIN y ON words.word = key[1] AND j = key_at
  GROUP BY ALL
), m AS (
  SELECT a.line, a.label, a.start, sum(y.weight) / any_value(a.mass) AS share, count(*) FILTER (rare) AS votes,
         count(*) FILTER (y.j >= y.key_at AND y.j < y.key_at + len(y.key)) = any_value(len(y.key)) AS held
  FROM sp a JOIN y ON y.label = a.label JOIN words w ON w.line = a.line AND w.pos = a.start + y.j AND w.word = y.word
  GROUP BY a.line, a.label, a.start
), f AS (
  SELECT line, list(DISTINCT label) AS more, max(share) AS share FROM m WHERE held AND votes >= 2 AND share >= 0.6 GROUP BY line
), pairs AS (
  SELECT line, pos, word, lead(word) OVER o AS word2, lead(word, 2) OVER o AS word3 FROM words WINDOW o AS (PARTITION BY line ORDER BY pos)
), b AS (
  SELECT line, pos - 1 AS start, CASE WHEN word = 'cc' THEN 'cc-by' WHEN word = 'all' THEN 'reserved' ELSE 'gpl' END AS label FROM pairs
  WHERE word = 'cc' AND word2 = 'by' OR word = 'general' AND word2 = 'public' AND word3 = 'license'
     OR word = 'all' AND word2 = 'rights' AND word3 = 'reserved'
), c AS (SELECT line, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word, list(DISTINCT label) AS base FROM b GROUP BY line)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(base), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(more, [])))), ','), '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE round(least(coalesce(share, 0.0), 1.0), 6) END::DOUBLE AS score
FROM d LEFT JOIN c USING (line) LEFT JOIN f USING (line)
"""

ORACLE["op10_substring_dedup"] = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS line, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), s AS MATERIALIZED (
  SELECT line, doc_id, unnest(range(len(w) - 19)) AS start, w FROM d WHERE len(w) >= 20
), h AS MATERIALIZED (
  SELECT line, doc_id, start, md5(array_to_string(w[start + 1:start + 20], ' ')) AS words FROM s
), r AS (
  SELECT line, start, rank() OVER (PARTITION BY words ORDER BY doc_id NULLS LAST, start) > 1 AS again FROM h
), g AS (
  SELECT DISTINCT line, unnest(range(start, start + 20)) AS place FROM r WHERE again
), l AS (
  SELECT line, list(place) AS gone FROM g GROUP BY line
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(coalesce(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(gone, i - 1)) END, ' '), '')) AS kept_sha256
FROM d LEFT JOIN l USING (line)
"""

ORACLE["op11_quality_rules"] = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS line, doc_id, coalesce(text, '') AS t,
         coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), c AS (
  SELECT line, doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_capitals, length(regexp_replace(t, '[^!]', '', 'g')) AS n_exclamations,
         length(regexp_replace(t, '[\x00-\x40\x5B-\x60\x7B-\x7F]', '', 'g')) AS n_letters
  FROM d
), l AS (
  SELECT line, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup_lines
  FROM (SELECT line, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY line
), g AS (
  SELECT line, start, md5(array_to_string(w[start + 1:start + 5], ' ')) AS words
  FROM (SELECT line, w, unnest(range(len(w) - 4)) AS start FROM d WHERE len(w) >= 5)
), r AS (
  SELECT line, count(DISTINCT place) AS n_repeat_words FROM (
    SELECT line, unnest(range(start, start + 5)) AS place
    FROM (SELECT *, count(*) OVER (PARTITION BY line, words) AS n FROM g) WHERE n > 1
  ) GROUP BY line
), o AS (
  SELECT line, max(n) AS n_top_word
  FROM (SELECT line, x, count(*) AS n FROM (SELECT line, unnest(w) AS x FROM d) GROUP BY line, x) GROUP BY line
), m AS (
  SELECT doc_id, n_words, word_chars, n_symbols, n_capitals, n_exclamations, n_letters, coalesce(n_lines, 0) AS n_lines,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         coalesce(n_top_word, 0) AS n_top_word
  FROM c LEFT JOIN l USING (line) LEFT JOIN r USING (line) LEFT JOIN o USING (line)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_lines
            OR word_chars < 3 * n_words OR word_chars > 10 * n_words OR 10 * n_capitals > 4 * word_chars
            OR 2 * n_exclamations > n_words OR 10 * n_letters < 4 * word_chars OR 10 * n_top_word > 4 * n_words) AS kept
FROM m
"""

# The unsigned checksum of a string x, as an expression over the table of the checksum.
_CRC_TABLE = r"""SELECT list(list_reduce([n::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY n) AS tab FROM range(256) g(n)"""


def _crc32(text: str) -> str:
    return f"""xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
      list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT)),
      lambda a, x: xor(tab[(xor(a, x) & 255) + 1], a >> 8)))"""


ORACLE["op12_conversation_trie"] = rf"""
WITH t AS ({_CRC_TABLE}), p AS MATERIALIZED (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, said) AS pos, said, words FROM (
    SELECT conv_id, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS said,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS words
    FROM conversations WHERE conv_id IS NOT NULL)
), c AS MATERIALIZED (
  SELECT conv_id, conv_id - conv_id % 20 AS first, ({_crc32("conv_id::VARCHAR")} % 4)::BIGINT AS h
  FROM (SELECT DISTINCT conv_id FROM p), t
), opened AS MATERIALIZED (
  SELECT c.conv_id, p.pos AS depth, said, words FROM c JOIN p ON p.conv_id = c.first AND p.pos <= c.h
), k AS (SELECT conv_id, count(*) AS k FROM opened GROUP BY conv_id
), r AS (
  SELECT conv_id, 0 AS depth, '' AS said, 0 AS words FROM c UNION ALL SELECT * FROM opened UNION ALL
  SELECT conv_id, p.pos - h + coalesce(k, 0), said, words FROM p JOIN c USING (conv_id) LEFT JOIN k USING (conv_id) WHERE p.pos > h
), s AS MATERIALIZED (
  SELECT conv_id, depth, words, string_agg(said, '') OVER w AS node, lag(depth) OVER w AS up, lead(depth) OVER w IS NULL AS ends
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), n AS MATERIALIZED (
  SELECT node, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs, max(words) AS words, bool_and(ends) AS leaf,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM s GROUP BY node
), o AS (
  SELECT s.node, sum(n.leaf::INT) AS n_leaves, sum((n.n_convs - 1) * n.words) AS saved, sum((n.depth = s.depth + 1)::INT) AS n_children
  FROM n JOIN s ON s.conv_id = n.conv_id AND s.depth <= n.depth GROUP BY s.node
)
SELECT n.conv_id, n.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs, n_children::BIGINT AS n_children,
       n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, n.ends_sha256
FROM n JOIN o ON n.node = o.node
LEFT JOIN s ON s.conv_id = n.conv_id AND s.depth = n.depth - 1 LEFT JOIN n u ON u.node = s.node
"""

ORACLE["op13_spelling_variants"] = rf"""
WITH RECURSIVE t AS ({_CRC_TABLE}), r0 AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents
), r AS (
  SELECT run, {_crc32("id || ':' || run")} AS h, length(run) AS len FROM r0, t WHERE length(run) >= 7
), v AS MATERIALIZED (
  SELECT word, count(*) AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % len)::BIGINT) || substr(run, (h % len)::BIGINT + 2) ELSE run END AS word FROM r
  ) WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2
), x AS MATERIALIZED (
  SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS short FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)
), near AS MATERIALIZED (
  SELECT DISTINCT word, near FROM (
    SELECT a.word, b.word AS near FROM x a JOIN x b ON a.short = b.short AND a.i = b.i AND a.word <> b.word
    UNION ALL SELECT x.word, v.word FROM x JOIN v ON x.short = v.word
    UNION ALL SELECT v.word, x.word FROM x JOIN v ON x.short = v.word)
), b AS (
  SELECT near.word, count(*) AS n_near, arg_min(near, (-v.n, near)) AS best, max(v.n) AS best_n
  FROM near JOIN v ON v.word = near.near GROUP BY near.word
), f AS MATERIALIZED (
  SELECT v.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * n THEN best END AS form,
         CASE WHEN best_n >= 10 * n THEN best_n END AS form_n
  FROM v LEFT JOIN b ON v.word = b.word
), c AS (
  SELECT word, word AS at, form AS further FROM f
  UNION ALL SELECT c.word, f.word, f.form FROM c JOIN f ON f.word = c.further
)
SELECT f.word, form, c.at AS root, n, n_near, form_n FROM f JOIN c ON c.word = f.word AND c.further IS NULL
"""
