r"""SQL for DuckDB, written from the contracts and not from the operators' code."""

MIX_SOURCES = r"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         coalesce(doc_id::VARCHAR, '') || ':' || coalesce(md5(text), '') AS key
  FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, 2 * source_size AS cap,
         CASE (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3
           WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM totals),
left_over AS (
  SELECT *,
    (SELECT sum(source_size) FROM totals) * 3
      - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, source IS NULL, encode(source)
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 2 AS twice_left,
    sum(weight) OVER (ORDER BY cap::DOUBLE / weight, source IS NULL, encode(source)
                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM weighted),
shared AS (
  SELECT *, (twice_left * weight)::DOUBLE / (weights * 2)::DOUBLE AS fair FROM left_over),
targets AS (
  -- capped: whatever stands before the first source whose share is under its cap
  SELECT s.source, s.source_size,
    CASE WHEN f.place IS NULL OR s.cap::DOUBLE / s.weight < f.place THEN s.cap::DOUBLE
         WHEN s.cap::DOUBLE / s.weight = f.place AND s.cap <= s.fair THEN s.cap::DOUBLE
         ELSE (f.twice_left * s.weight)::DOUBLE / (f.weights * 2)::DOUBLE END AS target
  FROM shared s LEFT JOIN (
    SELECT cap::DOUBLE / weight AS place, twice_left, weights FROM shared WHERE cap > fair
    ORDER BY cap::DOUBLE / weight, source IS NULL, encode(source) LIMIT 1) f ON true),
rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM targets),
draws AS (
  SELECT doc_id, source, size, seed,
    ('0x' || substr(md5(key || substr('abcd', seed // 4 + 1, 1)),
                    8 * (seed % 4) + 1, 8))::UBIGINT::DOUBLE / 4294967296.0 AS u
  FROM sized, range(16) AS s(seed)),
tried AS (
  SELECT r.source, d.seed,
    abs(any_value(r.source_size) * floor(any_value(r.rate))
        + sum(CASE WHEN d.u < r.rate - floor(r.rate) THEN d.size ELSE 0 END)
        - any_value(r.target)) AS miss
  FROM draws d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source GROUP BY r.source, d.seed),
chosen AS (
  SELECT source, seed FROM tried
  QUALIFY row_number() OVER (PARTITION BY source ORDER BY miss, seed) = 1)
SELECT d.doc_id, d.size, r.source_size, r.target,
  (d.size * (floor(r.rate) + CASE WHEN d.u < r.rate - floor(r.rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM draws d
JOIN rates r ON d.source IS NOT DISTINCT FROM r.source
JOIN chosen c ON d.source IS NOT DISTINCT FROM c.source AND d.seed = c.seed
"""

URL_TEMPLATES = r"""
WITH cut AS (
  SELECT page_id,
    CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
placed AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM cut),
rules(verdict, h, p) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
spots AS (SELECT host, path, count(*) AS pages FROM placed GROUP BY host, path),
ruled AS (
  SELECT s.host, s.path, s.pages, r.h || r.p AS rule, r.verdict AS ruled
  FROM spots s LEFT JOIN rules r
    ON (s.host = r.h OR ends_with(s.host, '.' || r.h)) AND starts_with(s.path, r.p)
  QUALIFY row_number() OVER (PARTITION BY s.host, s.path ORDER BY length(r.h || r.p) DESC NULLS LAST) = 1),
shaped AS (
  SELECT *, list_transform(list_filter(string_split(path, '/'), lambda s: s <> ''),
                           lambda s: CASE WHEN regexp_matches(s, '[0-9]') THEN '*' ELSE s END) AS shape
  FROM ruled),
nodes AS (
  SELECT host, path, i, shape[i] AS segment, array_to_string(shape[1:i - 1], '/') AS above
  FROM (SELECT host, path, shape, unnest(range(1, len(shape) + 1)) AS i FROM shaped)),
slots AS (
  SELECT host, i, above FROM nodes GROUP BY ALL
  HAVING count(DISTINCT segment) >= 20 AND count(DISTINCT segment) >= count(*) * 0.5),
parts AS (
  SELECT n.host, n.path,
    list(CASE WHEN s.host IS NULL THEN n.segment ELSE '*' END ORDER BY n.i) AS parts
  FROM nodes n LEFT JOIN slots s ON n.host = s.host AND n.i = s.i AND n.above = s.above
  GROUP BY n.host, n.path),
templates AS (
  SELECT r.*, '/' || coalesce(array_to_string(p.parts, '/'), '') AS template, coalesce(p.parts[1], '') AS branch
  FROM ruled r LEFT JOIN parts p ON r.host = p.host AND r.path = p.path),
counted AS (
  SELECT host, branch, template,
    sum(CASE WHEN ruled IS NOT NULL THEN pages ELSE 0 END)::DOUBLE AS n,
    sum(CASE WHEN ruled = 'block' THEN pages ELSE 0 END)::DOUBLE AS b
  FROM templates GROUP BY ALL),
prior AS (SELECT coalesce(sum(b) / nullif(sum(n), 0), 0) AS prior FROM counted),
branches AS (SELECT host, branch, sum(n) AS n, sum(b) AS b FROM counted GROUP BY ALL),
hosts AS (SELECT host, sum(n) AS nh, sum(b) AS bh FROM branches GROUP BY ALL),
alike AS (
  SELECT x.*, nh, bh,
    coalesce(abs(b / nullif(n, 0) - (bh - b) / nullif(nh - n, 0))
      <= 1.96 * sqrt(bh / nullif(nh, 0) * (1 - bh / nullif(nh, 0)) * (1.0 / nullif(n, 0) + 1.0 / nullif(nh - n, 0))),
      false) AS alike
  FROM branches x JOIN hosts y USING (host)),
merged AS (
  SELECT host, branch, CASE WHEN alike THEN nh ELSE n END AS nb, CASE WHEN alike THEN bh ELSE b END AS bb FROM alike),
scored AS (
  SELECT c.host, c.branch, c.template,
    nb > 0 AND (c.b + 4.0 * ((bb + 4.0 * prior) / (nb + 4.0))) / (c.n + 4.0) >= 0.9 AS reject
  FROM counted c JOIN merged m USING (host, branch), prior)
SELECT p.page_id, p.host, p.path, t.rule,
  coalesce(t.ruled, CASE WHEN s.reject THEN 'block' ELSE 'allow' END) AS verdict
FROM placed p
JOIN templates t ON p.host = t.host AND p.path = t.path
JOIN scored s ON t.host = s.host AND t.branch = s.branch AND t.template = s.template
"""

REPEATED_WINDOWS = r"""
WITH texts AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
words AS (
  SELECT doc_id, i, w[i] AS word, CASE WHEN i + 12 <= len(w) THEN array_to_string(w[i:i + 12], ' ') END AS span
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM texts)),
firsts AS (SELECT span, min(doc_id) AS doc FROM words WHERE span IS NOT NULL GROUP BY span),
marked AS (
  SELECT w.doc_id, w.i, w.word,
    coalesce(bool_or(f.doc < w.doc_id) OVER (PARTITION BY w.doc_id ORDER BY w.i
             ROWS BETWEEN 12 PRECEDING AND CURRENT ROW), false) AS gone
  FROM words w LEFT JOIN firsts f ON w.span = f.span),
kept AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed,
    string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept
  FROM marked GROUP BY doc_id)
SELECT t.doc_id, len(t.w)::BIGINT AS n_words, coalesce(k.n_removed, 0)::BIGINT AS n_removed,
  sha256(coalesce(k.kept, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k ON t.doc_id = k.doc_id
"""

REPEATED_BYTES = r"""
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
bytes AS (
  SELECT doc_id, i, substr(h, 2 * i - 1, 2) AS byte,
    CASE WHEN 2 * (i + 49) <= length(h) THEN substr(h, 2 * i - 1, 100) END AS span
  FROM (SELECT doc_id, h, unnest(range(1, length(h) // 2 + 1)) AS i FROM texts)),
firsts AS (SELECT span, min(doc_id) AS doc FROM bytes WHERE span IS NOT NULL GROUP BY span),
marked AS (
  SELECT b.doc_id, b.i, b.byte,
    coalesce(bool_or(f.doc < b.doc_id) OVER (PARTITION BY b.doc_id ORDER BY b.i
             ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), false) AS gone
  FROM bytes b LEFT JOIN firsts f ON b.span = f.span),
edged AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens FROM marked),
kept AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans,
    string_agg(byte, '' ORDER BY i) FILTER (NOT gone) AS kept
  FROM edged GROUP BY doc_id)
SELECT t.doc_id, (length(t.h) // 2)::BIGINT AS n_bytes, coalesce(k.n_removed, 0)::BIGINT AS n_removed,
  coalesce(k.n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(k.kept, ''))) AS kept_sha256
FROM texts t LEFT JOIN kept k ON t.doc_id = k.doc_id
"""

JACCARD_JOIN = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i FROM texts)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * k >= 80 * (x.n + y.n - k)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, w.b FROM reach r JOIN ways w ON r.other = w.a)
SELECT r.doc_id, coalesce(any_value(s.n), 0)::BIGINT AS n_shingles, min(r.other) AS component_id
FROM reach r LEFT JOIN sizes s ON r.doc_id = s.doc_id GROUP BY r.doc_id
"""

COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
cut AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM cut GROUP BY lang),
placed AS (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM cut, range(1, 5) AS s(m)),
f AS (
  SELECT lang, m, w[i:i + m - 1] AS words, count(*) AS a
  FROM placed GROUP BY ALL HAVING count(*) >= 30),
cuts AS (SELECT *, unnest(range(1, m)) AS k FROM f WHERE m > 1),
best AS (
  SELECT c.lang, c.words, c.a, l.a AS l, r.a AS r, (2000000::HUGEINT * c.a // (l.a + r.a))::BIGINT AS score
  FROM cuts c
  JOIN f l ON l.lang = c.lang AND l.words = c.words[1:c.k]
  JOIN f r ON r.lang = c.lang AND r.words = c.words[c.k + 1:c.m]
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.words ORDER BY score, c.k) = 1),
inner_places AS (
  SELECT *, unnest(range(1, m - size + 2)) AS i
  FROM (SELECT *, unnest(range(2, m)) AS size FROM f WHERE m > 2)),
held AS (
  SELECT lang, words[i:i + size - 1] AS words, max(a) AS outer_a FROM inner_places GROUP BY ALL)
SELECT b.lang,
  row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, array_to_string(b.words, ' ')) AS rank,
  array_to_string(b.words, ' ') AS phrase, b.a, b.l, b.r, t.n, b.score
FROM best b JOIN totals t ON t.lang = b.lang
LEFT JOIN held h ON h.lang = b.lang AND h.words = b.words
WHERE h.outer_a IS NULL OR 100::HUGEINT * h.outer_a < 80::HUGEINT * b.a
QUALIFY rank <= 2000
"""

PREFIX_TRIE = r"""
WITH turns AS (
  SELECT conv_id AS c, coalesce(text, '') AS text,
    md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS code, turn
  FROM conversations WHERE conv_id IS NOT NULL),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, code) AS i FROM turns),
convs AS (
  -- crc32 of the decimal digits, bit by bit; only its last two bits are wanted
  SELECT c, c - c % 20 AS base,
    (4294967295 - list_reduce(
      list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(c::VARCHAR, ''),
        lambda s: [ascii(s)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
      lambda acc, v: xor(xor(acc, v) >> 1, (xor(acc, v) & 1) * 3988292384))) % 4 AS h
  FROM (SELECT DISTINCT c FROM turns)),
rebuilt AS (
  SELECT v.c, 0 AS part, p.i, p.code, p.text FROM convs v JOIN placed p ON p.c = v.base AND p.i <= v.h
  UNION ALL
  SELECT v.c, 1, p.i, p.code, p.text FROM convs v JOIN placed p ON p.c = v.c AND p.i > v.h),
whole AS (
  SELECT v.c, coalesce(list(r.code ORDER BY part, i) FILTER (r.code IS NOT NULL), []) AS codes,
    list(len(regexp_extract_all(r.text, '[^\x20\x09-\x0D]+')) ORDER BY part, i) AS words
  FROM convs v LEFT JOIN rebuilt r ON r.c = v.c GROUP BY v.c),
members AS (
  SELECT c, d, codes[1:d] AS path, d = len(codes) AS last, CASE WHEN d > 0 THEN words[d] ELSE 0 END AS words
  FROM (SELECT *, unnest(range(0, len(codes) + 1)) AS d FROM whole)),
nodes AS (
  SELECT path, d, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS saved,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (last), '')) AS ends_sha256
  FROM members GROUP BY path, d),
children AS (SELECT path[1:d - 1] AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
below AS (
  SELECT path[1:k] AS path, sum(saved)::BIGINT AS saved, (count(*) FILTER (leaf))::BIGINT AS leaves
  FROM (SELECT n.path, n.saved, c.n IS NULL AS leaf, unnest(range(0, n.d + 1)) AS k
        FROM nodes n LEFT JOIN children c ON c.path = n.path)
  GROUP BY 1)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
  b.leaves AS n_leaves, b.saved AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b ON b.path = n.path
LEFT JOIN children c ON c.path = n.path
LEFT JOIN nodes p ON n.d > 0 AND p.path = n.path[1:n.d - 1]
"""
