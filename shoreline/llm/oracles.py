"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from shoreline.llm import licences, quality

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _fold(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{LOWER}')"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _cut(text: str, word: str = WORD) -> str:
    return f"regexp_extract_all(coalesce({text}, ''), '{word}')"


NGRAM_JOIN = f"""
WITH cut AS (SELECT doc_id, {_cut(_fold('text'))} AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, w[i:i + least(3, len(w)) - 1] AS g
  FROM cut, unnest(range(1, greatest(len(w) - 1, 2))) AS t(i) WHERE len(w) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY ALL),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM grams x JOIN grams y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * o >= 90 * (p.n + q.n - o)
),
reach AS (
  WITH RECURSIVE r AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM r JOIN links l ON r.b = l.a) SELECT * FROM r
),
least_ AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT c.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(c.doc_id, coalesce(l.b, c.doc_id)) AS component_id
FROM cut c LEFT JOIN sizes s ON s.doc_id = c.doc_id LEFT JOIN least_ l ON l.a = c.doc_id
"""

NGRAM_LINKS = NGRAM_JOIN[:NGRAM_JOIN.index("reach AS")] + """counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT c.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, coalesce(l.n, 0)::BIGINT AS n_links
FROM cut c LEFT JOIN sizes s ON s.doc_id = c.doc_id LEFT JOIN counts l ON l.a = c.doc_id
"""

_SPELLED = "regexp_replace({}, " + _text(licences.COPYRIGHT_LINES) + r", '\1', 'g')"


def _canonical(text: str) -> str:
    out = _SPELLED.format(_fold(f"coalesce({text}, '')"))
    for spelling, one in licences.SPELLINGS:
        out = f"replace({out}, '{spelling}', '{one}')"
    return f"trim(regexp_replace({out}, '{licences.NO_WORD}', ' ', 'g'))"


LICENSES = f"""
WITH given(license, text) AS (VALUES {', '.join(f'({_text(a)}, {_text(b)})' for a, b in licences.KNOWN)}),
known AS (SELECT md5({_canonical('text')}) AS digest, min(license) AS license FROM given GROUP BY ALL),
whole AS (
  SELECT doc_id, license FROM documents LEFT JOIN known ON md5({_canonical('text')}) = digest
),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
found AS (
  SELECT doc_id, count(*) AS n, array_to_string(list_sort(list(DISTINCT license)), ',') AS names
  FROM lines JOIN known ON md5({_canonical('line')}) = digest GROUP BY doc_id
)
SELECT w.doc_id, w.license, coalesce(n, 0)::BIGINT AS n_lines, coalesce(names, '') AS line_licenses
FROM whole w LEFT JOIN found f ON f.doc_id = w.doc_id
"""

SUBSTRING_DEDUP = f"""
WITH cut AS (SELECT doc_id, {_cut('text')} AS w FROM documents),
windows AS (SELECT doc_id, i, w[i:i + 19] AS g FROM cut, unnest(range(1, len(w) - 18)) AS t(i)),
firsts AS (SELECT g, min({{'d': doc_id, 'i': i}}) AS f FROM windows GROUP BY g HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS pos FROM windows JOIN firsts USING (g) WHERE {{'d': doc_id, 'i': i}} > f
),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM cut),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
),
counts AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT c.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM cut c LEFT JOIN counts g ON g.doc_id = c.doc_id LEFT JOIN kept k ON k.doc_id = c.doc_id
"""


def _rule(rule: quality.Rule) -> str:
    top, bottom = quality.RATIOS[rule.measure]
    value = f"(CASE WHEN {bottom} > 0 THEN {top}::DOUBLE / {bottom} ELSE 0 END)"
    tests = [f"{value} >= {rule.least}"] * (rule.least is not None) + [f"{value} <= {rule.most}"] * (rule.most is not None)
    return " AND ".join(tests)


QUALITY = f"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, {_cut('text')} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines
  FROM documents
),
windows AS (SELECT doc_id, i, w[i:i + 7] AS g FROM cut, unnest(range(1, len(w) - 6)) AS t(i)),
twice AS (SELECT doc_id, g FROM windows GROUP BY ALL HAVING count(*) > 1),
repeated AS (
  SELECT doc_id, count(*) AS n FROM (
    SELECT DISTINCT doc_id, unnest(range(i, i + 8)) AS pos FROM windows SEMI JOIN twice USING (doc_id, g)
  ) GROUP BY doc_id
),
counts AS (
  SELECT c.doc_id, len(w)::BIGINT AS n_words,
    length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^{quality.SYMBOLS}]', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words,
    len(lines)::BIGINT AS n_lines,
    len(list_filter(w, lambda x: lower(x) IN ({', '.join(map(_text, quality.STOP_WORDS))})))::BIGINT AS n_stop_words
  FROM cut c LEFT JOIN repeated r ON r.doc_id = c.doc_id
),
based AS (
  SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.REPEAT_PERCENT} * n_words AS base_failed FROM counts
)
SELECT *, NOT base_failed AND {' AND '.join(map(_rule, quality.RULES))} AS kept FROM based
"""

BENCH_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

DECONTAMINATION = f"""
WITH cut AS (SELECT doc_id, {_cut(_fold('text'), BENCH_WORD)} AS w FROM documents),
items AS (SELECT item_id, {_cut(_fold('text'), BENCH_WORD)} AS w FROM benchmark),
sized AS (SELECT item_id, w, least(len(w), 13) AS n FROM items WHERE len(w) > 0),
known AS (SELECT DISTINCT item_id, n, w[i:i + n - 1] AS g FROM sized, unnest(range(1, len(w) - n + 2)) AS t(i)),
lengths AS (SELECT DISTINCT n FROM known),
windows AS (SELECT doc_id, n, i, w[i:i + n - 1] AS g FROM cut, lengths, unnest(range(1, len(w) - n + 2)) AS t(i)),
hits AS (SELECT DISTINCT doc_id, i, n, item_id FROM windows JOIN known USING (n, g)),
words AS (SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM hits) GROUP BY doc_id),
named AS (
  SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS items FROM hits GROUP BY doc_id
)
SELECT c.doc_id, len(w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
  coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(w) AS contaminated
FROM cut c LEFT JOIN words h ON h.doc_id = c.doc_id LEFT JOIN named m ON m.doc_id = c.doc_id
"""

MIXING = f"""
WITH sized AS (SELECT doc_id, source, len({_cut('text')})::BIGINT AS size FROM documents),
sources AS (
  SELECT source, sum(size)::HUGEINT AS s, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM sized GROUP BY source
),
ordered AS (SELECT *, row_number() OVER (ORDER BY 3.0 * s / w, source) AS k FROM sources),
summed AS (
  SELECT *, sum(s) OVER () - coalesce(sum(3 * s) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS r,
    sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS u FROM ordered
),
cut AS (SELECT arg_min(r, k) AS r, arg_min(u, k) AS u, min(k) AS k FROM summed WHERE 3 * s * u >= w * r),
targets AS (
  SELECT source, s::BIGINT AS source_size,
    CASE WHEN o.k < c.k THEN (3 * s)::DOUBLE ELSE (w * c.r)::DOUBLE / c.u::DOUBLE END AS target FROM ordered o, cut c
),
rated AS (
  SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
    ('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS draw
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, ((floor(rate) + (draw < rate - floor(rate))::INT) * size)::BIGINT AS taken, source FROM rated
"""

FILL_IN_MIDDLE = r"""
WITH given AS (
    SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS digest
    FROM documents),
drawn AS (
    SELECT *, [CAST('0x' || substr(digest, 1 + 8 * i, 8) AS BIGINT) FOR i IN [0, 1, 2, 3]] AS h FROM given),
cut AS (
    SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
           CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 90
                THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn),
parts AS (
    SELECT *, substr(text, 1, a) AS prefix, substr(text, a + 1, b - a) AS middle, substr(text, b + 1) AS suffix FROM cut)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts"""

# the checksum goes byte by byte over each distinct word, with the table of the reflected polynomial
IMPORTANCE = r"""
WITH RECURSIVE rounds AS (
    SELECT i, 0 AS r, i AS c FROM range(256) AS t(i)
    UNION ALL
    SELECT i, r + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM rounds WHERE r < 8),
steps AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM rounds WHERE r = 8),
doc_words AS MATERIALIZED (
    SELECT rowid AS row, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
    FROM (SELECT row_number() OVER () AS rowid, doc_id, text FROM documents)),
target_words AS MATERIALIZED (
    SELECT unnest(list_filter(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')) AS word
    FROM benchmark),
doc_terms AS MATERIALIZED (
    SELECT row, word, count(*) AS n FROM (SELECT row, unnest(w) AS word FROM doc_words) GROUP BY ALL),
vocabulary AS MATERIALIZED (
    SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM doc_terms UNION SELECT word FROM target_words)),
hashed AS (
    SELECT word, h, 0 AS pos, 4294967295 AS c FROM vocabulary
    UNION ALL
    SELECT word, h, pos + 1, xor(c >> 8, (SELECT t FROM steps)[
        CAST(xor(c & 255, CAST('0x' || substr(h, 2 * pos + 1, 2) AS BIGINT)) AS INT) + 1])
    FROM hashed WHERE 2 * pos < length(h)),
buckets AS MATERIALIZED (
    SELECT word, xor(c, 4294967295) % 10000 AS bucket FROM hashed WHERE 2 * pos = length(h)),
s AS (SELECT bucket, sum(n) AS s FROM doc_terms JOIN buckets USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM target_words JOIN buckets USING (word) GROUP BY bucket),
sums AS (SELECT coalesce((SELECT sum(s) FROM s), 0) AS all_s, coalesce((SELECT sum(t) FROM t), 0) AS all_t),
gain AS MATERIALIZED (
    SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (all_s + 10000)::DOUBLE
           / ((s + 1)::DOUBLE * (all_t + 10000)::DOUBLE))) AS BIGINT) AS gain
    FROM s LEFT JOIN t USING (bucket), sums),
weights AS (
    SELECT row, sum(n * gain) AS weight FROM doc_terms JOIN buckets USING (word) JOIN gain USING (bucket) GROUP BY row),
scores AS (
    SELECT d.doc_id, len(w) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
           CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) AS BIGINT) + 0.5)::DOUBLE
               / 4294967296::DOUBLE))) AS BIGINT) AS score
    FROM doc_words d LEFT JOIN weights USING (row)),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
           10 * count(*) FILTER (n_features >= 20) OVER () // 100 AS drawn
    FROM scores)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= drawn THEN place END AS rank FROM placed"""
