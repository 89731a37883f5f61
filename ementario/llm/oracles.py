"""DuckDB SQL of the operators that SQL can express; whole tables, no shared code with the operators."""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

# The strength of a level's prior, by moments, from groups with n outcomes, good of them good.
_STRENGTH = """(SELECT CASE WHEN k IS NULL OR n IS NULL THEN 1.0 WHEN w <= 0 OR chance <= 0 OR rho <= 0 THEN 1000.0 ELSE least(1000.0, greatest(1.0, (1 - rho) / rho)) END
  FROM (SELECT *, (xx - n * m * m - w * (k - 1)) / (w * chance) AS rho
    FROM (SELECT *, x / n AS m, (x / n) * (1 - x / n) AS w, n - nn / n - (k - 1) AS chance
      FROM (SELECT count(*) AS k, sum(n)::DOUBLE AS n, sum(good)::DOUBLE AS x, sum(n::DOUBLE * n) AS nn, sum(good::DOUBLE * good / n) AS xx
            FROM {} WHERE n > 0))))"""

URL_FILTERS = f"""
WITH parts AS (
  SELECT page_id, {_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages)
),
outcome AS (SELECT doc_id, 1 - max(CASE WHEN coalesce(quality, 1) = 0 OR coalesce(toxic, 0) = 1 THEN 1 ELSE 0 END) AS good
            FROM labels GROUP BY doc_id),
h0 AS (SELECT host, count(good) AS n, coalesce(sum(good), 0) AS good, regexp_replace(host, ':[0-9]*$', '') AS bare
       FROM parts LEFT JOIN outcome ON page_id = doc_id GROUP BY host),
h1 AS (SELECT *, string_split(bare, '.') AS l, regexp_full_match(bare, '[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+') OR starts_with(bare, '[') AS address FROM h0),
h2 AS (SELECT *, array_to_string(l[-2:], '.') AS two, array_to_string(l[-3:], '.') AS three FROM h1),
shared AS (SELECT two FROM h2 WHERE NOT address AND three <> two GROUP BY two HAVING count(DISTINCT three) >= 100),
h3 AS (SELECT *, two IN (SELECT two FROM shared) OR regexp_full_match(two, '(ac|co|com|edu|go|gob|gov|mil|ne|net|or|org)[.][a-z][a-z]') AS deep FROM h2),
h AS (SELECT host, n, good, CASE WHEN address THEN bare WHEN deep THEN three ELSE two END AS domain,
        CASE WHEN address THEN bare WHEN deep THEN two ELSE l[-1] END AS suffix FROM h3),
kh AS (SELECT {_STRENGTH.format("h")} AS kh),
he AS (SELECT *, e * CASE WHEN n > 0 THEN good / n ELSE 0.0 END AS eg FROM (SELECT h.*, n * (kh + 1) / (n + kh) AS e FROM h, kh)),
d AS (SELECT domain, suffix, sum(e) AS n, sum(eg) AS good FROM he GROUP BY domain, suffix),
kd AS (SELECT {_STRENGTH.format("d")} AS kd),
de AS (SELECT *, e * CASE WHEN n > 0 THEN good / n ELSE 0.0 END AS eg FROM (SELECT d.*, n * (kd + 1) / (n + kd) AS e FROM d, kd)),
s AS (SELECT suffix, sum(e) AS n, sum(eg) AS good FROM de GROUP BY suffix),
ks AS (SELECT {_STRENGTH.format("s")} AS ks),
se AS (SELECT *, e * CASE WHEN n > 0 THEN good / n ELSE 0.0 END AS eg FROM (SELECT s.*, n * (ks + 1) / (n + ks) AS e FROM s, ks)),
z AS (SELECT sum(e) AS n, sum(eg) AS good FROM se),
dp AS (SELECT de.domain, de.suffix, de.n, de.good,
         (se.good - de.eg + ks * ((z.good - se.eg + 1.0 * 0.5) / (z.n - se.e + 1.0))) / (se.n - de.e + ks) AS p FROM de JOIN se USING (suffix), z, ks),
ab AS (SELECT host, good + kh * pr AS a, n - good + kh * (1 - pr) AS b, pow(kh / (n + kh), 2) * pr * (1 - pr) / (known + 1) AS unsure
       FROM (SELECT he.host, he.n, he.good, kh, dp.n - he.e + kd AS known, (dp.good - he.eg + kd * p) / (dp.n - he.e + kd) AS pr FROM he JOIN dp USING (domain, suffix), kh, kd)),
rep AS (SELECT host, least(1.0, a / (a + b) + 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)) + unsure)) AS upper FROM ab),
ruled AS (
  SELECT p.*, upper, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM parts p JOIN rep USING (host)
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN upper < 0.5 THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

LINE_DEDUP = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
),
k AS (SELECT *, {_LOWER.format(f"trim(line, {_BLANKS})")} AS key FROM l),
shared AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, shared.key IS NOT NULL AND doc_id <> last AS dropped FROM k LEFT JOIN shared USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
),
p AS (SELECT *, 16 + strlen(role) + strlen(text) + len(regexp_extract_all(role || text, '[\\<>]')) AS tokens FROM t),
q AS (SELECT *, row_number() OVER w - 1 AS seq, sum(tokens) OVER w - tokens AS start FROM p
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING)),
s AS (SELECT conv_id, min(seq) AS sys, arg_min(tokens, seq) AS sys_tokens, arg_min(text, seq) AS sys_text FROM q WHERE role = 'system' GROUP BY conv_id),
r AS (SELECT q.*, sys, sys_text, greatest(64, floor((2048 - 256 - coalesce(sys_tokens, 0)) / 2)) AS width FROM q LEFT JOIN s USING (conv_id)),
u AS (SELECT *, floor(start / width) AS win, 16 + length(text) + len(regexp_extract_all(text, '[\\<>]')) + length(role) AS marked FROM r),
spans AS (SELECT DISTINCT conv_id, win FROM u),
chars AS (
  SELECT conv_id, sum(marked) AS n FROM (
    SELECT conv_id, marked FROM u
    UNION ALL SELECT u.conv_id, marked FROM u JOIN spans ON spans.conv_id = u.conv_id AND spans.win = u.win + 1
              WHERE seq IS DISTINCT FROM sys AND start >= (u.win + 1) * width - 256
    UNION ALL SELECT spans.conv_id, 22 + length(sys_text) + len(regexp_extract_all(sys_text, '[\\<>]')) FROM spans JOIN s USING (conv_id)
              WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.conv_id = spans.conv_id AND u.win = spans.win AND u.seq = s.sys)
  ) GROUP BY conv_id
)
SELECT u.conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY seq)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY seq) FILTER (role = 'assistant'), '')) AS loss_sha256, max(chars.n)::BIGINT AS formatted_chars
FROM u JOIN chars USING (conv_id) GROUP BY u.conv_id
"""

_MEASURES = ("symbol_ratio", "dup_line_ratio", "repeat_ratio", "word_length")

QUALITY = """
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text,
             list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, i, w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] AS v FROM d, unnest(range(1, len(w) - 1)) AS r(i)),
g2 AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, v) AS n FROM g) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words FROM g2, (VALUES (0), (1), (2)) AS o(j) GROUP BY doc_id),
b AS (SELECT doc_id, lang, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
        len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]'))) AS n_lines,
        len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))
        - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM d LEFT JOIN rep USING (doc_id)),
m AS (SELECT *, n_symbols / greatest(n_words, 1)::DOUBLE AS symbol_ratio, n_dup_lines / greatest(n_lines, 1)::DOUBLE AS dup_line_ratio,
        n_repeat_words / greatest(n_words, 1)::DOUBLE AS repeat_ratio, word_chars / greatest(n_words, 1)::DOUBLE AS word_length,
        n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b),
v AS (""" + " UNION ALL ".join(
    f"SELECT lang, source, '{n}' AS measure, {n} AS x FROM m WHERE NOT base_failed" for n in _MEASURES
) + """),
k AS (SELECT *, CASE WHEN x <= 0.001 THEN -1000000 ELSE ceil(ln(x) / ln(1.02 / 0.98))::INT END AS bin FROM v),
q AS (
  SELECT lang, source, GROUPING(lang) AS gl, GROUPING(source) AS gs, measure, count(*) AS n,
    quantile_disc(bin, 0.5) AS b5, quantile_disc(bin, 0.9) AS b9
  FROM k GROUP BY GROUPING SETS ((lang, source, measure), (lang, measure), (measure))
),
e AS (SELECT *, CASE WHEN b5 = -1000000 THEN 0.0 ELSE pow(1.02 / 0.98, b5) * (2 / (1 + 1.02 / 0.98)) END AS q5,
        CASE WHEN b9 = -1000000 THEN 0.0 ELSE pow(1.02 / 0.98, b9) * (2 / (1 + 1.02 / 0.98)) END AS q9 FROM q),
f AS (SELECT *, q9 + 3 * (q9 - q5) AS fence FROM e),
t AS (
  SELECT o.lang, o.source, o.measure, (o.n * o.fence + 200 * p.parent) / (o.n + 200) AS fence
  FROM f o JOIN (SELECT l.lang, l.measure, (l.n * l.fence + 200 * c.fence) / (l.n + 200) AS parent
                 FROM f l JOIN f c ON l.measure = c.measure AND c.gl = 1 AND c.gs = 1 WHERE l.gl = 0 AND l.gs = 1) p
    ON o.lang IS NOT DISTINCT FROM p.lang AND o.measure = p.measure
  WHERE o.gl = 0 AND o.gs = 0
),
p AS (SELECT lang, source""" + "".join(f", max(fence) FILTER (measure = '{n}') AS max_{n}" for n in _MEASURES) + """ FROM t GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed
    OR coalesce(n_symbols > n_words * max_symbol_ratio + 3 * sqrt(1 * (n_words * max_symbol_ratio)) + 3, FALSE)
    OR coalesce(n_dup_lines > n_lines * max_dup_line_ratio + 3 * sqrt(1 * (n_lines * max_dup_line_ratio)) + 3, FALSE)
    OR coalesce(n_repeat_words > n_words * max_repeat_ratio + 3 * sqrt(6 * (n_words * max_repeat_ratio)) + 18, FALSE)
    OR coalesce(word_length > max_word_length * 1.04, FALSE)) AS kept
FROM m LEFT JOIN p ON p.lang IS NOT DISTINCT FROM m.lang AND p.source IS NOT DISTINCT FROM m.source
"""

EMBEDDINGS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id
"""

# crc32 by its definition: eight shifts for each byte of the UTF-8 text, here of ASCII and Latin-1 letters.
_SHIFTS = "list_reduce(list_prepend(xor(c, b), range(8)), lambda s, k: CASE WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END)"
_BYTES = """flatten(list_transform(string_split(doc_id || ':' || run, ''),
  lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [192 + (unicode(x)::BIGINT >> 6), 128 + (unicode(x)::BIGINT & 63)] END))"""

VARIANTS = rf"""
WITH RECURSIVE r0 AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS doc_id,
    unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents
),
r1 AS (SELECT doc_id, run, count(*) AS n FROM r0 WHERE length(run) >= 7 GROUP BY ALL),
r2 AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295, {_BYTES}), lambda c, b: {_SHIFTS}), 4294967295) AS h FROM r1),
w AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM r2
  ) WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
),
d AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM w, unnest(range(1, length(word) + 1)) AS r(i)),
near AS (
  SELECT a.word, b.word AS near FROM d a JOIN d b ON a.i = b.i AND a.less = b.less AND a.word <> b.word AND length(a.word) = length(b.word)
  UNION SELECT d.word, w.word FROM d JOIN w ON d.less = w.word UNION SELECT w.word, d.word FROM d JOIN w ON d.less = w.word
),
s AS (SELECT near.word, near, b.n AS near_n, count(*) OVER (PARTITION BY near.word) AS n_near,
        row_number() OVER (PARTITION BY near.word ORDER BY b.n DESC, near) AS k FROM near JOIN w b ON b.word = near),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * w.n THEN near END AS form, CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n
      FROM w LEFT JOIN s ON s.word = w.word AND k = 1),
up AS (SELECT word, word AS root, 0 AS depth FROM f UNION ALL SELECT up.word, f.form, depth + 1 FROM up JOIN f ON f.word = up.root WHERE f.form IS NOT NULL)
SELECT f.word, form, arg_max(up.root, depth) AS root, n, n_near, form_n FROM f JOIN up USING (word) GROUP BY ALL
"""

_TEST_WORDS = f"list_filter(string_split_regex({_LOWER.format('text')}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"

LEAKS = f"""
WITH d AS (SELECT doc_id, coalesce({_TEST_WORDS}, []) AS w FROM documents),
i AS (SELECT item_id, {_TEST_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
iw AS (SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[k : k + least(len(w), 10) - 1], ' ') AS span
       FROM i, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS r(k) WHERE len(w) > 0),
dw AS (SELECT doc_id, k, s.size, array_to_string(w[k : k + s.size - 1], ' ') AS span
       FROM d, (SELECT DISTINCT size FROM iw) s, unnest(range(1, len(w) - s.size + 2)) AS r(k) WHERE len(w) >= s.size),
hit AS (SELECT doc_id, k, dw.size, item_id FROM dw JOIN iw ON dw.span = iw.span AND dw.size = iw.size),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(k, k + size)) AS r(p) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
          FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_FAILS = " + ".join(f"CASE WHEN {c} THEN {1 << k} ELSE 0 END" for k, c in enumerate((
    "len(w) < 100", "100 * len(list_distinct(w)) < 80 * len(w)", "100 * len(regexp_extract_all(text, '[A-Z]')) > 10 * length(text)",
    "regexp_matches(text, '[#$%&*|]')", "doc_id > min(doc_id) OVER (PARTITION BY text)",
)))

AUDIT = f"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
             list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, {_FAILS} AS mask, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM t LEFT JOIN l USING (doc_id)),
c AS (SELECT part, mask, good, toxic, count(*) AS n FROM m GROUP BY ALL),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(letter, bit)),
o AS (SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
      FROM f a JOIN f b ON b.letter <> a.letter JOIN f c ON c.letter NOT IN (a.letter, b.letter)
      JOIN f d ON d.letter NOT IN (a.letter, b.letter, c.letter) JOIN f e ON e.letter NOT IN (a.letter, b.letter, c.letter, d.letter)),
s AS (SELECT filter_order, k AS step, bits[k] AS bit, coalesce(list_sum(bits[1 : k - 1]), 0)::INT AS earlier FROM o, unnest(range(1, 6)) AS r(k)),
g AS (
  SELECT part, filter_order, step, bit, coalesce(sum(n) FILTER (mask & (earlier | bit) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (mask & bit > 0 AND mask & earlier = 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (mask & bit > 0 AND mask & earlier > 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(n) FILTER (mask & bit > 0 AND mask & earlier = 0 AND good = 1), 0)::BIGINT AS good_lost,
    coalesce(sum(n) FILTER (mask & bit > 0 AND mask & earlier = 0 AND toxic = 1), 0)::BIGINT AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM g
"""
