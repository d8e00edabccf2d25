"""DuckDB SQL that restates the queries whose results SQL can express."""

ORACLE = {}

# op2: measures of whole texts, host rates shrunk by beta priors fitted by moments
_W = r"[^\x20\x09-\x0D]+"
ORACLE["op2_host_rules"] = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, regexp_extract_all(text, '{_W}') AS words FROM d),
pos AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
win AS (SELECT r, i, word AS a, lead(word) OVER o AS b, lead(word, 2) OVER o AS c
        FROM pos WINDOW o AS (PARTITION BY r ORDER BY i)),
rep AS (SELECT r, i FROM win WHERE c IS NOT NULL
        QUALIFY count(*) OVER (PARTITION BY r, a, b, c) > 1),
cov AS (SELECT r, count(DISTINCT p) AS n_repeat_words
        FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY r),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
        FROM lines WHERE regexp_matches(line, '{_W}') GROUP BY r),
base AS (
  SELECT d.r, doc_id, source, len(words)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM d JOIN w USING (r) LEFT JOIN dup USING (r) LEFT JOIN cov USING (r)),
rules AS (
  SELECT *, n_words < 50 AS f1, 100 * n_repeat_words > 50 * n_words AS f2,
         n_symbols > 0.5 * n_words AS f3, 100 * n_dup_lines > 50 * n_lines AS f4 FROM base),
hosts AS (
  SELECT source, count(*) AS n, unnest([1, 2, 3, 4]) AS rule,
         unnest([count(*) FILTER (f1), count(*) FILTER (f2), count(*) FILTER (f3),
                 count(*) FILTER (f4)]) AS k
  FROM rules GROUP BY source),
moments AS (
  SELECT rule, sum(k) / sum(n) AS m, var_pop(k / n) AS v, avg(1 / n) AS inverse
  FROM hosts GROUP BY rule),
prior AS (
  SELECT rule, m, CASE WHEN v - m * (1 - m) * inverse > m * (1 - m) / 1001
                       THEN greatest(m * (1 - m) / (v - m * (1 - m) * inverse) - 1, 1)
                       ELSE 1000 END AS strength FROM moments),
verdict AS (
  SELECT source, max(n)::BIGINT AS host_docs,
         max((k + m * strength) / (n + strength)) > 0.75 AS host_failed
  FROM hosts JOIN prior USING (rule) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       f1 OR f2 AS base_failed, host_docs, host_failed, NOT (f1 OR f2) AND NOT host_failed AS kept
FROM rules JOIN verdict ON rules.source IS NOT DISTINCT FROM verdict.source
"""

# op4: water level of the targets, then prefix sums in the order of exponential keys
ORACLE["op4_source_mix"] = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         len(regexp_extract_all(coalesce(text, ''), '{_W}'))::BIGINT AS size,
         md5(concat_ws(':', '7', coalesce(doc_id::VARCHAR, 'null'), md5(coalesce(text, '')))) AS tie
  FROM documents),
k AS (
  SELECT *, -ln((('0x' || substr(tie, 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)
         / (1.0::DOUBLE / (1.0::DOUBLE + 20.0::DOUBLE
            * length(regexp_replace(text, '[^0-9#*$%&|<>{{}}=_~^@\\/+]', '', 'g'))
            / (length(text) + 1))) AS key FROM d),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM d GROUP BY source),
left_over AS (
  SELECT *, 2.0::DOUBLE * source_size AS most,
         sum(source_size) OVER () * 1.5::DOUBLE
           - coalesce(sum(2.0::DOUBLE * source_size) OVER before, 0) AS words,
         sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS weights
  FROM s WINDOW before AS (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT max(weights) AS weights, arg_max(words, weights) AS words
  FROM left_over WHERE most * weights > words * weight),
t AS (
  SELECT source, source_size,
         CASE WHEN most * l.weights <= l.words * weight THEN most
              ELSE weight * level.words / level.weights END AS target
  FROM left_over l CROSS JOIN level),
e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs
  FROM t),
ranked AS (
  SELECT doc_id, size, source_size, target, epochs, target - epochs * source_size AS budget,
         sum(size) OVER (PARTITION BY k.source ORDER BY key, tie) AS ending,
         sum(size) OVER (PARTITION BY k.source, key, tie) AS unit
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       (size * (epochs + (2 * ending - unit <= 2 * budget)::INT))::BIGINT AS taken
FROM ranked
"""

# op6: every 13-word window of the documents against every window of the benchmark
_N = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE["op6_decontamination"] = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all({_LOWER}, '{_N}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_N}') AS w FROM benchmark),
pat AS (SELECT item_id, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i, w,
               least(13, len(w)) AS n FROM b WHERE len(w) > 0),
p AS (SELECT DISTINCT item_id, n, list_slice(w, i, i + n - 1) AS pattern FROM pat),
lengths AS (SELECT DISTINCT n FROM p),
win AS (SELECT r, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM d, lengths WHERE len(w) >= n),
occ AS (SELECT r, i, win.n, item_id FROM win JOIN p
        ON p.n = win.n AND p.pattern = list_slice(win.w, win.i, win.i + win.n - 1)),
hit AS (SELECT r, count(DISTINCT x) AS n_hit FROM
        (SELECT r, unnest(range(i, i + n)) AS x FROM occ) GROUP BY r),
it AS (SELECT r, list_sort(list(DISTINCT item_id::VARCHAR)) AS items FROM occ GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(len(items), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN it USING (r)
"""

# op8: payload digests in base32, and the smallest page of each group of equal payloads
ORACLE["op8_warc"] = r"""
WITH p AS (SELECT page_id, url, encode(coalesce(html, '')) AS payload FROM pages),
d AS (
  SELECT page_id, url, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS hex FROM p),
r AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS original FROM d)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i:
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
           ((('0x' || hex[(i // 4) * 5 + 1 : (i // 4) * 5 + 5])::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1]),
         'string_agg', '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM original THEN original END AS refers_to,
       array_to_string(list_reverse(string_split(lower(regexp_extract(url, '://([^/:?#]*)', 1)), '.')), ',')
         || regexp_extract(url, '://[^/:?#]*(:[0-9]+)?', 1) || ')'
         || regexp_extract(url, '://[^/#]*([^#]*)', 1) AS url_key,
       strftime(TIMESTAMP '2024-01-01' + to_seconds(page_id), '%Y-%m-%dT%H:%M:%SZ') AS capture_time
FROM r
"""

# op10: CRC-32 by its table, then prefix sums in the order of doc_id
ORACLE["op10_sharding"] = r"""
WITH t AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
d AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size,
         list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                        lambda x: ('0x' || x)::BIGINT) AS bytes
  FROM documents),
c AS (
  SELECT doc_id, size::BIGINT AS size,
         xor(list_reduce(list_prepend(4294967295::BIGINT, bytes),
               lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)::BIGINT AS text_crc32
  FROM d, t),
s AS (
  SELECT *, row_number() OVER o AS nth, sum(size) OVER () AS total, sum(size) OVER o AS ending
  FROM c WINDOW o AS (ORDER BY doc_id NULLS FIRST, text_crc32, size
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
p AS (SELECT *, ((2 * ending - size) * 8 // (2 * total))::INTEGER AS shard FROM s)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       (nth - min(nth) OVER (PARTITION BY shard))::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM p
"""

# op12: whole scores of the anchors with all rows, positives by rank, windows by their scores
ORACLE["op12_hard_negatives"] = r"""
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label,
         list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i]))::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, anchor_label, vec_id AS positive_id, score AS positive_score
  FROM s WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id
                            ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE s.label <> s.anchor_label AND 80 * positive_score <= 100 * s.score
    AND 100 * s.score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 5
"""

# op13: crc32 by its table, near words by what is left when one code point is taken out
ORACLE["op13_spelling_variants"] = r"""
WITH RECURSIVE t AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
r AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[a-z\x{00C0}-\x{00FF}]+')) AS run FROM documents)
  GROUP BY ALL),
c AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
             regexp_extract_all(hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)), '..'),
             lambda x: ('0x' || x)::BIGINT)),
           lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)::BIGINT AS h
  FROM r, t),
w AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT)
                                   || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word,
         sum(n)::BIGINT AS n
  FROM c GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3),
d AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS m
  FROM d a JOIN d b ON a.i = b.i AND a.less = b.less AND a.word <> b.word
  UNION SELECT d.word, d.n, w.word, w.n FROM d JOIN w ON d.less = w.word
  UNION SELECT w.word, w.n, d.word, d.n FROM d JOIN w ON d.less = w.word),
best AS (
  SELECT word, max(n) AS n, count(*) AS n_near, max(m) AS m,
         arg_min(other, {'a': -m, 'b': encode(other)}) AS other FROM near GROUP BY word),
form AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN m >= 2 * w.n THEN other END AS form, CASE WHEN m >= 2 * w.n THEN m END AS form_n
  FROM w LEFT JOIN best USING (word)),
chain AS (
  SELECT word, form AS at FROM form WHERE form IS NOT NULL
  UNION ALL SELECT chain.word, form.form FROM chain JOIN form ON chain.at = form.word
  WHERE form.form IS NOT NULL),
ends AS (
  SELECT chain.word, chain.at AS root FROM chain JOIN form ON chain.at = form.word
  WHERE form.form IS NULL)
SELECT form.word, form, coalesce(root, form.word) AS root, n, n_near, form_n
FROM form LEFT JOIN ends USING (word)
"""
