"""DuckDB SQL for the queries that SQL can express."""

SQL: dict[str, str] = {}

SQL["op1_url_filter"] = r"""
WITH rest AS (
  SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(regexp_extract(r, '^[^/?#]*', 0), '') AS h0,
         coalesce(regexp_extract(r, '^[^/?#]*([^?#]*)', 1), '') AS path FROM rest),
hosts AS (
  SELECT page_id, translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS url, path,
         translate(h0, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM parts),
judged AS (
  SELECT page_id, url, host, path, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM hosts)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN regexp_matches(url, '^[a-z]+://(?:[^/?#]*\.)?(?:ads|adserver|doubleclick)\.')
      OR regexp_matches(url, '[?&]sessionid=[0-9a-f]{16,}') OR regexp_matches(url, '/wp-login\.php(?:$|[?#])')
      OR regexp_matches(url, '/cgi-bin/') OR regexp_matches(url, '\.(?:exe|dmg|apk|zip|rar)(?:$|[?#])') THEN 'block'
    ELSE 'allow' END AS verdict
FROM judged
"""

SQL["op10_source_mix"] = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(concat_ws('|', 'mix', coalesce(doc_id::VARCHAR, ''), md5(coalesce(text, '')))) AS sign FROM documents),
classed AS (
  SELECT *, CASE WHEN size = 0 THEN 1 ELSE floor(log2(size + 0.5))::INT + 1 END AS c,
         (('0x' || substr(sign, 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0 AS u FROM sized),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM classed GROUP BY source),
weighed AS (
  SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w, source_size * 3 AS cap FROM sources),
by_cap AS (
  SELECT *, sum(source_size) OVER () AS total, row_number() OVER o AS k,
         sum(cap) OVER o AS capped, sum(w) OVER () - sum(w) OVER o AS rest,
         lead(cap / w) OVER o AS next_ratio, min(cap / w) OVER () AS least_ratio, sum(w) OVER () AS all_w
  FROM weighed WINDOW o AS (ORDER BY cap / w, source ROWS UNBOUNDED PRECEDING)),
rate AS (
  SELECT coalesce(max(total::DOUBLE / all_w) FILTER (total::DOUBLE / all_w <= least_ratio),
                  min_by((total - capped)::DOUBLE / rest, k) FILTER (rest > 0 AND (total - capped)::DOUBLE / rest <= next_ratio)) AS r
  FROM by_cap),
targets AS (
  SELECT source, source_size, least(cap::DOUBLE, r * w) AS target FROM weighed, rate),
classes AS (
  SELECT c.source, c.c, sum(c.size)::BIGINT AS s FROM classed c GROUP BY ALL),
upto AS (
  SELECT c.*, t.source_size, t.target, sum(s) OVER o AS head, lead(c) OVER o AS next_c,
         sum(s * c) OVER (PARTITION BY c.source) - sum(s * c) OVER o AS tail,
         sum(s * c) OVER (PARTITION BY c.source) AS al, max(c) OVER (PARTITION BY c.source) AS top
  FROM classes c JOIN targets t ON c.source IS NOT DISTINCT FROM t.source
  WINDOW o AS (PARTITION BY c.source ORDER BY c DESC ROWS UNBOUNDED PRECEDING)),
rated AS (
  SELECT *, least(3.0::DOUBLE, coalesce(CASE WHEN al = 0 THEN 0.0::DOUBLE
      WHEN target / al::DOUBLE * top <= 3 THEN target / al::DOUBLE
      ELSE max_by((target - 3 * head::DOUBLE) / tail::DOUBLE, c) FILTER (tail > 0 AND (target - 3 * head::DOUBLE) / tail::DOUBLE * next_c <= 3)
           OVER (PARTITION BY source) END, 3.0::DOUBLE) * c) AS wanted FROM upto),
ranked AS (
  SELECT d.doc_id, d.source, d.size, d.sign, r.source_size, r.target, floor(r.wanted)::BIGINT AS certain,
         r.wanted - floor(r.wanted) AS f, d.u
  FROM classed d JOIN rated r ON d.source IS NOT DISTINCT FROM r.source AND d.c = r.c),
ordered AS (
  SELECT *, CASE WHEN f > 0 THEN (u * (1 - f)) / ((1 - u) * f) END AS q,
         target - sum(certain * size) OVER (PARTITION BY source) AS missing FROM ranked),
filled AS (
  SELECT *, sum(CASE WHEN q IS NOT NULL THEN size ELSE 0 END) OVER (
      PARTITION BY source ORDER BY q NULLS FIRST, sign ROWS UNBOUNDED PRECEDING) AS upto FROM ordered),
mixed AS (
  SELECT *, certain + CASE WHEN q IS NOT NULL AND 2 * upto - size <= 2 * missing THEN 1 ELSE 0 END AS copies FROM filled)
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken, source, copies FROM mixed
"""

SQL["op11_importance_resampling"] = r"""
WITH texts AS (
  SELECT 'd' AS kind, row_number() OVER () AS r, doc_id, text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), NULL, text FROM benchmark),
worded AS (
  SELECT kind, r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
tokens AS (
  SELECT kind, r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM worded),
features AS (
  SELECT kind, r, word AS f FROM tokens
  UNION ALL
  SELECT kind, r, word || ' ' || next_word FROM (
    SELECT kind, r, word, lead(word) OVER (PARTITION BY kind, r ORDER BY p) AS next_word FROM tokens) WHERE next_word IS NOT NULL),
counted AS (
  SELECT kind, r, f, count(*) AS n FROM features GROUP BY ALL),
crc_step AS (
  SELECT list_transform(range(0, 256), lambda b: list_reduce(list_prepend(b, range(0, 8)), lambda c, i:
    CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
distinct_features AS (
  SELECT DISTINCT f FROM counted),
bytes AS (
  SELECT f, hex(encode(f)) AS h FROM distinct_features),
buckets AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
      lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295::BIGINT) % 10000 AS bucket
  FROM bytes, crc_step),
placed AS (
  SELECT kind, r, bucket, n FROM counted JOIN buckets USING (f)),
sums AS (
  SELECT bucket, coalesce(sum(n) FILTER (kind = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (kind = 'b'), 0)::DOUBLE AS t FROM placed GROUP BY bucket),
totals AS (
  SELECT sum(s) AS s_all, sum(t) AS t_all FROM sums),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000))))::BIGINT AS gain FROM sums, totals),
summed AS (
  SELECT r, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS g FROM placed JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY r),
weighed AS (
  SELECT d.doc_id, d.r, len(d.w) AS n_words, coalesce(n_features, 0) AS n_features,
         CASE WHEN n_features IS NULL THEN 0 ELSE (g - ((g % n_features) + n_features) % n_features) // n_features END AS weight,
         ('0x' || substr(sha256('7:' || coalesce(d.doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
  FROM worded d LEFT JOIN summed USING (r) WHERE d.kind = 'd'),
scored AS (
  SELECT *, (weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score FROM weighed),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features) AS k,
         count(*) OVER (PARTITION BY n_words >= 20) AS able FROM scored)
SELECT doc_id, n_features::BIGINT AS n_features, weight::BIGINT AS weight, score,
       CASE WHEN n_words >= 20 AND k <= (25 * able) // 100 THEN k END AS rank FROM ordered
"""

SQL["op12_quality_rules"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs)),
windows AS (
  SELECT r, p, word, lead(word, 1) OVER o AS b, lead(word, 2) OVER o AS c, lead(word, 3) OVER o AS d, lead(word, 4) OVER o AS e
  FROM words WINDOW o AS (PARTITION BY r ORDER BY p)),
found AS (
  SELECT r, p, e IS NOT NULL AND count(*) OVER (PARTITION BY r, word, b, c, d, e) > 1 AS again FROM windows),
covered AS (
  SELECT r, max(again::INT) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS inside FROM found),
repeats AS (
  SELECT r, sum(inside)::BIGINT AS n_repeat_words FROM covered GROUP BY r),
lines AS (
  SELECT r, doc_id, source, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w
  FROM (SELECT r, doc_id, source, unnest(string_split(text, chr(10))) AS line FROM docs)),
normal AS (
  SELECT r, doc_id, source, line, len(w) AS n, regexp_replace(translate(array_to_string(w, ' '),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]+', '0', 'g') AS norm FROM lines WHERE len(w) > 0),
frequent AS (
  SELECT source, norm FROM normal GROUP BY source, norm HAVING count(DISTINCT coalesce(doc_id::VARCHAR, '')) > 10),
removed AS (
  SELECT r, sum(n)::BIGINT AS removed_words FROM normal m JOIN frequent f ON m.norm = f.norm AND m.source IS NOT DISTINCT FROM f.source GROUP BY r),
per_doc AS (
  SELECT r, sum(n)::BIGINT AS n_words, (count(*) - count(DISTINCT line))::BIGINT AS n_dup_lines FROM normal GROUP BY r),
measured AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(removed_words, 0) AS removed_words
  FROM docs LEFT JOIN per_doc USING (r) LEFT JOIN repeats USING (r) LEFT JOIN removed USING (r)),
judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * removed_words <= 50 * n_words AND n_words - removed_words >= 10 AS kept, removed_words
FROM judged
"""


def _clusters_sql(k: int = 40, rounds: int = 5) -> str:
    """Rounds of assignment and replacement, written out one after the other."""
    steps = [f"""
whole AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
parts AS (
  SELECT r, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM whole),
c0 AS (
  SELECT c, unnest(v) AS y, generate_subscripts(v, 1) AS i FROM (
    SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS c, v FROM whole) WHERE c < {k})"""]
    for n in range(rounds + 1):
        steps.append(f"""
d{n} AS (
  SELECT r, c, sum((x - y) * (x - y))::BIGINT AS d FROM parts JOIN c{n} USING (i) GROUP BY r, c),
a{n} AS (
  SELECT r, min(d) AS d, min(c) FILTER (d = least) AS c FROM (SELECT r, c, d, min(d) OVER (PARTITION BY r) AS least FROM d{n}) GROUP BY r)""")
        if n < rounds:
            steps.append(f"""
m{n} AS (
  SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n FROM a{n} JOIN parts USING (r) GROUP BY c, i),
c{n + 1} AS (
  SELECT c, i, coalesce((s - ((s % n) + n) % n) // n, y) AS y FROM c{n} LEFT JOIN m{n} USING (c, i))""")
    return f"""WITH {",".join(steps)},
signs AS (
  SELECT c, sha256(string_agg(y::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c),
sums AS (
  SELECT c, sum(d)::BIGINT AS cluster_inertia FROM a{rounds} GROUP BY c)
SELECT vec_id, a.c::INT AS cluster, d AS distance, cluster_inertia, (SELECT sum(d)::BIGINT FROM a{rounds}) AS inertia, centroid_sha256
FROM a{rounds} a JOIN whole USING (r) JOIN signs USING (c) JOIN sums USING (c)
"""


SQL["op13_centroid_clusters"] = _clusters_sql()
