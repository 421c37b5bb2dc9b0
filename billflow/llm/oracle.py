"""DuckDB SQL of the queries that SQL can express."""

_HOST = r"regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(?:www\.)?([^/?#:]+)', 1)"

OP2 = rf"""
WITH pages_ AS (
  SELECT page_id, nullif({_HOST}, '') AS host,
    string_split(coalesce(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
      '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->', ' ', 'g'),
      '[\r\n]+', ' ', 'g'),
      '(?i)</?(?:p|div|br|li|ul|ol|tr|td|th|table|h[1-6]|nav|article|section|header|footer|title|body|head|html)(?:\s[^>]*)?/?>', chr(10), 'g'),
      '<[^>]*>', '', 'g'), ''), chr(10)) AS lines
  FROM pages),
trimmed AS (
  SELECT *, list_transform(lines, lambda x: regexp_replace(x, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')) AS cut FROM pages_),
totals AS (SELECT host, count(*) AS pages FROM pages_ WHERE host IS NOT NULL GROUP BY host),
each AS (SELECT host, unnest(list_distinct(list_filter(cut, lambda x: x <> ''))) AS line FROM trimmed WHERE host IS NOT NULL),
counted AS (SELECT host, line, count(*) AS n FROM each GROUP BY host, line HAVING count(*) > 1),
drops AS (SELECT host, list(line) AS dropped FROM counted JOIN totals USING (host) WHERE n > 0.1 * pages GROUP BY host),
kept AS (
  SELECT page_id, host, lines, list_filter(list_zip(lines, cut), lambda z: NOT list_contains(coalesce(dropped, []), z[2])) AS stay
  FROM trimmed LEFT JOIN drops USING (host)),
done AS (
  SELECT page_id, host, lines, CASE WHEN len(list_filter(stay, lambda z: z[2] <> '')) = 0 THEN lines
    ELSE list_transform(stay, lambda z: z[1]) END AS clean FROM kept)
SELECT page_id, host, len(lines)::BIGINT AS n_lines, (len(lines) - len(clean))::BIGINT AS n_dropped,
  sha256(array_to_string(clean, chr(10))) AS clean_sha256
FROM done"""

OP5 = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS print,
    row_number() OVER (PARTITION BY doc_id, source, md5(coalesce(text, ''))) - 1 AS number, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w
  FROM d GROUP BY source),
k AS (
  SELECT *, row_number() OVER o AS k,
    (sum(source_size) OVER ()::BIGINT - 3 * coalesce(sum(source_size) OVER b, 0)::BIGINT)::DOUBLE
      / (sum(w) OVER () - coalesce(sum(w) OVER b, 0))::DOUBLE AS level
  FROM s
  WINDOW o AS (ORDER BY source_size::DOUBLE / w, source NULLS LAST),
    b AS (ORDER BY source_size::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size, least((3 * source_size)::DOUBLE,
    w * (SELECT arg_min(level, k) FROM k WHERE level * w <= 3 * source_size)) AS target
  FROM k),
r AS (
  SELECT doc_id, size, source_size, target,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
    ('0x' || substr(md5(concat_ws('|', '5', coalesce(doc_id::VARCHAR, '\N'), print)), 1, 12))::BIGINT / 281474976710656.0::DOUBLE
      + number * 0.6180339887498949::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  ((floor(rate) + CASE WHEN u - floor(u) < rate - floor(rate) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM r"""

OP9 = rf"""
WITH p AS (SELECT page_id, nullif({_HOST}, '') AS host, ((page_id * 7919) % 730)::INT AS day FROM pages),
h AS (
  SELECT host, md5(host) AS h, array_to_string(string_split(host, '.')[2:], '.') AS up
  FROM (SELECT DISTINCT host FROM p WHERE host IS NOT NULL)),
n AS (
  SELECT host, up, ('0x' || substr(h, 1, 3))::INT % 500 AS day, ('0x' || substr(h, 4, 1))::INT AS kind,
    ('0x' || substr(h, 5, 2))::INT AS stay, ('0x' || substr(h, 7, 1))::INT AS up1, ('0x' || substr(h, 8, 1))::INT AS up2
  FROM h),
e AS (
  SELECT 'block' AS list, host AS key, day, true AS adds FROM n WHERE kind < 4
  UNION ALL SELECT 'block', host, day + 1 + stay, false FROM n WHERE kind < 4
  UNION ALL SELECT 'block', host, day + 300, true FROM n WHERE kind < 2
  UNION ALL SELECT 'allow', host, day + 20, true FROM n WHERE kind IN (3, 4)
  UNION ALL SELECT 'block', up, 100 + up1, true FROM n WHERE up LIKE '%.%'
  UNION ALL SELECT 'block', up, 160 + up2, false FROM n WHERE up LIKE '%.%'),
o AS (SELECT list, key, day, bool_and(adds) AS adds FROM e GROUP BY list, key, day),
i AS (SELECT list, key, day AS since, adds, lead(day) OVER (PARTITION BY list, key ORDER BY day) AS until FROM o),
keyed AS (
  SELECT host, day, unnest(list_transform(range(1, greatest(len(string_split(host, '.')) - 1, 1) + 1),
    lambda x: array_to_string(string_split(host, '.')[x:], '.'))) AS key
  FROM (SELECT DISTINCT host, day FROM p WHERE host IS NOT NULL)),
met AS (
  SELECT host, keyed.day, keyed.key, list FROM keyed JOIN i ON i.key = keyed.key AND i.adds
    AND i.since <= keyed.day AND (i.until IS NULL OR keyed.day < i.until)),
v AS (
  SELECT host, day, count(*) AS n_active,
    arg_max(key, length(key) * 2 + (list = 'allow')::INT) AS decided_by,
    arg_max(list, length(key) * 2 + (list = 'allow')::INT) = 'block' AS blocked
  FROM met GROUP BY host, day)
SELECT page_id, p.host, p.day, coalesce(n_active, 0)::BIGINT AS n_active, decided_by, coalesce(blocked, false) AS blocked
FROM p LEFT JOIN v ON p.host = v.host AND p.day = v.day"""

OP6 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM shared JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * c >= 80 * (na.n + nb.n - c)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a AS x, b AS y FROM ways UNION SELECT reach.x, ways.b FROM reach JOIN ways ON reach.y = ways.a),
low AS (SELECT x, least(x, min(y)) AS component_id FROM reach GROUP BY x)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(low.component_id, w.doc_id) AS component_id,
  coalesce(low.component_id, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN low ON low.x = w.doc_id"""

SQL: dict[str, str] = {"op2_line_dedup": OP2, "op5_mixing": OP5, "op6_minhash": OP6, "op9_url_filter": OP9}
