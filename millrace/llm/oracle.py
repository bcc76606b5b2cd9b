"""SQL for the queries that SQL can express."""

OP6 = r"""
WITH digested AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM digested WINDOW same AS (PARTITION BY text_sha256)
"""

SQUARED = "list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"


def _round(number: int) -> str:
    """Assignment to the centroids of one round, and the centroids of the next."""
    return f"""
a{number} AS (
    SELECT k.n, min(struct_pack(distance := CAST({SQUARED} AS BIGINT), cluster := c.cluster)) AS best
    FROM kept k, c{number} c GROUP BY k.n),
m{number} AS (
    SELECT cluster, list(x ORDER BY d) AS v
    FROM (SELECT cluster, d, CAST(floor(CAST(sum(x) AS DOUBLE) / count(*)) AS BIGINT) AS x
          FROM (SELECT best.cluster AS cluster, unnest(v) AS x, generate_subscripts(v, 1) AS d
                FROM a{number} JOIN kept USING (n))
          GROUP BY cluster, d)
    GROUP BY cluster),
c{number + 1} AS (
    SELECT cluster, coalesce(m{number}.v, c{number}.v) AS v FROM c{number} LEFT JOIN m{number} USING (cluster))"""


OP12 = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS n, vec_id,
           list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64),
c0 AS (
    SELECT CAST(row_number() OVER (ORDER BY h, v) - 1 AS INTEGER) AS cluster, v
    FROM (SELECT sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, v FROM kept ORDER BY h, v LIMIT 16)),
{",".join(_round(number) for number in range(3))},
a3 AS (
    SELECT k.n, min(struct_pack(distance := CAST({SQUARED} AS BIGINT), cluster := c.cluster)) AS best
    FROM kept k, c3 c GROUP BY k.n)
SELECT vec_id, best.cluster AS cluster, best.distance AS distance,
       CAST(sum(best.distance) OVER (PARTITION BY best.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(best.distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c3.v, ',')) AS centroid_sha256
FROM a3 JOIN kept USING (n) JOIN c3 ON c3.cluster = best.cluster
"""

OP13 = """
WITH rules(verdict, host, path) AS (VALUES
    ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
    ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
cut AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages),
parts AS (
    SELECT page_id, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
           translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
    FROM cut),
judged AS (
    SELECT page_id, host, path,
           (SELECT max(struct_pack(size := length(r.host || r.path), rule := r.host || r.path, verdict := r.verdict))
            FROM rules r
            WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)) AS best
    FROM parts p)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict FROM judged
"""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit: 3988292384 is the reversed polynomial."""
    bits = f"flatten(list_transform(string_split({text}, ''), lambda c: list_transform(range(8), lambda k: (ascii(c) >> k) & 1)))"
    return (f"xor(list_reduce(list_concat([4294967295], {bits}), "
            "lambda c, bit: xor(c >> 1, 3988292384 * (xor(c, bit) & 1))), 4294967295)")


ID_CRC = crc32("CAST(doc_id AS VARCHAR)")

OP3 = f"""
WITH texts AS (SELECT row_number() OVER () AS n, doc_id, {WORDS} AS words FROM documents),
windows AS (
    SELECT n, unnest(range(1, len(words) - 33)) AS i,
           unnest(list_transform(range(1, len(words) - 33), lambda i: array_to_string(words[i:i + 34], ' '))) AS words
    FROM texts WHERE len(words) >= 35),
repeated AS (SELECT n, i FROM windows QUALIFY count(*) OVER (PARTITION BY words) > 1),
words AS (SELECT n, generate_subscripts(words, 1) AS i, unnest(words) AS word FROM texts),
judged AS (
    SELECT w.n, i, word, count(r.i) OVER (PARTITION BY w.n ORDER BY i ROWS 34 PRECEDING) > 0 AS removed
    FROM words w LEFT JOIN repeated r USING (n, i)),
gathered AS (
    SELECT n, count(*) FILTER (removed) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT removed) AS kept
    FROM judged GROUP BY n)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN gathered USING (n)
"""

OP5 = """
WITH RECURSIVE numbered AS MATERIALIZED (
    SELECT row_number() OVER () AS n, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
vectors AS MATERIALIZED (
    SELECT n, list_resize(v, (SELECT max(len(v)) FROM numbered), 0) AS v FROM numbered
    WHERE len(list_filter(v, lambda x: isfinite(x))) = len(v) AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (
    SELECT a.n AS a, b.n AS b FROM vectors a JOIN vectors b ON a.n <> b.n AND list_cosine_similarity(a.v, b.v) >= 0.95),
reached(a, b) AS (
    SELECT n, n FROM numbered
    UNION
    SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
components AS (SELECT r.a AS n, min(o.vec_id) AS component_id FROM reached r JOIN numbered o ON o.n = r.b GROUP BY r.a),
degrees AS (SELECT a AS n, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM numbered JOIN components USING (n) LEFT JOIN degrees USING (n)
"""

# Profiles are learnt from all rows here: up to 2000 documents a language the query does so too.
OP10 = rf"""
WITH texts AS (
    SELECT row_number() OVER () AS n, doc_id, lang, text IS NOT NULL AND lang IS NOT NULL AS labelled,
           coalesce({ID_CRC} % 4 = 2, false) AS held_out,
           string_split(' ' || trim(regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}]+', ' ', 'g')) || ' ', '') AS c
    FROM documents),
places AS (SELECT n, unnest(list_zip(c, c[2:], c[3:])) AS p FROM texts WHERE len(c) > 2),
grams AS (
    SELECT n, p[1] AS gram FROM places WHERE p[1] <> ' '
    UNION ALL SELECT n, p[1] || p[2] FROM places WHERE p[2] IS NOT NULL
    UNION ALL SELECT n, p[1] || p[2] || p[3] FROM places WHERE p[3] IS NOT NULL AND p[2] <> ' '),
counted AS MATERIALIZED (SELECT n, gram, count(*) AS times FROM grams GROUP BY n, gram),
profiles AS MATERIALIZED (
    SELECT lang, gram, row_number() OVER (PARTITION BY lang ORDER BY times DESC, length(gram), gram) AS rank
    FROM (SELECT lang, gram, sum(times) AS times
          FROM counted JOIN texts USING (n) WHERE labelled AND NOT held_out GROUP BY lang, gram)
    QUALIFY rank <= 400),
own AS (
    SELECT n, gram, row_number() OVER (PARTITION BY n ORDER BY times DESC, length(gram), gram) AS rank
    FROM counted QUALIFY rank <= 400),
sizes AS (SELECT n, count(*) AS size FROM own GROUP BY n),
nearness AS (
    SELECT n, lang, sum(400 - abs(o.rank - p.rank)) AS nearer FROM own o JOIN profiles p USING (gram) GROUP BY n, lang),
best AS (
    SELECT s.n, min(struct_pack(distance := CAST(400 * size - coalesce(nearer, 0) AS BIGINT), lang := l.lang)) AS best
    FROM sizes s JOIN (SELECT DISTINCT lang FROM profiles) l ON true LEFT JOIN nearness f ON f.n = s.n AND f.lang = l.lang
    GROUP BY s.n)
SELECT doc_id, held_out, coalesce(best.lang, 'und') AS lang_pred,
       coalesce(1 - CAST(best.distance AS DOUBLE) / (400 * size), 0) AS score
FROM texts LEFT JOIN best USING (n) LEFT JOIN sizes USING (n)
"""

# Words that start a window; a run of period q is found by the shortest window that is no shorter than q.
FIRST_WINDOW, LAST_WINDOW = 16, 16384


def _windows() -> str:
    """Names of windows of 1, 2, 4, ... words, each from two of the step before."""
    steps, size = [], 1
    while size < LAST_WINDOW:
        steps.append(f"""
w{2 * size} AS MATERIALIZED (
    SELECT n, i, dense_rank() OVER (ORDER BY name, after) AS name
    FROM (SELECT n, i, name, lead(name, {size}) OVER (PARTITION BY n ORDER BY i) AS after FROM w{size})
    WHERE after IS NOT NULL)""")
        size *= 2
    return ",".join(steps)


def _periods() -> str:
    """Per window length, the distance to the window's next place: a run's smallest period all along it."""
    parts, size = [], FIRST_WINDOW
    while size <= LAST_WINDOW:
        least = 1 if size == FIRST_WINDOW else size // 2 + 1
        parts.append(f"""
    SELECT n, i, period, {size} AS size
    FROM (SELECT n, i, lead(i) OVER (PARTITION BY n, name ORDER BY i) - i AS period FROM w{size})
    WHERE period BETWEEN {least} AND {size}""")
        size *= 2
    return " UNION ALL ".join(parts)


# Periods up to 16384 words, which is all there are in texts of up to 49,152 words.
OP11 = f"""
WITH split AS (
    SELECT row_number() OVER () AS n, doc_id, {WORDS} AS words, {ID_CRC} AS h FROM documents),
anchored AS (
    SELECT n, doc_id, words, h // 10 AS g,
           CASE WHEN h % 10 = 0 AND len(words) > 0 THEN (h // 10) % len(words) END AS a FROM split),
texts AS MATERIALIZED (
    SELECT n, doc_id, CASE WHEN a IS NULL THEN words ELSE list_transform(words, lambda word, j:
               CASE WHEN j <= a THEN word ELSE words[a + 1 + (j - 1 - a) % (1 + (len(words) - a) // (3 + g % 8))] END)
           END AS words
    FROM anchored),
words AS MATERIALIZED (SELECT n, generate_subscripts(words, 1) - 1 AS i, unnest(words) AS word FROM texts),
w1 AS MATERIALIZED (SELECT n, i, dense_rank() OVER (ORDER BY word) AS name FROM words),{_windows()},
periods AS ({_periods()}),
islands AS (
    SELECT n, i, period, size, i - row_number() OVER (PARTITION BY n, period ORDER BY i) AS island FROM periods),
runs AS MATERIALIZED (
    SELECT n, min(i) AS start, max(i) - min(i) + any_value(size) + period AS length, period
    FROM islands GROUP BY n, period, island
    HAVING max(i) - min(i) + any_value(size) + period >= greatest(24, 3 * period)),
dropped AS (SELECT DISTINCT n, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
    SELECT n, string_agg(word, ' ' ORDER BY i) AS collapsed FROM words ANTI JOIN dropped USING (n, i) GROUP BY n),
gathered AS (
    SELECT n, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines,
           min(struct_pack(shortness := -length / period, start := start, period := period, length := length)) AS best
    FROM runs GROUP BY n)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(best.start AS BIGINT) AS start, CAST(best.length AS BIGINT) AS length,
       CAST(best.period AS BIGINT) AS period, CAST(1000 * best.length // best.period AS BIGINT) AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM texts LEFT JOIN gathered USING (n) LEFT JOIN kept USING (n)
"""

ORACLE = {"op3_substring_dedup": OP3, "op5_embedding_near_dedup": OP5, "op6_exact_dedup": OP6, "op10_language_id": OP10,
          "op11_periodic_runs": OP11, "op12_centroid_clusters": OP12, "op13_url_filter": OP13}
