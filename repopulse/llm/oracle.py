"""SQL for another engine that gives the rows of a query, where SQL can express them."""

from __future__ import annotations

# Counts of every context by joins of all tails with the training characters; one probability a row
# and order by a chain of joins from the shortest context to the longest.
URL = r"""
WITH RECURSIVE parts AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0
        THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), split AS (
    SELECT page_id,
        translate(regexp_extract(rest, '^[^/?#]*'),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM parts
), rules(host, path, verdict) AS (
    VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
        ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), ruled AS (
    SELECT host, path, host || path AS address, rule, verdict
    FROM (SELECT DISTINCT host, path FROM split) s LEFT JOIN LATERAL (
        SELECT r.host || r.path AS rule, r.verdict FROM rules r
        WHERE ('.' || s.host) LIKE ('%.' || r.host) AND starts_with(s.path, r.path)
        ORDER BY length(r.host || r.path) DESC LIMIT 1) ON true
), folded AS (
    SELECT address, verdict, left(md5(address), 1) IN ('0', '1', '2', '3') AS held FROM ruled
), characters AS (
    SELECT address, verdict, held,
        repeat(chr(2), 4) || address || chr(3) AS padded, unnest(range(5, length(address) + 6)) AS i
    FROM folded
), contexts AS (
    SELECT address, i, o, verdict, verdict IS NOT NULL AND NOT held AS trains,
        substr(padded, CAST(i AS BIGINT) - o, o + 1) AS tail
    FROM characters, range(0, 5) AS orders(o)
), tails AS (
    SELECT tail, count(*) FILTER (verdict = 'allow') AS a, count(*) FILTER (verdict = 'block') AS b
    FROM contexts WHERE trains GROUP BY tail
), befores AS (
    SELECT length(tail) AS n, left(tail, length(tail) - 1) AS before, sum(a) AS a, sum(b) AS b
    FROM tails GROUP BY ALL
), wanted AS (
    SELECT tail, coalesce(t.a, 0) AS a, coalesce(t.b, 0) AS b,
        coalesce(f.a, 0) AS fa, coalesce(f.b, 0) AS fb
    FROM (SELECT DISTINCT tail FROM contexts) LEFT JOIN tails t USING (tail)
    LEFT JOIN befores f ON f.n = length(tail) AND f.before = left(tail, length(tail) - 1)
), chances AS (
    SELECT tail, (a + 4.0::DOUBLE * (1.0::DOUBLE / 256)) / (fa + 4.0::DOUBLE) AS pa,
        (b + 4.0::DOUBLE * (1.0::DOUBLE / 256)) / (fb + 4.0::DOUBLE) AS pb
    FROM wanted WHERE length(tail) = 1
    UNION ALL
    SELECT w.tail, (w.a + 4.0::DOUBLE * c.pa) / (w.fa + 4.0::DOUBLE),
        (w.b + 4.0::DOUBLE * c.pb) / (w.fb + 4.0::DOUBLE)
    FROM wanted w JOIN chances c ON length(w.tail) = length(c.tail) + 1 AND right(w.tail, -1) = c.tail
), scored AS (
    SELECT address, floor(sum(CAST(round(1000000 * (ln(pa) - ln(pb))) AS BIGINT))::DOUBLE
        / (count(*) * 1000.0::DOUBLE)) AS bin
    FROM contexts JOIN chances USING (tail) WHERE o = 4 GROUP BY address
), held AS (
    SELECT least(greatest(bin, -20000), 20000) AS bin, verdict
    FROM scored JOIN folded USING (address) WHERE held AND verdict IS NOT NULL
), gains AS (
    SELECT c.bin,
        count(*) FILTER (h.verdict = 'allow' AND h.bin >= c.bin)
            * (SELECT count(*) FROM held WHERE verdict = 'block')
        - count(*) FILTER (h.verdict = 'block' AND h.bin >= c.bin)
            * (SELECT count(*) FROM held WHERE verdict = 'allow') AS gain
    FROM (SELECT DISTINCT bin FROM held) c, held h GROUP BY c.bin
), cut AS (
    SELECT CASE WHEN count(DISTINCT verdict) < 2 THEN 0
        ELSE (SELECT bin FROM gains ORDER BY gain DESC, bin LIMIT 1) END AS bin
    FROM held
)
SELECT page_id, host, path, rule,
    coalesce(verdict, CASE WHEN s.bin >= cut.bin THEN 'allow' ELSE 'block' END) AS verdict,
    least(greatest(s.bin, -20000), 20000) / 1000 AS score
FROM split JOIN ruled USING (host, path) JOIN scored s USING (address), cut
"""

# Words and their shingles by list functions, links by counting shared shingles, reachability by
# recursion over the links.
JACCARD = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 2),
            lambda i: array_to_string(w[i:i + 3], ' '))) END AS grams
    FROM words
), members AS (
    SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM sets
), links AS (
    SELECT x.doc_id AS a, y.doc_id AS b
    FROM members x JOIN members y ON x.gram = y.gram AND x.doc_id <> y.doc_id
    GROUP BY x.doc_id, y.doc_id
    HAVING 100 * count(*) >= 85 * (any_value(x.n) + any_value(y.n) - count(*))
), reach AS (
    SELECT doc_id AS node, doc_id AS seen FROM sets
    UNION
    SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.seen
)
SELECT doc_id, CAST(len(grams) AS BIGINT) AS n_shingles, least_seen AS component_id
FROM sets JOIN (SELECT node, min(seen) AS least_seen FROM reach GROUP BY node) ON node = doc_id
"""



def _clusters() -> str:
    """Every round by a full join of vectors and centroids."""
    steps = [
        """points AS (
    SELECT row_number() OVER () AS i, vec_id,
        list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS p
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64
), c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c, p AS m FROM points
    ORDER BY sha256('3:' || vec_id) LIMIT 8)"""
    ]
    for r in range(11):
        steps.append(
            f"""a{r} AS MATERIALIZED (
    SELECT i, vec_id, any_value(p) AS p, min({{'d': d, 'c': c}}) AS near FROM (
        SELECT i, vec_id, p, c, CAST(list_sum(list_transform(p,
            lambda x, j: (x - m[j]) * (x - m[j]))) AS BIGINT) AS d
        FROM points, c{r}) GROUP BY i, vec_id)"""
        )
        steps.append(
            f"""c{r + 1} AS MATERIALIZED (
    SELECT c, coalesce(n.m, o.m) AS m FROM c{r} o LEFT JOIN (
        SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS m FROM (
            SELECT near.c AS c, j, CAST(sum(p[j]) AS BIGINT) AS s, count(*) AS n
            FROM a{r}, range(1, 65) AS places(j) GROUP BY near.c, j)
        GROUP BY c) n USING (c))"""
        )
    return "WITH " + ", ".join(steps[:-1]) + """
SELECT vec_id, CAST(near.c AS INTEGER) AS cluster, near.d AS distance,
    CAST(sum(near.d) OVER (PARTITION BY near.c) AS BIGINT) AS cluster_inertia,
    CAST(sum(near.d) OVER () AS BIGINT) AS inertia,
    sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a10 JOIN c10 ON c = near.c"""


# The checksum bit by bit, once per distinct feature; ranks by one sort.
DRAW = r"""
WITH words AS (
    SELECT row_number() OVER () AS i, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w, false AS target
    FROM documents
    UNION ALL
    SELECT -row_number() OVER (), NULL, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), true
    FROM benchmark
), found AS (
    SELECT i, target, unnest(w) AS feature FROM words
    UNION ALL
    SELECT i, target, unnest(list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]))
    FROM words
), hexed AS (
    SELECT feature, hex(encode(feature)) AS h FROM (SELECT DISTINCT feature FROM found)
), buckets AS (
    SELECT feature, xor(list_reduce(
        list_transform(range(0, len(h) // 2),
            lambda k: CAST('0x' || substr(h, CAST(2 * k + 1 AS BIGINT), 2) AS BIGINT)),
        lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]),
            lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END),
        4294967295), 4294967295) % 10000 AS bucket
    FROM hexed
), counts AS (
    SELECT bucket, count(*) FILTER (NOT target) AS s, count(*) FILTER (target) AS t
    FROM found JOIN buckets USING (feature) GROUP BY bucket
), gains AS (
    SELECT bucket, CAST(floor(1000 * ln((t + 1.0::DOUBLE) * (sum(s) OVER () + 10000.0::DOUBLE)
        / ((s + 1.0::DOUBLE) * (sum(t) OVER () + 10000.0::DOUBLE)))) AS BIGINT) AS gain
    FROM counts
), weights AS (
    SELECT i, count(*) AS n, CAST(sum(gain) AS BIGINT) AS total
    FROM found JOIN buckets USING (feature) JOIN gains USING (bucket) WHERE NOT target GROUP BY i
), scored AS (
    SELECT i, doc_id, len(w) >= 20 AS long, coalesce(n, 0) AS n_features,
        coalesce((total - ((total % n) + n) % n) // n, 0) AS weight,
        CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT)
            + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS noise
    FROM words LEFT JOIN weights USING (i) WHERE NOT target
), ranked AS (
    SELECT *, weight + noise AS score,
        row_number() OVER (PARTITION BY long ORDER BY weight + noise DESC, doc_id) AS place,
        25 * count(*) OVER (PARTITION BY long) // 100 AS drawn
    FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN long AND place <= drawn THEN place END AS rank
FROM ranked
"""

# Lengths by counting, digests of the source itself.
CHAT = r"""
WITH turns AS (
    SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -7, turn, role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(turn, role)
), whole AS (
    SELECT conv_id, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn) AS listing,
        coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '') AS learnt,
        CAST(sum(15 + length(role) + length(text)
            + len(regexp_extract_all(text, '</turn>|### '))) AS BIGINT) AS formatted_chars
    FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(listing) AS turns_sha256, length(learnt) AS loss_chars,
    sha256(learnt) AS loss_sha256, formatted_chars
FROM whole
"""

ORACLE: dict[str, str] = {
    "op1_url_filter": URL,
    "op10_ngram_jaccard_join": JACCARD,
    "op11_centroid_clustering": _clusters(),
    "op12_importance_draw": DRAW,
    "op13_chat_formatting": CHAT,
}
