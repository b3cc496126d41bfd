"""DuckDB SQL of the corpus queries that SQL can express, besides the mixing query's."""


def _nearest(centroids):
    """Nearest of the table ``centroids`` (cluster, c) for every vector; ties go to the smaller number."""
    return (
        "SELECT n, vec_id, v, min(apart) AS distance, arg_min(cluster, (apart, cluster)) AS cluster FROM ("
        "SELECT n, vec_id, v, cluster, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS apart "
        f"FROM vectors, {centroids}) GROUP BY n, vec_id, v"
    )


def _moved(centroids, assigned):
    """Centroids at the floors of the means of their vectors; those without vectors stay."""
    return (
        f"SELECT cluster, coalesce(m.c, {centroids}.c) AS c FROM {centroids} LEFT JOIN ("
        "SELECT cluster, list(mean ORDER BY dim) AS c FROM ("
        "SELECT cluster, dim, floor(sum(v[dim])::DOUBLE / count(*))::BIGINT AS mean "
        f"FROM {assigned}, range(1, 65) AS d(dim) GROUP BY cluster, dim) GROUP BY cluster) m USING (cluster)"
    )


def clustering_sql(k=16, rounds=3):
    parts = [
        "vectors AS (SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v "
        "FROM embeddings WHERE len(embedding) = 64 "
        "AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)",
        "c0 AS (SELECT (row_number() OVER (ORDER BY mark, v) - 1)::INTEGER AS cluster, v AS c FROM ("
        f"SELECT sha256('1:' || vec_id) AS mark, v FROM vectors ORDER BY mark, v LIMIT {k}))",
    ]
    for i in range(rounds):
        parts += [f"a{i} AS ({_nearest(f'c{i}')})", f"c{i + 1} AS ({_moved(f'c{i}', f'a{i}')})"]
    parts.append(f"placed AS ({_nearest(f'c{rounds}')})")
    return (
        f"WITH {', '.join(parts)} SELECT vec_id, cluster, distance, "
        "(sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia, "
        f"sha256(array_to_string(c, ',')) AS centroid_sha256 FROM placed JOIN c{rounds} USING (cluster)"
    )


#: Counts of every term per (lang, source), shares in exact integers, and their differences.
DIVERGENCE = r"""
WITH docs AS (
    SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
    FROM documents),
places AS (SELECT DISTINCT lang, source FROM docs),
said AS (SELECT d, lang, source, unnest(words) AS item FROM docs),
kept AS (SELECT lang, item FROM said GROUP BY lang, item HAVING count(DISTINCT d) >= 30),
counts AS (SELECT lang, source, item, count(*) AS n FROM said SEMI JOIN kept USING (lang, item) GROUP BY lang, source, item),
every AS (
    SELECT lang, source, item, coalesce(n, 0) AS n
    FROM places JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, item)),
shares AS (
    SELECT lang, source, item, n,
           1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER here + 5 * count(*) OVER here) AS p
    FROM every WINDOW here AS (PARTITION BY lang, source)),
whole AS (SELECT lang, item, sum(n) AS n FROM every GROUP BY lang, item),
lang_shares AS (
    SELECT lang, item, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER here + 5 * count(*) OVER here) AS q
    FROM whole WINDOW here AS (PARTITION BY lang)),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
    FROM places a JOIN places b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
    LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.item = x.item
    GROUP BY a.lang, a.source, b.source),
terms AS (
    SELECT lang, source, item, p - q AS value FROM shares JOIN lang_shares USING (lang, item) WHERE n > 0 AND p > q),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
    FROM (SELECT lang, source, 'pair' AS part, item, value FROM pairs
          UNION ALL SELECT lang, source, 'term' AS part, item, value FROM terms))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50
"""
