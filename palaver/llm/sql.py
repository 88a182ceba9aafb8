"""DuckDB SQL of the clustering and of the prefix trie, put together from their rounds."""

from __future__ import annotations


def sort_means_sql(rounds: int = 10, k: int = 8, dims: int = 64, scale: int = 1024, seed: str = "3") -> str:
    parts = [
        f"""v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}
)""",
        f"""c0 AS (
  SELECT row_number() OVER (ORDER BY digest) - 1 AS k, x
  FROM (SELECT sha256('{seed}:' || vec_id) AS digest, x FROM v ORDER BY digest LIMIT {k})
)""",
    ]
    for i in range(rounds + 1):
        parts.append(
            f"""a{i} AS (
  SELECT v.vec_id, min({{'d': list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT, 'k': c.k}}) AS m
  FROM v, c{i} AS c GROUP BY v.vec_id
)"""
        )
        if i < rounds:
            parts.append(
                f"""s{i} AS (
  SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY j) AS x FROM (
    SELECT m.k AS k, j, sum(e)::BIGINT AS s, count(*) AS n
    FROM (SELECT a.m, unnest(v.x) AS e, generate_subscripts(v.x, 1) AS j FROM a{i} AS a JOIN v USING (vec_id)) GROUP BY ALL
  ) GROUP BY k
), c{i + 1} AS (SELECT c.k, coalesce(s.x, c.x) AS x FROM c{i} AS c LEFT JOIN s{i} AS s USING (k))"""
            )
    return f"""
WITH {", ".join(parts)}, t AS (SELECT m.k AS k, sum(m.d)::BIGINT AS cluster_inertia FROM a{rounds} GROUP BY m.k)
SELECT a.vec_id, a.m.k::INTEGER AS cluster, a.m.d AS distance, t.cluster_inertia, (SELECT sum(cluster_inertia)::BIGINT FROM t) AS inertia,
       sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} AS a JOIN c{rounds} AS c ON a.m.k = c.k JOIN t ON t.k = c.k"""


#: crc32 of an ASCII text, bit by bit.
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({0}, ''), lambda s: ascii(s)::BIGINT)),
    lambda r, b: list_reduce([xor(r, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)))"""


def prefix_trie_sql(family: int = 20, longest: int = 3) -> str:
    h = f"({_CRC.format('conv_id::VARCHAR')} % {longest + 1})"
    return f"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (SELECT conv_id, {h} AS h FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
  SELECT c.conv_id, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % {family} AND t.pos <= c.h
  UNION ALL SELECT c.conv_id, t.pos + {longest}, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h
), chained AS (
  SELECT conv_id, row_number() OVER w AS depth, list(md5(length(role) || ':' || role || text)) OVER w AS path,
         len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY pos)
), paths AS (
  SELECT conv_id, 0 AS depth, []::VARCHAR[] AS path, 0 AS words FROM convs UNION ALL SELECT * FROM chained
), hashed AS (
  SELECT conv_id, depth, md5(array_to_string(path, ',')) AS node, CASE WHEN depth > 0 THEN md5(array_to_string(path[:-2], ',')) END AS parent, words,
         depth = max(depth) OVER (PARTITION BY conv_id) AS last
  FROM paths
), nodes AS (
  SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE last), '')) AS ends_sha256,
         count(*) FILTER (WHERE last) = count(*) AS leaf, max(words) AS words
  FROM hashed GROUP BY node
), under AS (
  SELECT DISTINCT a.node AS top, b.node FROM hashed a JOIN hashed b ON a.conv_id = b.conv_id AND b.depth >= a.depth
), sums AS (
  SELECT u.top AS node, count(*) FILTER (WHERE n.leaf) AS n_leaves, sum((n.n_convs - 1) * n.words)::BIGINT AS saved_tokens
  FROM under u JOIN nodes n ON u.node = n.node GROUP BY u.top
), children AS (SELECT parent AS node, count(*) AS n_children FROM nodes GROUP BY parent)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s USING (node) LEFT JOIN children c USING (node) LEFT JOIN nodes p ON n.parent = p.node"""
