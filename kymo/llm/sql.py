"""SQL equivalents of the training-data queries."""

from __future__ import annotations


def kmeans_sql(rounds: int = 3, k: int = 16) -> str:
    """Every round as its own named table; floor division by remainder."""
    steps = [
        """kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id,
         list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        "e AS MATERIALIZED (SELECT rid, unnest(range(1, 65)) AS i, unnest(v) AS x FROM kept)",
        f"""c0 AS MATERIALIZED (
  SELECT k, unnest(range(1, 65)) AS i, unnest(v) AS x
  FROM (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS k, v FROM kept) WHERE k < {k})""",
    ]
    for r in range(rounds + 1):
        steps.append(
            f"""a{r} AS MATERIALIZED (
  SELECT rid, k, d FROM (
    SELECT e.rid, c.k, sum((e.x - c.x) * (e.x - c.x)) AS d FROM e JOIN c{r} AS c ON e.i = c.i GROUP BY e.rid, c.k)
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, k) = 1)"""
        )
        if r < rounds:
            steps.append(
                f"""c{r + 1} AS MATERIALIZED (
  SELECT c.k, c.i, CAST(coalesce((s - ((s % n) + n) % n) // n, c.x) AS BIGINT) AS x
  FROM c{r} AS c LEFT JOIN (
    SELECT a.k, e.i, sum(e.x) AS s, count(*) AS n FROM a{r} AS a JOIN e ON e.rid = a.rid GROUP BY a.k, e.i) AS m
  ON c.k = m.k AND c.i = m.i)"""
            )
    return (
        "WITH "
        + ",\n".join(steps)
        + f""",
named AS (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY k)
SELECT kept.vec_id, CAST(a.k AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
       CAST(sum(a.d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.d) OVER () AS BIGINT) AS inertia, named.h AS centroid_sha256
FROM a{rounds} AS a JOIN kept ON kept.rid = a.rid JOIN named ON named.k = a.k"""
    )
