"""The clustering of op12 in DuckDB SQL: every round is one more pair of tables."""

START = """
WITH kept AS (
    SELECT row_number() OVER () AS row, vec_id, embedding FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x::DOUBLE))) = 64
), parts AS (
    SELECT row, unnest(range(64)) AS dim, unnest(embedding) AS x FROM kept
), vectors AS (
    SELECT row, dim, floor(256 * x::DOUBLE)::BIGINT AS v FROM parts
), drawn AS (
    SELECT row, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS cluster FROM kept
    QUALIFY cluster < {k}
), centroids0 AS (
    SELECT cluster, dim, v AS c FROM drawn JOIN vectors USING (row)
)"""

ASSIGNED = """, distances{r} AS (
    SELECT row, cluster, sum((v - c) * (v - c)) AS distance
    FROM vectors JOIN centroids{r} USING (dim) GROUP BY row, cluster
), assigned{r} AS (
    SELECT row, cluster, distance FROM distances{r}
    QUALIFY row_number() OVER (PARTITION BY row ORDER BY distance, cluster) = 1
)"""

MOVED = """, sums{r} AS (
    SELECT cluster, dim, sum(v) AS s, count(*) AS n FROM assigned{r} JOIN vectors USING (row) GROUP BY cluster, dim
), centroids{next} AS (
    SELECT cluster, dim, coalesce((s - ((s % n) + n) % n) // n, c) AS c FROM centroids{r} LEFT JOIN sums{r} USING (cluster, dim)
)"""

END = """, digests AS (
    SELECT cluster, sha256(string_agg(c::VARCHAR, ',' ORDER BY dim)) AS centroid_sha256 FROM centroids{r} GROUP BY cluster
)
SELECT vec_id, cluster::INTEGER AS cluster, distance::BIGINT AS distance,
    (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
    (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM assigned{r} JOIN kept USING (row) JOIN digests USING (cluster)
"""


def sql(k: int, rounds: int) -> str:
    text = START.format(k=k)
    for r in range(rounds):
        text += ASSIGNED.format(r=r) + MOVED.format(r=r, next=r + 1)
    return text + ASSIGNED.format(r=rounds) + END.format(r=rounds)


SQL = sql(40, 5)
