"""DuckDB SQL of the training-data queries that SQL can express.

The SQL compares every part with every entry; it states the result, not the method.
"""

from __future__ import annotations


def ball_codes_sql(parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> str:
    """Product codes by plain k-means on integers; whole numbers in doubles are exact here."""
    nearest = """SELECT vec_id, label, p, arg_min(e, d * 256 + e) AS e, min(d) AS d FROM (
        SELECT s.vec_id, s.label, s.p, b.e,
               CAST(list_inner_product(s.v, s.v) - 2 * list_inner_product(s.v, b.v) + list_inner_product(b.v, b.v) AS BIGINT) AS d
        FROM slices s JOIN book{r} b ON b.p = s.p) GROUP BY vec_id, label, p"""
    steps = [
        f"""whole AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {scale}) AS DOUBLE)) AS x
        FROM embeddings WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""slices AS MATERIALIZED (SELECT vec_id, label, p, x[p * (len(x) // {parts}) + 1 : (p + 1) * (len(x) // {parts})] AS v
        FROM whole, range({parts}) t(p))""",
        f"""book0 AS MATERIALIZED (SELECT p, e, v FROM (
        SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, v FROM slices) WHERE e < {entries})""",
    ]
    for r in range(rounds):
        steps += [
            f"near{r} AS MATERIALIZED ({nearest.format(r=r)})",
            f"""mean{r} AS (SELECT p, e, list(m ORDER BY k) AS v FROM (
            SELECT p, e, k, floor_sum - 0.0 AS m FROM (
            SELECT p, e, k, (s - ((s % n) + n) % n) // n AS floor_sum FROM (
            SELECT n.p, n.e, k, CAST(sum(CAST(s.v[k] AS BIGINT)) AS BIGINT) AS s, count(*) AS n
            FROM near{r} n JOIN slices s ON s.vec_id = n.vec_id AND s.p = n.p, range(1, len(s.v) + 1) t(k)
            GROUP BY n.p, n.e, k))) GROUP BY p, e)""",
            f"""book{r + 1} AS MATERIALIZED (SELECT b.p, b.e, list_transform(coalesce(m.v, b.v), lambda x: CAST(x AS DOUBLE)) AS v
            FROM book{r} b LEFT JOIN mean{r} m ON m.p = b.p AND m.e = b.e)""",
        ]
    steps += [
        f"final AS MATERIALIZED ({nearest.format(r=rounds)})",
        """coded AS (SELECT vec_id, label, string_agg(lower(printf('%02x', e)), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
        FROM final GROUP BY vec_id, label)""",
        f"""hashed AS (SELECT sha256(string_agg(CAST(CAST(c AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, k)) AS h
        FROM (SELECT p, e, k, v[k] AS c FROM book{rounds}, range(1, len(v) + 1) t(k)))""",
    ]
    return (
        "WITH " + ",\n".join(steps) + """
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
    FROM coded, hashed"""
    )
