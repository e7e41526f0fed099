"""Queries of the vector operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from roispark.llm import codes
from roispark.llm.common import table
from roispark.llm.forest import nearest


def neighbours(spark, sf_dir):
    return nearest(table(spark, sf_dir, "embeddings"))


def vector_codes(spark, sf_dir):
    coded, books = codes.compress(table(spark, sf_dir, "embeddings"), keep=["label"])
    return codes.with_group_error(coded, "label").select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", F.col("group_error").alias("label_error"),
        F.lit(codes.books_digest(books)).alias("codebooks_sha256"))


def _codes_sql() -> str:
    """The rounds written out; ``nearest`` packs distance and index into one integer, so ties go to the lower index."""
    steps = ["""kept AS (SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label,
        list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        """cell AS (SELECT rid, (i - 1) // (len(q) // 4) AS p, (i - 1) % (len(q) // 4) AS j, q[i] AS v
        FROM (SELECT rid, q, unnest(range(1, len(q) + 1)) AS i FROM kept))""",
        "book0 AS (SELECT p, rid - 1 AS e, j, v AS c FROM cell WHERE rid <= 256)"]
    for r in range(codes.ROUNDS + 1):
        steps.append(f"""near{r} AS (SELECT rid, p, min(d * 256 + e) AS m FROM (
            SELECT rid, p, e, sum((v - c) * (v - c)) AS d FROM cell JOIN book{r} USING (p, j) GROUP BY ALL) GROUP BY ALL)""")
        if r < codes.ROUNDS:
            steps.append(f"""book{r + 1} AS (SELECT p, e, j, coalesce((s - ((s % n) + n) % n) // n, c) AS c FROM book{r} LEFT JOIN (
                SELECT p, m % 256 AS e, j, sum(v) AS s, count(*) AS n FROM near{r} JOIN cell USING (rid, p) GROUP BY ALL)
                USING (p, e, j))""")
    r = codes.ROUNDS
    steps.append(f"""coded AS (SELECT rid, string_agg(printf('%02x', CAST(m % 256 AS BIGINT)), '' ORDER BY p) AS code,
        CAST(sum(m // 256) AS BIGINT) AS error FROM near{r} GROUP BY rid)""")
    steps.append(f"digest AS (SELECT sha256(string_agg(CAST(CAST(c AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, j)) AS h FROM book{r})")
    parts = ", ".join(s.replace(" AS (", " AS MATERIALIZED (", 1) for s in steps)
    return f"""WITH {parts} SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
        h AS codebooks_sha256 FROM kept JOIN coded USING (rid), digest"""


QUERIES = {"op5_nearest_neighbours": neighbours, "op13_vector_codes": vector_codes}
SQL: dict[str, str] = {"op13_vector_codes": _codes_sql()}
