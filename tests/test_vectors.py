"""The blocked lookup join against brute force."""

import numpy as np
import pytest

from millrace.operators import vectors as V
from millrace.plans import QUERIES

QUERY, VECTOR = "query_id long, query array<float>", "vec_id long, vector array<float>"


def brute(queries, vectors, k, metric):
    def distance(a, b):
        if a is None or b is None or len(a) != len(b) or None in a or None in b:
            return None
        a, b = np.array(a, float), np.array(b, float)
        if metric == "cosine":
            n = np.sqrt(a @ a) * np.sqrt(b @ b)
            return 1 - a @ b / n if n else None
        return {"l2": ((a - b) ** 2).sum(), "l1": np.abs(a - b).sum(), "inner_product": -(a @ b)}[metric]

    out = set()
    for q, a in queries:
        near = sorted((d is None, round(d or 0.0, 9), i) for i, b in vectors for d in [distance(a, b)])
        out |= {(q, i, r + 1) for r, (_, _, i) in enumerate(near[:k])}
    return out


@pytest.mark.parametrize("metric", sorted(V.DISTANCES))
@pytest.mark.parametrize("block", [30, 8192])
def test_lookup_join_in_blocks(spark, metric, block):
    rng = np.random.default_rng(3)
    vectors = [(i, rng.integers(-3, 4, 5).astype(float).tolist() if i % 3 else [1.0, 2.0, -1.0, 0.0, 3.0]) for i in range(90)]
    vectors += [(90, None), (91, [1.0, None, 0.0, 0.0, 0.0]), (92, [0.0] * 5), (93, [1.0, 2.0]), (94, [])]
    queries = [*vectors[:20], *vectors[90:]]
    if metric == "cosine":  # no ties but of equal vectors
        vectors = [(i, (rng.standard_normal(5).tolist() if i % 3 else v)) if i < 90 else (i, v) for i, v in vectors]
    vectors = [(i, v and [x if x is None else float(np.float32(x)) for x in v]) for i, v in vectors]
    got = V.lookup_join(spark.createDataFrame(queries, QUERY), spark.createDataFrame(vectors, VECTOR), 4, metric, block=block)
    assert {(r.query_id, r.vec_id, r["rank"]) for r in got.collect()} == brute(queries, vectors, 4, metric)


def test_more_queries_than_ten_thousand(spark):
    queries = spark.range(10_050).selectExpr("id AS query_id", "array(CAST(id AS FLOAT), 0F) AS query")
    vectors = spark.range(0, 10_050, 50).selectExpr("id AS vec_id", "array(CAST(id AS FLOAT), 0F) AS vector")
    got = {(r.query_id, r.vec_id): r.distance for r in V.lookup_join(queries, vectors, 1).collect()}
    assert len(got) == 10_050 and all(d == abs(q - v) <= 25 or q > 10_000 for (q, v), d in got.items())


def test_every_row_is_a_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet")
    got = QUERIES["vector_lookup_join"](spark, sf)
    assert got.select("query_id").distinct().count() == rows.select("vec_id").distinct().count() > 100
