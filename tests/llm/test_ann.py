import math

import numpy as np
import pytest

from millrace.llm import ann
from millrace.llm.queries import op6_neighbours

SCHEMA = "vec_id long, embedding array<float>, digest int"


def brute(rows, k=5, every=50):
    """Each query's ranks, by exact cosine in double precision."""
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for a, (i, v) in enumerate(good):
        if i % every == 0:
            near = sorted((-float((v * w).sum() / (np.sqrt((v * v).sum()) * np.sqrt((w * w).sum()))), j) for b, (j, w) in enumerate(good) if a != b and len(v) == len(w))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(near[:k])]
    return sorted(out)


def check_exact(got, want):
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(abs(g[3] - w[3]) < 1e-12 for g, w in zip(got, want))


def test_small_and_odd_rows_exactly(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(-2, 3, 6).astype(float).tolist()) for i in range(200)]
    rows += [(300, None), (350, []), (400, [0.0] * 6), (450, [float("nan")] + [1.0] * 5), (500, [None] + [1.0] * 5), (550, [float("inf")] + [1.0] * 5), (None, [1.0] * 6), (600, [1.0, 2.0]), (601, [1.0, 3.0])]
    rows += [(650, [1.0] * 6), (650, [1.0] * 6), (651, [2.0] * 6), (700, [1e-30] * 6), (750, [1e30, 0.0, 0.0, 0.0, 0.0, 0.0]), (800, [7.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    check_exact(sorted(map(tuple, ann.neighbours(df).collect())), brute(rows))


def test_ties_in_a_large_group_of_equal_vectors(spark):
    rng = np.random.default_rng(2)
    one = rng.standard_normal(16).astype(np.float32).tolist()
    rows = [(i, one if i % 3 == 0 else rng.standard_normal(16).astype(np.float32).tolist()) for i in range(3000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    got = {(r.query_id, r.rank): r.vec_id for r in ann.neighbours(df).filter("query_id % 3 = 0").collect()}
    for q in range(0, 3000, 150):
        assert [got[q, r] for r in range(1, 6)] == [i for i in (0, 3, 6, 9, 12, 15) if i != q][:5]


@pytest.mark.parametrize("block", [700, 32768])
def test_blocks_and_recall(spark, block):
    sf = "/root/testdata/sf0.1"
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.select("vec_id", "embedding").collect()]
    got = ann.searched(df, df.filter("vec_id % 50 = 0"), block=block).collect()
    want = {(q, j) for q, _, j, _ in brute(rows)}
    assert len(got) == len(want)
    assert len({(r.query_id, r.vec_id) for r in got} & want) / len(want) > 0.93
    assert {r["rank"] for r in got} == {1, 2, 3, 4, 5}


def test_empty_table(spark):
    assert ann.neighbours(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = {(r.query_id, r.vec_id) for r in op6_neighbours(spark, sf).collect()}
    want = {(q, j) for q, _, j, _ in brute(rows)}
    assert len(got) == len(want) and len(got & want) / len(want) > 0.93
