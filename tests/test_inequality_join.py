"""Joins by inequalities alone are equi joins on tree nodes, never a product."""

import itertools

import duckdb
import pytest

from millrace.plans import QUERIES
from millrace.sql import Engine

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_theta_query_has_no_nested_loop(spark):
    text = plan(QUERIES["join_theta"](spark, SF))
    assert "NestedLoop" not in text and "CartesianProduct" not in text


@pytest.mark.parametrize("on", [
    "a.n < b.n AND a.d > b.d + 0.5", "b.n >= a.n AND a.d <= b.d", "a.k > b.k", "a.k <= b.k AND a.n > b.n AND a.d < b.d", "a.t < b.t AND a.n >= b.n - 2",
])
def test_inequalities_against_duckdb(spark, on):
    source = "SELECT i::int AS i, nullif(i * 7 % 23, 5)::int AS n, CASE WHEN i % 31 = 0 THEN 'nan' ELSE i * 37 % 101 / 8.0 END::double AS d, (1152921504606846976 + i * 13 % 400)::bigint AS k, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(i * 17 % 97) AS t FROM range(150) r(i)"
    c = duckdb.connect()
    c.sql(f"CREATE TABLE rows_a AS {source}")
    rows = c.sql("SELECT * FROM rows_a").fetchall()
    spark.createDataFrame([*rows, rows[3]], "i int, n int, d double, k bigint, t timestamp_ntz").createOrReplaceTempView("rows_a")
    c.sql("INSERT INTO rows_a SELECT * FROM rows_a WHERE i = 3")
    text = f"SELECT a.i AS x, b.i AS y, b.n FROM rows_a a JOIN rows_a b ON {on}"
    df = Engine(spark).sql(text)
    assert "NestedLoop" not in plan(df)
    key = lambda r: tuple((v is None, v or 0) for v in r)
    want = sorted(map(tuple, c.sql(text).fetchall()), key=key)
    assert sorted(map(tuple, df.collect()), key=key) == want and len(want) > 1000


def test_what_is_no_plain_inequality_goes_the_usual_way(spark):
    spark.createDataFrame([(k, k % 3, f"w{k}") for k in range(12)], "i int, g int, w string").createOrReplaceTempView("rows_b")
    rows = list(itertools.product(range(12), range(12)))
    sql = Engine(spark).sql
    assert sql("SELECT count(*) AS n FROM rows_b a JOIN rows_b b ON a.g = b.g AND a.i < b.i").first()[0] == sum(x % 3 == y % 3 and x < y for x, y in rows)
    assert sql("SELECT count(*) AS n FROM rows_b a JOIN rows_b b ON a.i < b.i OR a.g > b.g").first()[0] == sum(x < y or x % 3 > y % 3 for x, y in rows)
    assert sql("SELECT count(*) AS n FROM rows_b a JOIN rows_b b ON a.w < b.w WHERE b.i > 4").first()[0] == sum(f"w{x}" < f"w{y}" and y > 4 for x, y in rows)
    assert sql("SELECT a.g, count(*) AS n FROM rows_b a JOIN rows_b b ON a.i < b.i WHERE b.i > 4 GROUP BY a.g").collect() and sql("SELECT * FROM rows_b a JOIN rows_b b ON a.i < b.i").columns == ["i", "g", "w"] * 2
