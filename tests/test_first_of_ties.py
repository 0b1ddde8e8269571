"""arg_min and arg_max: the first of tied rows of a table, rows without a value or an order left out."""

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from millrace.sql import Engine

SQL = [
    "SELECT k, arg_min(v, y) AS a, arg_max(v, y) AS b FROM ties GROUP BY k",
    "SELECT t.k, count(*) AS n, arg_max(t.v, t.y % 2) AS b FROM ties AS t WHERE t.v <> 'x3' AND t.k IN (1, 2) GROUP BY t.k HAVING count(*) > 1 ORDER BY t.k;",
    "SELECT arg_min(v, y) FILTER (WHERE y > 1) AS a, arg_max(v, -y) AS b FROM ties",
]


@pytest.fixture(scope="module")
def ties(spark, tmp_path_factory):
    # Spark reads the larger file first
    folder = tmp_path_factory.mktemp("ties")
    for name, rows in (("a", range(40)), ("b", range(40, 4000)), ("c", range(4000, 4050))):
        made = [(i % 3, None if i % 7 == 0 else f"x{(i * 7919) % 5000}", None if i % 11 == 0 else i % 4) for i in rows]
        pq.write_table(pa.table({"k": [r[0] for r in made], "v": [r[1] for r in made], "y": pa.array([r[2] for r in made], pa.int32())}), folder / f"{name}.parquet", row_group_size=100)
    spark.read.parquet(str(folder)).createOrReplaceTempView("ties")
    return folder


@pytest.mark.parametrize("text", SQL)
def test_first_of_ties(spark, ties, text):
    c = duckdb.connect()
    c.sql("SET threads = 1")
    c.sql(f"CREATE VIEW ties AS SELECT * FROM read_parquet('{ties}/*.parquet')")
    assert sorted(map(tuple, Engine(spark).sql(text).collect())) == sorted(c.sql(text).fetchall())


def test_filter_reaches_the_files(spark, ties):
    plan = Engine(spark).sql("SELECT arg_min(v, y) AS a FROM ties WHERE k = 1 GROUP BY k")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(k,1)" in plan


def test_rows_without_value_or_order_are_left_out(spark):
    spark.sql("SELECT * FROM VALUES (1, 10, 'a'), (2, 20, 'b'), (3, 15, 'c'), (4, 30, NULL), (5, 1, NULL), (4, NULL, 'd'), (5, NULL, 'e') AS t(v1, v2, v3)").createOrReplaceTempView("core")
    engine = Engine(spark)
    assert tuple(engine.sql("SELECT arg_min(v3, v2), arg_max(v3, v2) FROM core").first()) == ("a", "b")
    assert tuple(engine.sql("SELECT arg_min(a.v3, a.v2), arg_max(a.v3, a.v2) FROM core a JOIN core b ON a.v1 = b.v1").first()) == ("a", "b")
    assert tuple(engine.sql("SELECT arg_min(v1, v2), arg_max(v1, v2) FROM (VALUES (1, 2)) AS t(v1, v2) WHERE false").first()) == (None, None)


def test_a_view_of_several_tables(spark, ties):
    spark.sql("SELECT a.v, b.y FROM ties a JOIN ties b ON a.v = b.v").createOrReplaceTempView("tied_twice")
    assert Engine(spark).sql("SELECT arg_max(y, v) AS a FROM tied_twice").count() == 1
