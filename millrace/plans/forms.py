"""SQL forms of operators, integer division, JSON builders and records, regular expressions with groups, and views that follow their tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans.catalogue import ORACLES, register, register_sql
from millrace.plans.timeseries import hourly
from millrace.session import register_tables
from millrace.sql.engine import Engine

register_sql("integer_division", "SELECT o_orderkey, o_orderkey / 7 AS q, o_custkey * 3 / 4 AS r, -o_orderkey / 7 AS m, k / 2 AS h, o_totalprice / 2 AS p FROM (SELECT *, o_custkey + 1 AS k FROM orders) t", "SELECT o_orderkey, o_orderkey // 7 AS q, o_custkey * 3 // 4 AS r, -(o_orderkey // 7) AS m, (o_custkey + 1) // 2 AS h, o_totalprice / 2 AS p FROM orders")
register_sql(
    "jsonb_builders",
    "SELECT c_custkey, jsonb_build_array(c_custkey, c_name, NULL, c_custkey > 5) AS a, jsonb_build_object('k', c_custkey, 'n', jsonb_build_array(c_name)) AS o, jsonb_build_object('k', c_custkey, 'n', jsonb_build_array(c_name)) #>> '{n,0}' AS x, jsonb_path_query_first(jsonb_build_object('l', jsonb_build_array(c_custkey, 7)), '$.l[1]') AS p, jsonb_path_query_array(jsonb_build_array(c_custkey, 3), '$[*] ? (@ > 3)') AS q, jsonb_path_match(jsonb_build_object('k', c_custkey), '$.k > 9') AS m FROM customer",
    "SELECT c_custkey, json_array(c_custkey, c_name, NULL, c_custkey > 5)::varchar AS a, json_object('k', c_custkey, 'n', json_array(c_name))::varchar AS o, c_name AS x, '7' AS p, CASE WHEN c_custkey > 3 THEN json_array(c_custkey) ELSE json_array() END::varchar AS q, c_custkey > 9 AS m FROM customer",
)
register_sql(
    "jsonb_aggregates",
    "SELECT n_regionkey, jsonb_agg(n_name ORDER BY n_name) AS a, jsonb_agg(n_nationkey ORDER BY n_nationkey DESC) FILTER (WHERE n_nationkey > 5) AS f, jsonb_object_agg(n_name, n_nationkey ORDER BY n_name) AS o, array_to_string(array_agg(n_name ORDER BY n_name) FILTER (WHERE n_nationkey > 5), ',') AS g FROM nation GROUP BY n_regionkey",
    "SELECT n_regionkey, to_json(list(n_name ORDER BY n_name))::varchar AS a, to_json(list(n_nationkey ORDER BY n_nationkey DESC) FILTER (WHERE n_nationkey > 5))::varchar AS f, '{' || string_agg('\"' || n_name || '\":' || n_nationkey, ',' ORDER BY n_name) || '}' AS o, string_agg(n_name, ',' ORDER BY n_name) FILTER (WHERE n_nationkey > 5) AS g FROM nation GROUP BY n_regionkey",
)
register_sql(
    "regexp_groups",
    r"SELECT c_custkey, (regexp_match(c_name, '([A-Za-z]+)#0*([0-9]+)'))[2] AS n, array_to_string(regexp_match(c_name, '#0+'), ',') AS w, regexp_replace(c_name, '([A-Za-z]+)#(0)', '\2-\1') AS r, regexp_replace(c_name, '0([1-9])', '<\1>', 'g') AS g, regexp_replace(c_name, '0', '$') AS d, regexp_count(c_name, '0', 12) AS c FROM customer",
    r"SELECT c_custkey, regexp_extract(c_name, '([A-Za-z]+)#0*([0-9]+)', 2) AS n, regexp_extract(c_name, '#0+') AS w, regexp_replace(c_name, '([A-Za-z]+)#(0)', '\2-\1') AS r, regexp_replace(c_name, '0([1-9])', '<\1>', 'g') AS g, regexp_replace(c_name, '0', '$') AS d, len(regexp_extract_all(c_name[12:], '0'))::int AS c FROM customer",
)
register_sql("regexp_matches_rows", "SELECT c_custkey, (regexp_matches(c_name, '0([1-9])', 'g'))[1] AS m FROM customer", "SELECT c_custkey, unnest(regexp_extract_all(c_name, '0([1-9])', 1)) AS m FROM customer")
register_sql(
    "more_scalars",
    "SELECT c_custkey, format('%s: %I (%s)', c_custkey, c_mktsegment, c_nationkey) AS f, trunc(c_acctbal, 1)::double precision AS t, array_length(string_to_array(c_name, '')) AS s, array_sum(ARRAY[c_custkey, 1]) AS a, trim(to_char(c_custkey, '99999999')) AS tc, row(c_custkey, c_nationkey) = row(c_custkey, 3) AS r, concat(VARIADIC ARRAY['a', c_name]) AS v, make_time(c_nationkey % 24, 5, 6) AS mt, encode(convert_to(c_name, 'UTF-8'), 'escape') AS e FROM customer",
    """SELECT c_custkey, c_custkey || ': "' || c_mktsegment || '" (' || c_nationkey || ')' AS f, (trunc(c_acctbal * 10) / 10)::double AS t, 1 AS s, c_custkey + 1 AS a, c_custkey::varchar AS tc, c_nationkey = 3 AS r, 'a' || c_name AS v, lpad((c_nationkey % 24)::varchar, 2, '0') || ':05:06' AS mt, c_name AS e FROM customer""",
)
register_sql("asof_join_sql", "SELECT o.o_orderkey, p.o_orderdate AS before FROM orders o ASOF LEFT JOIN orders p ON o.o_custkey = p.o_custkey AND o.o_orderdate > p.o_orderdate")
register_sql("system_time_join", "SELECT o_orderkey, c_name FROM orders JOIN customer FOR SYSTEM_TIME AS OF PROCTIME() ON o_custkey = c_custkey", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
register_sql("ordinality_sql", "SELECT c_custkey, x, n FROM customer, unnest(string_to_array(c_name, '0')) WITH ORDINALITY AS t(x, n)", "SELECT c_custkey, unnest(l) AS x, unnest(range(1, len(l) + 1)) AS n FROM (SELECT c_custkey, string_split(c_name, '0') AS l FROM customer)")
register_sql("exclude_current_row_sql", "SELECT o_orderkey, sum(o_custkey) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey ROWS BETWEEN 3 PRECEDING AND CURRENT ROW EXCLUDE CURRENT ROW)::bigint AS before, count(*) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING EXCLUDE CURRENT ROW) AS after FROM orders")
register_sql("wrapped_scalars", "SELECT n_regionkey, aggregate:array_sum(n_nationkey) AS s, aggregate:array_max(n_nationkey) AS m FROM nation GROUP BY n_regionkey", "SELECT n_regionkey, sum(n_nationkey)::int AS s, max(n_nationkey) AS m FROM nation GROUP BY n_regionkey")
register_sql("jsonb_records", "SELECT n_nationkey, t.a, t.b FROM nation, jsonb_to_recordset(jsonb_build_array(jsonb_build_object('a', n_nationkey, 'b', n_name), jsonb_build_object('a', 1))) AS t(a int, b text)", "SELECT n_nationkey, unnest([n_nationkey, 1]) AS a, unnest([n_name, NULL]) AS b FROM nation")
register_sql("jsonb_each_rows", "SELECT n_nationkey, t.k, t.v FROM nation, jsonb_each_text(jsonb_build_object('a', n_name, 'b', n_nationkey)) AS t(k, v)", "SELECT n_nationkey, unnest(['a', 'b']) AS k, unnest([n_name, n_nationkey::varchar]) AS v FROM nation")
register_sql("jsonb_path_rows", "SELECT n_nationkey, jsonb_path_query(jsonb_build_object('l', jsonb_build_array(n_nationkey, 7)), '$.l[*]')::int AS v FROM nation", "SELECT n_nationkey, unnest([n_nationkey, 7]) AS v FROM nation")


@register("gap_fill_sql", ORACLES["gap_fill_locf"])
def gap_fill_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly(spark, sf_dir).createOrReplaceTempView("purchases_by_hour")
    filled = Engine(spark).sql("SELECT h, n, v FROM GAP_FILL(purchases_by_hour, h, INTERVAL '1' HOUR, LOCF(v), KEEPNULL(n))")
    return filled.select(F.unix_seconds(F.col("h").cast("timestamp")).alias("h"), "n", "v")


def followed(spark: SparkSession, sf_dir: str, view: str) -> tuple[Engine, str]:
    """An engine with a table of the events, filled in two steps after a view over it was made, and the view's name."""
    register_tables(spark, sf_dir, ("events",))
    engine, name = Engine(spark), uuid.uuid4().hex
    engine.sql(f"CREATE TABLE ev_{name} (event_id BIGINT PRIMARY KEY, ts TIMESTAMP, user_id BIGINT, event_type VARCHAR, WATERMARK FOR ts AS ts - INTERVAL '1 hour')")
    columns = "event_id, ts::timestamp AS ts, user_id, event_type"
    engine.sql(f"INSERT INTO ev_{name} SELECT {columns} FROM events WHERE event_id % 2 = 0")
    engine.sql(f"CREATE MATERIALIZED VIEW mv_{name} AS " + view.replace("{ev}", f"ev_{name}"))
    engine.sql(f"INSERT INTO ev_{name} SELECT {columns} FROM events WHERE event_id % 2 = 1")
    return engine, name


@register("materialized_view", "SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS u FROM events WHERE event_type <> 'view' GROUP BY event_type")
def materialized_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view made before half of the rows came and some went."""
    engine, name = followed(spark, sf_dir, "SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS u FROM {ev} GROUP BY event_type")
    engine.sql(f"DELETE FROM ev_{name} WHERE event_type = 'view'")
    return engine.sql(f"SELECT * FROM mv_{name}")


@register(
    "emit_on_window_close",
    "SELECT epoch(w)::bigint AS w, n FROM (SELECT time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01') AS w, count(*) AS n FROM events GROUP BY ALL) WHERE w + INTERVAL '6 hours' <= (SELECT max(ts) - INTERVAL '1 hour' FROM events)",
)
def emit_on_window_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    engine, name = followed(spark, sf_dir, "SELECT window_start, window_end, count(*) AS n FROM TUMBLE({ev}, ts, INTERVAL '6 hours') GROUP BY window_start, window_end EMIT ON WINDOW CLOSE")
    return engine.sql(f"SELECT * FROM mv_{name}").select(F.unix_seconds(F.col("window_start").cast("timestamp")).alias("w"), "n")


@register("changelog_sql", "SELECT op, count(*) AS n FROM (SELECT 1 AS op FROM nation UNION ALL SELECT unnest([3, 4]) FROM nation WHERE n_regionkey = 1 UNION ALL SELECT 2 FROM nation WHERE n_regionkey = 2) GROUP BY op")
def changelog_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_tables(spark, sf_dir, ("nation",))
    engine, name = Engine(spark), f"n_{uuid.uuid4().hex}"
    engine.script(f"CREATE TABLE {name} (n_nationkey BIGINT PRIMARY KEY, n_regionkey BIGINT); INSERT INTO {name} SELECT n_nationkey, n_regionkey FROM nation; UPDATE {name} SET n_regionkey = 9 WHERE n_regionkey = 1; DELETE FROM {name} WHERE n_regionkey = 2")
    return engine.sql(f"WITH c AS changelog FROM {name} SELECT changelog_op AS op, count(*) AS n FROM c GROUP BY changelog_op")
