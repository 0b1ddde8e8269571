"""More of the SQL surface: projections, correlated subqueries, ignore nulls, ordinality, and auction questions on the events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import grouping as G
from millrace.operators import joins as J
from millrace.operators import time as T
from millrace.plans.catalogue import register, register_sql
from millrace.session import table

register_sql("select_except", "SELECT * EXCEPT (c_name, c_mktsegment, c_acctbal) FROM customer", "SELECT * EXCLUDE (c_name, c_mktsegment, c_acctbal) FROM customer")
register_sql("ignore_nulls", "SELECT k, last_value(v) IGNORE NULLS OVER w AS l, first_value(v) IGNORE NULLS OVER w AS f FROM (SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN c_nationkey END AS v FROM customer) t WINDOW w AS (ORDER BY k ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)", "SELECT k, last_value(v IGNORE NULLS) OVER w AS l, first_value(v IGNORE NULLS) OVER w AS f FROM (SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN c_nationkey END AS v FROM customer) t WINDOW w AS (ORDER BY k ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)")
register_sql("correlated_exists", "SELECT s_suppkey FROM supplier WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey AND l_discount > 0.09) AND NOT EXISTS (SELECT 1 FROM customer WHERE c_nationkey = s_nationkey AND c_acctbal > 9990)")
register_sql("correlated_aggregate", "SELECT o_orderkey FROM orders o WHERE o_totalprice > (SELECT 1.5 * avg(o2.o_totalprice) FROM orders o2 WHERE o2.o_custkey = o.o_custkey)")
register_sql("subquery_in_select_with_limit", "SELECT n_name, (SELECT max(c_name) FROM customer WHERE c_nationkey = n_nationkey AND c_acctbal > 5000) AS top FROM nation")
register_sql("any_all", "SELECT c_custkey FROM customer WHERE c_nationkey = ANY (SELECT n_nationkey FROM nation WHERE n_regionkey = 2)", "SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2)")
register_sql("having_subquery", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) >= (SELECT max(k) - 5 FROM (SELECT count(*) AS k FROM orders GROUP BY o_custkey) t)")
register_sql("distinct_aggregates", "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS supps, sum(DISTINCT l_linenumber)::bigint AS lines FROM lineitem GROUP BY l_returnflag")
register_sql("generate_series_step", "SELECT n_nationkey, generate_series(0, n_nationkey, 5) AS g FROM nation", "SELECT n_nationkey, unnest(generate_series(0, n_nationkey, 5))::int AS g FROM nation")
register_sql("offset_without_limit", "SELECT n_nationkey FROM nation ORDER BY n_nationkey OFFSET 20 ROWS", "SELECT n_nationkey FROM nation ORDER BY n_nationkey OFFSET 20")
register_sql("limit_null", "SELECT n_nationkey FROM nation ORDER BY n_nationkey LIMIT NULL", "SELECT n_nationkey FROM nation")
register_sql("boolean_logic", "SELECT c_custkey, (c_nationkey > 5 AND NULL) IS NULL AS a, (c_nationkey > 5 OR NULL) AS o, NOT (c_nationkey > 5) AS n FROM customer")
register_sql("events_json_by_type", "SELECT event_type, (props->>'k')::int % 10 AS bucket, count(*) AS n, round(avg(value), 6) AS v FROM events GROUP BY event_type, (props->>'k')::int % 10")
register_sql("events_last_row_by_key", "SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) t WHERE r <= 1")
register_sql("events_top_ten_by_user", "SELECT user_id, event_id, r FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS r FROM events) t WHERE r <= 10")
register_sql("events_active_users", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id HAVING count(*) >= (SELECT count(*) / count(DISTINCT user_id) FROM events)", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id HAVING count(*) >= (SELECT count(*) // count(DISTINCT user_id) FROM events)")
register_sql("events_window_max", "SELECT e.event_id, EXTRACT(epoch FROM m.window_end)::bigint AS w FROM TUMBLE(events, ts, INTERVAL '1 hour') e JOIN (SELECT max(value) AS top, window_end FROM TUMBLE(events, ts, INTERVAL '1 hour') GROUP BY window_end) m ON e.value = m.top AND e.window_end = m.window_end", "SELECT event_id, epoch(w)::bigint + 3600 AS w FROM (SELECT event_id, value, time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01') AS w, max(value) OVER (PARTITION BY time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01')) AS top FROM events) WHERE value = top")
register_sql("documents_by_language", "SELECT lang, count(*) AS n, sum(n_chars)::bigint AS chars, max(length(text))::int AS longest FROM documents GROUP BY lang")
register_sql("benchmark_and_conversations", "SELECT role, count(*) AS n, count(DISTINCT conv_id) AS talks, max(turn) AS turns FROM conversations GROUP BY role")
register_sql("pages_by_host", r"SELECT split_part(split_part(url, '://', 2), '/', 1) AS host, count(*) AS n, sum(length(html))::bigint AS size FROM pages GROUP BY split_part(split_part(url, '://', 2), '/', 1)")


@register("union_corresponding", "SELECT n_nationkey AS k, n_name AS name FROM nation UNION SELECT r_regionkey, r_name FROM region")
def union_corresponding(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), "n_regionkey", F.col("n_name").alias("name"))
    b = table(spark, sf_dir, "region").select(F.col("r_name").alias("name"), F.col("r_regionkey").alias("k"))
    return G.union(a, b, all_rows=False, corresponding=True)


@register("with_ordinality", "SELECT n_nationkey, a, row_number() OVER (PARTITION BY n_nationkey ORDER BY a) AS n FROM (SELECT n_nationkey, unnest(range(n_nationkey % 4))::bigint AS a FROM nation)")
def with_ordinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey")
    numbers = F.expr("CASE WHEN n_nationkey % 4 > 0 THEN sequence(0L, n_nationkey % 4 - 1L) ELSE CAST(array() AS array<bigint>) END")
    return G.project_set(nation, ["n_nationkey"], ordinality="n", a=numbers)


@register("window_join", "SELECT a.user_id, epoch(a.w)::bigint AS w, a.n AS views, b.n AS purchases FROM (SELECT user_id, time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01') AS w, count(*) AS n FROM events WHERE event_type = 'view' GROUP BY ALL) a JOIN (SELECT user_id, time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01') AS w, count(*) AS n FROM events WHERE event_type = 'purchase' GROUP BY ALL) b ON a.user_id = b.user_id AND a.w = b.w")
def window_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = lambda kind, user, n: T.tumble(table(spark, sf_dir, "events").filter(F.col("event_type") == kind), "ts", "6 hours").groupBy(F.col("user_id").alias(user), "window_start", "window_end").agg(F.count("*").alias(n))
    a, b = counted("view", "user_id", "views"), counted("purchase", "other", "purchases")
    return J.window_join(a, b, [("user_id", "other")]).select("user_id", F.unix_seconds(F.col("window_start").cast("timestamp")).alias("w"), "views", "purchases")


@register("set_operators", "SELECT 'i' AS op, count(*) AS n FROM (SELECT c_nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier) UNION ALL SELECT 'e', count(*) FROM (SELECT c_nationkey FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier)")
def set_operators(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, s = table(spark, sf_dir, "customer").select("c_nationkey"), table(spark, sf_dir, "supplier").select("s_nationkey")
    return G.intersect(c, s).agg(F.lit("i").alias("op"), F.count("*").alias("n")).union(G.except_(c, s, all_rows=True).agg(F.lit("e").alias("op"), F.count("*").alias("n")))


@register("rollup_operator", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)")
def rollup_operator(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.rollup(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"], [F.count("*").alias("n")])


@register("grouping_sets_operator", "SELECT p_brand, p_size, count(*) AS n FROM part GROUP BY GROUPING SETS ((p_brand), (p_size))")
def grouping_sets_operator(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.grouping_sets(table(spark, sf_dir, "part"), [["p_brand"], ["p_size"]], [F.count("*").alias("n")])


@register("exclude_current_row", "SELECT c_custkey, round(sum(c_acctbal) OVER w, 4) AS s, count(c_acctbal) OVER w AS n, max(c_acctbal) OVER w AS m FROM customer WINDOW w AS (PARTITION BY c_nationkey ORDER BY c_custkey ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING EXCLUDE CURRENT ROW)")
def exclude_current_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.operators.windows import excluding_current_row

    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    for function, name in (("sum", "s"), ("count", "n"), ("max", "m")):
        rows = excluding_current_row(rows, ["c_nationkey"], [F.col("c_custkey")], "c_acctbal", function, name, -2, 2)
    return rows.select("c_custkey", F.round("s", 4).alias("s"), "n", "m")


@register("table_as_of_version", "SELECT count(*) AS now, (SELECT count(*) FROM region WHERE r_regionkey < 3) AS before FROM region")
def table_as_of_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.sources.tables import Table

    rows = table(spark, sf_dir, "region")
    kept = Table(spark, "versions", rows.schema, ["r_regionkey"])
    kept.insert(rows.filter("r_regionkey < 3"))
    then = kept.version
    kept.insert(rows)
    return kept.read().agg(F.count("*").alias("now")).crossJoin(kept.read(then).agg(F.count("*").alias("before")))
