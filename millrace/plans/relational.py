"""Relational queries over the driver's tables: joins, subqueries, grouping, windows, sets, top-n."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from millrace.operators import grouping as G
from millrace.operators import joins as J
from millrace.operators import ranking as R
from millrace.plans.catalogue import register, register_sql
from millrace.session import table

register_sql(
    "tpch_q1",
    """
    SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base_price,
           round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price,
           round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS sum_charge,
           round(avg(l_quantity), 6) AS avg_qty, count(*) AS count_order
    FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02 00:00:00' GROUP BY l_returnflag, l_linestatus
    """,
)
register_sql(
    "tpch_q3",
    """
    SELECT l_orderkey, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, CAST(o_orderdate AS DATE) AS orderdate
    FROM customer, orders, lineitem
    WHERE c_mktsegment = 'BUILDING' AND c_custkey = o_custkey AND l_orderkey = o_orderkey AND o_orderdate < TIMESTAMP '1995-03-15 00:00:00' AND l_shipdate > TIMESTAMP '1995-03-15 00:00:00'
    GROUP BY l_orderkey, CAST(o_orderdate AS DATE) ORDER BY revenue DESC, l_orderkey LIMIT 10
    """,
)
register_sql(
    "tpch_q4",
    """
    SELECT o_orderpriority, count(*) AS order_count FROM orders
    WHERE o_orderdate >= TIMESTAMP '1993-07-01 00:00:00' AND o_orderdate < TIMESTAMP '1996-10-01 00:00:00'
      AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 40)
    GROUP BY o_orderpriority
    """,
)
register_sql(
    "tpch_q5",
    """
    SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
    FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE r_name = 'ASIA' GROUP BY n_name
    """,
)
register_sql("tpch_q6", "SELECT round(sum(l_extendedprice * l_discount), 2) AS revenue FROM lineitem WHERE l_shipdate >= TIMESTAMP '1994-01-01 00:00:00' AND l_shipdate < TIMESTAMP '1995-01-01 00:00:00' AND l_discount BETWEEN 0.05 AND 0.07 AND l_quantity < 24")
register_sql(
    "tpch_q10",
    """
    SELECT c_custkey, c_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, n_name
    FROM customer, orders, lineitem, nation
    WHERE c_custkey = o_custkey AND l_orderkey = o_orderkey AND l_returnflag = 'R' AND c_nationkey = n_nationkey
    GROUP BY c_custkey, c_name, n_name ORDER BY revenue DESC, c_custkey LIMIT 20
    """,
)
register_sql(
    "tpch_q12",
    """
    SELECT l_linestatus, sum(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END)::bigint AS high, sum(CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END)::bigint AS low
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY l_linestatus
    """,
)
register_sql("tpch_q13", "SELECT c_count, count(*) AS custdist FROM (SELECT c_custkey, count(o_orderkey) AS c_count FROM customer LEFT OUTER JOIN orders ON c_custkey = o_custkey AND o_orderpriority <> '1-URGENT' GROUP BY c_custkey) AS c GROUP BY c_count")
register_sql("tpch_q14", "SELECT round(100.0 * sum(CASE WHEN p_type LIKE 'PROMO%' THEN l_extendedprice * (1 - l_discount) ELSE 0 END) / sum(l_extendedprice * (1 - l_discount)), 6)::double precision AS promo_revenue FROM lineitem, part WHERE l_partkey = p_partkey")
register_sql(
    "tpch_q17",
    """
    SELECT round(sum(l_extendedprice) / 7.0, 2)::double precision AS avg_yearly FROM lineitem, part
    WHERE p_partkey = l_partkey AND p_size < 10 AND l_quantity < (SELECT 0.5 * avg(l2.l_quantity) FROM lineitem AS l2 WHERE l2.l_partkey = p_partkey)
    """,
)
register_sql("tpch_q18", "SELECT c_name, o_orderkey, sum(l_quantity) AS qty FROM customer, orders, lineitem WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING sum(l_quantity) > 200) AND c_custkey = o_custkey AND o_orderkey = l_orderkey GROUP BY c_name, o_orderkey")
register_sql("tpch_q22", "SELECT c_nationkey, count(*) AS numcust, round(sum(c_acctbal), 2) AS total FROM customer WHERE c_acctbal > (SELECT avg(c_acctbal) FROM customer WHERE c_acctbal > 0) AND NOT EXISTS (SELECT * FROM orders WHERE o_custkey = c_custkey) GROUP BY c_nationkey")

register_sql("join_full_outer", "SELECT c.c_custkey AS custkey, s.s_suppkey AS suppkey FROM customer c FULL OUTER JOIN supplier s ON c.c_custkey = s.s_suppkey AND s.s_acctbal > 0")
register_sql("join_right", "SELECT n.n_name, s.s_suppkey FROM supplier s RIGHT JOIN nation n ON s.s_nationkey = n.n_nationkey")
register_sql("join_using_natural", "SELECT r_name, count(*) AS n FROM (SELECT n_nationkey AS k, n_regionkey FROM nation) a JOIN (SELECT c_nationkey AS k FROM customer) b USING (k) JOIN region ON r_regionkey = n_regionkey GROUP BY r_name")
register_sql("join_cross", "SELECT r_name, n_name FROM region CROSS JOIN nation")
register_sql("join_theta", "SELECT a.p_partkey AS a, b.p_partkey AS b FROM part a JOIN part b ON a.p_size < b.p_size AND a.p_retailprice > b.p_retailprice + 900")
register_sql("join_lateral", "SELECT n_name, top.c_custkey FROM nation, LATERAL (SELECT c_custkey FROM customer WHERE c_nationkey = n_nationkey ORDER BY c_acctbal DESC, c_custkey LIMIT 2) AS top")
register_sql("not_in_and_in", "SELECT count(*) AS n FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 100000) AND c_nationkey IN (1, 2, 3, 4, 5, 6, 7)")
register_sql("set_operations", "(SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier) EXCEPT SELECT n_nationkey FROM nation WHERE n_regionkey = 0 UNION ALL SELECT r_regionkey FROM region")
register_sql("set_operations_all", "SELECT c_nationkey AS k FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier")
register_sql("intersect_all", "SELECT c_nationkey AS k FROM customer INTERSECT ALL SELECT s_nationkey FROM supplier")
register_sql("values_and_limit", "SELECT v.a, v.b FROM (VALUES (1, 'x'), (2, 'y'), (3, NULL)) AS v(a, b) ORDER BY v.b DESC, v.a LIMIT 2", "SELECT v.a, v.b FROM (VALUES (1, 'x'), (2, 'y'), (3, NULL)) AS v(a, b) ORDER BY v.b DESC NULLS FIRST, v.a LIMIT 2")
register_sql("distinct_on", "SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_totalprice FROM orders ORDER BY o_custkey, o_totalprice DESC, o_orderkey")
register_sql("with_ties", "SELECT p_partkey, p_size FROM part ORDER BY p_size DESC FETCH FIRST 5 ROWS WITH TIES", "SELECT p_partkey, p_size FROM (SELECT p_partkey, p_size, rank() OVER (ORDER BY p_size DESC) AS r FROM part) WHERE r <= 5")
register_sql("null_ordering", "SELECT k, row_number() OVER (ORDER BY v DESC, k) AS down, row_number() OVER (ORDER BY v, k) AS up FROM (SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_nationkey END AS v FROM customer) t", "SELECT k, row_number() OVER (ORDER BY v DESC NULLS FIRST, k) AS down, row_number() OVER (ORDER BY v NULLS LAST, k) AS up FROM (SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_nationkey END AS v FROM customer) t")
register_sql("grouping_sets", "SELECT o_orderstatus, o_orderpriority, count(*) AS n, grouping(o_orderstatus)::int AS g1, grouping(o_orderpriority)::int AS g2 FROM orders GROUP BY GROUPING SETS ((o_orderstatus, o_orderpriority), (o_orderstatus), ())")
register_sql("rollup_sql", "SELECT p_brand, p_size, count(*) AS n, round(sum(p_retailprice), 2) AS total FROM part GROUP BY ROLLUP (p_brand, p_size)")
register_sql("cube_sql", "SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
register_sql("aggregate_filter", "SELECT o_orderstatus, count(*) FILTER (WHERE o_totalprice > 100000) AS big, count(DISTINCT o_custkey) AS customers, count(DISTINCT o_custkey) FILTER (WHERE o_totalprice > 200000) AS rich FROM orders GROUP BY o_orderstatus HAVING count(*) > 1")
register_sql("window_ranks", "SELECT c_custkey, rank() OVER w AS r, dense_rank() OVER w AS d, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey) AS n FROM customer WINDOW w AS (PARTITION BY c_nationkey ORDER BY c_mktsegment)")
register_sql("window_lag_lead", "SELECT o_orderkey, lag(o_totalprice) OVER w AS before, lead(o_totalprice, 2) OVER w AS after, lag(o_orderkey, 1, -1::bigint) OVER w AS filled FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)")
register_sql("window_frames", "SELECT l_orderkey, l_linenumber, sum(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_extendedprice ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS near, max(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber RANGE BETWEEN 2 PRECEDING AND CURRENT ROW) AS back, first_value(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_extendedprice) AS first_part, last_value(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_extendedprice ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_part FROM lineitem")
register_sql("scalar_subquery", "SELECT n_name, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS customers, (SELECT max(s_acctbal) FROM supplier WHERE s_nationkey = n_nationkey) AS best FROM nation")
register_sql("cte_shared", "WITH spend AS (SELECT o_custkey, sum(o_totalprice) AS total FROM orders GROUP BY o_custkey) SELECT count(*) AS n FROM spend a JOIN spend b ON a.o_custkey = b.o_custkey WHERE a.total >= b.total")
register_sql("case_and_coalesce", "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'some' ELSE 'much' END AS class, coalesce(nullif(c_nationkey, 3), -1) AS nation, greatest(c_nationkey, 7) AS g, least(c_nationkey, 7) AS l FROM customer")


@register("asof_join", "SELECT e.event_id, r.event_id AS before_id FROM events e ASOF JOIN (SELECT user_id, ts, min(event_id) AS event_id FROM events WHERE event_type = 'click' GROUP BY user_id, ts) r ON e.user_id = r.user_id AND e.ts > r.ts")
def asof_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    clicks = events.filter("event_type = 'click'").select("user_id", F.col("ts").alias("click_ts"), F.col("event_id").alias("before_id"))
    return J.asof_join(events.select("event_id", "user_id", "ts"), clicks, ["user_id"], ("ts", ">", "click_ts"), tie=["before_id"]).select("event_id", "before_id")


@register("asof_join_left", "SELECT e.event_id, r.event_id AS after_id FROM events e ASOF LEFT JOIN (SELECT user_id, ts, min(event_id) AS event_id FROM events WHERE event_type = 'purchase' GROUP BY user_id, ts) r ON e.user_id = r.user_id AND e.ts <= r.ts")
def asof_join_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    later = events.filter("event_type = 'purchase'").select("user_id", F.col("ts").alias("at"), F.col("event_id").alias("after_id"))
    return J.asof_join(events.select("event_id", "user_id", "ts"), later, ["user_id"], ("ts", "<=", "at"), "left", ["after_id"]).select("event_id", "after_id")


@register("range_join", "SELECT p_partkey, low FROM part JOIN (SELECT c_custkey AS low, c_custkey + 10 AS high FROM customer) r ON p_size >= low AND p_size < high")
def range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer makes a range."""
    ranges = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("low"), (F.col("c_custkey") + 10).alias("high"))
    return J.range_join(table(spark, sf_dir, "part"), ranges, "p_size", "low", "high", 10).select("p_partkey", "low")


@register("interval_join", "SELECT a.event_id AS a, b.event_id AS b FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts BETWEEN a.ts - INTERVAL '1 hour' AND a.ts + INTERVAL '2 hours' WHERE a.event_type = 'view' AND b.event_type = 'purchase'")
def interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    a = events.filter("event_type = 'view'").select(F.col("event_id").alias("a"), F.col("user_id").alias("ua"), F.col("ts").alias("ta"))
    b = events.filter("event_type = 'purchase'").select(F.col("event_id").alias("b"), F.col("user_id").alias("ub"), F.col("ts").alias("tb"))
    return J.interval_join(a, b, [("ua", "ub")], ("ta", "tb"), "1 hour", "2 hours").select("a", "b")


@register("temporal_join", "SELECT o_orderkey, c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def temporal_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.temporal_join(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"), [("o_custkey", "c_custkey")], "left").select("o_orderkey", "c_name")


@register("null_safe_join", "SELECT a.k AS ak, b.k AS bk FROM (SELECT c_custkey, nullif(c_nationkey, 3) AS k FROM customer) a JOIN (SELECT nullif(n_nationkey, 3) AS k FROM nation) b ON a.k IS NOT DISTINCT FROM b.k")
def null_safe_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "customer").select(F.expr("nullif(c_nationkey, 3)").alias("ak"))
    b = table(spark, sf_dir, "nation").select(F.expr("nullif(n_nationkey, 3)").alias("bk"))
    return J.null_safe_join(a, b, [("ak", "bk")])


@register("semi_anti_join", "SELECT count(*) FILTER (WHERE o) AS with_orders, count(*) FILTER (WHERE NOT o) AS without FROM (SELECT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AS o FROM customer)")
def semi_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, orders = table(spark, sf_dir, "customer").select("c_custkey"), table(spark, sf_dir, "orders").select("o_custkey")
    some = J.semi_join(customer, orders, customer.c_custkey == orders.o_custkey).agg(F.count("*").alias("with_orders"))
    none = J.anti_join(customer, orders, customer.c_custkey == orders.o_custkey).agg(F.count("*").alias("without"))
    return some.crossJoin(none)


@register("not_in_with_nulls", "SELECT c_custkey FROM customer WHERE nullif(c_nationkey, 3) NOT IN (SELECT s_nationkey + 10 FROM supplier)")
def not_in_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", F.expr("nullif(c_nationkey, 3)").alias("k"))
    return J.not_in(customer, "k", table(spark, sf_dir, "supplier").select((F.col("s_nationkey") + 10).alias("k")), "k").select("c_custkey")


@register("salted_join", "SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def salted_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("k"))
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), "n_name")
    return J.salted_join(customer, nation, ["k"], 8).groupBy("n_name").agg(F.count("*").alias("n"))


@register("group_top_n", "SELECT c_nationkey, c_custkey FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS r FROM customer) WHERE r > 1 AND r <= 4")
def group_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.group_top_n(table(spark, sf_dir, "customer"), ["c_nationkey"], [R.desc("c_acctbal"), R.asc("c_custkey")], 3, offset=1).select("c_nationkey", "c_custkey")


@register("group_top_n_with_ties", "SELECT p_brand, p_partkey FROM (SELECT *, rank() OVER (PARTITION BY p_brand ORDER BY p_size) AS r FROM part) WHERE r <= 2")
def group_top_n_with_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.group_top_n(table(spark, sf_dir, "part"), ["p_brand"], [R.asc("p_size")], 2, with_ties=True).select("p_brand", "p_partkey")


@register("top_n_offset", "SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10 OFFSET 5")
def top_n_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.top_n(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), [R.desc("o_totalprice"), R.asc("o_orderkey")], 10, 5).select("o_orderkey")


@register("max_one_row", "SELECT (SELECT n_name FROM nation WHERE n_nationkey = 7) AS n_name")
def max_one_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.at_most_one(table(spark, sf_dir, "nation").filter("n_nationkey = 7").select("n_name"))


@register("expand", "SELECT o_orderstatus, o_orderpriority, flag, count(*) AS n FROM (SELECT o_orderstatus, NULL AS o_orderpriority, 0::bigint AS flag FROM orders UNION ALL SELECT NULL, o_orderpriority, 1 FROM orders) GROUP BY ALL")
def expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority")
    return G.expand(rows, [["o_orderstatus"], ["o_orderpriority"]]).groupBy("o_orderstatus", "o_orderpriority", "flag").agg(F.count("*").alias("n"))


@register("cube_operator", "SELECT p_brand, p_size, max(p_retailprice) AS top FROM part GROUP BY CUBE (p_brand, p_size)")
def cube_operator(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.cube(table(spark, sf_dir, "part"), ["p_brand", "p_size"], [F.max("p_retailprice").alias("top")])


@register("project_set", "SELECT n_nationkey, unnest(range(n_nationkey % 4)) AS a, unnest(['x', 'y']) AS b FROM nation")
def project_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey")
    numbers = F.expr("CASE WHEN n_nationkey % 4 > 0 THEN sequence(0L, n_nationkey % 4 - 1L) END").cast("array<bigint>")
    return G.project_set(nation, ["n_nationkey"], a=F.coalesce(numbers, F.expr("CAST(array() AS array<bigint>)")), b=F.array(F.lit("x"), F.lit("y")))


@register("pre_aggregated", "SELECT o_orderstatus, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY o_orderstatus")
def pre_aggregated(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "orders").select("o_orderstatus", "o_custkey").distinct()
    return G.pre_aggregated(pairs, ["o_orderstatus"], 8, {"n": F.count("*")}, {"customers": F.sum("n")})


@register("dedup", "SELECT user_id, count(*) AS n FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY user_id")
def dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.dedup(table(spark, sf_dir, "events").select("user_id", "event_type"), ["user_id", "event_type"]).groupBy("user_id").agg(F.count("*").alias("n"))


@register("running_total", "SELECT o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING), 2) AS total FROM orders")
def running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = W.Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey").rowsBetween(W.Window.unboundedPreceding, 0)
    return table(spark, sf_dir, "orders").select("o_orderkey", F.round(F.sum("o_totalprice").over(w), 2).alias("total"))
