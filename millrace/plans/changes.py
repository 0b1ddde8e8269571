"""Queries that change tables or run as streams; their results are checked against plain SQL over the same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import python as P
from millrace.operators import joins as J
from millrace.operators import vectors as V
from millrace.plans.catalogue import register
from millrace.session import table
from millrace.sources import formats
from millrace.sources.generators import auction_events
from millrace.sources.tables import Table, applied, warehouse
from millrace.sql.engine import Engine
from millrace.streaming import views

EVENTS = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType())])


def state(spark: SparkSession) -> str:
    return f"{warehouse(spark)}/state-{uuid.uuid4().hex}"


def stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream."""
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events.parquet*")


@register("stream_windows_closed", "SELECT epoch(w)::bigint AS w, n FROM (SELECT time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01') AS w, count(*) AS n FROM events GROUP BY ALL) WHERE w + INTERVAL '1 hour' <= (SELECT max(ts) FROM events) - INTERVAL '10 minutes'")
def stream_windows_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = views.with_watermark(stream(spark, sf_dir), "ts", "10 minutes")
    closed = views.window_close_aggregate(marked, "ts", "1 hour", [], [F.count("*").alias("n")])
    view = views.View(Table(spark, "closed", T.StructType([T.StructField("window_start", T.TimestampType()), T.StructField("n", T.LongType())])))
    view.append(closed.select("window_start", "n"), state(spark)).awaitTermination()
    return view.table.read().select(F.unix_seconds("window_start").alias("w"), "n")


@register("stream_upserted_counts", "SELECT user_id, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY user_id")
def stream_upserted_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = stream(spark, sf_dir).groupBy("user_id").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    view = views.View(Table(spark, "counts", T.StructType([T.StructField("user_id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("total", T.DoubleType())]), ["user_id"]))
    view.upsert(counts, state(spark)).awaitTermination()
    return view.table.read()


@register("stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = views.append_only_dedup(stream(spark, sf_dir).select("user_id", "event_type"), ["user_id", "event_type"], within_watermark=False)
    view = views.View(Table(spark, "firsts", T.StructType([EVENTS["user_id"], EVENTS["event_type"]])))
    view.append(first, state(spark)).awaitTermination()
    return view.table.read()


@register("stream_temporal_join", "SELECT e.event_id, c.c_name FROM events e JOIN customer c ON e.user_id = c.c_custkey")
def stream_temporal_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = J.temporal_join(stream(spark, sf_dir), table(spark, sf_dir, "customer"), [("user_id", "c_custkey")]).select("event_id", "c_name")
    view = views.View(Table(spark, "named", T.StructType([EVENTS["event_id"], T.StructField("c_name", T.StringType())])))
    view.append(joined, state(spark)).awaitTermination()
    return view.table.read()


@register("stream_interval_join", "SELECT a.event_id AS a, b.event_id AS b FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts BETWEEN a.ts - INTERVAL '0 minutes' AND a.ts + INTERVAL '1 hour' WHERE a.event_type = 'view' AND b.event_type = 'purchase'")
def stream_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    side = lambda kind, n: views.with_watermark(stream(spark, sf_dir).filter(F.col("event_type") == kind).select(F.col("event_id").alias(n), F.col("user_id").alias(f"u{n}"), F.col("ts").alias(f"t{n}")), f"t{n}", "1 day")
    pairs = J.interval_join(side("view", "a"), side("purchase", "b"), [("ua", "ub")], ("ta", "tb"), "0 minutes", "1 hour").select("a", "b")
    view = views.View(Table(spark, "pairs", T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])))
    view.append(pairs, state(spark)).awaitTermination()
    return view.table.read()


@register("stream_recomputed_top", "SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS r FROM events) WHERE r <= 2")
def stream_recomputed_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.operators.ranking import asc, desc, group_top_n

    base = Table(spark, "seen", EVENTS, ["event_id"])
    view = views.View(Table(spark, "top", T.StructType([EVENTS["user_id"], EVENTS["event_id"]])))
    view.recompute(stream(spark, sf_dir).select(*EVENTS.names), base, ["user_id"], lambda df: group_top_n(df, ["user_id"], [desc("value"), asc("event_id")], 2).select("user_id", "event_id"), state(spark)).awaitTermination()
    return view.table.read()


@register("table_changes", "SELECT n_nationkey, CASE WHEN n_regionkey = 1 THEN upper(n_name) || '!' ELSE n_name END AS n_name FROM nation WHERE n_regionkey <> 2 UNION ALL SELECT 100, 'NOWHERE'")
def table_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    engine = Engine(spark)
    table(spark, sf_dir, "nation").createOrReplaceTempView("__nation")
    engine.sql("CREATE TABLE __land (n_nationkey INT PRIMARY KEY, n_name VARCHAR, n_regionkey INT)")
    engine.sql("INSERT INTO __land SELECT n_nationkey, n_name, n_regionkey FROM __nation")
    engine.sql("UPDATE __land SET n_name = upper(n_name) || '!' WHERE n_regionkey = 1")
    engine.sql("DELETE FROM __land WHERE n_regionkey = 2")
    engine.sql("INSERT INTO __land VALUES (100, 'NOWHERE', 9)")
    return engine.sql("SELECT n_nationkey, n_name FROM __land")


@register("changelog_applied", "SELECT n_nationkey, n_name FROM nation WHERE n_regionkey <> 3")
def changelog_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    log = Table(spark, "log", nation.schema, ["n_nationkey"], keep_changes=True)
    log.insert(nation.withColumn("n_name", F.lit("old")))
    log.insert(nation)
    log.delete("n_regionkey = 3")
    return applied(log.changes(), ["n_nationkey"], ["version"]).select("n_nationkey", "n_name")


@register("debezium_round_trip", "SELECT n_nationkey, n_name, CASE WHEN n_regionkey = 0 THEN 2 ELSE 1 END AS op FROM nation")
def debezium_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", F.when(F.col("n_regionkey") == 0, 2).otherwise(1).alias("op"))
    return formats.from_debezium(formats.to_debezium(rows, ["n_nationkey"]), "n_nationkey: int, n_name: string")


@register("vector_nearest", "SELECT vec_id FROM embeddings ORDER BY list_sum([(x - 0.1) ** 2 for x in embedding]), vec_id LIMIT 5")
def vector_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return V.nearest(rows, "embedding", [0.1] * 64, 5, tie="vec_id").select("vec_id")


@register("vector_lookup_join", "SELECT query_id, vec_id, rank FROM (SELECT q.vec_id AS query_id, v.vec_id, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_sum([(v.embedding[i]::double - q.embedding[i]) ** 2 for i in range(1, 65)]), v.vec_id)::int AS rank FROM embeddings v, embeddings q) WHERE rank <= 3")
def vector_lookup_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row is a query."""
    rows = table(spark, sf_dir, "embeddings")
    queries = rows.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    return V.lookup_join(queries, rows.select("vec_id", F.col("embedding").alias("vector")), 3).select("query_id", "vec_id", "rank")


@register("python_functions", """SELECT n_nationkey, round(gamma(n_nationkey % 5 + 1.5), 9) AS g, round(lgamma(n_nationkey + 1.5), 9) AS l, strip_accents('é' || n_name) AS a, n_nationkey % 2 = 1 AS c, '{"a":' || n_nationkey || '}' AS s, '{"b":1}' AS d FROM nation""")
def python_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    P.install(spark)
    table(spark, sf_dir, "nation").createOrReplaceTempView("nation")
    return spark.sql(
        """SELECT n_nationkey, round(gamma(n_nationkey % 5 + 1.5D), 9) AS g, round(lgamma(n_nationkey + 1.5D), 9) AS l, to_ascii(concat('é', n_name)) AS a,
        jsonb_contains(concat('{"a":[', n_nationkey % 2, ',5]}'), '{"a":[1]}') AS c, jsonb_set('{"a":0}', array('a'), CAST(n_nationkey AS STRING)) AS s, jsonb_delete_path('{"a":0,"b":1}', array('a')) AS d FROM nation"""
    )


@register("user_aggregate", "SELECT c_nationkey, round(exp(avg(ln(abs(c_acctbal) + 1))), 4) AS mean FROM customer GROUP BY c_nationkey")
def user_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    import math

    rows = table(spark, sf_dir, "customer").select("c_nationkey", "c_acctbal")
    return P.user_aggregate(rows, ["c_nationkey"], ["c_acctbal"], lambda: (0, 0.0), lambda s, x: (s[0] + 1, s[1] + math.log(abs(x) + 1)), lambda a, b: (a[0] + b[0], a[1] + b[1]), lambda s: round(math.exp(s[1] / s[0]), 4), "mean", "double")


@register("auction_hot_items")
def auction_hot_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The auctions with most bids in each hopping window."""
    from pyspark.sql import window as W

    from millrace.operators.time import hop

    bids = auction_events(spark, 20_000, gap_micros=10_000).filter("bid IS NOT NULL").select("bid.*")
    counted = hop(bids, "date_time", "2 seconds", "10 seconds").groupBy("window_start", "auction").agg(F.count("*").alias("n"))
    return counted.withColumn("r", F.rank().over(W.Window.partitionBy("window_start").orderBy(F.desc("n")))).filter("r = 1").drop("r")
