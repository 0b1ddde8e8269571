"""Event-time queries: windows, sessions, gap filling, and event-stream questions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from millrace.operators import grouping as G
from millrace.operators import time as T
from millrace.plans.catalogue import ORACLES, register, register_sql
from millrace.session import table

register_sql("tumble_sql", "SELECT EXTRACT(epoch FROM window_start)::bigint AS w, event_type, count(*) AS n FROM TUMBLE(events, ts, INTERVAL '1 hour') GROUP BY window_start, event_type", "SELECT epoch(time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01'))::bigint AS w, event_type, count(*) AS n FROM events GROUP BY ALL")
register_sql("hop_sql", "SELECT EXTRACT(epoch FROM window_start)::bigint AS w, count(*) AS n FROM HOP(events, ts, INTERVAL '30 minutes', INTERVAL '1 hour') GROUP BY window_start", "SELECT epoch(time_bucket(INTERVAL '30 minutes', ts, TIMESTAMP '1970-01-01'))::bigint - 1800 * k AS w, count(*) AS n FROM events, range(2) r(k) GROUP BY ALL")


@register("tumble", "SELECT epoch(time_bucket(INTERVAL '20 minutes', ts - INTERVAL '5 minutes', TIMESTAMP '1970-01-01'))::bigint + 300 AS w, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def tumble(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = T.tumble(table(spark, sf_dir, "events"), "ts", "20 minutes", "5 minutes")
    return w.groupBy(F.unix_seconds(F.col("window_start").cast("timestamp")).alias("w")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@register("hop", "SELECT epoch(time_bucket(INTERVAL '10 minutes', ts, TIMESTAMP '1970-01-01'))::bigint - 600 * k AS w, count(DISTINCT user_id) AS users FROM events, range(3) r(k) GROUP BY ALL")
def hop(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = T.hop(table(spark, sf_dir, "events"), "ts", "10 minutes", "30 minutes")
    return w.groupBy(F.unix_seconds(F.col("window_start").cast("timestamp")).alias("w")).agg(F.countDistinct("user_id").alias("users"))


SESSIONS = """
    SELECT user_id, session, count(*) AS n, (epoch_us(max(ts)) - epoch_us(min(ts)))::bigint AS long
    FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING)::bigint AS session
          FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL '2 hours' THEN 0 ELSE 1 END AS fresh FROM events))
    GROUP BY user_id, session"""


@register("sessions", SESSIONS)
def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = T.sessions(table(spark, sf_dir, "events"), ["user_id"], "ts", "2 hours")
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    return s.groupBy("user_id", "session").agg(F.count("*").alias("n"), (micros(F.max("ts")) - micros(F.min("ts"))).alias("long"))


@register("session_frame", f"SELECT e.event_id, s.n FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING)::bigint AS session FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL '2 hours' THEN 0 ELSE 1 END AS fresh FROM events)) e JOIN ({SESSIONS}) s USING (user_id, session)")
def session_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.session_frame(table(spark, sf_dir, "events"), ["user_id"], "ts", "2 hours", {"n": F.count("*")}).select("event_id", "n")


HOURLY = "SELECT time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01') AS h, round(avg(value), 6) AS v, count(*) AS n FROM events WHERE event_type = 'purchase' GROUP BY ALL"


@register("gap_fill_locf", f"WITH t AS ({HOURLY}), g AS (SELECT unnest(generate_series((SELECT min(h) FROM t), (SELECT max(h) FROM t), INTERVAL '1 hour')) AS h) SELECT epoch(g.h)::bigint AS h, t.n, last_value(t.v IGNORE NULLS) OVER (ORDER BY g.h ROWS UNBOUNDED PRECEDING) AS v FROM g LEFT JOIN t USING (h)")
def gap_fill_locf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.gap_fill(hourly(spark, sf_dir), "h", "1 hour", {"v": "locf", "n": "keepnull"}).select(F.unix_seconds(F.col("h").cast("timestamp")).alias("h"), "n", "v")


@register(
    "gap_fill_interpolate",
    f"""WITH t AS ({HOURLY}), p AS (SELECT *, lead(h) OVER (ORDER BY h) AS nh, lead(v) OVER (ORDER BY h) AS nv FROM t)
    SELECT epoch(h)::bigint + 3600 * k AS h, round(CASE WHEN k = 0 THEN v ELSE v + (nv - v) * k / ((epoch(nh) - epoch(h)) / 3600) END, 5) AS v FROM p, LATERAL (SELECT unnest(range(coalesce(((epoch(nh) - epoch(h)) / 3600)::bigint, 1))) AS k)""",
)
def gap_fill_interpolate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.gap_fill(hourly(spark, sf_dir), "h", "1 hour", {"v": "interpolate"}).select(F.unix_seconds(F.col("h").cast("timestamp")).alias("h"), F.round("v", 5).alias("v"))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").filter("event_type = 'purchase'")
    return T.tumble(rows, "ts", "1 hour").groupBy(F.col("window_start").alias("h")).agg(F.round(F.avg("value"), 6).alias("v"), F.count("*").alias("n"))


@register("approx_percentile", "SELECT event_type, count(*) AS n, quantile_disc(value, 0.5) AS exact, count(*) FILTER (WHERE value IS NOT NULL) AS known, true AS within FROM events GROUP BY event_type")
def approx_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sketch's answer held against the exact one, which the oracle works out too."""
    events = table(spark, sf_dir, "events")
    approx = G.approx_percentile(events, ["event_type"], "value", 0.5, 0.01)
    exact = events.groupBy("event_type").agg(F.count("*").alias("n"), F.count("value").alias("known"), F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY value)").alias("exact"))
    within = F.abs(F.col("approx") - F.col("exact")) <= 0.03 * F.abs(F.col("exact")) + 1e-9
    return approx.join(exact, "event_type").select("event_type", "n", "exact", "known", within.alias("within"))


@register("hot_users_by_window", "SELECT w, user_id, n FROM (SELECT *, rank() OVER (PARTITION BY w ORDER BY n DESC) AS r FROM (SELECT epoch(time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01'))::bigint AS w, user_id, count(*) AS n FROM events GROUP BY ALL)) WHERE r = 1")
def hot_users_by_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = T.tumble(table(spark, sf_dir, "events"), "ts", "6 hours").groupBy(F.unix_seconds(F.col("window_start").cast("timestamp")).alias("w"), "user_id").agg(F.count("*").alias("n"))
    place = W.Window.partitionBy("w").orderBy(F.desc("n"))
    return counted.withColumn("r", F.rank().over(place)).filter("r = 1").drop("r")


@register("temporal_filter", "SELECT count(*) AS n FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL '1 day'")
def temporal_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return T.temporal_filter(events.crossJoin(F.broadcast(events.agg(F.max("ts").alias("now")))), "ts", "1 DAY", F.col("now")).agg(F.count("*").alias("n"))
