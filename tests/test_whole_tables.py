"""The whole-table variants read every row."""

from pyspark.sql import functions as F

from millrace.plans import QUERIES

SF = "/root/testdata/sf0.001"


def test_gap_fill_counts_every_purchase(spark):
    purchases = spark.read.parquet(f"{SF}/events.parquet").filter("event_type = 'purchase'")
    filled = QUERIES["gap_fill_locf"](spark, SF)
    assert filled.agg(F.sum("n")).first()[0] == purchases.count()
    hours = purchases.select(F.date_trunc("hour", "ts").alias("h")).distinct()
    assert QUERIES["gap_fill_interpolate"](spark, SF).count() == filled.count() >= hours.count()


def test_range_join_takes_every_range(spark):
    lows = {r.c_custkey for r in spark.read.parquet(f"{SF}/customer.parquet").collect()}
    sizes = {r.p_size for r in spark.read.parquet(f"{SF}/part.parquet").collect()}
    want = {low for low in lows if any(low <= s < low + 10 for s in sizes)}
    assert {r.low for r in QUERIES["range_join"](spark, SF).select("low").distinct().collect()} == want and len(want) > 40
