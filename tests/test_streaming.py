"""Views kept up to date from file streams, and the rows of the survey's event-time fixtures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import time as times
from millrace.sources import formats
from millrace.sources.connectors import read, write
from millrace.sources.generators import auction_events, datagen
from millrace.sources.tables import Table, applied
from millrace.streaming import views


def at(text):
    return dt.datetime.fromisoformat(text)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


SCHEMA = T.StructType([T.StructField("tm", T.TimestampNTZType()), T.StructField("foo", T.IntegerType())])


def feed(spark, path, *values):
    spark.createDataFrame([(at(t), v) for t, v in values], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_windows_close_with_the_watermark(spark, tmp_path):
    path, state = str(tmp_path / "in"), str(tmp_path / "state")
    feed(spark, path, ("2023-05-06 16:51:00", 1), ("2023-05-06 16:56:00", 8), ("2023-05-06 17:30:00", 3))
    source = lambda: views.with_watermark(spark.readStream.schema(SCHEMA).parquet(path), "tm", "5 minutes")
    query = lambda: views.window_close_aggregate(source(), "tm", "1 hour", [], [F.max("foo").alias("m")])
    view = views.View(Table(spark, "closed", T.StructType([T.StructField("window_start", T.TimestampNTZType()), T.StructField("window_end", T.TimestampNTZType()), T.StructField("m", T.IntegerType())])))
    view.append(query(), state).awaitTermination()
    assert rows(view.table.read().select("window_start", "m")) == [(at("2023-05-06 16:00:00"), 8)]


def test_upserted_counts(spark, tmp_path):
    path, state = str(tmp_path / "in"), str(tmp_path / "state")
    feed(spark, path, ("2023-05-06 16:51:00", 1), ("2023-05-06 16:56:00", 1), ("2023-05-06 17:30:00", 3))
    view = views.View(Table(spark, "counts", T.StructType([T.StructField("foo", T.IntegerType()), T.StructField("n", T.LongType())]), ["foo"], keep_changes=True))
    counts = lambda: spark.readStream.schema(SCHEMA).parquet(path).groupBy("foo").agg(F.count("*").alias("n"))
    view.upsert(counts(), state).awaitTermination()
    assert rows(view.table.read()) == [(1, 2), (3, 1)]
    view.done = -1
    feed(spark, path, ("2023-05-06 18:00:00", 3))
    view.upsert(counts(), state).awaitTermination()
    assert rows(view.table.read()) == [(1, 2), (3, 2)]
    assert rows(applied(view.table.changes(), ["foo"], ["version"])) == [(1, 2), (3, 2)]


def test_recomputed_keys(spark, tmp_path):
    path, state = str(tmp_path / "in"), str(tmp_path / "state")
    feed(spark, path, ("2023-05-06 16:51:00", 1), ("2023-05-06 16:56:00", 2))
    base = Table(spark, "base", SCHEMA)
    view = views.View(Table(spark, "latest", SCHEMA, ["foo"]))
    view.recompute(spark.readStream.schema(SCHEMA).parquet(path), base, ["foo"], lambda df: df.groupBy("foo").agg(F.max("tm").alias("tm")).select("tm", "foo"), state).awaitTermination()
    assert len(rows(view.table.read())) == 2


def test_sort_buffer_and_time_to_live(spark):
    buffer = views.SortBuffer(Table(spark, "held", SCHEMA), "tm", 60)
    batch = lambda *v: spark.createDataFrame([(at(t), x) for t, x in v], SCHEMA)
    assert rows(buffer.take(batch(("2024-01-01 00:02:00", 2), ("2024-01-01 00:00:00", 1)))) == [(at("2024-01-01 00:00:00"), 1)]
    assert rows(buffer.take(batch(("2024-01-01 00:00:30", 9), ("2024-01-01 00:05:00", 3)))) == [(at("2024-01-01 00:02:00"), 2)]
    table = Table(spark, "ttl", SCHEMA)
    table.insert(batch(("2024-01-01 00:00:00", 1), ("2024-01-01 01:00:00", 2)))
    views.expire(table, "tm", 600)
    assert rows(table.read()) == [(at("2024-01-01 01:00:00"), 2)]


def test_gap_fill_rows(spark):
    given = [("10:00", 1.0), ("10:03", 4.0), ("10:08", 14.0)]
    df = spark.createDataFrame([(at(f"2023-05-01 {t}:00"), v) for t, v in given], "ts timestamp_ntz, value double")
    for fill, want in (("keepnull", [1.0, None, None, 4.0, None, None, None, None, 14.0]), ("locf", [1.0, 1.0, 1.0, 4.0, 4.0, 4.0, 4.0, 4.0, 14.0]), ("interpolate", [1.0, 2.0, 3.0, 4.0, 6.0, 8.0, 10.0, 12.0, 14.0])):
        got = times.gap_fill(df, "ts", "1 minute", {"value": fill}).orderBy("ts").collect()
        assert [r.value for r in got] == want
        assert [r.ts.minute for r in got] == list(range(9))


def test_hop_needs_whole_slides(spark):
    with pytest.raises(ValueError, match="multiple"):
        times.hop(spark.createDataFrame([], SCHEMA), "tm", "2 minutes", "5 minutes")


def test_formats(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "b", 4), (2, "c", 3), (3, "d", 2)], "k int, v string, op int")
    assert [r.value for r in formats.to_upsert(df, ["k"]).orderBy("key").collect()] == ['{"k":1,"v":"a"}', '{"k":2,"v":"c"}', None]
    back = formats.from_debezium(formats.to_debezium(df.filter("op IN (1, 2)"), ["k"]), "k: int, v: string")
    assert rows(back) == [(1, "a", 1), (3, "d", 2)]
    assert formats.to_append(df).count() == 2
    assert rows(formats.decode(spark.createDataFrame([("1,x",)], "value string"), "csv", "a int, b string")) == [(1, "x")]


def test_connectors_and_generators(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, s string")
    write(df, {"connector": "fs", "fs.path": str(tmp_path / "out"), "encode": "json"})
    assert rows(read(spark, {"connector": "posix_fs", "posix_fs.root": str(tmp_path / "out"), "encode": "json"}, "id INT, s VARCHAR")) == rows(df)
    write(df, {"connector": "blackhole"})
    made = datagen(spark, {"a": "int", "b": "string", "c": "double"}, {"fields.a.kind": "sequence", "fields.a.start": "5", "fields.c.min": "1", "fields.c.max": "2"}, 10).collect()
    assert sorted(r.a for r in made) == list(range(5, 15)) and all(len(r.b) == 10 and 1 <= r.c <= 2 for r in made)
    kinds = {r.event_type: r.n for r in auction_events(spark, 500).groupBy("event_type").agg(F.count("*").alias("n")).collect()}
    assert kinds == {0: 10, 1: 30, 2: 460}
    with pytest.raises(ValueError, match="no connector"):
        read(spark, {"connector": "mqtt"})


def test_other_envelopes(spark):
    rows_ = spark.createDataFrame([('{"type":"insert","data":{"k":1,"v":"a"}}',), ('{"type":"update","data":{"k":1,"v":"b"},"old":{"v":"a"}}',), ('{"type":"delete","data":{"k":1,"v":"b"}}',), ('{"type":"table-create"}',)], "value string")
    assert sorted(tuple(r) for r in formats.from_maxwell(rows_, "k: int, v: string").collect()) == [(1, "a", 1), (1, "b", 2), (1, "b", 3)]
    canal = spark.createDataFrame([('{"type":"INSERT","data":[{"k":"1","v":"a"},{"k":"2","v":"b"}]}',)], "value string")
    assert rows(formats.from_canal(canal, "k: string, v: string")) == [("1", "a", 1), ("2", "b", 1)]


def test_window_functions_on_closed_rows(spark):
    buffer = views.SortBuffer(Table(spark, "held2", SCHEMA), "tm", 60)
    out = Table(spark, "out2", T.StructType([*SCHEMA.fields, T.StructField("before", T.IntegerType())]))
    run = views.over_closed_rows(buffer, [], {"before": lambda w: F.lag("foo").over(w)}, Table(spark, "hist2", SCHEMA), out)
    batch = lambda *v: spark.createDataFrame([(at(t), x) for t, x in v], SCHEMA)
    run(batch(("2024-01-01 00:00:30", 2), ("2024-01-01 00:00:00", 1), ("2024-01-01 00:03:00", 3)), 0)
    run(batch(("2024-01-01 00:02:30", 9), ("2024-01-01 00:09:00", 4)), 1)
    assert sorted((r.foo, r.before) for r in out.read().collect()) == [(1, None), (2, 1), (3, 9), (9, 2)]


def test_user_table_function(spark):
    from millrace.functions.python import register_scalar, register_table

    class Letters:
        def eval(self, text: str):
            for c in text or "":
                yield c, ord(c)

    register_table(spark, "letters", Letters, "letter string, code int")
    assert rows(spark.sql("SELECT * FROM letters('ab')")) == [("a", 97), ("b", 98)]
    register_scalar(spark, "shout", lambda s: s.upper() + "!", "string")
    assert spark.sql("SELECT shout('hi') AS x").first().x == "HI!"
