"""Calls and statements whose answers PostgreSQL fixes."""

import uuid

import pytest

from millrace.sql import Engine


@pytest.fixture
def engine(spark):
    return Engine(spark)


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


CASES = [
    ("7/2", 3), ("-7/2", -3), ("7::int / 2::int", 3), ("7 / 2.0", 3.5), ("(1 + 2) * 7 / 2", 10),
    ("jsonb_build_array(1, 'a', NULL, true)", '[1,"a",null,true]'), ("jsonb_build_object('a', 1, 'b', jsonb_build_array(1, 2))", '{"a":1,"b":[1,2]}'), ("jsonb_build_array(VARIADIC ARRAY[1, 2])", "[1,2]"),
    ("regexp_match('foobar', '(foo)(bar)')", ["foo", "bar"]), ("(regexp_match('foobar', '(foo)(bar)'))[2]", "bar"), ("regexp_match('foobar', 'O', 'i')", ["o"]), ("regexp_match('foobar', 'x')", None),
    (r"regexp_replace('foobarbaz', 'b(..)', 'X\1Y')", "fooXarYbaz"), (r"regexp_replace('foobarbaz', 'b(..)', 'X\1Y', 'g')", "fooXarYXazY"), ("regexp_replace('aXbX', 'X', '$', 'g')", "a$b$"), (r"regexp_replace('abc', 'b', '[\&]')", "a[b]c"),
    ('jsonb_strip_nulls(\'{"a":{"b":null,"c":1}}\')', '{"a":{"c":1}}'), ("string_to_array('abc', '')", ["abc"]), ("array_sum(ARRAY[1, 2, NULL])", 3), ("trunc(-42.4382, 2)::double precision", -42.43), ("make_time(8, 15, 23.5)", "08:15:23.5"),
    ("to_char(1234.5, '9999.99')", " 1234.50"), ("to_char(-12, '999')", " -12"), ("to_char(0, '99')", "  0"), ("format('%s %I %L %%', 'a', 'b c', NULL)", 'a "b c" NULL %'), ("regexp_count('abcabc', 'b', 3)", 1), ("row(1, 2) = row(1, 2)", True), ("gamma(5.0)", 24.0),
    ("encode(decode('a\\000b', 'escape'), 'hex')", "610062"), ('\'{"a":{"b":[1,2]}}\'::jsonb #>> \'{a,b,1}\'', "2"), ("concat(VARIADIC ARRAY['a', 'b'])", "ab"), ('jsonb_path_match(\'{"a":3}\', \'$.a > 2\')', True), ('jsonb_path_query_array(\'{"a":[{"b":1},{"b":5}]}\', \'$.a[*] ? (@.b > 2)\')', '[{"b":5}]'),
    ("convert_from(decrypt(encrypt('hi'::bytea, '0123456789abcdef'::bytea, 'aes'), '0123456789abcdef'::bytea, 'aes'), 'UTF-8')", "hi"),
]


def test_calls(engine):
    got = engine.sql("SELECT " + ", ".join(f"{text} AS x{k}" for k, (text, _) in enumerate(CASES))).first()
    for value, (text, want) in zip(got, CASES):
        assert (float(value) if isinstance(want, float) else value) == want, text


def test_rows_of_calls(engine):
    assert rows(engine.sql("SELECT regexp_matches('foobarbequebaz', 'ba(.)', 'g') AS m")) == [(["r"],), (["z"],)]
    assert rows(engine.sql("SELECT regexp_matches('foobarbequebaz', '(b)(a.)') AS m")) == [(["b", "ar"],)]
    assert rows(engine.sql("SELECT * FROM unnest(ARRAY['a', 'b']) WITH ORDINALITY AS t(x, n)")) == [("a", 1), ("b", 2)]
    assert rows(engine.sql("""SELECT * FROM jsonb_to_record('{"a":1,"b":"x"}') AS t(a int, b text)""")) == [(1, "x")]
    assert rows(engine.sql("SELECT * FROM range(1, 4) AS r(i)")) == [(1,), (2,), (3,)]
    assert rows(engine.sql("SELECT generate_subscripts(ARRAY[5, 6], 1, true) AS i")) == [(1,), (2,)]


def test_check_not_null_and_rollback(engine):
    with pytest.raises(Exception, match="must not be null"):
        engine.sql("SELECT check_not_null(nullif(1, 1)) AS x").collect()
    with pytest.raises(NotImplementedError):
        engine.sql("ROLLBACK")


def test_asof_join_of_tables(engine):
    a, b = f"a_{uuid.uuid4().hex}", f"b_{uuid.uuid4().hex}"
    engine.script(f"CREATE TABLE {a} (v1 INT, v2 INT, v3 INT); CREATE TABLE {b} (v1 INT, v2 INT, v3 INT); INSERT INTO {a} VALUES (1, 2, 3), (2, 3, 4), (1, 2, 9); INSERT INTO {b} VALUES (1, NULL, 8), (1, 3, 4), (1, 2, 5), (1, 2, 6), (2, 5, 9)")
    text = f"SELECT {a}.v1 AS k, {a}.v3 AS l, {b}.v2 AS r FROM {a} ASOF %sJOIN {b} ON {a}.v1 = {b}.v1 AND {a}.v2 %s {b}.v2"
    assert rows(engine.sql(text % ("", "<"))) == [(1, 3, 3), (1, 9, 3), (2, 4, 5)]
    assert rows(engine.sql(text % ("LEFT ", ">"))) == [(1, 3, None), (1, 9, None), (2, 4, None)]
    with pytest.raises(ValueError, match="exactly one inequality"):
        engine.sql(text % ("", "=")).collect()


def test_views_follow_their_tables(engine):
    t = f"gap_{uuid.uuid4().hex}"
    engine.script(
        f"""CREATE TABLE {t} (ts TIMESTAMP, value DOUBLE, PRIMARY KEY (ts), WATERMARK FOR ts AS ts - INTERVAL '5' SECOND) APPEND ONLY;
        INSERT INTO {t} VALUES ('2024-05-21 10:00:00', 10.0), ('2024-05-21 10:02:00', 12.0), ('2024-05-21 10:05:00', 15.0);
        CREATE MATERIALIZED VIEW {t}_filled AS SELECT ts, value FROM GAP_FILL({t}, ts, INTERVAL '1' MINUTE) EMIT ON WINDOW CLOSE;
        CREATE MATERIALIZED VIEW {t}_n AS SELECT count(*) AS n FROM {t}; CREATE MATERIALIZED VIEW {t}_m AS SELECT n + 1 AS m FROM {t}_n;
        INSERT INTO {t} VALUES ('2024-05-21 10:08:00', 21.0)"""
    )
    got = [(r.ts.minute, r.value) for r in engine.sql(f"SELECT * FROM {t}_filled ORDER BY ts").collect()]
    assert got == [(0, 10.0), (1, None), (2, 12.0), (3, None), (4, None), (5, 15.0)]
    assert engine.sql(f"SELECT m FROM {t}_m").first().m == 5
    with pytest.raises(ValueError, match="watermark"):
        engine.sql("SELECT 1 AS x EMIT ON WINDOW CLOSE")


def test_tables_outlive_their_driver(spark, tmp_path):
    from millrace.sources.tables import Table
    from millrace.streaming.views import View

    schema = spark.createDataFrame([], "k int, n int").schema
    table = Table(spark, "kept", schema, ["k"], path=str(tmp_path / "t"), keep_changes=True)
    view = View(table)._each(lambda b: table.insert(b), "stream")
    view(spark.createDataFrame([(1, 1), (2, 2)], schema), 0)
    view(spark.createDataFrame([(2, 5)], schema), 1)
    again = Table.open(spark, str(tmp_path / "t"))
    assert (again.version, again.key, again.batches, again.name) == (table.version, ["k"], {"stream": 1}, "kept")
    assert rows(again.read()) == [(1, 1), (2, 5)] and rows(again.changes()) == rows(table.changes())
    replayed = View(again)._each(lambda b: again.insert(b), "stream")
    replayed(spark.createDataFrame([(2, 7)], schema), 1)
    assert rows(again.read()) == [(1, 1), (2, 5)]
    replayed(spark.createDataFrame([(2, 7)], schema), 2)
    assert rows(Table.open(spark, str(tmp_path / "t")).read()) == [(1, 1), (2, 7)]
    with pytest.raises(ZeroDivisionError):
        View(again)._each(lambda b: 1 / 0, "stream")(again.read(), 3)
    assert again.batches == {"stream": 2}
    again.vacuum()
    assert rows(again.read()) == [(1, 1), (2, 7)] and not (tmp_path / "t" / "v1").exists()
