"""Row formats of streams and sinks: JSON, CSV, bytes, upsert and Debezium envelopes, as columns expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.sources.tables import DELETE, INSERT, UPDATE_DELETE, UPDATE_INSERT

#: operations of a Debezium envelope (fixed values)
OPERATIONS = {"c": INSERT, "r": INSERT, "u": UPDATE_INSERT, "d": DELETE}


def decode(df: DataFrame, encode: str, schema: str, value: str = "value") -> DataFrame:
    """Messages with their value parsed into columns; what can't be parsed gives nulls."""
    text = F.col(value).cast("string")
    others = [c for c in df.columns if c != value]
    if encode == "json":
        return df.select(*others, F.from_json(text, schema).alias("__v")).select(*others, "__v.*")
    if encode == "csv":
        return df.select(*others, F.from_csv(text, schema).alias("__v")).select(*others, "__v.*")
    if encode in ("bytes", "text"):
        return df
    raise ValueError(f"unknown encoding {encode}; Avro and protobuf need Spark's packages for them")


def from_debezium(df: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """Rows with op from Debezium JSON envelopes: an update becomes its row before and its row after."""
    envelope = F.from_json(F.col(value).cast("string"), f"before struct<{schema}>, after struct<{schema}>, op string, payload struct<before: struct<{schema}>, after: struct<{schema}>, op: string>")
    parsed = df.select(envelope.alias("e")).select(F.coalesce("e.payload.before", "e.before").alias("b"), F.coalesce("e.payload.after", "e.after").alias("a"), F.coalesce("e.payload.op", "e.op").alias("o"))
    one = lambda op, row: F.struct(F.lit(op).alias("op"), row.alias("row"))
    rows = F.when(F.col("o").isin("c", "r"), F.array(one(INSERT, F.col("a")))).when(F.col("o") == "d", F.array(one(DELETE, F.col("b")))).when(F.col("o") == "u", F.array(one(UPDATE_DELETE, F.col("b")), one(UPDATE_INSERT, F.col("a"))))
    return parsed.select(F.explode(rows).alias("c")).select("c.row.*", "c.op")


def from_maxwell(df: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """Rows with op from Maxwell messages; an update carries the new row, with the old values of what changed."""
    m = F.from_json(F.col(value).cast("string"), f"type string, data struct<{schema}>")
    parsed = df.select(m.alias("m")).filter(F.col("m.type").isin("insert", "update", "delete", "bootstrap-insert"))
    op = F.when(F.col("m.type") == "delete", DELETE).when(F.col("m.type") == "update", UPDATE_INSERT).otherwise(INSERT)
    return parsed.select("m.data.*", op.alias("op"))


def from_canal(df: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """Rows with op from Canal messages, each with an array of rows."""
    m = F.from_json(F.col(value).cast("string"), f"type string, data array<struct<{schema}>>")
    parsed = df.select(m.alias("m")).filter(F.col("m.type").isin("INSERT", "UPDATE", "DELETE"))
    op = F.when(F.col("m.type") == "DELETE", DELETE).when(F.col("m.type") == "UPDATE", UPDATE_INSERT).otherwise(INSERT)
    return parsed.select(op.alias("op"), F.explode("m.data").alias("r")).select("r.*", "op")


def _key(keys: list[str]) -> Column:
    return F.to_json(F.struct(*keys))


def to_append(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Inserts and new values as JSON messages."""
    rows = df.filter(F.col("op").isin(INSERT, UPDATE_INSERT)).drop("op") if "op" in df.columns else df
    return rows.select((_key(keys) if keys else F.lit(None).cast("string")).alias("key"), F.to_json(F.struct(*rows.columns)).alias("value"))


def to_upsert(df: DataFrame, keys: list[str]) -> DataFrame:
    """Messages by key; a delete has a null value."""
    if not keys:
        raise ValueError("an upsert format needs a key")
    columns = [c for c in df.columns if c != "op"]
    op = F.col("op") if "op" in df.columns else F.lit(INSERT)
    return df.filter(op != UPDATE_DELETE).select(_key(keys).alias("key"), F.when(op != DELETE, F.to_json(F.struct(*columns))).alias("value"))


def to_debezium(df: DataFrame, keys: list[str]) -> DataFrame:
    """Messages by key with before, after and op; a changed row gives its old and its new state as two envelopes."""
    columns = [c for c in df.columns if c != "op"]
    op = F.col("op") if "op" in df.columns else F.lit(INSERT)
    row, none = F.struct(*columns), F.lit(None).cast(df.select(F.struct(*columns)).schema[0].dataType)
    gone = op.isin(DELETE, UPDATE_DELETE)
    letter = F.when(op == INSERT, "c").when(op == DELETE, "d").otherwise("u")
    return df.select(_key(keys).alias("key"), F.to_json(F.struct(F.when(gone, row).otherwise(none).alias("before"), F.when(~gone, row).otherwise(none).alias("after"), letter.alias("op")), {"ignoreNullFields": "false"}).alias("value"))
