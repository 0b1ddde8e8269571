"""Sources and sinks by connector options, mapped to Spark's readers and writers.

Connectors whose Spark package isn't on the class path fail when they are used, with Spark's own message.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from millrace.sources import formats
from millrace.sources.generators import auction_events, datagen

FILES = ("s3", "s3_v2", "gcs", "azblob", "posix_fs", "webhdfs", "fs")
DATABASES = {"postgres": "postgresql", "postgres-cdc": "postgresql", "citus-cdc": "postgresql", "mysql": "mysql", "mysql-cdc": "mysql", "sqlserver-cdc": "sqlserver", "jdbc": ""}
#: connectors that are Spark formats of the same or another name
FORMATS = {"kafka": "kafka", "kinesis": "aws-kinesis", "pulsar": "pulsar", "google_pubsub": "pubsub", "mongodb": "mongodb", "mongodb-cdc": "mongodb", "cassandra": "org.apache.spark.sql.cassandra", "elasticsearch": "org.elasticsearch.spark.sql", "opensearch": "opensearch", "clickhouse": "clickhouse", "starrocks": "starrocks", "doris": "doris", "bigquery": "bigquery", "redis": "org.apache.spark.sql.redis", "snowflake": "snowflake", "redshift": "io.github.spark_redshift_community.spark.redshift", "iceberg": "iceberg", "deltalake": "delta"}


def columns_of(text: str | None) -> dict[str, str]:
    """Column names and types of a source's column list."""
    from millrace.sql.dialect import Translator

    found = {}
    for part in re.split(r",(?![^(<]*[)>])", text or ""):
        if part.strip() and not re.match(r"(?i)\s*(primary|watermark)\b", part):
            t = Translator(part)
            name = t.take().strip("`")
            found[name] = t.type_name()
    return found


def location(options: dict[str, str]) -> str:
    """The path of a file connector."""
    root = options.get("path") or options.get("posix_fs.root") or options.get("fs.path")
    scheme = {"s3": "s3a", "s3_v2": "s3a", "gcs": "gs", "azblob": "abfss"}.get(options["connector"])
    bucket = options.get("s3.bucket_name") or options.get("gcs.bucket_name") or options.get("azblob.container_name")
    base = f"{scheme}://{bucket}" if scheme and bucket else ""
    return "/".join(x.rstrip("/") for x in (base, root or "", options.get("match_pattern", "")) if x)


def kafka_options(options: dict[str, str]) -> dict[str, str]:
    """Kafka options in Spark's names."""
    start = {"earliest": "earliest", "latest": "latest"}.get(options.get("scan.startup.mode", "earliest"), "earliest")
    out = {"kafka.bootstrap.servers": options["properties.bootstrap.server"], "subscribe": options["topic"], "startingOffsets": start, "failOnDataLoss": "false"}
    if "scan.startup.timestamp.millis" in options:
        out["startingTimestamp"] = options["scan.startup.timestamp.millis"]
    out.update({f"kafka.{k.removeprefix('properties.')}": v for k, v in options.items() if k.startswith("properties.") and k != "properties.bootstrap.server"})
    return out


def jdbc_options(options: dict[str, str]) -> dict[str, str]:
    kind = DATABASES[options["connector"]]
    url = options.get("jdbc.url") or f"jdbc:{kind}://{options['hostname']}:{options['port']}/{options.get('database.name', '')}"
    out = {"url": url, "dbtable": options.get("table.name", "")}
    for own, theirs in (("username", "user"), ("user", "user"), ("password", "password"), ("query", "query")):
        if own in options:
            out[theirs] = options[own]
    if "query" in out:
        out.pop("dbtable")
    return out


def read(spark: SparkSession, options: dict[str, str], columns: str | None = None, stream: bool = False) -> DataFrame:
    """The frame of a source; stream: an unbounded one where the connector has one."""
    kind, fields = options["connector"], columns_of(columns)
    schema = ", ".join(f"`{n}` {t}" for n, t in fields.items())
    encode = options.get("encode", options.get("format.encode", "json")).lower()
    reader = spark.readStream if stream else spark.read
    if kind in FILES:
        reader = reader.format("binaryFile" if encode == "bytes" else encode)
        if schema:
            reader = reader.schema(schema)
        if encode == "csv":
            reader = reader.option("header", str(options.get("without_header", "true") != "true").lower()).option("sep", options.get("delimiter", ","))
        return reader.load(location(options))
    if kind == "datagen":
        return datagen(spark, fields, options, None if stream else int(options.get("rows", "1000")))
    if kind == "nexmark":
        rows = auction_events(spark, int(options.get("nexmark.event.num", "1000")))
        table = options.get("nexmark.table.type", "").lower()
        return rows.filter(f"{table} IS NOT NULL").select(f"{table}.*") if table else rows
    if kind in DATABASES:
        return spark.read.format("jdbc").options(**jdbc_options(options)).load()
    if kind == "kafka":
        messages = reader.format("kafka").options(**kafka_options(options)).load()
        envelopes = {"debezium": formats.from_debezium, "maxwell": formats.from_maxwell, "canal": formats.from_canal}
        if envelope := envelopes.get(options.get("format", "plain").lower()):
            return envelope(messages, ", ".join(f"{n}: {t}" for n, t in fields.items()))
        return formats.decode(messages, encode, schema).select(*fields) if schema else messages
    if kind in FORMATS:
        return reader.format(FORMATS[kind]).options(**{k: v for k, v in options.items() if k != "connector"}).load(*([options["path"]] if "path" in options else []))
    if kind == "webhook":
        raise ValueError("a webhook needs a server that writes its requests to files; read them with a file connector")
    raise ValueError(f"no connector {kind}; nats and mqtt have no Spark source, bridge them to Kafka or files")


def message(df: DataFrame, options: dict[str, str]) -> DataFrame:
    """Key and value messages of a sink's format."""
    kind = options.get("type", options.get("format", "append-only")).lower()
    keys = [k.strip() for k in options.get("primary_key", "").split(",") if k.strip()]
    if kind == "debezium":
        return formats.to_debezium(df, keys)
    return formats.to_upsert(df, keys) if kind == "upsert" else formats.to_append(df, keys)


def write(df: DataFrame, options: dict[str, str]) -> None:
    """Writes a batch to a sink."""
    kind = options["connector"]
    if kind == "blackhole":
        df.write.format("noop").mode("overwrite").save()
    elif kind in FILES:
        encode = options.get("encode", "parquet").lower()
        df.write.format(encode).mode("append").save(location(options))
    elif kind == "kafka":
        message(df, options).write.format("kafka").options(**{k: v for k, v in kafka_options(options).items() if k.startswith("kafka.")}).option("topic", options["topic"]).save()
    elif kind in DATABASES:
        df.write.format("jdbc").options(**jdbc_options(options)).mode("append").save()
    elif kind in FORMATS:
        writer = df.write.format(FORMATS[kind]).options(**{k: v for k, v in options.items() if k != "connector"}).mode("append")
        writer.save(options["path"]) if "path" in options else writer.save()
    else:
        raise ValueError(f"no sink connector {kind}")


def write_stream(df: DataFrame, options: dict[str, str], checkpoint: str):
    """Writes a stream to a sink, batch by batch; files and Kafka by Spark's own sinks."""
    kind = options["connector"]
    writer = df.writeStream.option("checkpointLocation", checkpoint)
    if kind in FILES:
        return writer.format(options.get("encode", "parquet").lower()).option("path", location(options)).outputMode("append").start()
    if kind == "kafka":
        own = {k: v for k, v in kafka_options(options).items() if k.startswith("kafka.")}
        return message(df, options).writeStream.option("checkpointLocation", checkpoint).format("kafka").options(**own).option("topic", options["topic"]).start()
    return writer.foreachBatch(lambda batch, _: write(batch, options)).start()
