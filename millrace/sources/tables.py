"""Tables with keys, defaults, generated columns and conflict policies, kept as versions of parquet files.

Each change writes a new version by plain DataFrame plans (anti join, union, window) and then marks it as complete in the
table's folder, so readers see whole versions, a failed write leaves the old one, and a restarted driver opens the table
where it was. The mark also has the stream batches that went into the version. A table may also keep its changes as rows with an operation
and the version, in order: that is what changelogs and subscriptions read.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

INSERT, DELETE, UPDATE_INSERT, UPDATE_DELETE = 1, 2, 3, 4
CONFLICTS = ("overwrite", "ignore", "if_not_null")


def warehouse(spark: SparkSession) -> str:
    """The folder for tables: the checkpoint folder that the cluster shares if there is one, else the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/millrace-tables"


@dataclass
class Table:
    spark: SparkSession
    name: str
    schema: T.StructType
    key: list[str] = field(default_factory=list)
    append_only: bool = False
    on_conflict: str = "overwrite"
    version_column: str | None = None
    defaults: dict[str, str] = field(default_factory=dict)
    generated: dict[str, str] = field(default_factory=dict)
    watermark: tuple[str, str] | None = None
    keep_changes: bool = False
    path: str = ""
    version: int = 0
    #: checkpoint of a stream -> number of its last batch that is in this version
    batches: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.on_conflict not in CONFLICTS:
            raise ValueError(f"unknown conflict policy {self.on_conflict}")
        self.path = self.path or f"{warehouse(self.spark)}/{self.name}-{uuid.uuid4().hex}"
        if not self.version:
            self._write(self.spark.createDataFrame([], self.schema), [])

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> "Table":
        """The table that an earlier driver left at a path, in its last complete version."""
        base = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/versions")
        files = base.getFileSystem(spark._jsc.hadoopConfiguration())
        last = max(int(f.getPath().getName().partition(".")[0]) for f in files.listStatus(base))
        stream = files.open(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/versions/{last}.json"))
        try:
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        told = json.loads(text)
        told["schema"] = T.StructType.fromJson(told["schema"])
        told["watermark"] = tuple(told["watermark"]) if told["watermark"] else None
        return cls(spark, path=path, version=last, **told)

    def _mark(self, number: int) -> None:
        """The one small file that makes a version count; it is written after the rows."""
        told = {n: getattr(self, n) for n in ("name", "key", "append_only", "on_conflict", "version_column", "defaults", "generated", "watermark", "keep_changes", "batches")}
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/versions/{number}.json")
        out = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(path, True)
        try:
            out.write(bytearray(json.dumps({**told, "schema": self.schema.jsonValue()}).encode()))
        finally:
            out.close()

    def vacuum(self, keep: int = 2) -> None:
        """Deletes all but the last versions; who reads an older one has to be done with it."""
        base = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = base.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for old in range(1, self.version - keep + 1):
            files.delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/v{old}"), True)

    def read(self, version: int | None = None) -> DataFrame:
        """The table as it is, or as it was at a version."""
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/v{self.version if version is None else version}")

    def _write(self, rows: DataFrame, changes: list[DataFrame]) -> None:
        number = self.version + 1
        rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema.fields]).write.mode("overwrite").parquet(f"{self.path}/v{number}")
        if self.keep_changes:
            for k, change in enumerate(changes):
                change.withColumn("version", F.lit(number)).write.mode("overwrite").parquet(f"{self.path}/changes/version={number}/part={k}")
        self._mark(number)
        self.version = number

    def complete(self, rows: DataFrame) -> DataFrame:
        """rows with defaults for missing columns, and generated columns."""
        for f in self.schema.fields:
            if f.name not in rows.columns and f.name not in self.generated:
                rows = rows.withColumn(f.name, F.expr(self.defaults[f.name]) if f.name in self.defaults else F.lit(None).cast(f.dataType))
        for name, expression in self.generated.items():
            rows = rows.withColumn(name, F.expr(expression))
        return rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema.fields])

    def insert(self, rows: DataFrame) -> DataFrame:
        """The rows that became part of the table."""
        new = self.complete(rows)
        old = self.read()
        if not self.key:
            self._write(old.unionByName(new), [new.withColumn("op", F.lit(INSERT))])
            return new
        result = merged(old, new, self.key, self.on_conflict, self.version_column)
        changes = difference(old, result, self.key) if self.keep_changes else None
        self._write(result, [changes] if changes is not None else [])
        return new

    def delete(self, condition: str) -> DataFrame:
        if self.append_only:
            raise ValueError(f"{self.name} is append only")
        gone = self.read().filter(condition)
        stays = self.read().filter(f"NOT coalesce(({condition}), false)")
        self._write(stays, [gone.withColumn("op", F.lit(DELETE))])
        return gone

    def update(self, assignments: dict[str, str], condition: str = "true") -> DataFrame:
        if self.append_only:
            raise ValueError(f"{self.name} is append only")
        old = self.read()
        hit = F.coalesce(F.expr(f"({condition})"), F.lit(False))
        values = {c: F.expr(v).cast(self.schema[c].dataType) for c, v in assignments.items()}
        changed = old.filter(hit).select(*[values.get(c, F.col(f"`{c}`")).alias(c) for c in old.columns])
        for name, expression in self.generated.items():
            changed = changed.withColumn(name, F.expr(expression))
        before = old.filter(hit)
        self._write(old.filter(~hit).unionByName(changed), [before.withColumn("op", F.lit(UPDATE_DELETE)), changed.withColumn("op", F.lit(UPDATE_INSERT))])
        return changed

    def changes(self, since: int = 0) -> DataFrame:
        """Rows with op and version, of versions after the given one."""
        kind = T.StructType([*self.schema.fields, T.StructField("op", T.IntegerType()), T.StructField("version", T.IntegerType())])
        if self.version <= 1 or not self.keep_changes:
            return self.spark.createDataFrame([], kind)
        return self.spark.read.schema(kind).parquet(f"{self.path}/changes").select(*kind.names).filter(F.col("version") > since)


def merged(old: DataFrame, new: DataFrame, key: list[str], policy: str = "overwrite", version: str | None = None) -> DataFrame:
    """old with new rows by key. overwrite: the last (by version column, if there is one) wins; ignore: the first stays; if_not_null: new values that are not null replace."""
    age = F.lit(0) if version is None else F.col(version)
    columns = old.columns
    both = old.withColumns({"__new": F.lit(0), "__n": F.lit(0).cast("long")}).unionByName(new.withColumns({"__new": F.lit(1), "__n": F.monotonically_increasing_id()}))
    both = both.withColumn("__age", age)
    latest = [F.col("__age").desc_nulls_last(), F.col("__new").desc(), F.col("__n").desc()]
    if policy == "ignore":
        order = [F.col("__new").asc(), F.col("__n").asc()]
        place = W.Window.partitionBy(*key).orderBy(*order)
        return both.withColumn("__r", F.row_number().over(place)).filter("__r = 1").select(*columns)
    if policy == "overwrite":
        place = W.Window.partitionBy(*key).orderBy(*latest)
        return both.withColumn("__r", F.row_number().over(place)).filter("__r = 1").select(*columns)
    order = F.struct(*[F.col(c) for c in ("__age", "__new", "__n")])
    picked = [F.max_by(F.col(f"`{c}`"), F.when(F.col(f"`{c}`").isNotNull(), order)).alias(c) for c in columns if c not in key]
    return both.groupBy(*key).agg(*picked).select(*columns)


def difference(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """The changes that turn old into new, as rows with op: inserts, deletes and pairs of updates."""
    columns = old.columns
    a, b = old.select(*key, F.struct(*columns).alias("__old")), new.select(*key, F.struct(*columns).alias("__new"))
    both = a.join(b, key, "full").filter(~F.col("__old").eqNullSafe(F.col("__new")))
    ops = F.when(F.col("__old").isNull(), F.array(F.struct(F.lit(INSERT).alias("op"), F.col("__new").alias("row")))).when(F.col("__new").isNull(), F.array(F.struct(F.lit(DELETE).alias("op"), F.col("__old").alias("row")))).otherwise(F.array(F.struct(F.lit(UPDATE_DELETE).alias("op"), F.col("__old").alias("row")), F.struct(F.lit(UPDATE_INSERT).alias("op"), F.col("__new").alias("row"))))
    return both.select(F.explode(ops).alias("__c")).select(*[F.col(f"__c.row.{c}").alias(c) for c in columns], F.col("__c.op").alias("op"))


def applied(changes: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The table that a changelog leaves: of each key the last row, unless a delete came last."""
    place = W.Window.partitionBy(*key).orderBy(*[F.col(c).desc() for c in order], F.col("op").isin(DELETE, UPDATE_DELETE).asc())
    return changes.withColumn("__r", F.row_number().over(place)).filter((F.col("__r") == 1) & ~F.col("op").isin(DELETE, UPDATE_DELETE)).drop("__r", "op", *order)
