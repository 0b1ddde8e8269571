"""Continuously maintained views over Structured Streaming.

A view is a streaming plan plus a keyed table that each micro-batch is merged into. Append-only results (windows closed
by the watermark) are appended; results that change are upserted by key; results whose rows can vanish are recomputed for
the keys a batch touches. The merge of a batch is idempotent by batch number, so a replayed batch changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W
from pyspark.sql.streaming.query import StreamingQuery

from millrace.operators.time import hop, micros, tumble
from millrace.sources.tables import Table, difference


def with_watermark(df: DataFrame, time: str, delay: str) -> DataFrame:
    """df whose rows later than the delay are late; stateful steps drop them and their old state. Spark keeps watermarks on instants, so a local time counts as one of the session's zone."""
    return df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)


def window_close_aggregate(df: DataFrame, time: str, size: str, keys: list[str], aggregates: list[Column], slide: str | None = None) -> DataFrame:
    """Aggregates of tumbling or hopping windows, each emitted once the watermark has passed its end (run it in append mode)."""
    if df.isStreaming:  # the watermark goes with the window itself, so its ends are taken out afterwards
        if slide and micros(size) % micros(slide):
            raise ValueError("a hop window's size must be a multiple of its slide")
        window = F.window(time, f"{micros(size)} microseconds", f"{micros(slide or size)} microseconds").alias("__w")
        closed = df.groupBy(window, *keys).agg(*aggregates)
        return closed.select(F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"), *[c for c in closed.columns if c != "__w"])
    windows = hop(df, time, slide, size) if slide else tumble(df, time, size)
    return windows.groupBy("window_start", "window_end", *keys).agg(*aggregates)


def append_only_dedup(df: DataFrame, keys: list[str], within_watermark: bool = True) -> DataFrame:
    """The first row of each key; with a watermark the keys are forgotten after its delay."""
    return df.dropDuplicatesWithinWatermark(keys) if within_watermark else df.dropDuplicates(keys)


class View:
    """A table kept by the batches of a stream; the table remembers the last of them, so a replayed one changes nothing, whichever driver replays it."""

    def __init__(self, table: Table) -> None:
        self.table = table

    def _each(self, merge: Callable[[DataFrame], None], stream: str = "") -> Callable[[DataFrame, int], None]:
        def run(batch: DataFrame, number: int) -> None:
            if number <= self.table.batches.get(stream, -1):
                return
            before = self.table.batches
            self.table.batches = {**before, stream: number}  # becomes part of the version that the merge writes
            try:
                merge(batch)
            except BaseException:
                self.table.batches = before
                raise

        return run

    def append(self, df: DataFrame, checkpoint: str, once: bool = True) -> StreamingQuery:
        return self._start(df, "append", lambda b: self.table.insert(b) and None, checkpoint, once)

    def upsert(self, df: DataFrame, checkpoint: str, once: bool = True) -> StreamingQuery:
        """For results in update mode: new values replace those of the same key."""
        return self._start(df, "update", lambda b: self.table.insert(b) and None, checkpoint, once)

    def recompute(self, df: DataFrame, base: Table, keys: list[str], query: Callable[[DataFrame], DataFrame], checkpoint: str, once: bool = True) -> StreamingQuery:
        """For any query that treats its keys one by one: rows go into the base table, and the keys they touch are answered anew."""

        def merge(batch: DataFrame) -> None:
            number = self.table.batches[checkpoint]
            if number > base.batches.get(checkpoint, -1):  # base is written first, so it may have the batch already
                base.batches = {**base.batches, checkpoint: number}
                base.insert(batch)
            touched = batch.select(*keys).distinct()
            fresh = query(base.read().join(touched, keys, "left_semi"))
            rest = self.table.read().join(touched, keys, "left_anti")
            self.table._write(rest.unionByName(fresh), [difference(self.table.read(), rest.unionByName(fresh), self.table.key)] if self.table.keep_changes and self.table.key else [])

        return self._start(df, "append", merge, checkpoint, once)

    def _start(self, df: DataFrame, mode: str, merge: Callable[[DataFrame], None], checkpoint: str, once: bool) -> StreamingQuery:
        writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(self._each(merge, checkpoint))
        return (writer.trigger(availableNow=True) if once else writer).start()


class SortBuffer:
    """Rows of a stream held until the watermark has passed them, then released in order of time.

    Kept as a table that each batch rewrites; the state is what lies within the delay, whatever has gone through.
    """

    def __init__(self, table: Table, time: str, delay_seconds: int) -> None:
        self.table, self.time, self.delay = table, time, delay_seconds
        self.watermark: int | None = None

    def take(self, batch: DataFrame) -> DataFrame:
        """The rows that are complete after this batch."""
        at = F.unix_micros(F.col(self.time).cast("timestamp"))
        newest = batch.agg(F.max(at).alias("x")).first()["x"]
        mark = self.watermark if newest is None else max(self.watermark or -(1 << 62), newest - self.delay * 1_000_000)
        fresh = batch.filter(at >= F.lit(self.watermark)) if self.watermark is not None else batch
        held = self.table.read().unionByName(fresh.select(*self.table.schema.names))
        self.watermark = mark
        if mark is None:
            return held.limit(0)
        ready = held.filter(at < F.lit(mark)).orderBy(self.time)
        self.table._write(held.filter(at >= F.lit(mark)), [])  # a new version: what ready reads stays as it was
        return ready


def over_closed_rows(buffer: SortBuffer, keys: list[str], functions: dict[str, Callable[[W.WindowSpec], Column]], history: Table, output: Table) -> Callable[[DataFrame, int], None]:
    """A batch function for window functions on rows the watermark has passed: released rows are ordered after those released before.

    Only rows that the functions can look at need to be in history; trim it to the longest frame.
    """

    def run(batch: DataFrame, number: int) -> None:
        names = buffer.table.schema.names
        ready = buffer.take(batch)
        both = history.read().select(*names).withColumn("__old", F.lit(True)).unionByName(ready.withColumn("__old", F.lit(False)))
        order = W.Window.partitionBy(*keys).orderBy(buffer.time)
        result = both.withColumns({n: f(order) for n, f in functions.items()}).filter("NOT __old").drop("__old")
        output.insert(result)
        history.insert(ready)

    return run


def changelog(before: DataFrame, after: DataFrame, key: list[str]) -> DataFrame:
    """The changes between two versions of a view, with op."""
    return difference(before, after, key)


def expire(table: Table, time: str, seconds: int) -> None:
    """Time to live: rows older than the newest minus so many seconds go."""
    at = F.unix_micros(F.col(time).cast("timestamp"))
    rows = table.read()
    newest = rows.agg(F.max(at).alias("x")).first()["x"]
    if newest is not None:
        table._write(rows.filter(at >= F.lit(newest - seconds * 1_000_000)), [])


def stream_schema(fields: dict[str, str]) -> T.StructType:
    return T._parse_datatype_string(", ".join(f"{n} {t}" for n, t in fields.items()))
