"""Event-time relations: tumbling and hopping windows, sessions, gap filling, temporal filters."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

UNITS = {"microsecond": 1, "millisecond": 10**3, "second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6, "day": 86400 * 10**6, "week": 7 * 86400 * 10**6}


def micros(interval: str) -> int:
    """Microseconds of an interval such as '1 hour 30 minutes' or '00:05:00'."""
    total = 0
    for number, unit in re.findall(r"(-?\d+)\s*([a-zA-Z]+)", interval):
        unit = unit.lower().rstrip("s")
        if unit not in UNITS:
            raise ValueError(f"an interval of fixed length is needed, not {interval!r}")
        total += int(number) * UNITS[unit]
    for sign, h, m, s in re.findall(r"(-?)(\d+):(\d+)(?::(\d+(?:\.\d+)?))?", interval):
        total += (-1 if sign else 1) * round((int(h) * 3600 + int(m) * 60 + float(s or 0)) * 10**6)
    return total


def _kept(df: DataFrame, start: Column, end: Column) -> DataFrame:
    return df.withColumns({"window_start": start, "window_end": end})


def tumble(df: DataFrame, time: str, size: str, offset: str = "0 seconds") -> DataFrame:
    """df with window_start and window_end of the tumbling window each row's time lies in; rows without a time go."""
    if df.isStreaming:
        w = F.window(time, f"{micros(size)} microseconds", startTime=f"{micros(offset)} microseconds")
        return df.withColumn("__w", w).withColumns({"window_start": F.col("__w.start"), "window_end": F.col("__w.end")}).drop("__w")
    step, shift = micros(size), micros(offset)
    at = F.unix_micros(F.col(time).cast("timestamp"))
    start = at - F.pmod(at - F.lit(shift), F.lit(step))
    kind = df.schema[time].dataType
    return _kept(df.filter(F.col(time).isNotNull()), F.timestamp_micros(start).cast(kind), F.timestamp_micros(start + F.lit(step)).cast(kind))


def hop(df: DataFrame, time: str, slide: str, size: str, offset: str = "0 seconds") -> DataFrame:
    """df with each row once for every window of the size, begun every slide, that its time lies in."""
    step, length, shift = micros(slide), micros(size), micros(offset)
    if step <= 0 or length % step:
        raise ValueError("a hop window's size must be a multiple of its slide")
    if df.isStreaming:
        w = F.window(time, f"{length} microseconds", f"{step} microseconds", f"{shift % step} microseconds")
        return df.withColumn("__w", w).withColumns({"window_start": F.col("__w.start"), "window_end": F.col("__w.end")}).drop("__w")
    at = F.unix_micros(F.col(time).cast("timestamp"))
    last = at - F.pmod(at - F.lit(shift), F.lit(step))
    kind = df.schema[time].dataType
    spread = df.filter(F.col(time).isNotNull()).withColumn("__start", F.explode(F.sequence(last - F.lit(length - step), last, F.lit(step))))
    return _kept(spread, F.timestamp_micros("__start").cast(kind), F.timestamp_micros(F.col("__start") + F.lit(length)).cast(kind)).drop("__start")


def sessions(df: DataFrame, keys: list[str], time: str, gap: str, name: str = "session") -> DataFrame:
    """df with session number, start and last time: a row begins a session if more than the gap has passed since the row before."""
    order = W.Window.partitionBy(*keys).orderBy(F.col(time).asc_nulls_last())
    at = F.unix_micros(F.col(time).cast("timestamp"))
    fresh = F.coalesce(at - F.lag(at).over(order) > F.lit(micros(gap)), F.lit(True))
    numbered = df.withColumn("__new", fresh.cast("int")).withColumn(name, F.sum("__new").over(order.rowsBetween(W.Window.unboundedPreceding, 0)))
    whole = W.Window.partitionBy(*keys, name)
    return numbered.withColumns({f"{name}_start": F.min(time).over(whole), f"{name}_end": F.max(time).over(whole)}).drop("__new")


def session_frame(df: DataFrame, keys: list[str], time: str, gap: str, aggregates: dict[str, Column]) -> DataFrame:
    """Aggregates over the window frame SESSION WITH GAP: all rows of the row's session."""
    numbered = sessions(df, keys, time, gap, "__session")
    whole = W.Window.partitionBy(*keys, "__session")
    return numbered.withColumns({name: a.over(whole) for name, a in aggregates.items()}).drop("__session", "__session_start", "__session_end")


FILLS = ("keepnull", "locf", "interpolate")


def gap_fill(df: DataFrame, time: str, step: str, fills: dict[str, str], keys: list[str] | None = None) -> DataFrame:
    """df with rows added so that, within each key, no two times are more than a step apart.

    Added rows lie at whole steps after the row before. Their columns are null (keepnull), the last row's (locf) or on
    the line between the rows before and after (interpolate); columns without a fill are null. Each row makes the rows
    up to the next, so the work is spread like the rows themselves.
    """
    keys = keys or []
    if bad := {c: f for c, f in fills.items() if f.lower() not in FILLS}:
        raise ValueError(f"unknown fills: {bad}")
    stride = micros(step)
    order = W.Window.partitionBy(*keys).orderBy(time)
    at = F.unix_micros(F.col(time).cast("timestamp"))
    kind = df.schema[time].dataType
    ahead = df.filter(F.col(time).isNotNull()).withColumns({"__at": at, "__next": F.lead(at).over(order), **{f"__{c}": F.lead(c).over(order) for c, f in fills.items() if f.lower() == "interpolate"}})
    last = F.greatest(F.coalesce(F.col("__next"), F.col("__at")) - 1, F.col("__at"))
    spread = ahead.withColumn("__to", F.explode(F.sequence(F.col("__at"), last, F.lit(stride))))
    added = F.col("__to") > F.col("__at")
    share = (F.col("__to") - F.col("__at")) / (F.col("__next") - F.col("__at"))
    out = {}
    for field in df.schema.fields:
        c, fill = field.name, fills.get(field.name, "keepnull").lower()
        if c == time:
            out[c] = F.timestamp_micros("__to").cast(kind)
        elif c in keys or fill == "locf":
            out[c] = F.col(f"`{c}`")
        elif fill == "interpolate":
            out[c] = F.when(added, (F.col(f"`{c}`") + (F.col(f"__{c}") - F.col(f"`{c}`")) * share).cast(field.dataType)).otherwise(F.col(f"`{c}`"))
        else:
            out[c] = F.when(~added, F.col(f"`{c}`"))
    return spread.select(*[e.alias(c) for c, e in out.items()])


def temporal_filter(df: DataFrame, time: str, within: str, now: Column | None = None) -> DataFrame:
    """Rows whose time is later than now minus an interval."""
    return df.filter(F.col(time) > (F.current_timestamp() if now is None else now) - F.expr(f"INTERVAL {within}"))
