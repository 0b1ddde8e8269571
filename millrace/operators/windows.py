"""Window frames that leave out the current row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

FUNCTIONS = ("sum", "count", "avg", "min", "max")


def excluding_current_row(df: DataFrame, keys: list[str], order: list[Column], value: str, function: str, name: str, start: int = W.Window.unboundedPreceding, end: int = W.Window.unboundedFollowing) -> DataFrame:
    """df with an aggregate over ROWS BETWEEN start AND end EXCLUDE CURRENT ROW: what comes before and what comes after are aggregated in the same pass and put together."""
    if function not in FUNCTIONS:
        raise ValueError(f"{function} can't be put together from two frames")
    over = W.Window.partitionBy(*keys).orderBy(*order)
    parts = [over.rowsBetween(a, b) for a, b in ((start, min(end, -1)), (max(start, 1), end)) if a <= b]
    total = lambda f: sum((F.coalesce(f(value).over(w), F.lit(0)) for w in parts), F.lit(0))
    counted = total(F.count)
    if function == "count":
        result = counted
    elif function in ("min", "max"):
        f, pick = (F.min, F.least) if function == "min" else (F.max, F.greatest)
        result = pick(*[f(value).over(w) for w in parts]) if len(parts) > 1 else f(value).over(parts[0])
    else:
        result = F.when(counted > 0, total(F.sum) / counted if function == "avg" else total(F.sum))
    return df.withColumn(name, result)
