"""Top-n, group top-n, DISTINCT ON, deduplication and the one-row check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W


def asc(name: str) -> Column:
    """Ascending with nulls last, PostgreSQL's default."""
    return F.col(name).asc_nulls_last()


def desc(name: str) -> Column:
    """Descending with nulls first, PostgreSQL's default."""
    return F.col(name).desc_nulls_first()


def top_n(df: DataFrame, order: list[Column], n: int | None, offset: int = 0, with_ties: bool = False) -> DataFrame:
    """The first n rows after an offset; with_ties: also those equal to the last. Without ties Catalyst keeps n rows a task (TakeOrderedAndProject)."""
    if n is None:
        return df.orderBy(*order).offset(offset) if offset else df.orderBy(*order)
    if not with_ties:
        return df.orderBy(*order).offset(offset).limit(n) if offset else df.orderBy(*order).limit(n)
    # n best rows first, so that only they and their equals are ranked in one place
    first = df.select(F.struct(*df.columns).alias("__row"), F.rank().over(W.Window.orderBy(*order)).alias("__rank"), F.row_number().over(W.Window.orderBy(*order)).alias("__n"))
    return first.filter((F.col("__rank") <= offset + n) & (F.col("__n") > offset)).select("__row.*")


def group_top_n(df: DataFrame, group: list[str], order: list[Column], n: int, offset: int = 0, with_ties: bool = False) -> DataFrame:
    """The first n rows of each group; Catalyst limits groups before the shuffle (WindowGroupLimit)."""
    place = W.Window.partitionBy(*group).orderBy(*order)
    number = F.rank() if with_ties else F.row_number()
    return df.withColumn("__n", number.over(place)).filter((F.col("__n") > offset) & (F.col("__n") <= offset + n)).drop("__n")


def distinct_on(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key."""
    return group_top_n(df, keys, order, 1)


def dedup(df: DataFrame, keys: list[str]) -> DataFrame:
    """Some row of each key (append-only deduplication)."""
    return df.dropDuplicates(keys)


def at_most_one(df: DataFrame) -> DataFrame:
    """df, which fails when run if it has more than one row: the cardinality check of a scalar subquery."""
    names = df.columns
    rows = df.limit(2).agg(F.collect_list(F.struct(*names)).alias("__rows"))
    checked = rows.withColumn("__ok", F.assert_true(F.size("__rows") <= 1, "a scalar subquery gave more than one row"))
    return checked.filter(F.col("__ok").isNull()).select(F.explode("__rows").alias("__r")).select(*[F.col(f"__r.{c}").alias(c) for c in names])
