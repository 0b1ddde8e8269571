"""Grouping sets, expansion, filtered, ordered and two-phase aggregates, set operations, set-returning projections."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grouping_sets(df: DataFrame, sets: list[list[str]], aggregates: list[Column], keys: list[str] | None = None) -> DataFrame:
    """One aggregation for each set of keys in one pass (Catalyst's Expand); keys left out of a set are null."""
    keys = keys or list(dict.fromkeys(k for s in sets for k in s))
    return df.groupingSets([[F.col(k) for k in s] for s in sets], *[F.col(k) for k in keys]).agg(*aggregates)


def cube(df: DataFrame, keys: list[str], aggregates: list[Column]) -> DataFrame:
    return grouping_sets(df, [list(c) for n in range(len(keys), -1, -1) for c in combinations(keys, n)], aggregates, keys)


def rollup(df: DataFrame, keys: list[str], aggregates: list[Column]) -> DataFrame:
    return grouping_sets(df, [keys[:n] for n in range(len(keys), -1, -1)], aggregates, keys)


def expand(df: DataFrame, subsets: list[list[str]], flag: str = "flag") -> DataFrame:
    """Each row once for every subset of columns, all other listed columns being null; flag numbers the subsets."""
    listed = list(dict.fromkeys(c for s in subsets for c in s))
    copies = F.array(*[F.struct(F.lit(k).cast("long").alias("__f"), *[(F.col(c) if c in s else F.lit(None).cast(df.schema[c].dataType)).alias(c) for c in listed]) for k, s in enumerate(subsets)])
    rest = [c for c in df.columns if c not in listed]
    return df.withColumn("__x", F.explode(copies)).select(*rest, *[F.col(f"__x.{c}").alias(c) for c in listed], F.col("__x.__f").alias(flag))


def union(*frames: DataFrame, all_rows: bool = True, corresponding: bool = False) -> DataFrame:
    """UNION [ALL] [CORRESPONDING]; corresponding keeps the columns that all have."""
    if corresponding:
        shared = [c for c in frames[0].columns if all(c in f.columns for f in frames[1:])]
        frames = tuple(f.select(*shared) for f in frames)
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out if all_rows else out.distinct()


def intersect(left: DataFrame, right: DataFrame, all_rows: bool = False) -> DataFrame:
    return left.intersectAll(right) if all_rows else left.intersect(right)


def except_(left: DataFrame, right: DataFrame, all_rows: bool = False) -> DataFrame:
    return left.exceptAll(right) if all_rows else left.subtract(right)


def project_set(df: DataFrame, columns: list[str], ordinality: str | None = None, **arrays: Column) -> DataFrame:
    """Set-returning projections side by side: shorter ones are padded with null, a row without any element goes."""
    zipped = F.arrays_zip(*[F.coalesce(a, F.array()).alias(n) for n, a in arrays.items()])
    if ordinality:
        spread = df.select(*columns, F.posexplode(zipped).alias("__p", "__z"))
        return spread.select(*columns, *[F.col(f"__z.{n}").alias(n) for n in arrays], (F.col("__p") + 1).cast("long").alias(ordinality))
    spread = df.select(*columns, F.explode(zipped).alias("__z"))
    return spread.select(*columns, *[F.col(f"__z.{n}").alias(n) for n in arrays])


def pre_aggregated(df: DataFrame, keys: list[str], salt: int, partial: dict[str, Column], final: dict[str, Column]) -> DataFrame:
    """Aggregates whose state can't be combined before the shuffle, in two steps: over (keys, salt) first, so that a hot key meets many tasks, then over keys."""
    first = df.withColumn("__salt", F.pmod(F.xxhash64(*df.columns), F.lit(salt))).groupBy(*keys, "__salt").agg(*[a.alias(n) for n, a in partial.items()])
    return first.groupBy(*keys).agg(*[a.alias(n) for n, a in final.items()])


def approx_percentile(df: DataFrame, keys: list[str], value: str, quantile: float, relative_error: float = 0.01, name: str = "approx") -> DataFrame:
    """Quantile within a relative error, from counts of logarithmic buckets: a bounded number of rows a group, merged like any sum."""
    if not 0 < relative_error < 1:
        raise ValueError("the relative error lies between 0 and 1")
    base = (1 + relative_error) / (1 - relative_error)
    x = F.col(value).cast("double")
    bucket = F.when(x == 0, F.lit(0)).otherwise(F.ceil(F.log(base, F.abs(x))))
    counted = df.filter(x.isNotNull()).groupBy(*keys, F.signum(x).cast("int").alias("__s"), bucket.alias("__b")).agg(F.count("*").alias("__n"))
    middle = F.col("__s") * 2 * F.pow(F.lit(base), F.col("__b")) / F.lit(base + 1)
    from pyspark.sql import window as W

    upto = W.Window.partitionBy(*keys).orderBy("__v").rowsBetween(W.Window.unboundedPreceding, 0)
    whole = W.Window.partitionBy(*keys)
    ranked = counted.withColumn("__v", F.when(F.col("__s") == 0, F.lit(0.0)).otherwise(middle)).withColumn("__c", F.sum("__n").over(upto)).withColumn("__t", F.sum("__n").over(whole))
    wanted = F.floor(F.lit(float(quantile)) * (F.col("__t") - 1)) + 1
    return ranked.filter(F.col("__c") >= wanted).groupBy(*keys).agg(F.min("__v").alias(name))
