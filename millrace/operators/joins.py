"""Joins beyond the plain equi join: as-of, interval, range, temporal, window, null-safe and set-valued ones."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

COMPARISONS = {"<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b}


def asof_join(left: DataFrame, right: DataFrame, on: list[str], inequality: tuple[str, str, str], how: str = "inner", tie: list[str] | None = None) -> DataFrame:
    """Each left row with its nearest right row among those of equal keys that satisfy the inequality (left column, operator, right column).

    Both sides are merged by key and order in one window pass, so no left row ever meets more than one candidate and a
    hot key costs a sort, not a product. Of equal nearest rows the first by ``tie`` wins. Columns of the right side that
    the left has too (keys apart) must be renamed before.
    """
    if how not in ("inner", "left"):
        raise ValueError("an as-of join is inner or left")
    if not on:
        raise ValueError("an as-of join needs at least one equality")
    own, operator, other = inequality
    if operator not in COMPARISONS:
        raise ValueError(f"{operator} is no inequality")
    fields = [c for c in right.columns if c not in on]
    backward = operator in (">", ">=")
    # of rows with equal keys and order values, one candidate is enough: the first by tie
    ties = [F.col(f"`{c}`").asc_nulls_last() for c in (tie or fields)]
    first = W.Window.partitionBy(*on, other).orderBy(*ties)
    candidates = right.filter(F.col(other).isNotNull()).withColumn("__n", F.row_number().over(first)).filter("__n = 1").drop("__n")
    # at equal order values a candidate counts as seen exactly if the operator includes equality
    inclusive = operator in (">=", "<=")
    rows = left.select(*on, F.col(own).alias("__at"), F.lit(1 if inclusive else 0).alias("__side"), F.struct(*left.columns).alias("__l"), F.lit(None).cast(candidates.select(F.struct(*fields)).schema[0].dataType).alias("__r"))
    marks = candidates.select(*on, F.col(other).alias("__at"), F.lit(0 if inclusive else 1).alias("__side"), F.lit(None).cast(left.select(F.struct(*left.columns)).schema[0].dataType).alias("__l"), F.struct(*fields).alias("__r"))
    order = [F.col("__at").asc() if backward else F.col("__at").desc(), F.col("__side").asc()]
    seen = W.Window.partitionBy(*on).orderBy(*order).rowsBetween(W.Window.unboundedPreceding, 0)
    merged = rows.unionByName(marks).withColumn("__near", F.last("__r", ignorenulls=True).over(seen)).filter(F.col("__l").isNotNull())
    unmatched = F.col("__at").isNull()
    keyless = reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in on])
    near = F.when(~unmatched & ~keyless, F.col("__near"))
    out = merged.select(*[F.col(f"__l.{c}").alias(c) for c in left.columns], near.alias("__near"))
    if how == "inner":
        out = out.filter(F.col("__near").isNotNull())
    return out.select(*left.columns, *[F.col(f"__near.{c}").alias(c) for c in fields])


def range_join(points: DataFrame, ranges: DataFrame, point: str, low: str, high: str, width: float, how: str = "inner") -> DataFrame:
    """Points within [low, high) of ranges, by equi join on bins of the given width: each range is in every bin it touches.

    Choose the width near the usual length of a range; a range much longer is in many bins. how is inner or left: a
    range without points would show up once for each of its bins.
    """
    if how not in ("inner", "left"):
        raise ValueError("a range join is inner or left")
    bin_of = lambda c: F.floor(F.col(c).cast("double") / F.lit(float(width)))
    spread = ranges.withColumn("__bin", F.explode(F.sequence(bin_of(low), bin_of(high))))
    inside = (F.col(point) >= F.col(low)) & (F.col(point) < F.col(high))
    return points.withColumn("__b", bin_of(point)).join(spread, (F.col("__b") == F.col("__bin")) & inside, how).drop("__b", "__bin")


#: types whose values a double holds exactly
EXACT = (T.ByteType, T.ShortType, T.IntegerType, T.FloatType, T.DoubleType, T.DateType)
#: a tree of an inequality has 2**TREE_LEVELS leaves, for CUTS quantiles and what lies between them
TREE_LEVELS = 9
CUTS = 255


def ordered_alike(a: T.DataType, b: T.DataType) -> bool:
    """Whether values of the two types compare as their doubles do: equal doubles may hide an order, but never turn it round."""
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        # a float compared with integers or decimals may be compared in a type that rounds them
        return T.FloatType() not in (a, b) or (isinstance(a, T.FractionalType) and isinstance(b, T.FractionalType) and not isinstance(a, T.DecimalType) and not isinstance(b, T.DecimalType))
    return a == b and isinstance(a, (T.DateType, T.TimestampType, T.TimestampNTZType))


def _as_double(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_date(c.cast("date")) * F.lit(86400.0) + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
    return c.cast("double")


def _nodes(leaf: Column, smaller: bool, alone: Column) -> Column:
    """The ancestors of a leaf that it is left of (smaller) or right of, and the leaf itself unless it is left alone."""
    passed = [F.when(F.getbit(leaf, F.lit(bit)) == (0 if smaller else 1), F.shiftright(leaf, bit + 1)) for bit in range(TREE_LEVELS)]
    return F.array_compact(F.array(*passed, F.when(~alone, leaf)))


def inequality_join(left: DataFrame, right: DataFrame, conditions: list[tuple[Column, str, Column]]) -> DataFrame:
    """Inner join by inequalities alone (left expression, operator, right expression), as an equi join on nodes of binary trees.

    Values of the first two inequalities are dealt to the leaves of a tree each: one for each quantile, one for what lies
    between two of them. A row of the smaller side is listed at the ancestors that its leaf is left of, one of the larger
    side at those that its leaf is right of: rows of different leaves meet at exactly one node, and only if the inequality
    holds. Rows of one leaf meet there and are compared. So a row is listed at most 100 times (about 25 on average), and
    pairs that are compared in vain share a leaf, of which at most one value in 256 lies between two quantiles. Rows beyond
    the other side's extremes are left out before, nulls match nothing. Types have to be ordered_alike, and columns of the
    two sides must have different names.
    """
    names = left.columns + right.columns
    if not conditions or len({n.lower() for n in names}) < len(names):
        raise ValueError("an inequality join needs a condition and sides with different column names")
    every = range(len(conditions))
    sides = {"a": left.select("*", *[c[0].alias(f"__a{k}") for k, c in enumerate(conditions)]), "b": right.select("*", *[c[2].alias(f"__b{k}") for k, c in enumerate(conditions)])}
    kinds = [[sides[s].schema[f"__{s}{k}"].dataType for s in "ab"] for k in every]
    if not all(ordered_alike(*pair) for pair in kinds):
        raise ValueError("the two types of an inequality are not ordered alike")
    ends = {}
    for s in "ab":
        sides[s] = sides[s].filter(reduce(lambda x, y: x & y, [F.col(f"__{s}{k}").isNotNull() for k in every]))
        ends[s] = sides[s].agg(F.struct(*[f(f"__{s}{k}").alias(f"{what}{k}") for k in every for what, f in (("min", F.min), ("max", F.max))])).scalar()
    for k, (_, sign, _) in enumerate(conditions):
        least, most = ("min", "max") if sign[0] == "<" else ("max", "min")
        sides["a"] = sides["a"].filter(COMPARISONS[sign](F.col(f"__a{k}"), ends["b"].getField(f"{most}{k}")))
        sides["b"] = sides["b"].filter(COMPARISONS[sign](ends["a"].getField(f"{least}{k}"), F.col(f"__b{k}")))
    trees = every[:2]
    for s in "ab":
        sides[s] = sides[s].withColumns({f"__x{k}": _as_double(F.col(f"__{s}{k}"), kinds[k]["ab".index(s)]) for k in trees})
    values = sides["a"].select(*[f"__x{k}" for k in trees]).unionByName(sides["b"].select(*[f"__x{k}" for k in trees]))
    shares = [i / (CUTS + 1) for i in range(1, CUTS + 1)]
    cuts = values.agg(F.struct(*[F.array_sort(F.array_distinct(F.percentile_approx(f"__x{k}", shares, 10000))).alias(f"cuts{k}") for k in trees])).scalar()
    steps = F.array(*[F.lit(1 << bit) for bit in range(TREE_LEVELS - 2, -1, -1)])
    for k in trees:
        sign, at, x = conditions[k][1], F.col(f"__cuts{k}"), F.col(f"__x{k}")
        exact = all(isinstance(kind, EXACT) for kind in kinds[k])
        for s in "ab":
            # by halves: how many cuts are at most x
            count = F.aggregate(steps, F.lit(0), lambda n, step: F.when(F.coalesce(F.get(at, n + step - 1) <= x, F.lit(False)), n + step).otherwise(n))  # noqa: B023
            met = sides[s].withColumn(f"__cuts{k}", cuts.getField(f"cuts{k}")).withColumn(f"__c{k}", count).withColumn(f"__q{k}", F.coalesce(F.get(at, F.col(f"__c{k}") - 1) == x, F.lit(False)))
            met = met.withColumn(f"__leaf{k}", F.lit(1 << TREE_LEVELS) + 2 * F.col(f"__c{k}") - F.col(f"__q{k}").cast("int"))
            # equal values of a leaf of one value don't meet by < or >
            alone = F.col(f"__q{k}") & F.lit(exact and len(sign) == 1)
            sides[s] = met.withColumn(f"__node{k}", F.explode(_nodes(F.col(f"__leaf{k}"), (sign[0] == "<") == (s == "a"), alone))).drop(f"__cuts{k}", f"__c{k}", f"__q{k}", f"__leaf{k}", f"__x{k}")
    holds = reduce(lambda x, y: x & y, [COMPARISONS[sign](F.col(f"__a{k}"), F.col(f"__b{k}")) for k, (_, sign, _) in enumerate(conditions)])
    return sides["a"].join(sides["b"], [f"__node{k}" for k in trees]).filter(holds).select(*[F.col(f"`{n}`") for n in names])


def interval_join(left: DataFrame, right: DataFrame, on: list[tuple[str, str]], times: tuple[str, str], before: str, after: str, how: str = "inner") -> DataFrame:
    """Equi join whose right time lies within [left time - before, left time + after]; on watermarked streams the range lets Spark drop old state."""
    lt, rt = times
    keys = reduce(lambda a, b: a & b, [left[a] == right[b] for a, b in on])
    within = (right[rt] >= left[lt] - F.expr(f"INTERVAL {before}")) & (right[rt] <= left[lt] + F.expr(f"INTERVAL {after}"))
    return left.join(right, keys & within, how)


def temporal_join(stream: DataFrame, table: DataFrame, on: list[tuple[str, str]], how: str = "inner", limit: int | None = None) -> DataFrame:
    """Each row with the table's version at processing time (a stream-static join); limit: a table known to have fewer rows is broadcast."""
    keys = reduce(lambda a, b: a & b, [stream[a] == table[b] for a, b in on])
    side = F.broadcast(table) if limit is not None and not table.isStreaming and table.limit(limit + 1).count() <= limit else table
    return stream.join(side, keys, how)


def window_join(left: DataFrame, right: DataFrame, on: list[tuple[str, str]], how: str = "inner") -> DataFrame:
    """Rows of two windowed relations with equal keys and the same window."""
    keys = [left[a] == right[b] for a, b in on] + [left["window_start"] == right["window_start"], left["window_end"] == right["window_end"]]
    return left.join(right, reduce(lambda a, b: a & b, keys), how).drop(right["window_start"]).drop(right["window_end"])


def null_safe_join(left: DataFrame, right: DataFrame, on: list[tuple[str, str]], how: str = "inner") -> DataFrame:
    """Equi join in which null equals null."""
    return left.join(right, reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in on]), how)


def semi_join(left: DataFrame, right: DataFrame, condition: Column | list[str]) -> DataFrame:
    """IN / EXISTS."""
    return left.join(right, condition, "left_semi")


def anti_join(left: DataFrame, right: DataFrame, condition: Column | list[str]) -> DataFrame:
    """NOT EXISTS; a null never matches, so rows with null keys stay."""
    return left.join(right, condition, "left_anti")


def not_in(left: DataFrame, column: str, right: DataFrame, other: str) -> DataFrame:
    """NOT IN with SQL's nulls: nothing stays if the right side has a null, and a null on the left stays only against an empty right side.

    One row of facts about the right side decides that, so the join itself stays an equi anti join.
    """
    facts = right.agg(F.count("*").alias("__n"), F.coalesce(F.bool_or(F.col(other).isNull()), F.lit(False)).alias("__null"))
    values = right.select(F.col(other).alias("__v")).distinct()
    stays = (F.col("__n") == 0) | (~F.col("__null") & F.col(column).isNotNull())
    return left.join(values, F.col(column) == F.col("__v"), "left_anti").join(F.broadcast(facts), how="cross").filter(stays).drop("__n", "__null")


def salted_join(left: DataFrame, right: DataFrame, on: list[str], salt: int = 16, how: str = "inner") -> DataFrame:
    """Equi join with the left side's hot keys spread over ``salt`` parts and the right side repeated as often; for right sides of few rows a key."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("a salted join keeps or drops rows of the left side only")
    spread = left.withColumn("__salt", F.pmod(F.xxhash64(*left.columns), F.lit(salt)))
    copies = right.withColumn("__salt", F.explode(F.expr(f"sequence(0L, {salt - 1}L)")))
    return spread.join(copies, [*on, "__salt"], how).drop("__salt")
