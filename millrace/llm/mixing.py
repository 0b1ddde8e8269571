"""Mixing sources to target weights by balanced sampling with the cube method.

A document's size is its number of words. Sources in code-point order, null last, have the weights 3, 1, 2, repeating;
together they get ``share`` of all sizes by weight, none more than ``most`` times its own size, what is above being
shared again by weight among the others. A document of a source with target t and size s is expected t / s times: its
whole part is certain, its fraction an inclusion probability. The flight phase of the cube method moves the fractions
of three documents at a time along the null vector of their tokens and documents, so a source's totals of both stay
exactly as expected, until each has come to 0 or 1 except for two at most; those land, and a few
documents of the last group change over to bring the tokens back to what was expected.

Flights take place in groups of bounded size (a source's documents dealt by the hash of doc_id, large ones first, so
that what is left is small). The two open documents of each group fly again in the next level, a thousandth as many,
until one group is left for each source; a hot source is only more groups. Every random choice is seeded by source and
group, so reruns agree.

Null and empty texts have size 0; sources of size 0 have target 0. Rows that repeat a doc_id with the same source and
size are one unit, taken together. Targets and sizes depend on all documents.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from millrace.llm.common import WORD_PATTERN, only, sieve, sifted, tidy, written

WEIGHTS = (3, 1, 2)
GROUP = 4_000
#: so many sources are broadcast at most
MOST_SOURCES = 10_000
UNIT = "doc_id long, source string, size long, times long, parts long, bucket long, source_size long, target double, floor long, fraction double, done boolean"


def sized(df: DataFrame, text: str = "text", name: str = "size") -> DataFrame:
    """df with the number of words of its text."""
    from millrace.llm.bpe import put, with_field

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield put(batch, name, pc.fill_null(pc.count_substring_regex(batch.column(text), pattern=WORD_PATTERN), 0).cast(pa.int64()))

    return df.mapInArrow(tidy(run), with_field(df.schema, name, T.LongType()))


def targets(units: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """A row for each source: source_size, target, and the number of units."""
    totals = units.groupBy("source").agg(F.sum(F.col("size") * F.col("times")).alias("source_size"), F.count("*").alias("n"))
    place = F.row_number().over(W.Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    everywhere = W.Window.partitionBy()
    ranked = totals.withColumn("weight", weight).withColumn("cap", most * F.col("source_size")).withColumn("budget", share * F.sum("source_size").over(everywhere)).withColumn("ratio", F.col("cap") / F.col("weight"))
    # filling up: in order of cap over weight, a source is capped if its share of what is left is beyond its cap
    order = W.Window.orderBy("ratio", F.asc_nulls_last("source"))
    left = F.col("budget") - F.coalesce(F.sum("cap").over(order.rowsBetween(W.Window.unboundedPreceding, -1)), F.lit(0.0))
    level = left / F.sum("weight").over(order.rowsBetween(0, W.Window.unboundedFollowing))
    filled = ranked.withColumn("turn", F.row_number().over(order)).withColumn("level", level)
    first = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("turn", "level"))).over(everywhere)["level"]
    return filled.withColumn("target", F.least(F.col("cap"), F.coalesce(first, F.col("level")) * F.col("weight"))).select("source", "source_size", "target", "n")


def moved(units: list[list[float]], rng: random.Random) -> None:
    """One step of a flight: units [fraction, tokens, documents] move along a vector that keeps both totals, until one is whole."""
    if len(units) == 3:
        (_, a, d), (_, b, e), (_, c, f) = units
        vector = [b * f - c * e, c * d - a * f, a * e - b * d]
        if not any(vector):  # their ratios are equal: two of them balance each other
            vector = [b + e, -(a + d), 0.0]
    else:
        vector = [units[1][1], -units[0][1]] if units[0][1] or units[1][1] else [1.0, -1.0]
    up = min((1 - u[0]) / v if v > 0 else -u[0] / v for u, v in zip(units, vector) if v)
    down = min(u[0] / v if v > 0 else (u[0] - 1) / v for u, v in zip(units, vector) if v)
    step = up if rng.random() * (up + down) < down else -down
    nearest, reached = None, 2.0
    for u, v in zip(units, vector):
        if v:
            u[0] = min(1.0, max(0.0, u[0] + step * v))
            if (gap := min(u[0], 1 - u[0])) < reached:
                nearest, reached = u, gap
    nearest[0] = float(round(nearest[0]))
    for u in units:
        if min(u[0], 1 - u[0]) < 1e-9:
            u[0] = float(round(u[0]))


def flown(units: list[list[float]], rng: random.Random) -> None:
    """The flight phase over units [fraction, tokens, documents], in place; two at most stay between 0 and 1."""
    waiting = iter(units)
    flying: list[list[float]] = []
    while True:
        flying = [u for u in flying if 0 < u[0] < 1]
        while len(flying) < 3 and (u := next(waiting, None)) is not None:
            if 0 < u[0] < 1:
                flying.append(u)
        if len(flying) < 2 or len(flying) == 2 and flying[0][1] * flying[1][2] != flying[1][1] * flying[0][2]:
            return
        moved(flying, rng)


def landed(units: list[list[float]], flips: int = 16) -> None:
    """The landing: the open units (two at most) take the nearer ends, then single units of the group change over as long as that brings the tokens nearer to what was expected."""
    off = 0.0
    for u in units:
        if 0 < u[0] < 1:
            end = float(u[0] >= 0.5)
            off += (end - u[0]) * u[1]
            u[0] = end
    free = sorted((u for u in units if u[1]), key=lambda u: u[1])
    for _ in range(flips):
        best = min(free, key=lambda u: abs(off + (1 - 2 * u[0]) * u[1]), default=None)
        if best is None or abs(off + (1 - 2 * best[0]) * best[1]) >= abs(off):
            return
        off += (1 - 2 * best[0]) * best[1]
        best[0] = 1 - best[0]


def flight(seed: int, level: int):
    """The flight of one group, as a table function."""

    def fly(table: pa.Table) -> pa.Table:
        columns = table.to_pydict()
        source, bucket, parts = columns["source"][0], columns["bucket"][0], columns["parts"][0]
        units = [[f, float(s * t), float(t)] for f, s, t in zip(columns["fraction"], columns["size"], columns["times"])]
        order = sorted(range(len(units)), key=lambda k: (-units[k][1], columns["doc_id"][k] is None, columns["doc_id"][k] or 0, columns["size"][k]))
        ordered = [units[k] for k in order]
        rng = random.Random(f"{seed}|{source!r}|{level}|{bucket}")
        open_before = [u for u in ordered if 0 < u[0] < 1]
        flown(ordered, rng)
        if parts == 1:
            landed(open_before)
        table = table.set_column(table.schema.get_field_index("fraction"), "fraction", pa.array([u[0] for u in units], pa.float64()))
        table = table.set_column(table.schema.get_field_index("done"), "done", pa.array([not 0 < u[0] < 1 for u in units], pa.bool_()))
        return table

    return fly


def planned(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> tuple[DataFrame, DataFrame]:
    """The units of documents (doc_id, source, size, times), and a row for each source: of, source_size, target, n, and what a unit is expected, as floor and fraction."""
    units = written(sized(only(documents, "doc_id", "source", "text")).groupBy("doc_id", "source", "size").agg(F.count("*").alias("times")), "mix-units")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    sources = (
        targets(units, weights, share, most)
        .withColumn("floor", F.floor(ratio + 1e-12))
        .withColumn("fraction", F.greatest(ratio - F.col("floor"), F.lit(0.0)))
        .withColumn("fraction", F.when(F.col("fraction") < 1e-9, 0.0).otherwise(F.col("fraction")))
        .withColumnRenamed("source", "of")
    )
    return units, written(sources, "mix-sources")


def of_source(rows: DataFrame, sources: DataFrame, few: bool) -> DataFrame:
    """Rows with the columns of their source's row; the sources are broadcast if they are few."""
    return rows.join(F.broadcast(sources) if few else sources, F.col("source").eqNullSafe(F.col("of"))).drop("of")


def drawn(units: DataFrame, group: int = GROUP, seed: int = 0) -> DataFrame:
    """Units whose source has a fraction, after all levels of flights: those taken once more than floor have fraction 1, the others 0."""
    rows = (
        units.withColumn("parts", F.ceil(F.col("n") / group))
        .withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size"), F.col("parts")))
        .withColumn("done", F.lit(False))
        .selectExpr(*[f"CAST({x.split()[0]} AS {x.split()[1]}) AS {x.split()[0]}" for x in UNIT.split(", ")])
    )
    most_parts = rows.agg(F.max("parts").alias("x")).first()["x"] or 1
    finished = []
    for level in range(64):
        last = most_parts <= 1
        rows = written(rows.groupBy("source", "bucket").applyInArrow(flight(seed, level), UNIT), f"mix-level{level}")
        finished.append(rows.filter("done"))
        if last:
            break
        # the open ones, two of each group, fly again in a thousandth as many groups
        rows = rows.filter("NOT done").withColumn("bucket", F.expr("bucket div 1000")).withColumn("parts", F.expr("(parts + 999) div 1000"))
        most_parts = -(-most_parts // 1000)
    out = finished[0]
    for more in finished[1:]:
        out = out.unionByName(more)
    return out


def mixed(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, group: int = GROUP, seed: int = 0) -> DataFrame:
    """A row for each unit of documents (doc_id, source, text): how many times it is taken (copies), and its source's numbers.

    Units of a source whose share is a whole number, as at the cap, are certain and take no part in the flights.
    """
    units, sources = planned(documents, weights, share, most)
    rows = of_source(units, sources, sources.count() <= MOST_SOURCES)
    names = ["doc_id", "source", "size", "times", "source_size", "target", "floor", "fraction"]
    out = drawn(rows.filter("fraction > 0"), group, seed).select(*names).unionByName(rows.filter("fraction = 0").select(*names))
    return out.select(*names[:6], (F.col("floor") + F.round("fraction").cast("long")).alias("copies"))


def taken(documents: DataFrame) -> DataFrame:
    """For each document its size, its source's size and target, and the words that the mix takes of it."""
    each = mixed(documents).withColumn("one", F.explode(F.expr("sequence(1L, times)")))
    return each.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mix(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, group: int = GROUP, seed: int = 0) -> DataFrame:
    """The documents of the mix: each as many times as it is taken. Null ids and sources count as values, equal rows as units of their own, columns of any name are kept; an empty table gives an empty one.

    Documents of a source whose share is a whole number are taken that often where they are read. Of the other sources the
    draw leaves each unit at floor or one more, the unusual being the rarer of the two. A bitmap of the unusual units and
    one of the others that it lets through too tell most documents apart where they are read; only those that are in both
    bitmaps meet the units themselves.
    """
    names = documents.columns
    units, sources = planned(documents, weights, share, most)
    few = sources.count() <= MOST_SOURCES
    whole = sources.filter("fraction = 0 AND floor > 0").select("of", F.col("floor").alias("mix_copies"))
    split = sources.filter("fraction > 0")
    inner = [n if n in ("doc_id", "source", "text") else f"_{k}" for k, n in enumerate(names)]
    docs = documents.toDF(*inner)
    certain = of_source(docs, whole, few)
    more = F.col("fraction") > 0.5
    outcomes = split.select("of", (F.col("floor") + more.cast("long")).alias("mix_usual"), (F.col("floor") + (~more).cast("long")).alias("mix_unusual"))
    chosen = drawn(of_source(units, split, few), group, seed).withColumn("copies", F.col("floor") + F.round("fraction").cast("long"))
    chosen = of_source(chosen.select("doc_id", "source", "size", "copies"), outcomes, few)
    unusual = written(chosen.filter("copies <> mix_usual").select(*[F.col(c).alias(f"mix_{c}") for c in ("doc_id", "source", "size")]), "mix-unusual")
    one, other = F.xxhash64(F.col("doc_id").cast("long"), "source"), F.xxhash64("source", F.col("doc_id").cast("long"))
    bits = written(sieve(unusual, F.xxhash64("mix_doc_id", "mix_source")), "mix-bits")
    doubtful = written(sieve(sifted(chosen.filter("copies = mix_usual"), bits, one), other), "mix-bits")
    open_ = of_source(docs, outcomes, few)
    untold, maybe = sifted(open_, bits, one, keep=False), sifted(open_, bits, one)
    match = F.col("doc_id").eqNullSafe(F.col("mix_doc_id")) & F.col("source").eqNullSafe(F.col("mix_source")) & (F.col("mix_words") == F.col("mix_size"))
    told = sized(sifted(maybe, doubtful, other), name="mix_words").join(unusual, match, "left")
    parts = [
        certain,
        untold.withColumn("mix_copies", F.col("mix_usual")),
        sifted(maybe, doubtful, other, keep=False).withColumn("mix_copies", F.col("mix_unusual")),
        told.withColumn("mix_copies", F.when(F.col("mix_words") == F.col("mix_size"), F.col("mix_unusual")).otherwise(F.col("mix_usual"))),
    ]
    both = reduce(DataFrame.unionByName, [p.select(*inner, "mix_copies") for p in parts]).filter("mix_copies > 0")
    return both.withColumn("mix_copy", F.explode(F.expr("sequence(1L, mix_copies)"))).select(*inner).toDF(*names)
