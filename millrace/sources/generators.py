"""Generated sources: datagen by field options, and the events of an online auction. Both are plain expressions over a range of numbers, so any part of the stream can be made anywhere and again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _field(name: str, kind: str, options: dict[str, str], n: Column) -> Column:
    get = lambda key, default: options.get(f"fields.{name}.{key}", default)
    how = get("kind", "random")
    spread = lambda salt: F.pmod(F.xxhash64(n, F.lit(f"{name}/{salt}/{get('seed', '0')}")), F.lit(1 << 40)) / float(1 << 40)
    if how == "sequence":
        start, end = int(get("start", "0")), int(get("end", str(1 << 60)))
        return (F.lit(start) + n % F.lit(end - start + 1)).cast(kind)
    if kind in ("string", "varchar"):
        length = int(get("length", "10"))
        letter = lambda k: F.expr(f"char(97 + pmod(hash(__n, '{name}', {k}), 26))")
        return F.concat(*[letter(k) for k in range(length)])
    if kind.startswith("timestamp"):
        past = int(get("max_past_seconds", "86400"))
        return F.timestamp_micros((F.unix_micros(F.current_timestamp()) - spread("t") * past * 1_000_000).cast("long"))
    if kind in ("boolean",):
        return spread("b") < 0.5
    low, high = float(get("min", "0")), float(get("max", "100"))
    value = F.lit(low) + spread("v") * (high - low)
    return value.cast(kind) if kind in ("double", "float") or kind.startswith("decimal") else F.floor(F.lit(low) + spread("v") * (high - low + 1)).cast(kind)


def datagen(spark: SparkSession, columns: dict[str, str], options: dict[str, str], rows: int | None = None) -> DataFrame:
    """Rows by field options (fields.<name>.kind = sequence or random, start, end, min, max, length, seed); without rows a stream at datagen.rows.per.second."""
    if rows is None:
        base = spark.readStream.format("rate").option("rowsPerSecond", options.get("datagen.rows.per.second", "10")).load().select(F.col("value").alias("__n"))
    else:
        base = spark.range(rows).select(F.col("id").alias("__n"))
    return base.select(*[_field(n, t.lower(), options, F.col("__n")).alias(n) for n, t in columns.items()])


#: of fifty events in a row one is a person, three are auctions, the rest bids (fixed values)
PERSONS, AUCTIONS, TOTAL = 1, 3, 50


def auction_events(spark: SparkSession, rows: int, first_micros: int = 1_436_918_400_000_000, gap_micros: int = 100) -> DataFrame:
    """Events (event_type, person, auction, bid) of an online auction by event number."""
    n = F.col("id")
    place, epoch = n % TOTAL, F.floor(n / TOTAL)
    at = F.timestamp_micros(F.lit(first_micros) + n * gap_micros)
    pick = lambda what, most: F.pmod(F.xxhash64(n, F.lit(what)), most.cast("long"))
    people = epoch * PERSONS + F.least(place, F.lit(PERSONS - 1)) + 1
    offers = epoch * AUCTIONS + F.least(F.greatest(place - PERSONS, F.lit(0)), F.lit(AUCTIONS - 1)) + 1
    person = F.struct((F.lit(1000) + epoch * PERSONS + place).alias("id"), F.concat(F.lit("name "), pick("name", F.lit(1000))).alias("name"), F.concat(F.lit("user"), n, F.lit("@example.com")).alias("email_address"), F.element_at(F.array(*map(F.lit, ("OR", "ID", "CA", "WA", "AZ"))), (pick("state", F.lit(5)) + 1).cast("int")).alias("state"), at.alias("date_time"))
    auction = F.struct((F.lit(1000) + epoch * AUCTIONS + place - PERSONS).alias("id"), F.concat(F.lit("item "), n).alias("item_name"), (pick("first", F.lit(10_000)) + 1).alias("initial_bid"), (pick("reserve", F.lit(20_000)) + 1).alias("reserve"), at.alias("date_time"), F.timestamp_micros(F.unix_micros(at) + (pick("long", F.lit(100)) + 1) * 1_000_000).alias("expires"), (F.lit(1000) + pick("seller", people)).alias("seller"), (F.lit(10) + pick("category", F.lit(5))).alias("category"))
    bid = F.struct((F.lit(1000) + pick("auction", offers)).alias("auction"), (F.lit(1000) + pick("bidder", people)).alias("bidder"), (pick("price", F.lit(10_000)) + 1).alias("price"), F.element_at(F.array(*map(F.lit, ("Apple", "Google", "Facebook", "Baidu"))), (pick("channel", F.lit(4)) + 1).cast("int")).alias("channel"), at.alias("date_time"))
    kind = F.when(place < PERSONS, 0).when(place < PERSONS + AUCTIONS, 1).otherwise(2)
    rows_ = spark.range(rows).select(kind.alias("event_type"), F.when(kind == 0, person).alias("person"), F.when(kind == 1, auction).alias("auction"), F.when(kind == 2, bid).alias("bid"))
    return rows_
