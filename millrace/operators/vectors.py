"""Exact vector search: the nearest to one vector by built-in expressions, and to each of any number of vectors in blocks. There is no index."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from millrace.functions import postgres

DISTANCES = {"l2": "l2_distance", "l1": "l1_distance", "cosine": "cosine_distance", "inner_product": "inner_product"}


def distance(a: str, b: str, metric: str = "l2") -> Column:
    """Distance of two vector columns; the inner product is negated, so that nearest comes first."""
    text = postgres.call(DISTANCES[metric], [a, b])
    return F.expr(f"-({text})" if metric == "inner_product" else text)


def nearest(vectors: DataFrame, vector: str, query: list[float], k: int, metric: str = "l2", tie: str | None = None) -> DataFrame:
    """The k vectors nearest to one given vector; each task keeps k rows (TakeOrderedAndProject)."""
    given = F.array(*[F.lit(float(x)) for x in query])
    rows = vectors.withColumn("__q", given).withColumn("distance", distance(f"`{vector}`", "__q", metric)).drop("__q")
    return rows.orderBy(F.col("distance").asc_nulls_last(), *([F.col(tie)] if tie else [])).limit(k)


def total(x: np.ndarray) -> np.ndarray:
    """Sums of rows, added from left to right like SQL's."""
    return np.add.accumulate(x, axis=1)[:, -1] if x.shape[1] else np.zeros(len(x))


def exact(rows: np.ndarray, query: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """What orders the rows by distance (for l2 its square), and where there is no distance."""
    none = np.zeros(len(rows), bool)
    with np.errstate(all="ignore"):
        if metric == "l2":
            return total((rows - query) ** 2), none
        if metric == "l1":
            return total(np.abs(rows - query)), none
        if metric == "inner_product":
            return -total(rows * query), none
        norms = np.sqrt(total(rows * rows)) * np.sqrt(total(query[None] ** 2))
        return 1 - total(rows * query) / norms, norms == 0


def estimates(rows: np.ndarray, queries: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """What exact() gives for each query and row but for rounding, and how far two of a query's may be off together."""
    if metric == "l1":
        sums = np.zeros((len(queries), len(rows)))
        for own, other in zip(queries.T, rows.T):
            sums += np.abs(own[:, None] - other)
        return sums, np.zeros(len(queries))
    a, b = (queries * queries).sum(axis=1), (rows * rows).sum(axis=1)
    products = queries @ rows.T
    tiny = 64 * (rows.shape[1] + 8) * np.finfo(float).eps
    if metric == "l2":
        return a[:, None] + b - 2 * products, tiny * (a + b.max())
    if metric == "inner_product":
        return -products, tiny * np.sqrt(a * b.max())
    return 1 - products / np.sqrt(a)[:, None] / np.sqrt(b), np.full(len(a), tiny)


def odd(vectors: np.ndarray) -> np.ndarray:
    """Zero and non-finite vectors and those of extreme size, for which estimates() is no help."""
    most = np.abs(vectors).max(axis=1, initial=0.0)
    return ~((most > 1e-100) & (most < 1e100))


def by_dimension(column: pa.ChunkedArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Places and matrix of the vectors of each dimension; null ones and those that hold a null are left out."""
    lists = column.combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(lists), -1).to_numpy(zero_copy_only=False)
    out = {}
    for d in np.unique(lengths[lengths >= 0]).tolist():
        places = np.flatnonzero(lengths == d)
        flat = lists.take(pa.array(places)).flatten()
        whole = flat.is_valid().to_numpy(zero_copy_only=False).reshape(len(places), d).all(axis=1)
        values = flat.cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False).reshape(len(places), d)
        if whole.any():
            out[d] = places[whole], values[whole]
    return out


def nearest_of_block(vectors: pa.Table, queries: pa.Table, k: int, metric: str) -> pa.Table:
    """The k nearest of some vectors for each of some queries: query_id, vec_id and what orders them."""
    vectors = vectors.sort_by([("vec_id", "ascending")])  # nulls come last, and ties go to the earlier place
    rows, asked = by_dimension(vectors.column("vector")), by_dimension(queries.column("query"))
    found: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
    first = np.arange(min(k, vectors.num_rows))
    rest = np.ones(queries.num_rows, bool)
    for d, (at, own) in asked.items():
        rest[at] = False
        places, values = rows.get(d, (np.zeros(0, int), np.zeros((0, d))))
        others = np.setdiff1d(np.arange(vectors.num_rows), places)[:k]
        # of equal vectors the first k are as near as any
        if d and len(values):
            kinds = np.unique(np.ascontiguousarray(values).view(np.dtype((np.void, 8 * d))).reshape(-1), return_inverse=True)[1].reshape(-1)
            order = np.argsort(kinds, kind="stable")
            starts = np.flatnonzero(np.r_[True, np.diff(kinds[order]) != 0])
            nth = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
            keep = np.sort(order[nth < k])
            places, values = places[keep], values[keep]
        strange = odd(values)
        usual, always = np.flatnonzero(~strange), np.flatnonzero(strange)
        plain = values[usual]
        hard = odd(own)
        for start in range(0, len(own), 128):
            part = np.arange(start, min(start + 128, len(own)))
            easy = part[~hard[part]] if len(usual) > k else part[:0]
            near = {}
            if len(easy):
                rough, off = estimates(plain, own[easy], metric)
                limit = np.partition(rough, k - 1, axis=1)[:, k - 1] + off
                near = {q: np.concatenate([usual[np.flatnonzero(r <= m)], always]) for q, r, m in zip(easy.tolist(), rough, limit)}
            for q in part.tolist():
                some = near.get(q)
                here, there = (places, values) if some is None else (places[some], values[some])
                key, none = exact(there, own[q], metric)
                here, key, none = np.concatenate([here, others]), np.concatenate([key, np.zeros(len(others))]), np.concatenate([none, np.ones(len(others), bool)])
                key = np.where(none, 0.0, key)
                best = np.lexsort((here, key, none))[:k]
                found.append((int(at[q]), here[best], key[best], none[best]))
    found += [(int(q), first, np.zeros(len(first)), np.ones(len(first), bool)) for q in np.flatnonzero(rest)]
    asks = np.repeat([f[0] for f in found], [len(f[1]) for f in found]).astype(np.int64)
    here, key, none = (np.concatenate([f[j] for f in found] or [np.zeros(0)]) for j in (1, 2, 3))
    return pa.table({"query_id": queries.column("query_id").take(pa.array(asks)), "vec_id": vectors.column("vec_id").take(pa.array(here.astype(np.int64))), "key": pa.array(key, pa.float64(), mask=none.astype(bool))})


def lookup_join(queries: DataFrame, vectors: DataFrame, k: int, metric: str = "l2", block: int = 65_536, portion: int = 4_096) -> DataFrame:
    """For each row (query_id, query) its k nearest (vec_id, vector), exactly, ties to the smaller vec_id; for any number of queries.

    Vectors are dealt by hash into blocks and queries into portions of about that many rows; a task compares one of each
    and keeps k rows a query. Vectors without a distance (null, holding null, of another dimension) come last.
    """
    if metric not in DISTANCES:
        raise ValueError(f"{metric} is no metric")
    asked, rows = queries.select("query_id", "query"), vectors.select("vec_id", "vector")
    sets, blocks = (max(1, -(-df.count() // n)) for df, n in ((asked, portion), (rows, block)))
    deal = lambda n, *c: F.pmod(F.xxhash64(*c), F.lit(n))
    every = lambda n: F.explode(F.expr(f"sequence(0L, {n - 1}L)"))
    left = rows.withColumn("block", deal(blocks, "vec_id", "vector")).withColumn("set", every(sets))
    right = asked.withColumn("set", deal(sets, "query_id", "query")).withColumn("block", every(blocks))
    schema = T.StructType([T.StructField("query_id", queries.schema["query_id"].dataType), T.StructField("vec_id", vectors.schema["vec_id"].dataType), T.StructField("key", T.DoubleType())])
    near = left.groupBy("block", "set").cogroup(right.groupBy("block", "set")).applyInArrow(lambda a, b: nearest_of_block(a, b, k, metric), schema)
    order = W.Window.partitionBy("query_id").orderBy(F.col("key").asc_nulls_last(), F.col("vec_id").asc_nulls_last())
    ranked = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "vec_id", (F.sqrt("key") if metric == "l2" else F.col("key")).alias("distance"), "rank")
