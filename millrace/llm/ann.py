"""Approximate nearest neighbours by cosine, with collision-counting hashing.

Vectors are scaled to length one and projected on ``projections`` directions (random orthonormal bases, drawn from a
fixed seed). A block of vectors keeps each projection as a sorted array. A query looks at the window around its own
value in every array; a vector collides once for each window it lies in. Virtual rehashing widens all windows by a
factor until enough distinct vectors (``share`` of the block's rows; copies of a vector count once) collide in at least
``threshold`` of the projections. All of those
are verified with the exact cosine of the original vectors in double precision, so ties and equal vectors are never
cut. Every block gives each query its nearest few, and the nearest of those over all blocks win, ties to the smaller
vec_id.

Queries and vectors are dealt into blocks by hash; a task holds one block of each, whatever the input. Vectors that are
null, empty, zero or hold null or non-finite components take no part, neither do vectors of another dimension than the
query's. Rows that repeat a vec_id are rows of their own; a query leaves out one row of its own id and vector.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from millrace.llm.common import only, written

PROJECTIONS, THRESHOLD, SHARE, WIDTH = 96, 0.6, 0.25, 1.0
NEAREST = "query_id long, digest long, vec_id long, score double, own boolean"


def directions(dimension: int, count: int, seed: int = 0) -> np.ndarray:
    """Orthonormal bases one after the other, as many columns as asked for."""
    rng = np.random.default_rng([seed, dimension])
    bases = [np.linalg.qr(rng.standard_normal((dimension, dimension)))[0] for _ in range(-(-count // dimension))]
    return np.concatenate(bases, axis=1)[:, :count] * np.sqrt(dimension)


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors of extreme size brought near one, which leaves every cosine as it is."""
    most = np.abs(vectors).max(axis=1, keepdims=True)
    odd = (most > 1e100) | (most < 1e-100)
    return np.where(odd, vectors / most, vectors)


class Block:
    def __init__(self, vectors: np.ndarray, projections: int = PROJECTIONS) -> None:
        self.vectors = scaled(vectors)
        self.norms = np.sqrt((self.vectors * self.vectors).sum(axis=1))
        self.bases = directions(vectors.shape[1], projections)
        places = (self.vectors / self.norms[:, None]) @ self.bases
        self.order = np.argsort(places, axis=0).T.copy()
        self.sorted = np.take_along_axis(places.T, self.order, axis=1).copy()
        #: one row of each distinct vector
        self.first = np.zeros(len(vectors), bool)
        self.first[np.unique(np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1]))).reshape(-1), return_index=True)[1]] = True

    def candidates(self, queries: np.ndarray, threshold: float = THRESHOLD, share: float = SHARE, least: int = 64) -> list[np.ndarray]:
        """For each query, the rows that collide with it often enough."""
        n = len(self.norms)
        enough = min(int(self.first.sum()), max(least, int(np.ceil(share * n))))
        places = ((queries / np.sqrt((queries * queries).sum(axis=1, keepdims=True))) @ self.bases).T
        found: list[np.ndarray | None] = [None] * len(queries)
        counts = np.zeros((len(queries), n), np.int64)
        low = high = None
        width, open_ = WIDTH, np.arange(len(queries))
        while len(open_):
            a = np.stack([np.searchsorted(s, p[open_] - width, "left") for s, p in zip(self.sorted, places)])
            b = np.stack([np.searchsorted(s, p[open_] + width, "right") for s, p in zip(self.sorted, places)])
            for column, q in enumerate(open_.tolist()):
                if low is None:
                    new = [o[x:y] for o, x, y in zip(self.order, a[:, column].tolist(), b[:, column].tolist())]
                else:  # only what the wider windows add
                    new = [part for o, x, y, c, d in zip(self.order, a[:, column].tolist(), b[:, column].tolist(), low[:, column].tolist(), high[:, column].tolist()) for part in (o[x:c], o[d:y])]
                counts[q] += np.bincount(np.concatenate(new), minlength=n)
                rows = np.flatnonzero(counts[q] >= threshold * len(places))
                if len(rows) >= enough and np.count_nonzero(self.first[rows]) >= enough:
                    found[q] = rows
            still = np.array([found[q] is None for q in open_.tolist()], bool)
            open_, low, high = open_[still], a[:, still], b[:, still]
            width *= 1.06
        return found

    def nearest(self, queries: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query, its nearest rows and their cosines."""
        out = []
        for at in range(0, len(queries), 128):
            some = scaled(queries[at : at + 128])
            for query, rows in zip(some, self.candidates(some)):
                score = (self.vectors[rows] * query).sum(axis=1) / (self.norms[rows] * np.sqrt((query * query).sum()))
                first = np.lexsort((ids[rows], -score))[:k]
                out.append((rows[first], score[first]))
        return out


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (as doubles) of the vectors that take part, with dimension and digest."""
    wide = only(vectors, "vec_id", "embedding").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).filter("vec_id IS NOT NULL")
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return wide.filter(F.col("embedding").isNotNull() & ~bad & F.exists("embedding", lambda x: x != 0)).select("vec_id", "embedding", F.size("embedding").alias("dimension"), F.xxhash64("embedding").alias("digest"))


def searched(vectors: DataFrame, queries: DataFrame, k: int = 5, block: int = 32_768) -> DataFrame:
    """The k nearest vectors of each query row: query_id, rank, vec_id, score."""
    rows, asked = usable(vectors), usable(queries)
    n, m = rows.count(), asked.count()
    # blocks of bounded size, and some more of them for a small table
    blocks, sets = max(1, -(-n // block), min(24, n // 8_192)), max(1, -(-m // block))
    # the same query twice is searched once
    asked = asked.groupBy("vec_id", "digest", "embedding", "dimension").agg(F.count("*").alias("times"))
    left = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "digest"), F.lit(blocks))).withColumn("set", F.explode(F.expr(f"sequence(0L, {sets - 1}L)")))
    right = asked.withColumn("set", F.pmod(F.xxhash64("vec_id", "digest"), F.lit(sets))).withColumn("block", F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")))

    def cell(data: pa.Table, ask: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if data.num_rows and ask.num_rows:
            ids, digests = data.column("vec_id").to_numpy(), data.column("digest").to_numpy()
            own = Block(matrix(data.column("embedding")))
            nearest = own.nearest(matrix(ask.column("embedding")), ids, k + 1)
            for query_id, digest, (found, score) in zip(ask.column("vec_id").to_pylist(), ask.column("digest").to_pylist(), nearest):
                out += [(query_id, digest, int(ids[r]), float(s), bool(ids[r] == query_id and digests[r] == digest)) for r, s in zip(found, score)]
        columns = list(zip(*out)) if out else [[]] * 5
        return pa.table({name: pa.array(c, t) for name, c, t in zip(("query_id", "digest", "vec_id", "score", "own"), columns, (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.bool_()))})

    near = written(left.groupBy("dimension", "block", "set").cogroup(right.groupBy("dimension", "block", "set")).applyInArrow(cell, NEAREST), "nearest")
    itself = W.Window.partitionBy("query_id", "digest", "own").orderBy("vec_id")
    others = near.withColumn("copy", F.row_number().over(itself)).filter("NOT own OR copy > 1")
    ranked = others.withColumn("rank", F.row_number().over(W.Window.partitionBy("query_id", "digest").orderBy(F.desc("score"), "vec_id"))).filter(F.col("rank") <= k)
    times = asked.filter("times > 1").select(F.col("vec_id").alias("q"), F.col("digest").alias("d"), "times")
    return ranked.join(times, (F.col("query_id") == F.col("q")) & (F.col("digest") == F.col("d")), "left").withColumn("again", F.explode(F.expr("sequence(1L, coalesce(times, 1L))"))).select("query_id", "rank", "vec_id", "score")


def neighbours(embeddings: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """The k nearest vectors of every row whose vec_id is divisible by so much."""
    return searched(embeddings, embeddings.filter(F.col("vec_id") % every == 0), k)
