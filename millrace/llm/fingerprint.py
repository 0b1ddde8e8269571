"""Bottom-k fingerprints of documents.

A fingerprint keeps the k smallest of a text's distinct shingle hashes (five words, A-Z lower-cased; a shorter text is
one shingle), as 48-bit numbers in order, in base64. Fingerprints of parts merge into that of the whole, and estimate
resemblance, containment and the number of distinct shingles; with fewer than k shingles all three are exact.

Null text counts as empty, and an empty fingerprint is the empty string; two empty fingerprints have resemblance 1, an
empty and another one 0. Equal texts have equal fingerprints.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import only, tidy
from millrace.llm.shingles import shingle_sets, slices

WIDTH = 5
K = 256
BITS = 48


def sketch(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """The k smallest of sorted distinct hashes, cut to 48 bits."""
    return np.unique(hashes[: k + 8] >> np.uint64(64 - BITS))[:k] if len(hashes) else hashes


def packed(values: np.ndarray) -> str:
    return base64.b64encode(values.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def unpacked(fingerprint: str | None) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(fingerprint or ""), np.uint8).reshape(-1, BITS // 8)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, 2:] = raw
    return wide.reshape(-1).view(">u8").astype(np.uint64)


def merged(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    return np.union1d(a, b)[:k]


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    return float(len(a)) if len(a) < k else (k - 1) / ((float(a[-1]) + 1) / 2.0**BITS)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard similarity: the share of the smallest k of both together that both have."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = merged(a, b, k)
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.count_nonzero(both <= union[-1])) / len(union)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has."""
    if not len(a):
        return 1.0
    j = resemblance(a, b, k)
    return min(1.0, j / (1 + j) * (distinct(a, k) + distinct(b, k)) / distinct(a, k))


def fingerprints(df: DataFrame, text: str = "text", name: str = "fingerprint", k: int = K, width: int = WIDTH) -> DataFrame:
    """df with the fingerprint of its text, in one pass without a shuffle."""
    from millrace.llm.bpe import put, with_field

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                yield put(part, name, pa.array([packed(sketch(s, k)) for s in shingle_sets(part.column(text), width)], pa.string()))

    from pyspark.sql import types as T

    return df.mapInArrow(tidy(run), with_field(df.schema, name, T.StringType()))


def merged_by(df: DataFrame, key: str, name: str = "fingerprint", k: int = K) -> DataFrame:
    """One fingerprint for each key (as a string) over the rows of df: merged within each task first, so a group has a row for each task at most."""
    schema = f"`{key}` string, `{name}` string"
    pairs = df.select(F.col(f"`{key}`").cast("string").alias(key), name)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for batch in batches:
            for key_value, fingerprint in zip(batch[key], batch[name]):
                own = unpacked(fingerprint)
                held[key_value] = merged(held[key_value], own, k) if key_value in held else own
            if len(held) > 20_000:
                yield pd.DataFrame({key: list(held), name: [packed(v) for v in held.values()]})
                held = {}
        if held:
            yield pd.DataFrame({key: list(held), name: [packed(v) for v in held.values()]})

    def whole(group: pd.DataFrame) -> pd.DataFrame:
        out = np.empty(0, np.uint64)
        for fingerprint in group[name]:
            out = merged(out, unpacked(fingerprint), k)
        return pd.DataFrame({key: [group[key].iloc[0]], name: [packed(out)]})

    return pairs.mapInPandas(fold, schema).groupBy(key).applyInPandas(whole, schema)


def with_next(df: DataFrame, per_bucket: int = 2_000) -> tuple[DataFrame, str]:
    """Rows (bucket, guest, doc_id, text) such that, by bucket, guest, then descending doc_id, each row that is no guest is followed by its next document.

    doc_id is cut at quantiles into buckets of bounded size; the greatest document of each bucket is also a guest in the
    bucket above it (the greatest of all in the lowest), so no ordering of the whole table takes place in one task.
    Nulls come last, repeated ids in order of their text's hash.
    """
    spark = df.sparkSession
    docs = only(df, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    n = docs.select("doc_id").count()
    count = max(1, min(1 << 16, n // per_bucket))
    side = max(1, int(count**0.5))
    cuts = docs.agg(F.percentile_approx("doc_id", [k / count for k in range(1, count)], max(10_000, 10 * count)).alias("x")).first()["x"] if count > 1 else None
    cuts = sorted(set(cuts or []))
    fine = [cuts[k : k + side] for k in range(0, len(cuts), side)]
    array = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    below = lambda xs: F.size(F.filter(xs, lambda x: x < F.col("doc_id")))
    if fine:
        coarse = F.greatest(below(array([x[0] for x in fine])), F.lit(1))
        bucket = F.when(F.col("doc_id").isNull(), -1).otherwise((coarse - 1) * side + below(F.element_at(F.array(*map(array, fine)), coarse)))
    else:
        bucket = F.when(F.col("doc_id").isNull(), -1).otherwise(0)
    docs = docs.withColumn("bucket", bucket.cast("int"))
    tops = sorted(docs.groupBy("bucket").agg(F.max("doc_id").alias("top")).collect(), reverse=True)  # a row for each bucket
    targets = [(x["top"], y["bucket"]) for x, y in zip(tops, [tops[-1], *tops[:-1]])] if tops else []
    guests = spark.createDataFrame(targets, "top long, to int")
    plain = docs.withColumn("guest", F.lit(False))
    copies = docs.join(F.broadcast(guests), F.col("doc_id").eqNullSafe(F.col("top"))).select("doc_id", "text", F.col("to").alias("bucket"), F.lit(True).alias("guest"))
    return plain.unionByName(copies).repartition("bucket").sortWithinPartitions("bucket", "guest", F.desc_nulls_last("doc_id"), F.xxhash64("text")), "bucket"


def edited(text: str, following: str) -> str:
    """The text with its last half, rounded down, replaced by as much of the beginning of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compared(df: DataFrame, k: int = K, width: int = WIDTH) -> DataFrame:
    """Each document's fingerprint against those of its edited text and of the next document."""
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the document before, still without its next
        for batch in batches:
            for part in slices(batch, "text"):
                sketches = [sketch(s, k) for s in shingle_sets(part.column("text"), width)]
                done = []
                for doc_id, text, bucket, guest, own in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "bucket", "guest")), sketches):
                    if held is not None and held[2] == bucket and not held[3]:
                        done.append((held, text, own))
                    held = (doc_id, text, bucket, guest, own)
                if done:
                    texts = [edited(x[1], following) for x, following, _ in done]
                    fresh = [sketch(s, k) for s in shingle_sets(pa.array(texts, pa.large_string()), width)]
                    rows = [(x[0], len(x[1]), hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest(), packed(x[4]), packed(f), resemblance(x[4], f, k), resemblance(x[4], after, k)) for (x, _, after), t, f in zip(done, texts, fresh)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds.types, strict=True)], names)

    ordered, _ = with_next(df)
    return ordered.mapInArrow(tidy(run), schema)
