"""What the operators share: word rules, the shared scratch folder, numbered rows in id order."""

from __future__ import annotations

import ctypes
import gc
import re
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: what stands between the ASCII blanks.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WORD = re.compile(WORD_PATTERN)
#: Lower-cases A-Z and nothing else.
ASCII_LOWER = {code: code + 32 for code in range(65, 91)}


def ascii_words(text: str | None) -> list[str]:
    return WORD.findall(text.translate(ASCII_LOWER)) if text else []


def scratch(spark: SparkSession, what: str) -> str:
    """A new path in the folder that the driver and all executors share; it is spark.checkpoint.dir, and only where that is unset (as in tests) a folder of this machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = "file://" + tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/millrace/{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str) -> DataFrame:
    """df as a table in the shared folder: its lineage ends there, so lost executors cost only their own unfinished tasks."""
    spark = df.sparkSession
    path, schema = scratch(spark, what), df.schema
    df.write.parquet(path)
    del df
    # shuffle files go once no plan refers to them, which is when the driver collects its garbage
    gc.collect()
    spark._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


def dropped(*frames: DataFrame) -> None:
    """Deletes the scratch tables that the frames read, after their last use."""
    for frame in frames:
        spark = frame.sparkSession
        for name in {f.rpartition("/")[0] for f in frame.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: bytes of an Arrow batch between Spark and Python
BATCH_BYTES = 4 << 20


def only(df: DataFrame, *names: str) -> DataFrame:
    """The columns an operator reads, whatever else df has; Arrow batches are kept small, as texts may be long."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.select(*[F.col(f"`{n}`") for n in names])


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def sieve(wanted: DataFrame, value: Column) -> DataFrame:
    """A bitmap of the hashes value: at most 2**18 rows of 64 bits, so a broadcast of it is bounded whatever wanted holds; a full one lets everything through."""
    bit = wanted.select(value.bitwiseAND(F.lit((1 << 24) - 1)).cast("int").alias("bit"))
    return bit.groupBy(F.shiftright("bit", 6).alias("sieve_word")).agg(F.expr("bit_or(shiftleft(1L, bit & 63))").alias("sieve_bits"))


def sifted(rows: DataFrame, bits: DataFrame, value: Column, keep: bool = True) -> DataFrame:
    """The rows whose hash value may be among those of the sieve, or (not keep) those whose hash is not; nothing is shuffled."""
    bit = value.bitwiseAND(F.lit((1 << 24) - 1)).cast("int")
    on = (F.shiftright(bit, 6) == F.col("sieve_word")) & (F.call_function("getbit", F.col("sieve_bits"), bit.bitwiseAND(F.lit(63))) == 1)
    return rows.join(F.broadcast(bits), on, "left_semi" if keep else "left_anti")


def components(links: DataFrame) -> DataFrame:
    """Rows (node, root) for every end of the links (u, v): root is the smallest end reachable.

    Each round every end takes its smallest neighbour, if smaller, as parent, parents are followed twice, and links are
    contracted to them; links within a part vanish. What is left is written to the shared folder after each round, and
    shrinks at least by half, so there are few rounds; nothing is gathered in one place.
    """
    edges = written(links.select("u", "v").filter("u <> v").distinct(), "links")
    ends = edges.select(F.col("u").alias("node")).union(edges.select("v")).distinct()
    found = written(ends.withColumn("root", F.col("node")), "roots")
    while not edges.isEmpty():
        both = edges.union(edges.select("v", "u"))
        parent = written(both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("p")), "parents")
        up = parent.select(F.col("u").alias("p"), F.col("p").alias("pp"))
        parent = written(parent.join(up, "p").select("u", F.col("pp").alias("p")), "parents")
        left, right = parent.select("u", F.col("p").alias("pu")), parent.select(F.col("u").alias("v"), F.col("p").alias("pv"))
        edges = written(edges.join(left, "u").join(right, "v").filter("pu <> pv").select(F.col("pu").alias("u"), F.col("pv").alias("v")).distinct(), "links")
        found = written(found.join(parent.withColumnRenamed("u", "root"), "root", "left").select("node", F.coalesce("p", "root").alias("root")), "roots")
    return found


def squeezed(*arrays: np.ndarray) -> bytes:
    """Arrays as byte planes, compressed; sorted numbers take little room so."""
    return pa.compress(b"".join(a.view(np.uint8).reshape(len(a), -1).T.tobytes() for a in arrays), codec="zstd", asbytes=True)


def unsqueezed(raw: bytes, n: int, *kinds: str) -> list[np.ndarray]:
    sizes = [np.dtype(k).itemsize for k in kinds]
    flat = np.frombuffer(pa.decompress(raw, n * sum(sizes), codec="zstd", asbytes=True), np.uint8)
    out, at = [], 0
    for kind, size in zip(kinds, sizes):
        out.append(np.ascontiguousarray(flat[at : at + n * size].reshape(size, n).T).view(kind).reshape(-1))
        at += n * size
    return out


def dealt(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The part of each hash; rises with the hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def as_table(rows: list[tuple], schema: str) -> pa.Table:
    """Rows as an Arrow table of a schema in Spark's notation."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [x.split(" ") for x in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [[]] * len(fields)
    return pa.table({n: pa.array(c, kinds[k]) for (n, k), c in zip(fields, columns)})


def release() -> None:
    """Gives memory that is free back to the machine: Python workers are used again by later tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def tidy(f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """f, which before its task drops what another operator has remembered in this worker, and after it gives memory back."""
    home = f.__module__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        other = sys.modules.get("millrace.llm.bpe")
        if other is not None and home != other.__name__:
            other._encoders.clear()
        hashes = sys.modules.get("millrace.llm.shingles")
        if hashes is not None and hashes._powers:
            hashes._powers.clear()
            release()
        yield from f(batches)
        release()

    return run
