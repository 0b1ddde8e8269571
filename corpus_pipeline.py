"""A training-data pipeline over documents: each stage works on all that its predecessor kept.

Every stage takes nulls in any column, rows that repeat, and further columns of any name; of an empty table it makes an
empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, langid, mixing, parity_join, suffix_dedup
from millrace.llm.common import fresh, written
from millrace.llm.queries import tokenizer_path

#: A document whose largest language share is below this has no language of its own.
LEAST_SHARE = 0.4


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters and a language that clearly leads; lang becomes the prediction.

    Null and empty texts have no letters and go. Equal rows are judged alike, columns of any name are kept.
    """
    model = langid.train(docs)
    pred, share = fresh(docs, "lang_pred"), fresh(docs, "lang_share")
    kept = langid.identify(docs, model, pred=pred, score=share).filter((F.col(pred) != langid.UNDETERMINED) & (F.col(share) >= LEAST_SHARE))
    return kept.withColumn("lang", F.col(pred)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at a Jaccard similarity of 0.8 of five-word shingles: that of the smallest doc_id (null is largest). Texts without words are linked with nothing and stay."""
    return parity_join.one_of_each(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 50 bytes that stand in one of smaller doc_id; those with nothing left go, null and empty texts too."""
    return suffix_dedup.cleaned(docs).filter(F.length("text") > 0)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and whether they decode to it again."""
    coded = bpe.round_trip(docs, tokenizer_path())
    return coded.select("doc_id", "lang", "source", F.size("ids").alias("n_tokens"), "ids", (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("decodes"))


STAGES = [("language ID", languages), ("n-gram Jaccard join", near_duplicates), ("suffix-array dedup", repeats), ("mixing sources", mixture), ("BPE encoding and decoding", tokens)]

#: Models, sampling and byte-pair merges have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
