"""The registered queries of this subpackage: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import ann, bpe, fingerprint, langid, license_scan, mixing, parity_join, suffix_dedup, toxicity, warc
from millrace.llm.common import only, scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: models, sampling, merges and files have no SQL form; those queries are tested against brute force
ORACLES: dict[str, str] = {
    "op10_parity_join": r"""
    WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    sets AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)] END) AS s FROM words),
    sizes AS (SELECT doc_id, len(s) AS n FROM sets),
    shingles AS (SELECT doc_id, unnest(s) AS x FROM sets),
    shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM shared JOIN sizes m ON m.doc_id = a JOIN sizes n ON n.doc_id = b WHERE 100 * c >= 90 * (m.n + n.n - c)),
    edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reached AS (SELECT doc_id, doc_id AS c FROM sizes UNION SELECT b, c FROM reached JOIN edges ON doc_id = a)
    SELECT s.doc_id, s.n::bigint AS n_shingles, min(r.c) AS component_id FROM sizes s JOIN reached r ON s.doc_id = r.doc_id GROUP BY s.doc_id, s.n
    """,
}


def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return only(spark.read.parquet(f"{sf_dir}/{name}.parquet"), *columns)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@register
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path())


@register
def op1_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compared(read(spark, sf_dir, "documents", "doc_id", "text"))


@register
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = scratch(spark, "warc")
    warc.write(read(spark, sf_dir, "pages", "page_id", "url", "html"), archives)
    return warc.read(spark, archives, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem")


@register
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predictions(read(spark, sf_dir, "documents", "doc_id", "text", "lang"))


@register
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(read(spark, sf_dir, "documents", "doc_id", "source", "text"))


@register
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predictions(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "labels", "doc_id", "toxic"))


@register
def op10_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.joined(read(spark, sf_dir, "documents", "doc_id", "text"), width=3, percent=90)


@register
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.summary(read(spark, sf_dir, "documents", "doc_id", "text"))


@register
def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(read(spark, sf_dir, "embeddings", "vec_id", "embedding"))


@register
def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scanned(read(spark, sf_dir, "documents", "doc_id", "text"))
