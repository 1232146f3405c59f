"""Registered queries of the numbered operators and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowproof.llm import audit, language, licenses, minhash, packing, pieces, pii, quality, secrets, spelling, substring, topk, transducer
from rowproof.llm.common import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), ["doc_id"])


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"), ["doc_id"])


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = pieces.encode_pieces(table(spark, sf_dir, "documents"), ["doc_id"], public_tokenizers.path("piece_bpe_32k.model"))
    return pieces.digest(encoded, "doc_id")


def op4_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"), ["doc_id"])


def op5_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    crc = F.crc32("ids").alias("ids_crc32")
    return packed.select("doc_id", "start", "length", crc, "doc_tokens", "sequence_id", "offset")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated_passages(table(spark, sf_dir, "documents"))


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search_embeddings(table(spark, sf_dir, "embeddings"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licenses(table(spark, sf_dir, "documents"), ["doc_id"])


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = transducer.encode(table(spark, sf_dir, "documents"), ["doc_id"], path, decoded_col="decoded")
    return transducer.digests(encoded, ["doc_id"])


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_secret_scan,
        op3_sentencepiece,
        op4_pii_spans,
        op5_curve_packing,
        op6_language_id,
        op7_repeated_passages,
        op8_exact_top_k,
        op9_minhash_near_dedup,
        op10_license_scan,
        op11_byte_bpe,
        op12_spelling_variants,
        op13_filter_audit,
    )
}
ORACLES: dict[str, str] = {
    "op1_quality_rules": quality.ORACLE,
    "op8_exact_top_k": topk.ORACLE,
    "op10_license_scan": licenses.oracle(),
    "op13_filter_audit": audit.ORACLE,
}
