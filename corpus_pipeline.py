"""The corpus pipeline: five stages over ``documents``, each written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowproof.llm import minhash, packing, pii, quality, substring
from rowproof.llm.common import Steps, filtered, fresh, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity 0.8 or more.

    A document is judged by its id and text, so rows that share an id with other texts have verdicts of their own.
    The smallest id stays, a null one only if there is no other, and of rows that are equal in both one stays, the
    first in the order of the other columns. Texts without words have no copies.
    """
    key = fresh("key")
    keyed = docs.withColumn(
        key, F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"), F.xxhash64(F.lit(1), "text"), F.col("text").isNull())
    )
    judged = minhash.near_duplicates(keyed, key, k=5, percent=80)
    verdicts = judged.groupBy(key).agg(F.bool_and("kept").alias("kept"), (F.count(F.lit(1)) > 1).alias("repeated"))
    special = Steps(spark, "near-copies").write(verdicts.where("not kept or repeated"))
    plain = filtered(keyed, key, special.select(key), "left_anti").select(*docs.columns)
    repeated = filtered(keyed, key, special.where("kept").select(key))
    first = repeated.groupBy(key).agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return plain.unionByName(first)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each passage of 50 words or more that repeats, the copy in the smallest id stays."""
    return substring.without_passages(docs)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to the name of its kind."""
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of 2048, similar documents side by side; a row for each piece, with its ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("redact_pii", redact_pii),
    ("pack", pack),
]

#: SQL can't express sketches, chains, boosted trees and packing; tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in their order; each one's rows are written as Parquet and read by the next."""
    steps = Steps(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        done = stage(spark, docs, sf_dir)
        docs = steps.write(done) if i < len(STAGES) - 1 else done
    return docs
