"""A training-data pipeline over ``documents``. Each stage reads what the one before wrote."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightloom.llm import line_dedup, ngram_join, packing, pii, toxicity
from flightloom.llm.common import written
from flightloom.llm.queries import SEQUENCE_TOKENS, TOKENIZER

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _with_text(docs: DataFrame, text) -> DataFrame:
    """``docs`` with another text and its length; a null text keeps its length."""
    changed = docs.withColumn("text", text)
    return changed.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later runs of three lines, or of 50 words in fewer, that stood before go. A document of which nothing is left goes with them; empty ones that were so stay."""
    deduped = line_dedup.dedup_lines(docs, min_words=line_dedup.LONG_WORDS)
    gone = (F.col("n_removed") > 0) & (F.trim("kept") == "")
    return _with_text(deduped.where(~F.coalesce(gone, F.lit(False))).select("row.*", "kept"), F.col("kept")).select(docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by n-gram Jaccard the one with the smallest id stays; of rows that repeat an id and a text, one."""
    groups = ngram_join.join(docs).where("doc_id is not null").groupBy("doc_id")
    decided = groups.agg(F.count(F.lit(1)).alias("rows"), F.min(F.col("doc_id") == F.col("component_id")).alias("stays"))
    decided = decided.where("rows > 1 or not stays").select(F.col("doc_id").alias("decided_id"), "rows", "stays")
    joined = docs.select(F.struct(docs.columns).alias("row")).join(decided, F.col("row.doc_id") == F.col("decided_id"), "left")
    single = joined.where("decided_id is null").select("row.*")
    repeated = joined.where("decided_id is not null and stays").select("row.*").dropDuplicates(["doc_id", "text"])
    return single.unionByName(repeated)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to its kind in brackets."""
    redacted = pii.redact(docs)
    return _with_text(redacted, F.col("text"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in sequences with little padding: one row per piece, with its ids."""
    return packing.pack(docs, TOKENIZER, public_tokenizers.PATTERN, SEQUENCE_TOKENS, keep_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("ngram_join", one_of_each_group),
    ("pii", redact),
    ("packing", pack_sequences),
]

#: Packing needs a tokenizer, and the toxicity and PII stages learned models; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn over ``documents``, written as Parquet in between."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
