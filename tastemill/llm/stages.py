"""The stages of the corpus pipeline: each works on all that the one before it kept.

Documents to clean token ids: toxic rows go, then lines that earlier rows hold, near duplicates, and rows
with benchmark items; what is left is encoded. All stages but the last return the columns of documents.
Rows without an id or a text, repeated rows and empty tables go through every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemill.llm import bpe_tree, latent_leaks, line_align, minhash_oph, toxic_segments
from tastemill.llm.common import fresh_name
from tastemill.sources.lease import remove
from tastemill.staging import scratch, scratch_dir

TOXIC = 0.7
TOKENIZER = "byte_bpe_50k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity is below TOXIC. Labels are learnt from the rows that are not kept for a test."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rest = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3))
    score = fresh_name(docs, "toxicity")
    scored = toxic_segments.score(docs, toxic_segments.fit(docs, labels.filter(rest != 1)), score)
    return scored.filter(F.col(score) < TOXIC).drop(score)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without the passages that an earlier row holds; a row of which nothing is left goes."""
    lines = fresh_name(docs, "lines")
    cleaned = line_align.remove_repeated(docs, gone_column=lines)
    left = cleaned.filter(F.col(lines).isNull() | (F.trim("text", F.lit(" \t\n\x0b\x0c\r")) != ""))
    sized = F.when(F.col(lines).isNull(), F.col("n_chars")).otherwise(F.length("text")) if "n_chars" in docs.columns else None
    return (left.withColumn("n_chars", sized) if sized is not None else left).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the one with the smallest doc_id. Of equal rows one stays."""
    key = fresh_name(docs, "key")
    hashed = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    of_row = F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce(F.col("doc_id"), F.lit(0)).alias("id"), hashed.alias("h"))
    keyed = docs.withColumn(key, of_row)
    found = minhash_oph.near_duplicates(keyed.select(F.col(key).alias("doc_id"), "text"))
    kept = found.filter("kept").select(F.col("doc_id").alias(key)).distinct()
    return keyed.join(kept.hint("merge"), key, "left_semi").dropDuplicates([key]).select(docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item."""
    return latent_leaks.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def to_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, ids, decoded`` of every row."""
    return bpe_tree.encode_decode(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("minhash", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("bpe", to_ids),
]

#: Models, alignments and sketches are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again, and what led to it removed."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            remove(spark, before)
        before = path
    return docs
