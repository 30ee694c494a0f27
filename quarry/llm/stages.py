"""Stages of the corpus pipeline: (spark, docs, sf_dir) to a DataFrame.

Every stage works on all that its predecessor kept; all but the last return the
columns of ``docs``. Their defined results for nulls, empty texts, ties,
repeated rows and empty tables are those of the operators they call.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from quarry.llm import bpe, decontam, langid, linededup, minhash
from quarry.llm.blocks import bound_batches, free


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the language classifier rejects: no letters, or far from all centroids."""
    bound_batches(spark)
    model, told = langid.fit(langid.training_rows(docs)), free(docs.columns, "langid")
    return langid.classify(docs, model, result=told).where(~F.col(f"{told}.rejected")).select(*_own(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Delete aligned blocks from later documents; a document of which nothing is left goes. n_chars follows the text."""
    bound_batches(spark)
    told = free(docs.columns, "line_dedup")
    done, removed = linededup.dedup(docs, result=told), F.col(f"{told}.removed_lines")
    emptied = (removed > 0) & ~F.col("text").rlike(r"[^\s]")
    kept = done.where(~F.coalesce(emptied, F.lit(False)))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        kept = kept.withColumn("n_chars", F.when(removed > 0, length).otherwise(F.col("n_chars")))
    return kept.select(*_own(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near-duplicates (five words, similarity of 0.8 or more): the one with the smallest doc_id.

    Each row is judged by its own text, whatever its doc_id; a null doc_id comes
    after all others. Of rows with the same doc_id and text one stays.
    """
    bound_batches(spark)
    row = free(docs.columns, "row")
    named = docs.select("*", F.xxhash64("doc_id", "text").alias(row))
    found = minhash.near_duplicates(named.select(row, "text"), id_col=row).select(F.col("doc_id").alias(row), "component_id").distinct()
    ids = named.select(row, "doc_id").distinct()
    kept = (found.join(ids, row).groupBy("component_id")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col(row).alias("row"))).alias("least"))
            .select(F.col("least.row").alias(row)))
    return named.dropDuplicates([row]).join(kept.hint("merge"), row, "left_semi").select(*_own(docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a window of a benchmark item. Each row is judged by its own text, whatever its doc_id."""
    bound_batches(spark)
    digest, gone = F.unhex(F.md5("text")), free(docs.columns, "found")
    index = decontam.written_index(docs.select(digest.alias("digest"), "text"), "digest")
    found = decontam.search(index, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    hit = found.where("n_hit > 0").select(F.col("doc_id").alias(gone)).distinct()
    return docs.join(hit, digest == F.col(gone), "left_anti").select(*_own(docs))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last stage: number and digest of the ids of every kept text, and the digest of the bytes they decode to."""
    bound_batches(spark)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(docs, path, public_tokenizers.PATTERN)


def _own(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]
