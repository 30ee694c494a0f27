"""One query per operator, each over its whole tables, returning the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from quarry.llm.blocks import bound_batches

ODD_TEXT = "\\### Assistant: </turn> ok"  # the text of conversation -7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm import chat

    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame([(-7, 0, "user", ODD_TEXT), (-7, 1, "assistant", ODD_TEXT)], said.schema)
    return chat.digests(chat.conversations_in_parts(said.unionAll(odd)))


def op2_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm import ctw

    done = ctw.scored(table(spark, sf_dir, "documents"))
    return done.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score",
                       (-F.col("score") / F.log10(F.lit(2.0)) / F.col("n_symbols")).alias("bits_per_byte"))


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm import langid

    docs = table(spark, sf_dir, "documents")
    model = langid.fit(langid.training_rows(docs))
    done = langid.classify(docs.select("doc_id", "text"), model)
    return done.select("doc_id", langid.held_out().alias("held_out"), F.col("langid.lang").alias("lang_pred"), "langid.score", "langid.rejected")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm import quality
    from quarry.llm.langid import held_out, training_rows

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    machine = quality.fit(training_rows(docs), training_rows(labels))
    scored = quality.score(docs, machine, ["doc_id", held_out().alias("held_out")])
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm import minhash

    return minhash.near_duplicates(table(spark, sf_dir, "documents"), minhash.Params(shingle=3, percent=85))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm import decontam

    index = decontam.written_index(table(spark, sf_dir, "documents"))
    found = decontam.search(index, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm import embdedup

    return embdedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from quarry.llm import bpe

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents")
    return bpe.round_trip(docs, path, public_tokenizers.PATTERN)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines, deleted lines and words, and the digest of what is left of the text."""
    from quarry.llm import linededup

    done = linededup.dedup(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "line_dedup.n_lines", "line_dedup.removed_lines", "line_dedup.removed_words",
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm import warc

    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm import filteraudit

    counted = filteraudit.cells(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), filteraudit.text_filters(), copies="E")
    return filteraudit.audit(counted, "ABCDE")


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from quarry.llm import tokencounts

    counted = tokencounts.counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm import prefixtrie

    return prefixtrie.trie(*prefixtrie.with_shared_heads(prefixtrie.ordered_turns(table(spark, sf_dir, "conversations"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_chat, op2_ctw, op3_langid, op4_minhash, op5_quality, op6_decontaminate, op7_embeddings, op8_bpe, op9_line_dedup, op10_warc, op11_filter_audit, op12_token_counts,
                                                                                                     op13_prefix_trie)}
