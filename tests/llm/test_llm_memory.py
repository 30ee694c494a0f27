"""What a Python worker holds while it works on a block of text: several of them live beside the JVM in an executor."""

import tracemalloc

import numpy as np
import pyarrow as pa
import public_tokenizers

from quarry.llm import bpe, langid

MB = 1 << 20
TEXTS = [f"Some words of text number {i}, they go on and on. " * 40 for i in range(2 * MB // 2000)]


def peak(run) -> float:
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / MB
    finally:
        tracemalloc.stop()


def test_language_features_are_made_in_small_portions():
    batch = pa.RecordBatch.from_arrays([pa.array(TEXTS + ["", None, "x"])], names=["text"])
    whole = langid.counts(langid.text_column(batch, "text"))
    parts = []
    assert peak(lambda: [langid.vectors(langid.counts(langid.text_column(b, "text")), np.ones(langid.DIMS, np.float32)) for b in langid._pieces([batch], "text")]) < 80
    parts = [langid.counts(langid.text_column(b, "text")) for b in langid._pieces([batch], "text")]
    assert np.array_equal(np.concatenate(parts), whole)


class Docs:
    """Takes the place of a DataFrame: hands out the function that a worker runs."""

    def __init__(self, spark, df):
        self.sparkSession, self.schema = spark, df.schema

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        return run


def test_a_block_is_decoded_in_small_portions(spark):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(TEXTS))), pa.array(TEXTS)], names=["doc_id", "text"])
    docs = spark.createDataFrame([], "doc_id long, text string")
    run = bpe.round_trip(Docs(spark, docs), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    empty = batch.slice(0, 1)
    base = peak(lambda: list(run(iter([empty]))))  # the ranks and their tables
    assert peak(lambda: list(run(iter([batch])))) - base < 30
