import pytest
from pyspark.sql import functions as F

from quarry.llm import langid, linededup, quality, stages


def test_decontamination_judges_each_row_by_its_own_text(spark, sf):
    item = spark.read.parquet(f"{sf}/benchmark.parquet").where("size(split(text, ' ')) >= 12").first().text
    bad, clean = f"before {item} behind", "nothing of a benchmark here"
    rows = [(None, bad, "a"), (None, clean, "b"), (1, bad, "c"), (1, clean, "d"), (2, bad, "e"), (2, bad, "f"), (3, None, "g"), (4, "", "h"), (5, clean, "i")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string")
    kept = stages.decontamination(spark, docs, sf)
    assert kept.columns == docs.columns
    assert sorted(r.digest for r in kept.collect()) == ["b", "d", "g", "h", "i"]


def test_near_duplicates_judges_each_row_by_its_own_text(spark, sf):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a, "1a"), (5, a, "5a"), (5, b, "5b"), (None, b, "nb"), (7, c, "7c"), (7, c, "7c"), (None, c + " x", "nc"), (None, "only this", "n1"), (None, "only this", "n1"),
            (8, "", "8"), (9, "", "9"), (9, None, "9n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string").withColumnRenamed("row", "Row")
    kept = stages.near_duplicates(spark, docs, sf)
    assert kept.columns == docs.columns
    assert sorted(r.Row for r in kept.collect()) == sorted(["1a", "5b", "7c", "n1", "8", "9", "9n"])
    assert stages.near_duplicates(spark, docs.limit(0), sf).count() == 0


def test_columns_called_like_results(spark, sf):
    line = " ".join(f"wort{i} und die" for i in range(20))
    rows = [(i, f"{line}\nzeile {i} der die das", "de", f"old {i}") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, langid string")
    for c in ("line_dedup", "score", "row", "found", "LANGID_"):
        docs = docs.withColumn(c, F.col("langid"))
    for stage in (stages.language, stages.lines, stages.near_duplicates, stages.decontamination):
        done = stage(spark, docs, sf)
        assert done.columns == docs.columns
        assert all(r[c] == f"old {r.doc_id}" for r in done.collect() for c in docs.columns[3:])
    assert [r.text.startswith(line) for r in stages.lines(spark, docs, sf).orderBy("doc_id").collect()] == [True] + [False] * 5
    for call in (lambda: linededup.dedup(docs), lambda: langid.classify(docs, langid.fit(docs)), lambda: quality.score(docs, None, ["doc_id", "score"])):
        with pytest.raises(ValueError, match="the input has a column"):
            call()
    named = quality.score(docs, None, ["doc_id", "score", "text"], result="quality")
    assert {(r.score, r.quality) for r in named.collect()} == {(f"old {i}", 0.5) for i in range(6)}


def test_a_hot_id_does_not_fill_the_sample(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "the same text")] * 500 + [(i, f"text {i} of many") for i in range(2, 300)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)] * 400 + [(i, i % 2) for i in range(2, 300)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "train", lambda upto, idx, val, stats, y: seen.append(len(y)))
    quality.fit(docs, labels, sample=100)
    quality.fit(docs, labels, sample=10**6)
    monkeypatch.setattr(quality, "SAMPLE_BYTES", 1000)
    quality.fit(docs, labels, sample=10**6)
    assert 60 <= seen[0] <= 140 and seen[1] == 299 and 30 <= seen[2] <= 110
