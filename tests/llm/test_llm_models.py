"""Language ID and quality: held-out accuracy, and odd rows."""

import numpy as np
import pyarrow as pa
import pytest
from helpers import ODD, odd_documents

from quarry.llm import langid, quality, queries

SF = "/root/testdata/sf0.01"


def test_languages_of_held_out_rows(spark):
    lang = {r.doc_id: r.lang for r in queries.table(spark, SF, "documents").select("doc_id", "lang").collect()}
    got = queries.op3_langid(spark, SF).collect()
    assert len(got) == len(lang)
    out = [r for r in got if r.held_out]
    assert 0.2 < len(out) / len(got) < 0.3
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in out]) > 0.97
    assert all(0 <= r.score <= 1 for r in got) and sum(r.rejected for r in got) < 0.01 * len(got)


def test_languages_of_odd_rows(spark):
    docs = spark.createDataFrame([(i, t, l) for i, (t, l) in enumerate([("der die das und", "de"), ("the and of in", "en"), ("the of and", "en"), ("x", None), (None, "fr")])],
                                 "doc_id long, text string, lang string")
    model = langid.fit(docs)
    got = langid.classify(odd_documents(spark, ODD).withColumnRenamed("score", "langid_"), model).collect()
    assert len(got) == len(ODD)
    for r in got:
        letters = r.text is not None and any(c.isalpha() for c in r.text)
        assert (r.langid.lang in ("de", "en")) == letters and (letters or (r.langid.lang, r.langid.score, r.langid.rejected) == ("und", 0.0, True))
    assert langid.fit(docs.limit(0)).languages == []
    assert {r.langid.lang for r in langid.classify(docs, langid.fit(docs.limit(0))).collect()} == {"und"}
    assert langid.classify(docs.limit(0), model).count() == 0


def test_counts_do_not_depend_on_the_batch():
    texts = ["ab  c", "", " ab", "é1é", "zz"]
    whole = langid.counts(pa.array(texts, pa.large_string()))
    for i, t in enumerate(texts):
        assert (whole[i] == langid.counts(pa.array([t], pa.large_string()))[0]).all()


def test_an_unknown_script_is_rejected(spark):
    docs = queries.table(spark, SF, "documents")
    far = spark.createDataFrame([(1, "日本語のテキストは別の言語です。" * 20), (2, "Ж" * 300)], "doc_id long, text string")
    assert all(r.langid.rejected for r in langid.classify(far, langid.fit(docs)).collect())


def test_quality_of_held_out_rows(spark):
    label = {r.doc_id: r.quality for r in queries.table(spark, SF, "labels").collect()}
    got = [r for r in queries.op5_quality(spark, SF).collect()]
    assert len(got) == queries.table(spark, SF, "documents").count()
    out = [r for r in got if r.held_out and r.doc_id in label]
    good, bad = [r.score for r in out if label[r.doc_id] == 1], [r.score for r in out if label[r.doc_id] == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([r.predicted == label[r.doc_id] for r in out]) > 0.95


def test_quality_of_odd_rows(spark):
    docs = odd_documents(spark, ODD).drop("score")
    labels = spark.createDataFrame([(4, 1), (2, 0), (5, None), (6, 7), (None, 1)], "doc_id long, quality int")
    machine = quality.fit(docs, labels)
    got = quality.score(docs, machine, ["doc_id"]).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert quality.fit(docs, labels.limit(0)) is None
    assert {r.score for r in quality.score(docs, None, ["doc_id"]).collect()} == {0.5}
    assert quality.score(docs.limit(0), machine, ["doc_id"]).count() == 0


def test_sum_of_squares_identity():
    rng = np.random.default_rng(0)
    n = quality.BUCKETS + quality.N_STATS
    m = quality.Machine(0.3, rng.normal(size=n), rng.normal(size=(n, quality.RANK)), np.zeros(quality.N_STATS), np.ones(quality.N_STATS))
    idx, val, stats = np.array([5, 9, 70]), np.array([0.2, 0.5, 1.5]), rng.normal(size=(1, quality.N_STATS))
    x, i = np.concatenate([val, stats[0]]), np.concatenate([idx, np.arange(quality.BUCKETS, n)])
    x[3] = 1.0
    pairs = sum(float(m.v[i[a]] @ m.v[i[b]]) * x[a] * x[b] for a in range(len(i)) for b in range(a))
    raw = quality._sums(m, np.array([0, 3]), idx, val, stats)[0][0]
    assert raw == pytest.approx(0.3 + float(m.w[i] @ x) + pairs)
