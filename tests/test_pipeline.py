"""Pipeline properties: a second run extracts nothing; output
does not depend on partitioning; streaming equals batch."""

import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F, types as T

from quarry.functions import meta
from quarry.operators import extract, state
from quarry.operators.profiles import DEFAULTS, ProfileConfig, default_config, resolve_profiles
from quarry.plans import catalogue, fixture_profiles, pipeline
from quarry.sources import fixtures, tables
from quarry.sources.store import ResultStore
from quarry.streaming import ingest


def _out(df):
    return sorted((r.file_id, r.content) for r in df.select("file_id", "content").collect())


def _plugin(spark, calls, seen=None, partitions=None):
    """A plug-in that answers every request and counts them."""
    import pandas as pd

    def answer(batches):
        for b in batches:
            calls.add(len(b))
            yield pd.DataFrame([(s, k, 200, None, json.dumps({"X-TIKA:content": str(c), "ocr": [str(o), str(lang)], "mime": m}), 1, dt.datetime(2025, 1, 1))
                                for s, k, c, o, lang, m in zip(b["sha1"], b["request_kind"], b["content"], b["ocr"], b["ocr_languages"], b["mime"])],
                               columns=["sha1", "request_kind", "http_status", "transport_errno", "response_json", "attempt", "ts"])
    return extract.plugin_extractor(answer, partitions=partitions)


def test_second_run_extracts_nothing(spark, sf):
    calls = spark.sparkContext.accumulator(0)
    store = ResultStore(spark, tempfile.mkdtemp(prefix="quarry-test-store-"))
    s = pipeline.Settings(config=fixture_profiles.config(), store=store, now=dt.datetime(2025, 1, 1), extractor=_plugin(spark, calls))
    files = fixtures.files(spark, sf)
    first = _out(pipeline.generate(spark, files, s))
    p = pipeline.prepare_files(spark, files, s).where("request_rank > 0")
    assert calls.value == p.select("sha1").distinct().count()  # once per distinct content
    assert store.state().count() == p.select("store", "sha1").distinct().count()
    again = pipeline.Settings(config=s.config, store=ResultStore(spark, store.root), now=s.now, extractor=_plugin(spark, calls))
    n, v = calls.value, store.version()
    assert _out(pipeline.generate(spark, files, again)) == first
    assert (calls.value, store.version()) == (n, v)


def test_requests_carry_ocr_languages_and_mime(spark):
    conf = ProfileConfig.from_dict({"*": dict(DEFAULTS), "image/jpeg": {"inherit": "*", "allow_ocr": True, "ocr_languages": "eng+fra"}})
    rows = [(1, "text/plain", "same"), (2, "image/jpeg", "same"), (3, "text/plain", "other")]
    files = spark.createDataFrame([(*r, False, None, None) for r in rows], T.StructType([
        T.StructField("file_id", T.LongType()), T.StructField("mime", T.StringType()), T.StructField("content", T.StringType()),
        T.StructField("has_native", T.BooleanType()), T.StructField("native_text", T.StringType()), T.StructField("native_meta", meta.FORMATTED)]))
    s = pipeline.Settings(config=conf, extractor=_plugin(spark, spark.sparkContext.accumulator(0), partitions=3))
    out = {r.file_id: {p.name: list(p["values"]) for p in r.extracted_properties} for r in pipeline.generate(spark, files, s).collect()}
    assert out[1] == out[2] == {"ocr": ["True", "eng+fra"], "mime": ["image/jpeg"]}  # the file that allows OCR stands for the content
    assert out[3] == {"ocr": ["False", "None"], "mime": ["text/plain"]}
    with pytest.raises(ValueError, match="lack content, mime"):
        s.extractor(spark.createDataFrame([("a", "full")], "sha1 string, request_kind string"))


def test_an_unanswered_request_is_a_service_failure(spark, sf):
    s = pipeline.Settings(config=fixture_profiles.config(), now=dt.datetime(2025, 1, 1), extractor=lambda r: extract.text_extractor(r).where("false"))
    g = pipeline.generate(spark, fixtures.files(spark, sf), s)
    asked = g.where("content_request <> 'none'").collect()
    assert asked and all((r.content_error, r.content_error_ignored, r.content) == ("service_failure", False, None) for r in asked)
    strict = pipeline.Settings(config=s.config, now=s.now, extractor=s.extractor, strict=True)
    with pytest.raises(Exception, match="service_failure"):
        pipeline.generate(spark, fixtures.files(spark, sf), strict).collect()


def test_failures_without_metadata_are_not_stored(spark, sf):
    """The contents failure of a hash whose second request finds no service leaves the store as it was."""
    store = ResultStore(spark, tempfile.mkdtemp(prefix="quarry-test-p6-"))
    s = catalogue._failures(spark, sf)
    s.store, s.store_for_all = store, "t"
    pipeline.generate(spark, fixtures.files(spark, sf), s)
    left = store.state()
    assert left.count() > 0 and left.where("m_state = 'unknown'").count() == 0
    assert left.where("m_state = 'good' and c_state = 'fail'").count() > 0
    assert state.violations(left).count() == 0


def test_the_probe_reads_no_payload(spark, sf):
    store = ResultStore(spark, tempfile.mkdtemp(prefix="quarry-test-probe-"))
    s = pipeline.Settings(config=fixture_profiles.config(), store=store, now=dt.datetime(2025, 1, 1))
    pipeline.generate(spark, fixtures.files(spark, sf), s)
    plan = store.states(["00", "a1"])._jdf.queryExecution().executedPlan().toString()
    assert "shard" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "text" not in plan.split("ReadSchema:")[1] and "properties" not in plan


def test_store_versions(spark, sf):
    store = ResultStore(spark, tempfile.mkdtemp(prefix="quarry-test-versions-"), compact_after=1)
    s = pipeline.Settings(config=fixture_profiles.config(), now=dt.datetime(2025, 1, 1), store=store)
    f = fixtures.files(spark, sf)
    for lang in ("en", "fr", "de", "es"):
        pipeline.generate(spark, f.where(F.col("lang") == lang), s)
    whole = ResultStore(spark, tempfile.mkdtemp(prefix="quarry-test-versions-"))
    pipeline.generate(spark, f, pipeline.Settings(config=s.config, now=s.now, store=whole))
    key = lambda d: sorted(map(str, d.collect()))
    assert key(store.state()) == key(whole.state())
    assert len(store._live()) == 1 and min(store._folders()) > 1  # compacted; the oldest versions are gone
    store._folders = lambda: {}  # a second writer that picks the same version
    os.makedirs(f"{store.root}/v=1")
    with pytest.raises(FileExistsError):
        store._write(whole.state(), ["_COMMITTED"])


@pytest.mark.parametrize("word,value", [("content_strategy", "combin"), ("allow_ocr", "yes"), ("cache_expire_success_before", "2024-01-15"), ("content_composition", "all")])
def test_words_that_cannot_be_read_are_errors(spark, word, value):
    with pytest.raises(ValueError, match=word):
        resolve_profiles(spark, ProfileConfig.from_dict({"*": {**DEFAULTS, word: value}}))


def test_raw_files(spark, tmp_path):
    (tmp_path / "a.TXT").write_bytes(b"plain text")
    (tmp_path / "b.html").write_bytes(b"<html><head><title>T</title></head><body>seen</body></html>")
    (tmp_path / "c").write_bytes(b"x")
    files = tables.read_files(spark, str(tmp_path / "*"))
    s = pipeline.Settings(config=default_config(), extractor=extract.by_mime({"text/html": extract.html_extractor}))
    out = {os.path.basename(r.path): (r.mime, r.content) for r in pipeline.generate(spark, files, s).join(files.select("file_id", "path", "mime"), "file_id").collect()}
    assert out == {"a.TXT": ("text/plain", "plain text"), "b.html": ("text/html", "seen"), "c": ("application/octet-stream", "x")}


def test_partition_independent(spark, sf):
    s = pipeline.Settings(config=fixture_profiles.config(), now=dt.datetime(2025, 1, 1))
    a = _out(pipeline.generate(spark, fixtures.files(spark, sf), s))
    b = _out(pipeline.generate(spark, fixtures.files(spark, sf).repartition(7), s))
    assert a == b


def test_stream_equals_batch(spark, sf):
    """A table stored as a folder of part files, in several batches."""
    src = tempfile.mkdtemp(prefix="quarry-test-stream-")
    spark.read.parquet(f"{sf}/documents.parquet").repartition(3).write.parquet(src + "/documents.parquet")
    spark.read.parquet(f"{sf}/events.parquet").repartition(3).write.parquet(src + "/events.parquet")
    batch = catalogue.q_search_content(spark, sf)
    assert sorted(tuple(r) for r in catalogue.q_ingest_stream(spark, src).collect()) == sorted(tuple(r) for r in batch.collect())
    log = catalogue.q_fold_outcomes(spark, sf)
    assert sorted(map(str, catalogue.q_outcome_stream(spark, src).collect())) == sorted(map(str, log.collect()))


def test_a_replayed_batch_leaves_one_copy(spark, sf):
    base = tempfile.mkdtemp(prefix="quarry-test-replay-")
    spark.read.parquet(f"{sf}/documents.parquet").write.parquet(base + "/in")
    for checkpoint in ("/c1", "/c2"):  # the second stream replays batch 0 from the start
        stream = spark.readStream.schema(ingest.DOC_SCHEMA).parquet(base + "/in")
        ingest.ingest(spark, stream, fixtures.files_from, fixture_profiles.config(), base + "/out", base + checkpoint,
                      store=ResultStore(spark, base + "/store"), now=catalogue.FIXED_NOW)
    assert ingest.output(spark, base + "/out").count() == spark.read.parquet(base + "/in").count()


def test_decisive_events_fold_equal(spark, sf):
    from quarry.operators.outcomes import fold_outcomes
    from quarry.sources import fixtures
    from quarry.streaming.ingest import decisive_events
    log = fixtures.outcomes(spark, sf)
    full = sorted(tuple(r) for r in fold_outcomes(log).collect())
    seed = sorted(tuple(r) for r in fold_outcomes(decisive_events(log)).collect())
    assert full == seed


def test_outcome_stream(spark, sf):
    from quarry.operators.outcomes import fold_outcomes
    from quarry.sources import fixtures
    from quarry.streaming.ingest import fold_outcome_stream
    base = tempfile.mkdtemp(prefix="quarry-test-t3-")
    log = fixtures.outcomes(spark, sf)
    log.repartition(3).write.parquet(base + "/in")
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(base + "/in")
    got = sorted(tuple(r) for r in fold_outcome_stream(spark, stream, base + "/state", base + "/ckpt").entries().collect())
    assert got == sorted(tuple(r) for r in fold_outcomes(log).collect())


def test_plugin_extractor_and_fallback(spark, sf):
    """D1 through mapInPandas: full requests on contents whose hash starts
    with '0'-'3' fail to parse (422); the E3 pass then asks for metadata only,
    which succeeds. Everything else answers 200 with a JSON body."""
    import json

    import pandas as pd

    def fake(batches):
        for b in batches:
            rows = []
            for sha, kind, content in zip(b["sha1"], b["request_kind"], b["content"]):
                fail = kind == "full" and sha[0] in "0123"
                body = None if fail else json.dumps({"X-TIKA:content": f"  {content}  ", "dc:title": sha[:6]})
                rows.append((sha, kind, 422 if fail else 200, None, body, 1, dt.datetime(2025, 1, 1)))
            yield pd.DataFrame(rows, columns=["sha1", "request_kind", "http_status", "transport_errno",
                                              "response_json", "attempt", "ts"])

    s = pipeline.Settings(config=fixture_profiles.config(), now=dt.datetime(2025, 1, 1),
                          extractor=extract.plugin_extractor(fake))
    files = fixtures.files(spark, sf)
    p = pipeline.prepare_files(spark, files, s).drop("content")
    e = {r.sha1: r for r in pipeline.store_or_extract(spark, p, s, contents=files.select("file_id", "content")).collect()}
    bad = [r for k, r in e.items() if k[0] in "0123"]
    good = [r for k, r in e.items() if k[0] not in "0123"]
    assert bad and good
    assert all(r.m_state == "good" and r.c_state == "fail" and r.error_class == "parser_failure" for r in bad)
    assert all(r.m_state == "good" and r.c_state == "good" and r.error_class is None for r in good)
    assert all([p_.name for p_ in r.properties] == ["dc:title"] for r in good)
    out = {r.file_id: r for r in pipeline.generate(spark, files, s).collect()}
    jpeg_bad = [r for r in out.values() if r.route == "solo" and r.sha1[0] in "0123" and r.file_id % 6 == 2]
    assert jpeg_bad and all(r.content == "" and r.content_error_ignored for r in jpeg_bad)   # ignored → ''
    plain_bad = [r for r in out.values() if r.sha1[0] in "0123" and r.file_id % 6 == 0]
    assert plain_bad and all(r.content is None and r.content_error_ignored is False for r in plain_bad)
