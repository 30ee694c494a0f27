"""Retries of the running extraction: rounds, what each asks, and what becomes of the answers."""

import hashlib

import pytest
from pyspark.sql import functions as F

from quarry.operators.extract import REQUEST_COLS, RetryingExtractor
from quarry.plans import catalogue, fixture_profiles, pipeline
from quarry.sources import fixtures

CLASSES = {"6": "ts", "7": "ts", "8": "tts", "9": "te", "a": "tp", "b": "p", "c": "ttp", "d": "ttt", "e": "ts"}  # t(ransient), s(uccess), e(mpty), p(arser failure)


def requests(spark, n=120, kind="full"):
    rows = [(hashlib.sha1(f"text {i}".encode()).hexdigest(), kind, f" text {i} ", "text/plain", False, "") for i in range(n)]
    return spark.createDataFrame(rows, "sha1 string, request_kind string, content string, mime string, ocr boolean, ocr_languages string")


def test_attempts_and_outcomes(spark):
    extractor = RetryingExtractor(fixtures.answers_by_digit(), delay_seconds=0)
    found = {r.sha1: r for r in extractor(requests(spark)).collect()}
    log = {}
    for r in extractor.log().collect():
        log.setdefault(r.sha1, []).append((r.attempt, r["class"]))
    assert len(found) == 120 and set(log) == set(found)
    for sha1, r in found.items():
        classes = CLASSES.get(sha1[0], "s")
        assert [(a, c[0]) for a, c in sorted(log[sha1])] == [(k + 1, c) for k, c in enumerate(classes)]
        last = classes[-1]
        assert r.outcome == {"t": "service_failure", "p": "parser_failure"}.get(last, "parser_failure" if sha1[0] == "f" else "success")
        if r.outcome == "success":
            assert r.text == ("" if last == "e" else found[sha1].text) and (last == "e" or r.text.startswith("text "))
            assert [p.name for p in r.properties] == ([] if last == "e" else ["meta:asked", "dc:language"])
        assert r.ts is not None


def test_a_round_fetches_and_asks_its_own_requests_only(spark):
    every, fetched, settings = requests(spark, 200), [], []

    def fetch(some):
        fetched.append(some.count())
        return some.join(every.select("sha1", "content"), "sha1")

    def fn(frames):
        for f in frames:
            assert list(f.columns) == [*REQUEST_COLS, "attempt", "time_limit_seconds"] and (f.time_limit_seconds == 7.5).all()
            yield from fixture(iter([f]))

    fixture = fixtures.answers_by_digit()
    extractor = RetryingExtractor(fn, delay_seconds=0, time_limit_seconds=7.5, partitions=3)
    assert extractor.in_rounds(every.drop("content"), fetch).count() == 200
    digits = [r.sha1[0] for r in every.collect()]
    assert fetched == [200, sum(len(CLASSES.get(d, "s")) > 1 for d in digits), sum(len(CLASSES.get(d, "s")) > 2 for d in digits)]
    assert extractor.log().count() == sum(fetched)


def test_other_numbers_of_retries(spark):
    once = RetryingExtractor(fixtures.answers_by_digit(), retries=0)
    found = {r.sha1: r.outcome for r in once(requests(spark)).collect()}
    assert {o for s, o in found.items() if CLASSES.get(s[0], "s")[0] == "t"} == {"service_failure"}
    assert once.log().groupBy("sha1").count().where("count > 1").count() == 0
    good = RetryingExtractor(lambda frames: (f.assign(http_status=204, transport_errno=None, response_json=None, ts=None)[
        ["sha1", "request_kind", "http_status", "transport_errno", "response_json", "ts"]] for f in frames), retries=5, delay_seconds=60)
    assert good(requests(spark, 10)).where("ts is not null and outcome = 'success'").count() == 10  # one round, no waiting, the stamp is the request's
    none = RetryingExtractor(fixtures.answers_by_digit(), delay_seconds=60)
    assert none(requests(spark).limit(0)).count() == 0
    with pytest.raises(ValueError, match="retries"):
        RetryingExtractor(good, retries=-1)
    with pytest.raises(ValueError, match="nothing was extracted"):
        RetryingExtractor(good).log()


def test_the_last_attempt_of_a_lost_request_is_a_service_failure(spark):
    silent = RetryingExtractor(lambda frames: (f.iloc[:0].assign(http_status=0, transport_errno=0, response_json="", ts=None)[
        ["sha1", "request_kind", "http_status", "transport_errno", "response_json", "ts"]] for f in frames), delay_seconds=0)
    assert {(r.outcome, r.message) for r in silent(requests(spark, 20)).collect()} == {("service_failure", "retries exhausted")}
    assert silent.log().count() == 60


def test_in_the_pipeline_with_a_second_request_for_metadata(spark, sf):
    files = fixtures.files(spark, sf)
    extractor = RetryingExtractor(fixtures.answers_by_digit(), delay_seconds=0)
    s = pipeline.Settings(config=fixture_profiles.failure_config(), now=catalogue.FIXED_NOW, extractor=extractor)
    e = pipeline.store_or_extract(spark, pipeline.prepare_files(spark, files, s).drop("content"), s, contents=files.select("file_id", "content"))
    rows = e.where("request = 'full'").collect()
    assert rows
    for r in rows:
        last = CLASSES.get(r.sha1[0], "s")[-1]
        assert r.c_state == {"t": "unknown", "p": "fail"}.get(last, "fail" if r.sha1[0] == "f" else "good")
        # a failed parse is followed by a request for metadata alone, which this extractor answers as badly
        assert r.c_state != "fail" or r.action == "extract_metadata_fallback"
    asked = extractor.log().groupBy("sha1", "request_kind").agg(F.max("attempt").alias("n"), F.count("*").alias("rows")).collect()
    assert all(r.n == r.rows == len(CLASSES.get(r.sha1[0], "s")) for r in asked)


def test_metadata_first_then_in_full(spark, sf):
    """merge_requests=False: hashes that files need both ways are asked twice, and the results are the same."""
    files = fixtures.files(spark, sf)
    asked, entries = {}, {}
    for merge in (True, False):
        log = []

        def watching(requests):
            log.append(requests.select("sha1", "request_kind"))
            return catalogue.text_extractor(requests)

        watching.never_fails = True
        s = pipeline.Settings(config=fixture_profiles.failure_config(), now=catalogue.FIXED_NOW, extractor=watching, merge_requests=merge)
        e = pipeline.store_or_extract(spark, pipeline.prepare_files(spark, files, s).drop("content"), s, contents=files.select("file_id", "content"))
        entries[merge] = sorted(map(str, e.drop("action").collect()))
        asked[merge] = [{(r.sha1, r.request_kind) for r in x.collect()} for x in log]
    assert entries[True] == entries[False]
    first, then = asked[False]
    assert [then] == asked[True] and first and {k for _, k in first} == {"metadata"}
    assert {h for h, _ in first} <= {h for h, k in then if k == "full"}
