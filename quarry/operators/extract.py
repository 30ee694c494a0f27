"""Extractors (D1 D3) and the outcome rows they produce.

An extractor turns request rows ``(sha1, request_kind, content, mime, ocr,
ocr_languages, ts)`` into outcome rows ``(sha1, request_kind, outcome,
properties, text, message, ts)`` where ``outcome`` is success /
parser_failure / service_failure.

* Built-in extractors are Spark column expressions (no Python worker).
* A plug-in extractor (D1) is a batch function over pandas frames run with
  ``mapInPandas``; it returns raw attempts that go through E5/A3/S2 here. It
  retries by itself (:func:`plugin_extractor`) or is asked again by the engine
  (:class:`RetryingExtractor`).
"""

from __future__ import annotations

import time
from functools import reduce
from typing import Callable, Iterator

from pyspark.sql import Column, DataFrame, functions as F

from quarry.functions import html as H
from quarry.functions import meta
from quarry.functions.text import trim_text
from quarry.operators.outcomes import DEFAULT_RETRIES, classify_attempt, is_terminal
from quarry.operators.responses import parse_responses

OUTCOME_COLS = ["sha1", "request_kind", "outcome", "properties", "text", "message", "ts"]
REQUEST_COLS = ["sha1", "request_kind", "content", "mime", "ocr", "ocr_languages"]
DEFAULT_DELAY = 2.0        # seconds between two rounds of attempts
DEFAULT_TIME_LIMIT = 5.0   # seconds an extractor should give one request
ANSWER_SCHEMA = "sha1 string, request_kind string, http_status int, transport_errno int, response_json string, ts timestamp"
ATTEMPT_SCHEMA = ("sha1 string, request_kind string, http_status int, transport_errno int, "
                  "response_json string, attempt bigint, ts timestamp")


def _now(requests: DataFrame) -> Column:
    return F.col("ts") if "ts" in requests.columns else F.current_timestamp()


def _prop(pos: int, name: str, *values: Column, is_list: bool = False) -> Column:
    return F.struct(F.lit(pos).alias("pos"), F.lit(name).alias("name"),
                    F.array(*[v.cast("string") for v in values]).alias("values"),
                    F.lit(is_list).alias("is_list"))


def text_extractor(requests: DataFrame) -> DataFrame:
    """Built-in extractor for plain-text files: the text itself plus a few
    content-derived properties. Always succeeds (HTTP 200)."""
    now = _now(requests)
    c = F.col("content").cast("string")
    props = F.array(
        _prop(0, "Content-Type", F.lit("text/plain; charset=UTF-8")),
        _prop(1, "X-TIKA:Parsed-By", F.lit("quarry.TextParser"), F.lit("quarry.Utf8Decoder"), is_list=True),
        _prop(2, "meta:character-count", F.length(c)),
        # newline count + 1, without materialising the lines
        _prop(3, "meta:line-count", F.length(c) - F.length(F.replace(c, F.lit("\n"), F.lit(""))) + 1),
    )
    full = F.col("request_kind") == "full"
    return requests.select(
        "sha1", "request_kind", F.lit("success").alias("outcome"),
        props.alias("properties"),
        F.when(full, trim_text(c)).alias("text"),
        F.lit(None).cast("string").alias("message"),
        now.alias("ts"))


text_extractor.never_fails = True


def html_properties(html: Column) -> Column:
    return F.filter(F.array(
        _prop(0, "Content-Type", F.concat(F.lit("text/html; charset="), F.coalesce(H.charset(html), F.lit("utf-8")))),
        F.when(H.title(html).isNotNull(), _prop(1, "dc:title", H.title(html))),
        F.when(H.lang(html).isNotNull(), _prop(2, "dc:language", H.lang(html))),
    ), lambda p: p.isNotNull())


def html_extractor(requests: DataFrame) -> DataFrame:
    """D3: built-in HTML extractor, Catalyst-native. Same outcome shape."""
    now = _now(requests)
    h = F.col("content").cast("string")
    full = F.col("request_kind") == "full"
    return requests.select(
        "sha1", "request_kind", F.lit("success").alias("outcome"),
        html_properties(h).alias("properties"),
        F.when(full, H.body_text(h)).alias("text"),
        F.lit(None).cast("string").alias("message"), now.alias("ts"))


html_extractor.never_fails = True


def by_mime(extractors: dict[str, Callable], default: Callable = text_extractor) -> Callable:
    """One extractor per MIME type; ``default`` takes all other requests."""
    def run(requests: DataFrame) -> DataFrame:
        known = F.col("mime").isin(list(extractors))
        out = default(requests.where(~F.coalesce(known, F.lit(False)))).select(*OUTCOME_COLS)
        for mime, fn in extractors.items():
            out = out.unionByName(fn(requests.where(F.col("mime") == mime)).select(*OUTCOME_COLS))
        return out

    run.never_fails = all(getattr(f, "never_fails", False) for f in (default, *extractors.values()))
    return run


def _outcomes_of(res: DataFrame) -> DataFrame:
    """Outcome rows of resolved requests ``(sha1, request_kind, f: struct<class, response_json, ts> or null, last_ts)``."""
    res = parse_responses(res.withColumn("body", F.col("f.response_json")), "body")
    props, text, ok = F.col("properties"), F.col("text"), F.col("parsed_ok")
    cls = F.col("f.class")
    outcome = (F.when(cls == "empty", "success")
               .when((cls == "success") & ok, "success")
               .when(cls == "success", "parser_failure")
               .when(cls == "parser_failure", "parser_failure")
               .otherwise("service_failure"))
    full = F.col("request_kind") == "full"
    return res.select(
        "sha1", "request_kind", outcome.alias("outcome"),
        F.when(cls == "empty", meta.empty_properties()).when(cls == "success", props).alias("properties"),
        F.when(full & (cls == "empty"), F.lit("")).when(full & (cls == "success"), text).alias("text"),
        F.when(cls.isNull(), F.lit("retries exhausted"))
         .when(cls == "parser_failure", F.lit("unprocessable"))
         .when((cls == "success") & ~ok, F.lit("malformed response")).alias("message"),
        F.coalesce(F.col("f.ts"), F.col("last_ts")).alias("ts"))


def plugin_extractor(fn: Callable[[Iterator], Iterator], retries: int = DEFAULT_RETRIES,
                     partitions: int | None = None) -> Callable:
    """Wrap a batch function ``Iterator[pd.DataFrame] -> Iterator[pd.DataFrame]``.

    ``fn`` gets frames with :data:`REQUEST_COLS` (F13: the OCR switch, the OCR
    languages and the MIME type of the file that stands for the content) and
    yields frames in :data:`ATTEMPT_SCHEMA` (one row per attempt; it may stop
    after a terminal attempt): such a function does its own retries, while
    :class:`RetryingExtractor` has the engine do them. Attempts are resolved with
    E5/A3 semantics and successful bodies parsed with S2. A request without any
    row counts as a service failure. ``partitions``: tasks that extract at once;
    requests are small, so Spark would otherwise merge them into a few tasks by size.
    """
    limit = 1 + retries

    def run(requests: DataFrame) -> DataFrame:
        asked = _asked(requests, partitions)
        att = asked.mapInPandas(fn, ATTEMPT_SCHEMA)
        att = att.withColumn("class", classify_attempt(F.col("http_status"), F.col("transport_errno")))
        within = F.col("attempt") <= limit
        first = F.min(F.when(within & is_terminal(F.col("class")),
                             F.struct("attempt", "class", "response_json", "ts")))
        return _outcomes_of(att.groupBy("sha1", "request_kind").agg(first.alias("f"), F.max("ts").alias("last_ts")))

    return run


def _asked(requests: DataFrame, partitions: int | None, *more: Column) -> DataFrame:
    absent = [c for c in REQUEST_COLS if c not in requests.columns]
    if absent:
        raise ValueError(f"extraction requests lack {', '.join(absent)}")
    asked = requests.select(*REQUEST_COLS, *more)
    return asked.repartition(partitions, "sha1") if partitions else asked


class RetryingExtractor:
    """D1 with the retries of A3/E5 done by the engine, in rounds.

    ``fn`` is a batch function as in :func:`plugin_extractor`, but asks once: it
    gets frames with :data:`REQUEST_COLS`, ``attempt`` (from 1) and
    ``time_limit_seconds``, and yields frames in :data:`ANSWER_SCHEMA`. Round n
    asks attempt n of all requests that have no terminal answer yet. Its answers
    are written with a reliable checkpoint before the next round begins, so a
    terminal answer is never asked for again, also when executors are lost; a
    request without a row counts as a transient attempt. Requests without a
    terminal answer after ``1 + retries`` rounds are service failures.

    A round fetches contents for its own requests only, and passes keys and
    answers to the next one. Between rounds the engine waits ``delay_seconds``
    once, not once per request. :meth:`log` tells all attempts.
    """

    never_fails = False

    def __init__(self, fn: Callable[[Iterator], Iterator], retries: int = DEFAULT_RETRIES, delay_seconds: float = DEFAULT_DELAY,
                 time_limit_seconds: float = DEFAULT_TIME_LIMIT, partitions: int | None = None):
        if retries < 0:
            raise ValueError("retries: zero or more")
        self.fn, self.retries, self.partitions = fn, retries, partitions
        self.delay_seconds, self.time_limit_seconds = delay_seconds, time_limit_seconds
        self._rounds: list[DataFrame] = []

    def __call__(self, requests: DataFrame) -> DataFrame:
        """Outcome rows of requests that have their contents."""
        return self.in_rounds(requests.drop("content"), lambda some: some.join(requests.select("sha1", "request_kind", "content"), ["sha1", "request_kind"]))

    def in_rounds(self, requests: DataFrame, fetch: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Outcome rows of ``requests`` (without contents); ``fetch`` adds ``content`` to some of them."""
        key = ["sha1", "request_kind"]
        waiting = requests.checkpoint(eager=True)  # keys and settings; what they were worked out from isn't read again
        done = None
        for attempt in range(1, 2 + self.retries):
            answers = _asked(fetch(waiting), self.partitions, F.lit(attempt).alias("attempt"), F.lit(float(self.time_limit_seconds)).alias("time_limit_seconds")) \
                .mapInPandas(self.fn, ANSWER_SCHEMA).withColumn("class", classify_attempt(F.col("http_status"), F.col("transport_errno")))
            first = F.min(F.when(is_terminal(F.col("class")), F.struct("ts", "class", "response_json")))
            told = answers.groupBy(*key).agg(first.alias("f"), F.max("ts").alias("last_ts"))
            round_ = (waiting.select(*key, _now(waiting).alias("asked_ts")).join(told, key, "left")
                      .select(*key, F.lit(attempt).cast("long").alias("attempt"), "f", F.coalesce("f.ts", "last_ts", "asked_ts").alias("last_ts"))
                      .checkpoint(eager=True))
            self._rounds.append(round_)
            open_ = F.col("f").isNull()
            last = attempt > self.retries
            ended = round_ if last else round_.where(~open_)
            done = ended if done is None else done.unionByName(ended)
            if last or not round_.where(open_).limit(1).count():
                break
            waiting = waiting.join(round_.where(open_).select(*key), key, "left_semi").checkpoint(eager=True)
            time.sleep(self.delay_seconds)
        return _outcomes_of(done)

    def log(self) -> DataFrame:
        """``(sha1, request_kind, attempt, class)`` of all attempts so far; class ``transient`` where nothing final was answered."""
        if not self._rounds:
            raise ValueError("nothing was extracted yet")
        told = [r.select("sha1", "request_kind", "attempt", F.coalesce("f.class", F.lit("transient")).alias("class")) for r in self._rounds]
        return reduce(DataFrame.unionByName, told)
