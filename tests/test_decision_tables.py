"""Decision-table tests on hand-written rows: routing, text
merge, state expiry, actions, layers, attempts, folding."""

import datetime as dt

from pyspark.sql import functions as F

from quarry.functions.text import append_metadata, escape_html, trim_text
from quarry.operators import merge, outcomes, routing, state

NONE = None


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_route_table(spark):
    data = [(False, None, False, "none"), (False, None, True, "native"),
            (True, "fallback", False, "solo"), (True, "fallback", True, "native"),
            (True, "override", False, "solo"), (True, "override", True, "solo"),
            (True, "wrapping", False, "solo"), (True, "wrapping", True, "wrapping")]
    df = spark.createDataFrame(data, "ok boolean, hs string, nat boolean, want string")
    got = rows(df.withColumn("r", routing.route(F.col("ok"), F.col("hs"), F.col("nat"))), "r", "want")
    assert all(a == b for a, b in got)


def test_merge_content_table(spark):
    cases = []
    for n in (None, "", "N"):
        for e in ("", "E"):
            cases += [("no_extracted", n, e, n), ("prefer_native", n, e, n if n is not None else e),
                      ("combine", n, e, e if not n else (n if e == "" else n + "\n" + e)),
                      ("prefer_extracted", n, e, e if e != "" else n), ("only_extracted", n, e, e)]
    df = spark.createDataFrame(cases, "s string, n string, e string, want string")
    got = rows(df.withColumn("r", merge.merge_content(F.col("s"), F.col("n"), F.col("e"))), "r", "want")
    assert all(a == b for a, b in got), got


def test_trim_escape_append(spark):
    df = spark.createDataFrame([(" \t x \n\x0b", 'a<b & "c" \'d\'', "c", "m")], "t string, h string, c string, m string")
    r = df.select(trim_text("t").alias("t"), escape_html("h").alias("h"),
                  append_metadata(F.lit(""), F.col("m")).alias("a")).first()
    assert r.t == "x"
    assert r.h == "a&lt;b &amp; &quot;c&quot; &#039;d&#039;"
    assert r.a == " m"  # leading space kept when content is ''


def _entries(spark, data):
    return spark.createDataFrame(
        data, "sha1 string, m_state string, c_state string, success_ts timestamp, m_fail_ts timestamp, c_fail_ts timestamp")


T = dt.datetime


def test_expire_inclusive(spark):
    b = T(2024, 1, 10)
    df = _entries(spark, [("a", "good", "good", b, None, None),            # equal → expired
                          ("b", "good", "good", T(2024, 1, 11), None, None),  # after → kept
                          ("c", "fail", "fail", None, b, T(2024, 1, 11)),    # M failure expired only
                          ("d", "good", "fail", T(2024, 1, 1), None, T(2024, 1, 1))])
    e = state.expire(df, F.lit(b).cast("timestamp"), F.lit(b).cast("timestamp"))
    got = {r.sha1: (r.m_state, r.c_state, r.success_ts) for r in e.collect()}
    assert got["a"] == ("unknown", "unknown", None)
    assert got["b"] == ("good", "good", T(2024, 1, 11))
    assert got["c"][:2] == ("unknown", "fail")
    assert got["d"] == ("unknown", "unknown", None)


def test_action_table(spark):
    table = {("unknown", "unknown"): ("extract_metadata", "extract_full"),
             ("unknown", "fail"): ("extract_metadata", "extract_metadata"),
             ("fail", "unknown"): ("report_m_failure", "extract_full"),
             ("good", "unknown"): ("hit", "extract_full"),
             ("fail", "fail"): ("report_m_failure", "report_m_failure"),
             ("good", "fail"): ("hit", "report_c_failure"),
             ("good", "good"): ("hit", "hit")}
    data = [(m, c, req, want[i]) for (m, c), want in table.items() for i, req in enumerate(("metadata", "full"))]
    df = spark.createDataFrame(data, "m string, c string, req string, want string")
    got = rows(df.withColumn("a", state.action(F.col("m"), F.col("c"), F.col("req"))), "a", "want")
    assert all(a == b for a, b in got), got


def test_resolve_layers(spark):
    t = T(2024, 1, 5)
    near = _entries(spark, [("x", "unknown", "fail", None, None, t)])
    deep = _entries(spark, [("x", "good", "good", t, None, None)])
    r = state.resolve_layers(near, deep).first()
    assert (r.m_state, r.c_state, r.success_ts, r.conflict) == ("good", "fail", t, False)


def test_classify_and_resolve_attempts(spark):
    data = [(1, 1, 500, None), (1, 2, None, 7), (1, 3, 200, None),        # success on the 3rd
            (2, 1, 503, None), (2, 2, 500, None), (2, 3, None, 56), (2, 4, 200, None),  # exhausted
            (3, 1, None, 28),                                            # timeout → parser failure
            (4, 1, 500, None),                                           # pending
            (5, 1, 204, None)]
    df = spark.createDataFrame(data, "request_id long, attempt long, http_status int, transport_errno int")
    got = {r.request_id: (r.outcome, r.attempts_used) for r in outcomes.resolve_attempts(df).collect()}
    assert got == {1: ("success", 3), 2: ("exhausted", 3), 3: ("parser_failure", 1), 4: ("pending", 1), 5: ("empty", 1)}


def test_fold_order_insensitive(spark):
    log = [(1, "k", T(2024, 1, 1), "full", "success"), (2, "k", T(2024, 1, 2), "metadata", "parser_failure"),
           (3, "k", T(2024, 1, 3), "full", "service_failure"), (4, "j", T(2024, 1, 1), "full", "parser_failure")]
    schema = "event_id long, sha1 string, ts timestamp, request_kind string, outcome string"
    a = outcomes.fold_outcomes(spark.createDataFrame(log, schema))
    b = outcomes.fold_outcomes(spark.createDataFrame(list(reversed(log)), schema).repartition(3))
    ga = sorted(tuple(r) for r in a.collect())
    assert ga == sorted(tuple(r) for r in b.collect())
    got = {r.sha1: (r.m_state, r.c_state) for r in a.collect()}
    assert got == {"k": ("fail", "good"), "j": ("unknown", "fail")}
    v = [tuple(r) for r in state.violations(a).collect()]
    assert ("k", "contents_good_metadata_not_good") in v
