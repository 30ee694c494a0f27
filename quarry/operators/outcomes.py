"""Extraction outcomes.

Everything here is a column expression or a ``groupBy`` with
partially-aggregatable functions (``min``/``max``/``max_by``/``count``), so a
hash or request that holds a third of all rows is combined map-side before
the shuffle and never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

DEFAULT_RETRIES = 2  # retries after the first attempt


def classify_attempt(http_status: Column, transport_errno: Column) -> Column:
    """E5: success / empty / parser_failure / transient."""
    return (F.when(http_status == 200, "success")
            .when(http_status == 204, "empty")
            .when(http_status == 422, "parser_failure")
            .when(http_status.isNotNull(), "transient")
            .when(transport_errno.isin(28, 52), "parser_failure")
            .otherwise("transient"))


def is_terminal(cls: Column) -> Column:
    return cls.isin("success", "empty", "parser_failure")


def resolve_attempts(attempts: DataFrame, key: str = "request_id", retries: int = DEFAULT_RETRIES) -> DataFrame:
    """A3: attempts of each request → ``(outcome, attempts_used)``.

    Only the first ``1 + retries`` attempts count. The first terminal one
    decides; none terminal gives ``exhausted`` when the limit was reached
    (a service failure) and ``pending`` otherwise.
    """
    limit = 1 + retries
    a = attempts.withColumn("class", classify_attempt(F.col("http_status"), F.col("transport_errno")))
    within = F.col("attempt") <= limit
    first = F.min(F.when(within & is_terminal(F.col("class")), F.struct(F.col("attempt"), F.col("class"))))
    agg = a.groupBy(key).agg(first.alias("first"), F.count(F.when(within, 1)).alias("n_within"))
    outcome = F.coalesce(F.col("first.class"),
                         F.when(F.col("n_within") >= limit, "exhausted").otherwise("pending"))
    used = F.coalesce(F.col("first.attempt"), F.col("n_within")).cast("bigint")
    return agg.select(key, outcome.alias("outcome"), used.alias("attempts_used"))


def fold_outcomes(log: DataFrame, key: str = "sha1", m_payload=(), c_payload=()) -> DataFrame:
    """A2: ordered outcome log → entry state per key.

    ``log`` has ``ts``, ``request_kind`` (metadata / full), ``outcome``
    (success / parser_failure / service_failure) and an ``event_id`` tie
    breaker. M = latest of {any success, metadata-only parse failure};
    C = latest of {full success, full parse failure}; success_ts = latest
    success. Service failures are never stored. Arrival order is
    irrelevant: ordering is by (ts, event_id). ``m_payload`` columns (e.g.
    properties) follow M, ``c_payload`` columns (e.g. text) follow C.
    """
    ok = F.col("outcome") == "success"
    pf = F.col("outcome") == "parser_failure"
    full = F.col("request_kind") == "full"
    order = F.struct(F.col("ts"), F.col("event_id"))
    m_src = F.struct(F.col("ts").alias("ts"), F.col("outcome").alias("outcome"), *[F.col(c) for c in m_payload])
    c_src = F.struct(F.col("ts").alias("ts"), F.col("outcome").alias("outcome"), *[F.col(c) for c in c_payload])
    m_cond = ok | (pf & ~full)
    c_cond = full & (ok | pf)
    agg = log.groupBy(key).agg(
        F.max_by(F.when(m_cond, m_src), F.when(m_cond, order)).alias("m"),
        F.max_by(F.when(c_cond, c_src), F.when(c_cond, order)).alias("c"),
        F.max(F.when(ok, F.col("ts"))).alias("success_ts"))
    state = lambda s: F.when(s.isNull(), "unknown").when(s["outcome"] == "success", "good").otherwise("fail")
    cols = [key,
            state(F.col("m")).alias("m_state"), state(F.col("c")).alias("c_state"),
            "success_ts",
            F.when(F.col("m.outcome") == "parser_failure", F.col("m.ts")).alias("m_fail_ts"),
            F.when(F.col("c.outcome") == "parser_failure", F.col("c.ts")).alias("c_fail_ts")]
    cols += [F.col(f"m.{c}").alias(c) for c in m_payload]
    cols += [F.col(f"c.{c}").alias(c) for c in c_payload]
    return agg.select(*cols)


def read_result(m_state: Column, c_state: Column, request: Column):
    """What a resolved entry answers: ``(error_class, error_part)``;
    both NULL when the answer is data. M failures are reported first."""
    err = (F.when(m_state == "fail", "parser_failure")
           .when((request == "full") & (c_state == "fail"), "parser_failure"))
    part = (F.when(m_state == "fail", "metadata")
            .when((request == "full") & (c_state == "fail"), "contents"))
    return err, part


def error_policy(error_class: Column, ignore_parsing: Column, ignore_service: Column) -> Column:
    """true when the error is ignored (empty result), false when it
    must be reported, NULL when there is no error."""
    return (F.when(error_class == "parser_failure", F.coalesce(ignore_parsing, F.lit(False)))
            .when(error_class == "service_failure", F.coalesce(ignore_service, F.lit(False))))
