"""Result-store entry state (F6 F7 F8 E1 J4 J5 U2 X11 and the E2 action).

An entry is ``(sha1, m_state, c_state, success_ts, m_fail_ts, c_fail_ts)``
plus payload; states are ``unknown`` / ``good`` / ``fail`` (never NULL).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quarry.functions.timefmt import format_ts, parse_ts
from quarry.operators.responses import parse_responses

STATE_COLS = ["m_state", "c_state", "success_ts", "m_fail_ts", "c_fail_ts"]
SCHEMA_VERSION = 1
# ---- fixed values ----
# Keys of a serialized base record.
RECORD_KEYS = ["schema", "sha1", "successTimestamp", "metadata", "metadataFailure",
               "contents", "contentsFailure"]
# Keys of a serialized failure and of a contents record.
FAILURE_KEYS = ["previousMessage", "timestamp", "onlyMetadata"]
CONTENTS_KEYS = ["schema", "sha1", "contents"]
# ---- end of fixed values ----


def expire(df: DataFrame, success_before: Column, failure_before: Column) -> DataFrame:
    """Inclusive expiry. A success stamp at or before the bound turns good
    M and good C unknown and clears the stamp; a failure stamp at or before
    its bound turns that failure unknown. NULL bound = never."""
    s_exp = success_before.isNotNull() & F.col("success_ts").isNotNull() & (F.col("success_ts") <= success_before)
    m_fexp = F.coalesce(failure_before.isNotNull() & (F.col("m_state") == "fail")
                        & (F.col("m_fail_ts") <= failure_before), F.lit(False))
    c_fexp = F.coalesce(failure_before.isNotNull() & (F.col("c_state") == "fail")
                        & (F.col("c_fail_ts") <= failure_before), F.lit(False))
    # Flags first: every rewrite below reads the state before expiry.
    df = df.withColumn("_s_exp", s_exp).withColumn("_m_fexp", m_fexp).withColumn("_c_fexp", c_fexp)
    s_exp, m_fexp, c_fexp = F.col("_s_exp"), F.col("_m_fexp"), F.col("_c_fexp")
    return df.select(
        *[c for c in df.columns if c not in ("m_state", "c_state", "success_ts", "m_fail_ts", "c_fail_ts",
                                              "_s_exp", "_m_fexp", "_c_fexp", "expired")],
        F.when((s_exp & (F.col("m_state") == "good")) | m_fexp, "unknown").otherwise(F.col("m_state")).alias("m_state"),
        F.when((s_exp & (F.col("c_state") == "good")) | c_fexp, "unknown").otherwise(F.col("c_state")).alias("c_state"),
        F.when(~s_exp, F.col("success_ts")).alias("success_ts"),
        F.when(~m_fexp, F.col("m_fail_ts")).alias("m_fail_ts"),
        F.when(~c_fexp, F.col("c_fail_ts")).alias("c_fail_ts"),
        (s_exp | m_fexp | c_fexp).alias("expired"))


def resolved_enough(m_state: Column, c_state: Column, request: Column) -> Column:
    """M known, and (metadata-only request or C known)."""
    return (m_state != "unknown") & ((request == "metadata") | (c_state != "unknown"))


def action(m_state: Column, c_state: Column, request: Column) -> Column:
    """E2 action for a request against an (expired) entry: ``hit``,
    ``report_m_failure``, ``report_c_failure``, ``extract_metadata`` or
    ``extract_full``. Known contents narrow a full request to metadata."""
    res = resolved_enough(m_state, c_state, request)
    return (F.when(res & (m_state == "fail"), "report_m_failure")
            .when(res & (request == "full") & (c_state == "fail"), "report_c_failure")
            .when(res, "hit")
            .when((request == "metadata") | (c_state != "unknown"), "extract_metadata")
            .otherwise("extract_full"))


def _broken() -> Column:
    """The invariants that a row breaks."""
    return F.array_compact(F.array(
        F.when((F.col("c_state") == "good") & (F.col("m_state") != "good"), F.lit("contents_good_metadata_not_good")),
        F.when((F.col("m_state") == "good") & F.col("success_ts").isNull(), F.lit("metadata_good_without_stamp")),
        F.when((F.col("m_state") != "good") & F.col("success_ts").isNotNull(), F.lit("stamp_without_metadata_good"))))


def violations(df: DataFrame) -> DataFrame:
    """F8: rows that break an invariant, one row per broken rule."""
    return df.select("sha1", F.explode(_broken()).alias("violation"))


def checked(df: DataFrame) -> DataFrame:
    """F8, strict: the same rows; the first one that breaks an invariant ends the job."""
    told = F.concat(F.lit("entry "), F.col("sha1"), F.lit(": "), F.array_join(_broken(), ", "))
    return df.withColumn("m_state", F.when(F.size(_broken()) > 0, F.raise_error(told)).otherwise(F.col("m_state")))


def resolve_layers(near: DataFrame, deep: DataFrame, m_payload=(), c_payload=()) -> DataFrame:
    """Fill unknown parts of the nearer entry from the deeper layer.

    M (with its stamp) and C are taken independently. Good contents taken
    from the deeper layer must carry the same success stamp; otherwise the
    row is flagged ``conflict``.
    """
    h = near.alias("h")
    c = deep.alias("c")
    j = h.join(c, F.col("h.sha1") == F.col("c.sha1"), "full_outer")
    hm = F.coalesce(F.col("h.m_state"), F.lit("unknown"))
    hc = F.coalesce(F.col("h.c_state"), F.lit("unknown"))
    cm = F.coalesce(F.col("c.m_state"), F.lit("unknown"))
    cc = F.coalesce(F.col("c.c_state"), F.lit("unknown"))
    take_m = (hm == "unknown") & (cm != "unknown")
    take_c = (hc == "unknown") & (cc != "unknown")
    ts = F.when(take_m, F.col("c.success_ts")).otherwise(F.col("h.success_ts"))
    conflict = take_c & (cc == "good") & ~ts.eqNullSafe(F.col("c.success_ts"))
    cols = [F.coalesce(F.col("h.sha1"), F.col("c.sha1")).alias("sha1"),
            F.when(take_m, cm).otherwise(hm).alias("m_state"),
            F.when(take_c, cc).otherwise(hc).alias("c_state"),
            ts.alias("success_ts"),
            F.when(take_m, F.col("c.m_fail_ts")).otherwise(F.col("h.m_fail_ts")).alias("m_fail_ts"),
            F.when(take_c, F.col("c.c_fail_ts")).otherwise(F.col("h.c_fail_ts")).alias("c_fail_ts")]
    cols += [F.when(take_m, F.col(f"c.{p}")).otherwise(F.col(f"h.{p}")).alias(p) for p in m_payload]
    cols += [F.when(take_c, F.col(f"c.{p}")).otherwise(F.col(f"h.{p}")).alias(p) for p in c_payload]
    cols.append(conflict.alias("conflict"))
    return j.select(*cols)


def properties_json(props: Column) -> Column:
    """Ordered properties as a JSON object: one value as itself, a list as an array."""
    # what stands between the brackets of a JSON array; the lambda is a name for it, so that a long text is written once
    inner = lambda c: F.transform(F.array(F.to_json(F.array(c))), lambda j: F.substring(j, F.lit(2), F.length(j) - 2))[0]
    item = lambda p: F.concat(inner(p["name"]), F.lit(":"), F.when(
        p["is_list"], F.to_json(p["values"], {"ignoreNullFields": "false"})).otherwise(F.coalesce(inner(p["values"][0]), F.lit("null"))))
    return F.concat(F.lit("{"), F.array_join(F.transform(props, item), ","), F.lit("}"))


def encode_record(df: DataFrame) -> DataFrame:
    """X11 (encode): entry → ``(sha1, body, contents_body)``.

    ``body`` has all keys of :data:`RECORD_KEYS`, NULL values included; failures
    carry message, stamp and whether the request was for metadata only. Contents
    are a record of their own (``false`` for a failure, NULL when unknown).
    """
    string = lambda c: F.substring(F.to_json(F.array(c)), F.lit(2), F.length(F.to_json(F.array(c))) - 2)
    orn = lambda c: F.coalesce(c, F.lit("null"))

    def failure(st, t, message, only):
        return F.when(F.col(st) == "fail", F.concat(
            F.lit('{"previousMessage":'), orn(string(F.col(message))), F.lit(',"timestamp":'), orn(string(format_ts(F.col(t)))),
            F.lit(f',"onlyMetadata":{only}}}')))
    m, c = F.col("m_state"), F.col("c_state")
    head = F.concat(F.lit(f'{{"schema":{SCHEMA_VERSION},"sha1":'), string(F.col("sha1")))
    body = F.concat(
        head, F.lit(',"successTimestamp":'), orn(string(format_ts(F.col("success_ts")))),
        F.lit(',"metadata":'), F.when(m == "good", properties_json(F.col("properties"))).when(m == "fail", "false").otherwise("null"),
        F.lit(',"metadataFailure":'), orn(failure("m_state", "m_fail_ts", "m_message", "true")),
        F.lit(',"contents":'), F.when(c == "good", "true").when(c == "fail", "false").otherwise("null"),
        F.lit(',"contentsFailure":'), orn(failure("c_state", "c_fail_ts", "c_message", "false")), F.lit("}"))
    contents = F.when(c == "good", F.concat(head, F.lit(',"contents":['), string(F.coalesce("text", F.lit(""))), F.lit("]}"))).when(c == "fail", "false")
    return df.select("sha1", body.alias("body"), contents.alias("contents_body"))


def missing_keys(body: Column, keys: list) -> Column:
    """The keys that a JSON record lacks (a key with a NULL value is there)."""
    found = F.map_keys(F.from_json(body, "map<string,variant>"))
    return F.array_except(F.array(*[F.lit(k) for k in keys]), F.coalesce(found, F.array().cast("array<string>")))


def decode_record(df: DataFrame) -> DataFrame:
    """X11 (decode) + U2 + X8: ``(body, contents_body)`` → entry columns, and
    ``missing`` keys (of the record, its failures and its contents record) and
    ``version_ok``. An entry with missing keys or another version is unknown."""
    get = lambda c, path: F.get_json_object(c, path)
    b, cb = F.col("body"), F.col("contents_body")
    prefixed = lambda name, keys: F.transform(keys, lambda k: F.concat(F.lit(name + "."), k))
    none = F.array().cast("array<string>")
    fails = [F.when(get(b, f"$.{k}").isNotNull(), prefixed(k, missing_keys(get(b, f"$.{k}"), FAILURE_KEYS))).otherwise(none)
             for k in ("metadataFailure", "contentsFailure")]
    record = F.when(cb.isNotNull() & (cb != "false"), prefixed("contents", missing_keys(cb, CONTENTS_KEYS))).otherwise(none)
    df = df.withColumns({"missing": F.concat(missing_keys(b, RECORD_KEYS), *fails, record),
                         "version_ok": F.coalesce(get(b, "$.schema") == str(SCHEMA_VERSION), F.lit(False))})
    good = (F.size("missing") == 0) & F.col("version_ok")
    meta_json, contents = get(b, "$.metadata"), get(b, "$.contents")
    m_state = F.when(good & (meta_json == "false"), "fail").when(good & meta_json.isNotNull(), "good").otherwise("unknown")
    c_state = F.when(good & (contents == "false"), "fail").when(good & contents.isNotNull(), "good").otherwise("unknown")
    df = df.withColumns({"m_state": m_state, "c_state": c_state, "_meta": F.when(m_state == "good", meta_json)})
    df = parse_responses(df, "_meta").drop("text", "parsed_ok", "_meta")
    fail = lambda st, k, f: F.when(F.col(st) == "fail", get(b, f"$.{k}.{f}"))
    return df.select(
        get(b, "$.sha1").alias("sha1"), "m_state", "c_state", F.when(good, parse_ts(get(b, "$.successTimestamp"))).alias("success_ts"),
        parse_ts(fail("m_state", "metadataFailure", "timestamp")).alias("m_fail_ts"), parse_ts(fail("c_state", "contentsFailure", "timestamp")).alias("c_fail_ts"),
        F.when(F.col("m_state") == "good", F.col("properties")).alias("properties"),
        F.when(F.col("c_state") == "good", get(cb, "$.contents[0]")).alias("text"),
        fail("m_state", "metadataFailure", "previousMessage").alias("m_message"), fail("c_state", "contentsFailure", "previousMessage").alias("c_message"),
        "missing", "version_ok")
