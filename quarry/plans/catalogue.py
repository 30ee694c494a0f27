"""The query catalogue: one Spark query per operator group.

Each query takes ``(spark, sf_dir)`` and returns a flat DataFrame whose
column names equal those of the matching DuckDB SQL in
:mod:`quarry.plans.oracle`. Every query reads whole driver tables (or
relations derived from them); there are no row caps or id subsets.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from quarry.functions import html as H
from quarry.functions import meta
from quarry.functions.text import append_metadata, trim_text
from quarry.operators import content, merge, outcomes, routing, state
from quarry.operators.extract import RetryingExtractor, by_mime, html_extractor, text_extractor
from quarry.operators.profiles import DEFAULTS, ProfileConfig, default_config, match_profile, resolve_long, resolve_profiles, choose_label
from quarry.operators.properties import BUILTIN_RULES, RuleSet, map_properties, processed, register_batch_formatter, register_formatter, register_processor
from quarry.operators.responses import parse_responses
from quarry.plans import fixture_profiles, pipeline
from quarry.session import work_dir
from quarry.sources import fixtures
from quarry.sources.files import PathIndex, fetcher, listing
from quarry.sources.outputs import OutputTable
from quarry.sources.store import ResultStore
from quarry.sources.tables import table

# Parameters of the catalogue (fixed, shared with the oracle SQL).
CUT = "2024-01-16 00:00:00"                 # early / late split of the outcome log
SUCCESS_BEFORE = "2024-01-20 00:00:00"      # expiry bounds for q_expire
FAILURE_BEFORE = "2024-01-10 00:00:00"
STRATEGIES = ["no_extracted", "prefer_native", "combine", "prefer_extracted", "only_extracted"]
COMPOSITIONS = ["text", "metadata", "text_and_metadata"]
FIXED_NOW = dt.datetime(2025, 1, 1)


def _ts_text(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def _cfg():
    return fixture_profiles.config()


def _profiled(spark, sf):
    cfg = _cfg()
    f = fixtures.files(spark, sf)
    return match_profile(f, resolve_profiles(spark, cfg), cfg)


def _labelled(spark, sf, cfg):
    """Files whose MIME types go round all configured labels (loop, dangling, partial, off) and an unknown one."""
    mimes = [x[0] for x in fixture_profiles.LABELS if x[0] != "*"] + ["x/unknown"]
    mime = F.element_at(F.array(*[F.lit(m) for m in mimes]), (F.pmod("doc_id", F.lit(len(mimes))) + 1).cast("int"))
    return table(spark, sf, "documents").select(F.col("doc_id").alias("file_id"), choose_label(mime, cfg).alias("label"))


def _new_store(spark, name):
    return ResultStore(spark, work_dir(spark, f"{name}-{uuid.uuid4().hex[:12]}"))


def _two_loads(spark, sf):
    """An output table after a load without the German files, and a complete one without the English files, in which
    French texts have changed and contents whose hash begins with 0 can't be extracted; and the second change set."""
    def some_fail(requests):
        out, bad = text_extractor(requests), F.col("sha1").startswith("0")
        return out.withColumns({"outcome": F.when(bad, "parser_failure").otherwise(F.col("outcome")), "text": F.when(~bad, F.col("text"))})
    lang, d = F.coalesce("lang", F.lit("")), table(spark, sf, "documents")
    changed = d.withColumn("text", F.when(lang == "fr", F.concat("text", F.lit(" changed"))).otherwise(F.col("text")))
    out, changes = OutputTable(spark, work_dir(spark, f"outputs-{uuid.uuid4().hex[:12]}"), most=1), None
    for docs, extractor in ((d.where(lang != "de"), text_extractor), (changed.where(lang != "en"), some_fail)):
        files = docs.select(F.col("doc_id").alias("file_id"), F.lit("text/plain").alias("mime"), F.lit(False).alias("has_native"), F.lit(None).cast("string").alias("native_text"),
                            F.lit(None).cast(meta.FORMATTED).alias("native_meta"), F.coalesce("text", F.lit("")).alias("content"))
        changes = out.apply(pipeline.generate(spark, files, pipeline.Settings(config=default_config(), now=FIXED_NOW, extractor=extractor)), complete=True)
    return out, changes


def q_output_changes(spark, sf):
    """The change set of a second load."""
    return _two_loads(spark, sf)[1].select(F.col("file_id").alias("doc_id"), "change", F.sha1("content").alias("content_sha1"))


def q_output_table(spark, sf):
    """The outputs after two loads."""
    return _two_loads(spark, sf)[0].rows().select(F.col("file_id").alias("doc_id"), "sha1", F.sha1("content").alias("content_sha1"),
                                                  F.size("display.collapsed").alias("n_collapsed"))


# ---- content identity -------------------------------------------------------

def q_content_key(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", F.sha1("text").alias("sha1"))


def q_distinct_content(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("file_id"), F.sha1("text").alias("sha1"))
    return content.distinct_content(d).select("sha1", "n_files", "representative")


def q_path_conflicts(spark, sf):
    return content.path_conflicts(fixtures.path_log(spark, sf)).select("path", "n_hashes")


def q_path_index(spark, sf):
    """Files resolved through the latest path index, which doesn't know the German paths yet."""
    log = fixtures.path_log(spark, sf).where(~F.col("path").endswith("/de.txt"))
    idx = content.latest_path_index(log)
    f = fixtures.files(spark, sf).select("file_id", "content",
                                         F.concat(F.lit("/files/"), F.col("source"), F.lit("/"), F.col("lang"),
                                                  F.lit(".txt")).alias("path"))
    r = content.resolve_path_keys(f, idx)
    return r.select(F.col("file_id").alias("doc_id"), "sha1", "sha1_source")


def _named_texts(spark, sf):
    name = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return table(spark, sf, "documents").select("doc_id", "lang", name.alias("name"), F.coalesce("text", F.lit("")).alias("text"))


def q_path_index_loads(spark, sf):
    """Two loads of a folder of files. English and French files come first; then the others come, and the
    French ones have changed. The second load reads and hashes what is new or changed; the rest it knows."""
    base = work_dir(spark, f"files-{uuid.uuid4().hex[:12]}")
    texts, first = _named_texts(spark, sf), F.coalesce(F.col("lang").isin("en", "fr"), F.lit(False))
    index, folder = PathIndex(spark, base + "/index"), base + "/files"
    fixtures.as_files(texts.where(first), folder)
    index.resolve(listing(spark, folder))
    fixtures.as_files(texts.where(~first), folder)
    fixtures.as_files(texts.where("lang = 'fr'").withColumn("text", F.concat("text", F.lit(" changed"))), folder)
    return index.resolve(listing(spark, folder)).select(_doc_of_path().alias("doc_id"), "sha1", "sha1_source")


def _doc_of_path():
    return F.regexp_extract("path", r"([0-9]+)\.txt$", 1).cast("bigint")


def q_files_search_content(spark, sf):
    """Search text of a folder of files that are hashed in ranges; contents are read once per distinct hash."""
    base = work_dir(spark, f"files-{uuid.uuid4().hex[:12]}")
    fixtures.as_files(_named_texts(spark, sf), base + "/files")
    files = PathIndex(spark, base + "/index").resolve(listing(spark, base + "/files"))
    s = pipeline.Settings(config=default_config(), now=FIXED_NOW)
    g = pipeline.generate(spark, files, s, fetch=fetcher(files))
    return g.join(files.select("file_id", "path"), "file_id").select(_doc_of_path().alias("doc_id"), "sha1", "route", "content")


# ---- profiles and routing ---------------------------------------------------

def q_match_profile(spark, sf):
    p = _profiled(spark, sf)
    return p.select(F.col("file_id").alias("doc_id"), "label", "profile_ok", "handler_strategy",
                    "content_strategy", "content_composition", "metadata_strategy")


def q_resolve_profiles(spark, sf):
    """J2 long form joined to files: the 13 values of each file's profile."""
    cfg = _cfg()
    labels, params = cfg.frames(spark)
    long = resolve_long(spark, labels, params)
    f = _labelled(spark, sf, cfg)
    # one row per label and parameter of the configuration
    return f.join(F.broadcast(long), "label").select(F.col("file_id").alias("doc_id"), "label", "param", "value")


def q_profile_report(spark, sf):
    """A6 + F14 per file: status of the chosen label and what it misses."""
    cfg = _cfg()
    res = resolve_profiles(spark, cfg).select("label", "status", "missing")
    f = _labelled(spark, sf, cfg)
    j = f.join(F.broadcast(res), "label", "left")
    return j.select(F.col("file_id").alias("doc_id"), F.coalesce("label", F.lit("(none)")).alias("label"),
                    F.coalesce("status", F.lit("no_label")).alias("status"),
                    F.coalesce("missing", F.lit("")).alias("missing"))


def q_route(spark, sf):
    p = routing.apply_route(_profiled(spark, sf))
    return p.select(F.col("file_id").alias("doc_id"), "route")


def q_request_kind(spark, sf):
    p = routing.add_requests(routing.apply_route(_profiled(spark, sf)))
    return p.select(F.col("file_id").alias("doc_id"), "content_request", "metadata_request", "ocr",
                    F.col("ocr_languages_sent").alias("ocr_languages"))


# ---- outcomes and state -----------------------------------------------------

def q_classify_attempts(spark, sf):
    a = fixtures.attempts(spark, sf)
    return a.select("request_id", "attempt",
                    outcomes.classify_attempt(F.col("http_status"), F.col("transport_errno")).alias("class"))


def q_resolve_attempts(spark, sf):
    return outcomes.resolve_attempts(fixtures.attempts(spark, sf))


def _fold(spark, sf, where=None):
    log = fixtures.outcomes(spark, sf)
    if where is not None:
        log = log.where(where)
    return outcomes.fold_outcomes(log)


def _state_out(df):
    return df.select("sha1", "m_state", "c_state", _ts_text(F.col("success_ts")).alias("success_ts"),
                     _ts_text(F.col("m_fail_ts")).alias("m_fail_ts"), _ts_text(F.col("c_fail_ts")).alias("c_fail_ts"))


def q_fold_outcomes(spark, sf):
    return _state_out(_fold(spark, sf))


def q_invariants(spark, sf):
    return state.violations(_fold(spark, sf))


def q_expire(spark, sf):
    e = state.expire(_fold(spark, sf), F.lit(SUCCESS_BEFORE).cast("timestamp"), F.lit(FAILURE_BEFORE).cast("timestamp"))
    return _state_out(e).join(e.select("sha1", "expired"), "sha1")


def q_action(spark, sf):
    e = state.expire(_fold(spark, sf), F.lit(SUCCESS_BEFORE).cast("timestamp"), F.lit(FAILURE_BEFORE).cast("timestamp"))
    r = e.select("sha1", "m_state", "c_state", F.explode(F.array(F.lit("metadata"), F.lit("full"))).alias("request"))
    return r.select("sha1", "request", state.action(F.col("m_state"), F.col("c_state"), F.col("request")).alias("action"))


def q_probe_store(spark, sf):
    """J4 against a filled store: English contents in ``main``, French ones in ``other``, in two deltas."""
    store = _new_store(spark, "probe")
    d = table(spark, sf, "documents").select("doc_id", "lang", F.sha1("text").alias("sha1"), "text")
    for lang, name in (("en", "main"), ("fr", "other")):
        known = d.where(F.col("lang") == lang).groupBy("sha1").agg(F.min("text").alias("text"))
        store.commit(known.select(
            F.lit(name).alias("store"), "sha1", F.lit(1).alias("schema_version"), F.lit("good").alias("m_state"), F.lit("good").alias("c_state"),
            F.lit(FIXED_NOW).cast("timestamp").alias("success_ts"), *[F.lit(None).cast("timestamp").alias(c) for c in ("m_fail_ts", "c_fail_ts")],
            meta.empty_properties().alias("properties"), "text", *[F.lit(None).cast("string").alias(c) for c in ("m_message", "c_message")]))
    states = store.states().groupBy("sha1").agg(F.max(F.col("store") == "main").alias("hit"), F.max(F.col("store") == "other").alias("hit_other"))
    no = F.lit(False)
    return d.join(states, "sha1", "left").select("doc_id", "sha1", F.coalesce("hit", no).alias("hit"), F.coalesce("hit_other", no).alias("hit_other"))


def q_resolve_layers(spark, sf):
    cut = F.lit(CUT).cast("timestamp")
    near = _fold(spark, sf, F.col("ts") >= cut)
    deep = _fold(spark, sf, F.col("ts") < cut)
    r = state.resolve_layers(near, deep)
    return _state_out(r).join(r.select("sha1", "conflict"), "sha1")


def q_upsert_store(spark, sf):
    """An early and a late state of the outcome log committed one after the other, then compacted and read."""
    store, cut = _new_store(spark, "upsert"), F.lit(CUT).cast("timestamp")
    for version, when in (("old", F.col("ts") < cut), ("new", F.col("ts") >= cut)):
        store.commit(_fold(spark, sf, when).select(
            F.lit("main").alias("store"), "sha1", F.lit(1).alias("schema_version"), "m_state", "c_state", "success_ts", "m_fail_ts", "c_fail_ts",
            meta.empty_properties().alias("properties"), F.lit("contents").alias("text"), F.lit(version).alias("m_message"),
            F.lit(None).cast("string").alias("c_message")))
    store.compact()
    return store.state().select("sha1", F.col("m_message").alias("version"), "m_state", "c_state", F.col("text").isNotNull().alias("keeps_contents"))


def failing_extractor(requests):
    """Column-built extractor that fails by the first digit of the hash: 0-3 can't be parsed in full (0 not for metadata
    either), 4-5 find no service, 6 is never answered in full; 1 finds no service for metadata."""
    digit, full = F.substring("sha1", 1, 1), F.col("request_kind") == "full"
    out = text_extractor(requests).where(~(full & (digit == "6")))
    outcome = (F.when(full & digit.isin("0", "1", "2", "3"), "parser_failure").when(full & digit.isin("4", "5"), "service_failure")
               .when(~full & (digit == "0"), "parser_failure").when(~full & (digit == "1"), "service_failure").otherwise("success"))
    good = outcome == "success"
    return out.select("sha1", "request_kind", outcome.alias("outcome"), F.when(good, F.col("properties")).alias("properties"),
                      F.when(good, F.col("text")).alias("text"), F.when(~good, F.lit("failed")).alias("message"), "ts")


def _failures(spark, sf):
    return pipeline.Settings(config=fixture_profiles.failure_config(), now=FIXED_NOW, extractor=failing_extractor)


def q_fallback_metadata(spark, sf):
    """E3 as the engine runs it: which contents got a second, metadata-only request, and what became of them."""
    s, f = _failures(spark, sf), fixtures.files(spark, sf)
    e = pipeline.store_or_extract(spark, pipeline.prepare_files(spark, f, s).drop("content"), s, contents=f.select("file_id", "content"))
    return e.select(F.coalesce("store", F.lit("-")).alias("store"), "sha1", (F.col("action") == "extract_metadata_fallback").alias("second_pass"), "m_state", "c_state")


def q_errors(spark, sf):
    """Every failed request of every file, judged by the file's own profile."""
    g = pipeline.errors(pipeline.generate(spark, fixtures.files(spark, sf), _failures(spark, sf)))
    return g.select(F.col("file_id").alias("doc_id"), "kind", "error_class", "error_part", "ignored")


def _search_content_failures(spark, sf):
    g = pipeline.generate(spark, fixtures.files(spark, sf), _failures(spark, sf))
    return g.select(F.col("file_id").alias("doc_id"), "route", F.sha1("content").alias("content_sha1"),
                                  F.size("extracted_properties").alias("n_properties"))


def q_search_content_failures(spark, sf):
    """M2 when extraction fails: what is left of the search text of all files, and whether metadata are stashed."""
    return _search_content_failures(spark, sf)


def q_search_content_failures_wrapping(spark, sf):
    """The files of route wrapping among them: native text merged with the metadata text."""
    return _search_content_failures(spark, sf).where("route = 'wrapping'")


def q_refresh(spark, sf):
    """English contents extracted early, the others later; a refresh extracts again what is older than the bound."""
    from quarry.streaming.ingest import refresh
    cfg = ProfileConfig.from_dict({"*": {**DEFAULTS, "cache_file_backend": "main"}})
    store, f = _new_store(spark, "refresh"), fixtures.files(spark, sf)
    for files, now in ((f.where("lang = 'en'"), dt.datetime(2024, 1, 10)), (f, dt.datetime(2024, 2, 1))):
        pipeline.generate(spark, files, pipeline.Settings(config=cfg, store=store, now=now))
    refresh(spark, f, cfg, store, success_before=dt.datetime(2024, 1, 20), now=FIXED_NOW)
    return store.state().select("store", "sha1", _ts_text(F.col("success_ts")).alias("success_ts"))


def q_extract_retries(spark, sf):
    """A3, D1, E5 in the engine: every distinct content asked for in rounds, until a final answer or the last attempt."""
    d = table(spark, sf, "documents").where("text is not null")
    requests = d.groupBy(F.sha1("text").alias("sha1")).agg(F.min("text").alias("content")).select(
        "sha1", F.lit("full").alias("request_kind"), "content", F.lit("text/plain").alias("mime"), F.lit(False).alias("ocr"), F.lit("").alias("ocr_languages"),
        F.lit(FIXED_NOW).cast("timestamp").alias("ts"))
    extractor = RetryingExtractor(fixtures.answers_by_digit(), delay_seconds=0)
    found = extractor(requests)
    asked = extractor.log().groupBy("sha1").agg(F.count("*").alias("attempts"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("attempt", "class"))),
                                                                                                         lambda a: a["class"]), " ").alias("classes"))  # three attempts at most
    return found.join(asked, "sha1").select("sha1", "outcome", "attempts", "classes", F.size("properties").alias("n_properties"), F.sha1("text").alias("text_sha1"), "message",
                                            _ts_text(F.col("ts")).alias("ts"))


def q_extract_pages(spark, sf):
    """Pages as files without a native handler; the extractor is chosen by MIME type."""
    files = table(spark, sf, "pages").select(
        F.col("page_id").alias("file_id"), F.lit("text/html").alias("mime"), F.lit(False).alias("has_native"), F.lit(None).cast("string").alias("native_text"),
        F.lit(None).cast(meta.FORMATTED).alias("native_meta"), F.col("html").alias("content"))
    s = pipeline.Settings(config=default_config(), now=FIXED_NOW, extractor=by_mime({"text/html": html_extractor}))
    g = pipeline.generate(spark, files, s)
    title = F.try_element_at(F.filter("extracted_properties", lambda p: p["name"] == "dc:title"), F.lit(1))["values"][0]
    return g.select(F.col("file_id").alias("page_id"), F.sha1("content").alias("text_sha1"), title.alias("title"))


def q_error_policy(spark, sf):
    """F12 + E4 + P5 for a full request against each folded entry; the
    entry's profile is chosen by its hash (two profiles)."""
    cfg = _cfg()
    prof = resolve_profiles(spark, cfg).select("label", "ignore_content_parsing_errors")
    f = _fold(spark, sf).withColumn(
        "label", F.when(F.substring("sha1", 1, 1) < "8", F.lit("image/jpeg")).otherwise(F.lit("*")))
    f = f.join(F.broadcast(prof), "label")
    err, part = outcomes.read_result(F.col("m_state"), F.col("c_state"), F.lit("full"))
    res = state.resolved_enough(F.col("m_state"), F.col("c_state"), F.lit("full"))
    ign = outcomes.error_policy(err, F.col("ignore_content_parsing_errors"), F.lit(False))
    result = (F.when(~res, "extract").when(err.isNull(), "data")
              .when(ign, "ignored_empty").otherwise("error"))
    return f.select("sha1", "label", F.when(res, err).alias("error_class"), F.when(res, part).alias("error_part"),
                    result.alias("result"))


def _records(spark, sf):
    """Folded entries with payload, as the store keeps them (stamps in milliseconds)."""
    e, ms = _fold(spark, sf), lambda c: F.date_trunc("millisecond", F.col(c)).alias(c)
    prop = lambda pos, name, many, *v: F.struct(F.lit(pos).alias("pos"), F.lit(name).alias("name"), F.array(*v).alias("values"), F.lit(many).alias("is_list"))
    quoted = F.concat(F.lit('a "b" \\ '), F.col("sha1"))
    return e.select(
        "sha1", "m_state", "c_state", ms("success_ts"), ms("m_fail_ts"), ms("c_fail_ts"),
        F.when(F.col("m_state") == "good", F.array(prop(0, "z:last", False, quoted), prop(1, "a:list", True, F.col("sha1"), F.lit("x")))).alias("properties"),
        F.when(F.col("c_state") == "good", F.concat(F.lit("line\n"), quoted)).alias("text"),
        F.when(F.col("m_state") == "fail", F.lit("bad \"m\"")).alias("m_message"), F.when(F.col("c_state") == "fail", F.lit("bad c")).alias("c_message"))


def q_record_roundtrip(spark, sf):
    """X11: both records written and read back."""
    r = state.decode_record(state.encode_record(_records(spark, sf)))
    lines = F.transform("properties", lambda p: F.concat(p["pos"].cast("string"), F.lit(" "), p["name"], F.lit(" "), p["is_list"].cast("string"), F.lit(" "),
                                                         F.array_join(p["values"], ",")))
    return r.select("sha1", "m_state", "c_state", *[_ts_text(F.col(c)).alias(c) for c in ("success_ts", "m_fail_ts", "c_fail_ts")],
                    F.array_join(lines, ";").alias("properties"), "text", "m_message", "c_message", F.array_join("missing", ",").alias("missing"), "version_ok")


def q_missing_keys(spark, sf):
    """Records that lost a key, and failures that lost one."""
    enc = state.encode_record(_records(spark, sf))
    first = F.substring("sha1", 1, 1)
    body = F.when(first < "4", F.replace("body", F.lit('"contents":'), F.lit('"other":'))) \
        .when(first > "b", F.replace("body", F.lit('"onlyMetadata"'), F.lit('"only"'))).otherwise(F.col("body"))
    r = state.decode_record(enc.withColumn("body", body))
    return r.select("sha1", F.array_join("missing", ",").alias("missing"), "m_state", "c_state")


def q_unstash(spark, sf):
    """M4: extracted properties stashed with native metadata and recovered, in both forms."""
    p = _props(spark, sf).select("file_id", "properties")
    out = None
    for form, c in (("object", merge.stash(F.col("properties"))), ("array", merge.stash_json(F.col("properties")))):
        one = merge.unstash(p.withColumn("kept", c), "kept", "found").select("file_id", F.lit(form).alias("form"), "found")
        out = one if out is None else out.unionByName(one)
    # the text key is no property, so parsing a stash drops it
    # explode_outer as in q_parse_properties: of a plain explode Catalyst makes a filter that writes and parses the stash a second time
    e = out.select("file_id", "form", F.explode_outer("found").alias("p")).where(F.col("p.name") != meta.CONTENT_KEY)
    return e.select(F.col("file_id").alias("doc_id"), "form", F.col("p.name").alias("name"), F.col("p.is_list").alias("is_list"),
                    F.posexplode("p.values").alias("vpos", "value"))


# ---- properties and merging -------------------------------------------------

def q_parse_properties(spark, sf):
    r = parse_responses(fixtures.responses(spark, sf))
    # explode_outer + filter: a plain explode makes Catalyst infer a
    # size(...) > 0 filter and push it (with the JSON parse) into the scan.
    p = r.select("response_id", F.explode_outer("properties").alias("p")).where(F.col("p").isNotNull())
    return p.select("response_id", F.col("p.pos").alias("pos"), F.col("p.name").alias("name"),
                    F.col("p.is_list").alias("is_list"), F.posexplode("p.values").alias("vpos", "value"))


def q_response_text(spark, sf):
    r = parse_responses(fixtures.responses(spark, sf))
    return r.select("response_id", "parsed_ok", F.sha1("text").alias("text_sha1"),
                    F.length("text").alias("text_chars"))


def _props(spark, sf):
    return fixtures.file_properties(fixtures.files(spark, sf))


def q_map_properties(spark, sf):
    p = _props(spark, sf).select("file_id", map_properties(F.col("properties"), RuleSet()).alias("m"))
    e = p.select("file_id", F.explode("m").alias("m"))
    return e.select(F.col("file_id").alias("doc_id"), F.col("m.pos").alias("pos"), F.col("m.name").alias("name"),
                    F.col("m.visibility_tag").alias("visibility_tag"), F.col("m.id").alias("id"),
                    F.posexplode("m.values").alias("vpos", "value"))


RULE_NAMES = [*(r[0] for r in BUILTIN_RULES), "Unknown:Name", "unknown <name>"]
NAMES_PER_FILE = 12


def q_builtin_rules(spark, sf):
    """All built-in rules. The files' properties go round the names of all rules and two unknown ones; a value holds markup."""
    names, file_id = F.array(*[F.lit(n) for n in RULE_NAMES]), F.col("doc_id")
    at = lambda k: F.pmod(file_id * NAMES_PER_FILE + k, F.lit(len(RULE_NAMES))).cast("int")
    props = F.transform(F.sequence(F.lit(0), F.lit(NAMES_PER_FILE - 1)), lambda k: F.struct(
        k.alias("pos"), F.get(names, at(k)).alias("name"), F.array(F.concat(F.lit("a < "), F.coalesce("lang", F.lit("-")))).alias("values"), F.lit(False).alias("is_list")))
    m = table(spark, sf, "documents").select("doc_id", F.explode(map_properties(props, RuleSet())).alias("m"))
    return m.select("doc_id", F.col("m.pos").alias("pos"), F.col("m.name").alias("name"), F.col("m.visibility_tag").alias("visibility_tag"), F.col("m.id").alias("id"),
                    F.posexplode("m.values").alias("vpos", "value"))


def stars_of_batches():
    """The formatter ``stars`` over Arrow arrays."""
    def stars(tags, values):
        import pyarrow.compute as pc
        return pc.binary_join_element_wise("*", tags, "* ", values, "")

    return stars


def user_rules():
    """Rule sets over all levels of precedence: exact, ``!``, built-in, ``*``; with formatters, arguments and discard.
    One formatter comes as a Column and as a function of Arrow batches."""
    register_formatter("stars", lambda tag, v: F.concat(F.lit("*"), tag, F.lit("* "), v))
    register_batch_formatter("stars_arrow", stars_of_batches())
    register_processor("wrap", lambda name, values, a, b: processed(
        F.upper(name), F.transform(values, lambda v: F.concat(F.lit(a), v, F.lit(b))), F.lit("Note")))
    register_processor("long_only", lambda name, values, n: F.when(F.length(values[0]) > n, processed(name, values, name)))
    star = {"dc:language": ("Lang<uage>", "Tongue"), "dc:source": False, "meta:keyword": True, "Custom:Note": {"formatter": "wrap", "args": ["[", "]"]},
            "meta:character-count": {"formatter": "long_only", "args": [3]}, "*": False}
    return {"star": RuleSet(star, formatter="stars", labels={"exif-artist": "Künstler"}), "star_arrow": RuleSet(star, formatter="stars_arrow", labels={"exif-artist": "Künstler"}),
            "bang": RuleSet({"dc:language": True, "!": "Bang"})}


def q_user_rules(spark, sf):
    """Properties mapped by user rules."""
    p, out = _props(spark, sf), None
    for name, rules in user_rules().items():
        m = p.select("file_id", F.explode(map_properties(F.col("properties"), rules)).alias("m"))
        one = m.select(F.col("file_id").alias("doc_id"), F.lit(name).alias("rules"), F.col("m.pos").alias("pos"), F.col("m.name").alias("name"),
                       F.col("m.visibility_tag").alias("visibility_tag"), F.col("m.id").alias("id"), F.posexplode("m.values").alias("vpos", "value"))
        out = one if out is None else out.unionByName(one)
    return out


def q_metadata_text(spark, sf):
    p = _props(spark, sf).withColumn("strategy", F.explode(F.array(*[F.lit(s) for s in STRATEGIES])))
    p = p.withColumn("mapped", map_properties(F.col("properties"), RuleSet()))
    p = merge.metadata_text_lines(p, "strategy", "mapped", "native_meta", "text")
    return p.select(F.col("file_id").alias("doc_id"), "strategy", "text")


def q_metadata_display(spark, sf):
    p = _props(spark, sf).withColumn("strategy", F.explode(F.array(*[F.lit(s) for s in STRATEGIES])))
    p = p.withColumn("mapped", map_properties(F.col("properties"), RuleSet()))
    p = merge.metadata_display(p, "strategy", "properties", "mapped", "native_meta", "display")
    g = p.select("file_id", "strategy", F.explode(F.array(
        F.struct(F.lit("visible").alias("grp"), F.col("display.visible").alias("entries")),
        F.struct(F.lit("collapsed").alias("grp"), F.col("display.collapsed").alias("entries")))).alias("g"))
    e = g.select("file_id", "strategy", F.col("g.grp").alias("grp"), F.posexplode("g.entries").alias("pos", "e"))
    return e.select(F.col("file_id").alias("doc_id"), "strategy", "grp", "pos",
                    F.col("e.id").alias("id"), F.col("e.name").alias("name"), F.col("e.value").alias("value"))


def q_merge_content(spark, sf):
    f = fixtures.files(spark, sf).withColumn("strategy", F.explode(F.array(*[F.lit(s) for s in STRATEGIES])))
    return f.select(F.col("file_id").alias("doc_id"), "strategy",
                    merge.merge_content(F.col("strategy"), F.col("native_text"), trim_text(F.col("content"))).alias("content"))


def q_append_metadata(spark, sf):
    p = _props(spark, sf).withColumn("mapped", map_properties(F.col("properties"), RuleSet()))
    p = p.withColumn("strategy", F.lit("combine"))
    p = merge.metadata_text_lines(p, "strategy", "mapped", "native_meta", "md")
    p = p.withColumn("composition", F.explode(F.array(*[F.lit(c) for c in COMPOSITIONS])))
    base = F.when(F.col("composition") == "metadata", F.lit("")).otherwise(trim_text(F.col("content")))
    out = F.when(F.col("composition") == "text", base).otherwise(append_metadata(base, F.col("md")))
    return p.select(F.col("file_id").alias("doc_id"), "composition", out.alias("content"))


# ---- end to end ---------------------------------------------------------------

def _generated(spark, sf):
    s = pipeline.Settings(config=_cfg(), now=FIXED_NOW)
    return pipeline.generate(spark, fixtures.files(spark, sf), s)


def q_search_content(spark, sf):
    g = _generated(spark, sf)
    return g.select(F.col("file_id").alias("doc_id"), "sha1", "route", "content")


def q_generate_metadata(spark, sf):
    """M3 + M4: native metadata entries (stash removed) next to the
    extracted properties stashed for each file."""
    return _metadata_rows(_generated(spark, sf))


def _metadata_rows(g):
    ext = g.select("file_id", F.lit("extracted").alias("source"), F.explode("extracted_properties").alias("p")) \
        .select("file_id", "source", F.col("p.pos").alias("pos"), F.col("p.name").alias("name"),
                F.array_join("p.values", " ").alias("value"))
    nat = merge.strip_stash(F.col("native_meta"))
    n = g.select("file_id", F.lit("native").alias("source"),
                 F.posexplode(F.concat(nat["visible"], nat["collapsed"])).alias("pos", "e")) \
        .select("file_id", "source", "pos", F.col("e.name").alias("name"), F.col("e.value").alias("value"))
    return ext.unionByName(n).withColumnRenamed("file_id", "doc_id")


def q_display_metadata(spark, sf):
    g = _generated(spark, sf)
    x = g.select("file_id", F.explode(F.array(
        F.struct(F.lit("visible").alias("grp"), F.col("display.visible").alias("entries")),
        F.struct(F.lit("collapsed").alias("grp"), F.col("display.collapsed").alias("entries")))).alias("g"))
    e = x.select("file_id", F.col("g.grp").alias("grp"), F.posexplode("g.entries").alias("pos", "e"))
    return e.select(F.col("file_id").alias("doc_id"), "grp", "pos", F.col("e.name").alias("name"),
                    F.col("e.value").alias("value"))


def q_html_extract(spark, sf):
    p = table(spark, sf, "pages")
    h = F.col("html")
    t = p.select("page_id", H.title(h).alias("title"), H.lang(h).alias("lang"), H.charset(h).alias("charset"),
                 H.body_text(h).alias("text"))
    return t.select("page_id", "title", "lang", "charset", F.length("text").alias("text_chars"),
                    F.sha1("text").alias("text_sha1"))


def q_ingest_stream(spark, sf):
    """The documents come in three batches; copies of a content come in different ones."""
    from quarry.streaming.ingest import ingest_documents_stream
    base, out = work_dir(spark, f"ingest-{uuid.uuid4().hex[:12]}"), None
    for folder in fixtures.arriving(table(spark, sf, "documents"), "doc_id", base + "/arriving", 3):
        out = ingest_documents_stream(spark, sf, _cfg(), now=FIXED_NOW, source=folder, base=base, files_per_batch=None)
    return out


def q_outcome_stream(spark, sf):
    """The events arrive in six batches, out of order and some of them twice, and are folded batch by batch
    into sharded state; the final state equals q_fold_outcomes."""
    from quarry.streaming.ingest import fold_outcome_stream
    base = work_dir(spark, f"outcomes-{uuid.uuid4().hex[:12]}")
    events = table(spark, sf, "events")
    schema, kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in events.schema) + ", arrival int", None
    for folder in fixtures.arriving(events, "event_id", base + "/arriving", 6, again=F.col("event_type").isin("error", "view")):
        stream = spark.readStream.schema(schema).parquet(folder)  # all that has arrived is a batch
        kept = fold_outcome_stream(spark, fixtures.outcomes_from(stream), base + "/state", base + "/checkpoint", most=2)
    return _state_out(kept.entries())


def _warm(spark, sf):
    """A second run over all files whose extractor finds no service: whatever it returns comes from the stores."""
    def nothing(requests):
        return text_extractor(requests).withColumns({"outcome": F.lit("service_failure"), "text": F.lit(None).cast("string")})
    store, f = _new_store(spark, "warm"), fixtures.files(spark, sf)
    pipeline.generate(spark, f, pipeline.Settings(config=_cfg(), store=store, now=FIXED_NOW))
    return pipeline.generate(spark, f, pipeline.Settings(config=_cfg(), store=store, now=FIXED_NOW, extractor=nothing))


def q_warm_store(spark, sf):
    """Search text of all files, answered from the stores."""
    return _warm(spark, sf).select(F.col("file_id").alias("doc_id"), "sha1", "route", "content")


def q_warm_metadata(spark, sf):
    """Metadata of all files, answered from the stores."""
    return _metadata_rows(_warm(spark, sf))


QUERIES = {name: fn for name, fn in dict(globals()).items() if name.startswith("q_") and callable(fn)}
