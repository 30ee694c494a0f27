"""The central pipeline (E2 E3 M2 M3 S8): files → search text and metadata.

Stages and their Spark boundaries:

1. files ⋈ broadcast(profiles) → route → request kinds          (narrow)
2. sha1(content)                                                (narrow)
3. requests per (store, sha1): strongest request, representative (shuffle by sha1,
   partial aggregation; ``content`` is not carried)
4. probe the store's states in the shards of the batch → expiry → action
5. distinct hashes to extract → fetch bytes of the representative only → extractor
6. apply outcomes; metadata-only second pass where needed (E3)
7. checkpoint; commit the changed entries as a delta
8. fetch stored payload for hits, join entries back to files on (store, sha1)
   → M2 / M3, each file judged by its own requests               (shuffle; AQE skew join)
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quarry.functions import meta
from quarry.functions.text import append_metadata
from quarry.operators import merge, routing, state
from quarry.operators.content import with_content_key
from quarry.operators.extract import text_extractor
from quarry.operators.outcomes import error_policy, read_result
from quarry.operators.profiles import ProfileConfig, match_profile, resolve_profiles
from quarry.operators.properties import DEFAULT_VISIBLE_FIELDS, RuleSet, map_properties
from quarry.functions.keys import shard
from quarry.sources.store import KEY, STATE, STORE_SCHEMA, ResultStore


@dataclass
class Settings:
    config: ProfileConfig
    rules: RuleSet = field(default_factory=RuleSet)
    extractor: Callable[[DataFrame], DataFrame] = text_extractor
    store: ResultStore | None = None
    store_for_all: str | None = None      # use this store name for every profile
    now: _dt.datetime | None = None
    success_before: _dt.datetime | None = None  # T2: bounds that override earlier ones of the profiles
    failure_before: _dt.datetime | None = None
    visible_fields: tuple = tuple(DEFAULT_VISIBLE_FIELDS)  # J7
    strict: bool = False                  # an error that isn't ignored ends the job
    merge_requests: bool = True           # False: a hash needed for metadata and in full is asked for metadata first, then in full


def prepare_files(spark: SparkSession, files: DataFrame, s: Settings) -> DataFrame:
    """Stages 1-2: profile, route, request kinds, store name, content key."""
    resolved = resolve_profiles(spark, s.config)
    f = match_profile(files, resolved, s.config)
    for c, at in (("expire_success_before", s.success_before), ("expire_failure_before", s.failure_before)):
        if at is not None:
            f = f.withColumn(c, F.greatest(F.col(c), F.lit(at).cast("timestamp")))
    f = routing.apply_route(f)
    f = routing.add_requests(f)
    if s.store_for_all is not None:
        f = f.withColumn("store", F.when(F.col("profile_ok"), F.lit(s.store_for_all)))
    f = f.withColumn("request_rank", routing.strongest_request(F.col("content_request"), F.col("metadata_request")))
    return f if "sha1" in f.columns else with_content_key(f)


def _apply(entries: DataFrame, outcomes: DataFrame, asked: Column) -> DataFrame:
    """A2 update of the asked entries by at most one new outcome per sha1.

    A request without an outcome, like a service failure, changes nothing."""
    o = outcomes.select(F.col("sha1").alias("o_sha1"), F.col("request_kind").alias("o_kind"),
                        F.col("outcome").alias("o_outcome"), F.col("properties").alias("o_props"),
                        F.col("text").alias("o_text"), F.col("message").alias("o_message"),
                        F.col("ts").alias("o_ts"))
    j = entries.join(o, (entries["sha1"] == o["o_sha1"]) & asked, "left")
    ok = F.col("o_outcome") == "success"
    pf = F.col("o_outcome") == "parser_failure"
    full = F.col("o_kind") == "full"
    own = full & (F.col("action") == "extract_full")  # another store may have asked more of the same content
    upd = {
        "m_state": F.when(ok, "good").when(pf & ~full, "fail").otherwise(F.col("m_state")),
        "properties": F.when(ok, F.col("o_props")).when(pf & ~full, F.lit(None)).otherwise(F.col("properties")),
        "m_fail_ts": F.when(ok, F.lit(None)).when(pf & ~full, F.col("o_ts")).otherwise(F.col("m_fail_ts")),
        "m_message": F.when(ok, F.lit(None)).when(pf & ~full, F.col("o_message")).otherwise(F.col("m_message")),
        "m_new": F.col("m_new") | F.coalesce(ok | (pf & ~full), F.lit(False)),
        "c_state": F.when(ok & own, "good").when(pf & own, "fail").otherwise(F.col("c_state")),
        "text": F.when(ok & own, F.col("o_text")).when(pf & own, F.lit(None)).otherwise(F.col("text")),
        "c_fail_ts": F.when(ok & own, F.lit(None)).when(pf & own, F.col("o_ts")).otherwise(F.col("c_fail_ts")),
        "c_message": F.when(ok & own, F.lit(None)).when(pf & own, F.col("o_message")).otherwise(F.col("c_message")),
        "c_new": F.col("c_new") | F.coalesce(own & (ok | pf), F.lit(False)),
        "success_ts": F.when(ok, F.col("o_ts")).otherwise(F.col("success_ts")),
    }
    return j.withColumns(upd).drop("o_sha1", "o_kind", "o_outcome", "o_props", "o_text", "o_message", "o_ts")


def _with_payload(entries: DataFrame, store: ResultStore, column: str, wanted: Column, shards: list, live: dict) -> DataFrame:
    """Fill ``column`` from the store where ``wanted`` (entries have the ``v`` of their stored record)."""
    old = store.payload([column], shards, live).select(*[F.col(k).alias(f"p_{k}") for k in KEY], F.col("v").alias("p_v"), F.col(column).alias("p_value"))
    j = entries.join(old, (F.col("store") == F.col("p_store")) & (F.col("sha1") == F.col("p_sha1")) & (F.col("v") == F.col("p_v")) & wanted, "left")
    return j.withColumn(column, F.coalesce(F.col(column), F.col("p_value"))).drop("p_store", "p_sha1", "p_v", "p_value")


def error_class(m_state: Column, c_state: Column, request: Column):
    """E4 for one file's own request: ``(error_class, error_part)``. An entry that
    isn't resolved for the request after extraction is a service failure."""
    err, part = read_result(m_state, c_state, request)
    resolved = F.coalesce(state.resolved_enough(m_state, c_state, request), F.lit(False))
    asked = request != "none"
    return (F.when(asked & ~resolved, "service_failure").when(asked, err), F.when(asked & resolved, part))


def _extracted(e: DataFrame, s: Settings, extract: Callable[[DataFrame, Column], DataFrame], asked: Column) -> DataFrame:
    """Entries after the extractions they ask for (E2, E3), written with a reliable checkpoint if an answer can't be asked for again."""
    if not s.merge_requests:
        both = (F.col("action") == "extract_full") & F.col("wants_metadata") & (F.col("m_state") == "unknown")
        # the full answer that follows replaces the metadata; failed metadata stay if it isn't given
        e = _apply(e, extract(e.where(both), F.lit(False)), both).checkpoint(eager=True)
    e = _apply(e, extract(e.where(asked), F.col("action") == "extract_full"), asked)
    fails = not getattr(s.extractor, "never_fails", False)
    if fails:
        # Contents failed to parse and M is still unknown: ask for metadata only. The same after any full request
        # for the content, if a file needs metadata alone (it would have asked on its own).
        # The first answers are written, so that no lost executor asks again for them.
        e = e.checkpoint(eager=True)
        hashes = e.where(F.col("action") == "extract_full").select("sha1").distinct().withColumn("in_full", F.lit(True))
        # Only entries that may ask again are compared and written again: they have no text, the others stay as they are.
        may = F.coalesce(asked & (F.col("m_state") == "unknown") & ((F.col("c_state") == "fail") | F.col("wants_metadata")), F.lit(False))
        some = e.where(may).join(hashes, "sha1", "left").withColumn(
            "action", F.when(F.col("in_full"), "extract_metadata_fallback").otherwise(F.col("action"))).drop("in_full")
        second = F.col("action") == "extract_metadata_fallback"
        some = _apply(some, extract(some.where(second), F.lit(False)), second)
        return e.where(~may).unionByName(some.checkpoint(eager=True))
    # In the shared folder: new answers survive lost executors, and lineage is cut here.
    return e.checkpoint(eager=True) if s.store is not None else e


def store_or_extract(spark: SparkSession, prepared: DataFrame, s: Settings,
                     contents: DataFrame | Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """E2 + E3 over all requests of a batch; returns one entry per (store, sha1)
    with the request it served and its answer (E4).

    ``prepared`` holds the per-file keys; ``contents`` ``(file_id, content)``, or
    a function that adds ``content`` to requests by their ``rep``, is read only for the representative file of each hash to extract: the
    smallest id among those with the strongest request, OCR first."""
    now = F.lit(s.now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)).cast("timestamp")
    meta_only = (F.col("metadata_request") == "metadata") | (F.col("content_request") == "metadata")
    best = F.min(F.struct((-F.col("request_rank")).alias("rank"), (~F.coalesce("ocr", F.lit(False))).alias("no_ocr"),
                          F.col("file_id").alias("rep"), F.col("ocr_languages_sent").alias("langs"), F.col("mime").alias("mime")))
    reqs = (prepared.where(F.col("request_rank") > 0)
            .groupBy("store", "sha1")
            .agg(best.alias("best"), F.max(meta_only).alias("wants_metadata"),
                 F.max("expire_success_before").alias("success_before"),
                 F.max("expire_failure_before").alias("failure_before"))
            .select("store", "sha1", "best", "wants_metadata", "success_before", "failure_before",
                    routing.rank_to_request(-F.col("best.rank")).alias("request")))
    shards: list = []
    live: dict = {}
    if s.store is not None:
        live = s.store.runs.live()  # the commit below may merge runs; this batch goes on with those it has probed
        # at most 256 values; a small batch reads the store's partitions of its own keys only
        shards = [r[0] for r in reqs.where("store is not null").select(shard(F.col("sha1"))).distinct().collect()]
        e = reqs.join(s.store.states(shards, live).drop("schema_version"), KEY, "left")
    else:
        e = reqs.withColumn("v", F.lit(None).cast("int"))
        for c in STATE:
            if c != "schema_version":
                e = e.withColumn(c, F.lit(None).cast(STORE_SCHEMA[c].dataType))
    for c in ("properties", "text", "m_message", "c_message"):
        e = e.withColumn(c, F.lit(None).cast(STORE_SCHEMA[c].dataType))
    e = e.withColumn("m_state", F.coalesce("m_state", F.lit("unknown"))) \
         .withColumn("c_state", F.coalesce("c_state", F.lit("unknown")))
    e = state.expire(e, F.col("success_before"), F.col("failure_before"))
    e = e.withColumn("action", state.action(F.col("m_state"), F.col("c_state"), F.col("request"))) \
         .withColumn("m_new", F.lit(False)).withColumn("c_new", F.lit(False))
    if callable(contents):
        fetch = contents
    else:
        content = (contents if contents is not None else prepared).select(F.col("file_id").alias("rep"), "content")
        fetch = lambda some: some.join(content, "rep")

    def extract(todo: DataFrame, full: Column) -> DataFrame:
        """Ask once per hash; ``todo`` has (sha1, best, action)."""
        kind = F.when(full, F.lit(2)).otherwise(F.lit(1))
        t = (todo.groupBy("sha1").agg(F.min(F.struct((-kind).alias("kind"), "best")).alias("b"))
             .select("sha1", F.when(F.col("b.kind") == -2, "full").otherwise("metadata").alias("request_kind"),
                     F.col("b.best.rep").alias("rep"), F.col("b.best.mime").alias("mime"),
                     ((F.col("b.kind") == -2) & ~F.col("b.best.no_ocr")).alias("ocr"), F.col("b.best.langs").alias("ocr_languages"))
             .withColumn("ts", now))
        in_rounds = getattr(s.extractor, "in_rounds", None)  # contents are fetched by each round for its own requests
        return in_rounds(t, fetch) if in_rounds else s.extractor(fetch(t))

    asked = F.col("action").startswith("extract")
    ask = True
    if s.store is not None:
        # Keys and states are worked out once. If the stores answer everything, no content is read at all.
        e = e.checkpoint(eager=True)
        ask = e.where(asked).limit(1).count() > 0
    if ask:
        e = _extracted(e, s, extract, asked)
    if s.store is not None:
        stored = F.col("v").isNotNull()
        old_m = stored & ~F.col("m_new") & (F.col("m_state") == "good")
        old_c = stored & ~F.col("c_new") & (F.col("c_state") == "good")
        # An entry whose metadata stay unknown isn't stored (the contents failure before it neither).
        changed = (F.col("m_new") | F.col("c_new")) & (F.col("m_state") != "unknown") & F.col("store").isNotNull()
        if ask and e.where(changed).limit(1).count() > 0:
            ch = _with_payload(e.where(changed), s.store, "properties", old_m, shards, live)
            ch = _with_payload(ch, s.store, "text", old_c, shards, live)
            s.store.commit(ch.withColumn("schema_version", F.lit(state.SCHEMA_VERSION)), strict=True)
        e = _with_payload(e, s.store, "properties", old_m, shards, live)
        if e.where((F.col("request") == "full") & old_c).limit(1).count() > 0:  # texts are read only if a file needs one
            e = _with_payload(e, s.store, "text", old_c & (F.col("request") == "full"), shards, live)
    # The answer to the strongest request, and to either kind: files are judged by their own (not worked out again per file).
    told = [c.alias(name + kind) for kind, request in (("", F.col("request")), ("_full", F.lit("full")), ("_metadata", F.lit("metadata")))
            for name, c in zip(("error_class", "error_part"), error_class(F.col("m_state"), F.col("c_state"), request))]
    return e.select("store", "sha1", "request", "action", "m_state", "c_state", "properties",
                    F.when(F.col("c_state") == "good", F.col("text")).alias("text"), *told)


def generate(spark: SparkSession, files: DataFrame, s: Settings, fetch: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """M2 + M3 per file: ``search_content`` and metadata columns.

    Files come with their ``content``, or with its ``sha1`` and a function
    ``fetch`` that reads contents when they must be extracted (:func:`quarry.sources.files.fetcher`).

    Output: file_id, sha1, route, content_request, metadata_request,
    content (search text), extracted_properties (M3 stash, typed),
    native_meta, display (M6 struct), and for the content and the metadata
    request of the file each: error class, part and whether it is ignored.
    """
    # Keys once: hashing reads every content byte, so the per-file keys with the
    # native inputs (without content) are checkpointed and reused by both the
    # request aggregation and the final join; bytes are read again only for the
    # representative file of each hash that must be extracted.
    p = prepare_files(spark, files, s).drop("content").checkpoint(eager=True)
    entries = store_or_extract(spark, p, s, contents=fetch or files.select("file_id", "content"))
    j = p.join(entries.withColumnRenamed("store", "e_store").withColumnRenamed("sha1", "e_sha1"),
               F.col("store").eqNullSafe(F.col("e_store")) & (F.col("sha1") == F.col("e_sha1")), "left") \
         .drop("e_store", "e_sha1", "content")
    # The entry answers the strongest request of its hash; every file is judged by its own.
    for kind in ("content", "metadata"):
        asked = F.col(f"{kind}_request")
        j = j.withColumns({f"{kind}_error{x}": F.when(asked == "full", F.col(f"error_{y}_full")).when(asked == "metadata", F.col(f"error_{y}_metadata"))
                           for x, y in (("", "class"), ("_part", "part"))})
    j = j.withColumns({
        "content_error_ignored": error_policy(F.col("content_error"), F.col("ignore_content_parsing_errors"),
                                              F.col("ignore_content_service_errors")),
        "metadata_error_ignored": error_policy(F.col("metadata_error"), F.col("ignore_metadata_parsing_errors"),
                                               F.col("ignore_metadata_service_errors"))})
    has_err, reported = F.col("content_error").isNotNull(), ~F.coalesce("metadata_error_ignored", F.lit(True))
    # P5: an ignored failure leaves both text and metadata empty.
    j = j.withColumns({
        "ext_props": F.when(has_err, meta.empty_properties())
                      .otherwise(F.coalesce(F.col("properties"), meta.empty_properties())),
        "ext_text": F.when(has_err | (F.col("content_request") != "full"), F.lit(""))
                     .otherwise(F.coalesce(F.col("text"), F.lit(""))),
        "extracted_properties": F.when(
            (F.col("metadata_request") != "none") & ~reported,
            F.when(F.col("metadata_error").isNotNull(), meta.empty_properties())
             .otherwise(F.coalesce(F.col("properties"), meta.empty_properties()))),
    })
    j = j.withColumns({"ext_mapped": map_properties(F.col("ext_props"), s.rules),
                       "stash_mapped": map_properties(F.col("extracted_properties"), s.rules)})
    j = merge.metadata_text_lines(j, "metadata_strategy", "ext_mapped", "native_meta", "md_text")
    j = merge.metadata_display(j, "metadata_strategy", "extracted_properties", "stash_mapped", "native_meta", "_disp", s.visible_fields)
    ext = F.when(F.col("content_composition").isin("metadata", "text_and_metadata"),
                 append_metadata(F.col("ext_text"), F.col("md_text"))).otherwise(F.col("ext_text"))
    merged = merge.merge_content(F.col("content_strategy"), F.col("native_text"), F.col("ext"))
    content = (F.when(F.col("route") == "native", F.col("native_text"))
               .when(F.col("route") == "none", F.lit(None))
               .when(F.col("content_request") == "none", F.col("native_text"))
               .when(~F.coalesce("content_error_ignored", F.lit(True)), F.lit(None))
               .otherwise(merged))
    j = j.withColumn("ext", ext)
    j = j.withColumns({
        "search_text": content.cast("string"),
        "display": F.when(F.col("route").isin("solo", "wrapping"), F.col("_disp"))
                    .otherwise(merge.strip_stash(F.col("native_meta")))})
    if s.strict:
        for kind in ("content", "metadata"):
            bad = ~F.coalesce(f"{kind}_error_ignored", F.lit(True))
            j = j.withColumn(f"{kind}_error", F.when(bad, F.raise_error(F.concat(
                F.lit(f"{kind} of file "), F.col("file_id").cast("string"), F.lit(": "), F.col(f"{kind}_error")))).otherwise(F.col(f"{kind}_error")))
    return j.select("file_id", "sha1", "route", "content_request", "metadata_request",
                    F.col("search_text").alias("content"), "extracted_properties", "native_meta", "display",
                    *[f"{kind}_error{x}" for kind in ("content", "metadata") for x in ("", "_part", "_ignored")])


def errors(generated: DataFrame) -> DataFrame:
    """``(file_id, sha1, kind, error_class, error_part, ignored)``, a row per failed request of a file."""
    each = [F.struct(F.lit(k).alias("kind"), F.col(f"{k}_error").alias("error_class"), F.col(f"{k}_error_part").alias("error_part"),
                     F.col(f"{k}_error_ignored").alias("ignored")) for k in ("content", "metadata")]
    return (generated.select("file_id", "sha1", F.explode(F.array(*each)).alias("e")).select("file_id", "sha1", "e.*")
            .where("error_class is not null"))
