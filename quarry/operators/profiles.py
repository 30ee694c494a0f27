"""Handling profiles: configuration → resolved profile table (S6 F14 J2 A6
X9), and per-file profile matching (J1).

The configuration is small and lives on the driver (it is user settings,
like any Spark job's options). It is turned into two tiny DataFrames,
resolved with a recursive CTE, and joined to files by broadcast.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quarry.functions.timefmt import parse_ts

# ---- fixed values ----
# The thirteen profile parameters, in the reference's resolution order.
PARAMS = [
    "handler_strategy", "allow_ocr", "ocr_languages", "content_strategy",
    "content_composition", "metadata_strategy",
    "ignore_content_service_errors", "ignore_content_parsing_errors",
    "ignore_metadata_service_errors", "ignore_metadata_parsing_errors",
    "cache_expire_success_before", "cache_expire_failure_before",
    "cache_file_backend",
]
# Built-in defaults (the `*` block shipped with the reference).
DEFAULTS = {
    "handler_strategy": "fallback", "allow_ocr": "false", "ocr_languages": "",
    "content_strategy": "combine", "content_composition": "text",
    "metadata_strategy": "prefer_other",
    "ignore_content_service_errors": "false", "ignore_content_parsing_errors": "false",
    "ignore_metadata_service_errors": "false", "ignore_metadata_parsing_errors": "false",
    "cache_expire_success_before": "false", "cache_expire_failure_before": "false",
    "cache_file_backend": "false",
}
HANDLER_STRATEGIES = ["fallback", "override", "wrapping"]
COMPOSITIONS = ["text", "metadata", "text_and_metadata"]
# Strategy words of the reference, and the neutral words we use.
STRATEGY_WORDS = {"no_tika": "no_extracted", "prefer_other": "prefer_native",
                  "combine": "combine", "prefer_tika": "prefer_extracted",
                  "only_tika": "only_extracted"}
# ---- end of fixed values ----
STRATEGIES = list(STRATEGY_WORDS.values())
BOOL_PARAMS = ["allow_ocr", "ignore_content_service_errors", "ignore_content_parsing_errors",
               "ignore_metadata_service_errors", "ignore_metadata_parsing_errors"]
# Setting: profiles are configuration, and their table is broadcast. A larger configuration is refused with an error
# (nothing is dropped). The walk through aliases is bound by spark.sql.cteRecursionLevelLimit and ...RowLimit.
MAX_CONFIG_LABELS = 10_000


@dataclass
class ProfileConfig:
    """Label graph: ``labels`` rows ``(label, kind, ref)`` with kind one of
    ``block`` (ref = inherit target), ``ref`` (alias), ``off``; ``params``
    rows ``(label, param, value)`` where the text ``false`` is a value."""

    labels: list = field(default_factory=list)
    params: list = field(default_factory=list)
    warnings: list = field(default_factory=list)

    @classmethod
    def from_dict(cls, conf: dict) -> "ProfileConfig":
        """From a mapping label → block dict | alias string | False | None."""
        out = cls()
        for label, v in conf.items():
            if v is None:
                continue  # explicit null: label absent, falls through to '*'
            if v is False:
                out.labels.append((label, "off", None))
            elif isinstance(v, str):
                out.labels.append((label, "ref", v))
            elif isinstance(v, dict):
                inherit = v.get("inherit")
                if inherit is None and "inherits" in v:
                    out.warnings.append(f"{label}: 'inherits' read as 'inherit'")
                    inherit = v["inherits"]
                if inherit is not None and not isinstance(inherit, str):
                    raise TypeError(f"profile {label!r}: inherit must be a label string")
                out.labels.append((label, "block", inherit))
                for k, val in v.items():
                    if k in ("inherit", "inherits") or val is None:
                        continue
                    if k not in PARAMS:
                        out.warnings.append(f"{label}: unknown parameter {k!r} ignored")
                        continue
                    if isinstance(val, bool):
                        val = "true" if val else "false"
                    out.params.append((label, k, str(val)))
            else:
                raise TypeError(f"profile {label!r}: unsupported value {v!r}")
        if len(out.labels) > MAX_CONFIG_LABELS:
            raise ValueError("profile configuration too large")
        return out

    @property
    def label_names(self) -> list:
        return [r[0] for r in self.labels]

    def frames(self, spark: SparkSession):
        labels = spark.createDataFrame(self.labels, "label string, kind string, ref string")
        params = spark.createDataFrame(self.params, "label string, param string, value string")
        return labels, params


def default_config() -> ProfileConfig:
    return ProfileConfig.from_dict({"*": dict(DEFAULTS)})


def _normalise_strategy(c: Column) -> Column:
    words = dict(STRATEGY_WORDS)
    words.update({v: v for v in STRATEGIES})
    m = F.create_map(*itertools.chain.from_iterable((F.lit(k), F.lit(v)) for k, v in words.items()))
    return F.try_element_at(m, c)


def resolve_walk(spark: SparkSession, labels: DataFrame) -> DataFrame:
    """J2 walk: every label reachable from each root through alias and
    inherit edges, with its depth; a revisited label ends the walk."""
    name = f"quarry_labels_{id(labels)}"
    labels.createOrReplaceTempView(name)
    return spark.sql(f"""
        WITH RECURSIVE walk(root, label, depth, visited) AS (
          SELECT label, label, 0, array(label) FROM {name}
          UNION ALL
          SELECT w.root, l.ref, w.depth + 1, concat(w.visited, array(l.ref))
          FROM walk w JOIN {name} l ON l.label = w.label
          WHERE l.kind IN ('ref', 'block') AND l.ref IS NOT NULL
            AND NOT array_contains(w.visited, l.ref)
        )
        SELECT root, label, depth FROM walk""")


def resolve_long(spark: SparkSession, labels: DataFrame, params: DataFrame) -> DataFrame:
    """``(label, param, value)`` — first value along the walk wins."""
    walk = resolve_walk(spark, labels)
    blocks = labels.where(F.col("kind") == "block").select("label")
    hits = (walk.join(blocks, "label").join(params, "label")
            .groupBy("root", "param")
            .agg(F.min_by("value", "depth").alias("value")))
    return hits.select(F.col("root").alias("label"), "param", "value")


_RESOLVED_CACHE: dict = {}


def resolve_profiles(spark: SparkSession, config: ProfileConfig) -> DataFrame:
    """Resolved profile table, one row per configured label (cached).

    The table has at most one row per configured label (checked), so it is
    resolved once, brought to the driver and re-created as a local relation:
    every plan that joins it gets a broadcast of a few hundred bytes instead
    of re-running the recursive resolution.
    """
    key = (id(spark), tuple(config.labels), tuple(config.params))
    hit = _RESOLVED_CACHE.get(key)
    if hit is None:
        df = _resolve_profiles(spark, config)
        rows = df.limit(MAX_CONFIG_LABELS + 1).collect()
        if len(rows) > MAX_CONFIG_LABELS:
            raise ValueError("profile configuration too large to broadcast")
        bad = [f"{r.label}: {r.invalid}" for r in rows if r.invalid]
        if bad:  # X8, X9: an unknown word or a bad stamp is an error, a missing parameter only makes the label no profile
            raise ValueError("profile values that can't be read: " + "; ".join(sorted(bad)))
        hit = (rows, df.schema)
        _RESOLVED_CACHE[key] = hit
    return spark.createDataFrame(hit[0], hit[1])


def _resolve_profiles(spark: SparkSession, config: ProfileConfig) -> DataFrame:
    """Resolved profile table, one row per configured label.

    Columns: label, status (``complete`` / ``incomplete`` / ``invalid``),
    missing (comma-separated parameter names, A6), the 13 typed parameters
    (strategies in neutral words; ``false`` bounds and store become NULL).
    """
    labels, params = config.frames(spark)
    long = resolve_long(spark, labels, params)
    wide = long.groupBy("label").pivot("param", PARAMS).agg(F.first("value"))
    allp = F.array(*[F.lit(p) for p in PARAMS])
    found = F.array_compact(F.array(*[F.when(F.col(p).isNotNull(), F.lit(p)) for p in PARAMS]))
    missing = F.array_except(allp, found)
    base = labels.select("label").join(wide, "label", "left")
    for p in PARAMS:
        if p not in base.columns:
            base = base.withColumn(p, F.lit(None).cast("string"))
    hs, cs, ms, comp = (F.col("handler_strategy"), _normalise_strategy(F.col("content_strategy")),
                        _normalise_strategy(F.col("metadata_strategy")), F.col("content_composition"))
    bad = F.array_compact(F.array(
        F.when(hs.isNotNull() & ~hs.isin(HANDLER_STRATEGIES), F.lit("handler_strategy")),
        F.when(F.col("content_strategy").isNotNull() & cs.isNull(), F.lit("content_strategy")),
        F.when(F.col("metadata_strategy").isNotNull() & ms.isNull(), F.lit("metadata_strategy")),
        F.when(comp.isNotNull() & ~comp.isin(COMPOSITIONS), F.lit("content_composition")),
        *[F.when(F.col(p).isNotNull() & ~F.col(p).isin("true", "false"), F.lit(p)) for p in BOOL_PARAMS],
        *[F.when(F.col(p).isNotNull() & (F.col(p) != "false") & parse_ts(F.col(p)).isNull(), F.lit(p))
          for p in ("cache_expire_success_before", "cache_expire_failure_before")],
    ))
    status = (F.when(F.size(missing) > 0, "incomplete")
              .when(F.size(bad) > 0, "invalid").otherwise("complete"))
    bound = lambda p: F.when(F.col(p) != "false", parse_ts(F.col(p))).cast("timestamp")
    return base.select(
        "label",
        status.alias("status"),
        F.array_join(missing, ", ").alias("missing"),
        F.array_join(bad, ", ").alias("invalid"),
        hs.alias("handler_strategy"),
        (F.col("allow_ocr") == "true").alias("allow_ocr"),
        F.col("ocr_languages").alias("ocr_languages"),
        cs.alias("content_strategy"),
        comp.alias("content_composition"),
        ms.alias("metadata_strategy"),
        *[(F.col(p) == "true").alias(p) for p in BOOL_PARAMS[1:]],
        bound("cache_expire_success_before").alias("expire_success_before"),
        bound("cache_expire_failure_before").alias("expire_failure_before"),
        F.when(F.col("cache_file_backend") != "false", F.col("cache_file_backend")).alias("store"),
    )


def choose_label(mime: Column, config: ProfileConfig) -> Column:
    """J1 with P3: the exact MIME label if configured (even as ``off``),
    else ``*`` if configured, else NULL. The label set is configuration."""
    names = config.label_names
    star = "*" in names
    exact = [n for n in names if n != "*"]
    c = F.when(mime.isin(exact), mime) if exact else F.lit(None).cast("string")
    if star:
        c = F.coalesce(c, F.when(mime.isNotNull(), F.lit("*")))
    return c


def match_profile(files: DataFrame, resolved: DataFrame, config: ProfileConfig,
                  mime_col: str = "mime") -> DataFrame:
    """Attach the profile chosen for each file's MIME type.

    ``profile_ok`` is true when the chosen label resolved completely; the
    profile columns are NULL otherwise. The profile table has one row per
    configured label (bounded by the configuration), so it is broadcast.
    """
    prof = resolved.where(F.col("status") == "complete").drop("status", "missing", "invalid") \
        .withColumnRenamed("label", "profile_label")
    out = files.withColumn("label", choose_label(F.col(mime_col), config))
    out = out.join(F.broadcast(prof), out["label"] == prof["profile_label"], "left")
    return out.withColumn("profile_ok", F.col("profile_label").isNotNull()).drop("profile_label")
