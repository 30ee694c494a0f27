"""Merging extracted and native results.

All in-row: arrays of structs with higher-order functions, no explode and
no regroup (an explode would cost a shuffle to put rows back together).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from quarry.functions import meta
from quarry.functions.text import ascii_lower, display_value, join_values
from quarry.operators.properties import DEFAULT_VISIBLE_FIELDS
from quarry.operators.responses import parse_responses
from quarry.operators.state import properties_json


def merge_content(strategy: Column, native: Column, extracted: Column) -> Column:
    """M1: text merge. ``native`` nullable, ``extracted`` never NULL."""
    return (F.when(strategy == "no_extracted", native)
            .when(strategy == "prefer_native", F.coalesce(native, extracted))
            .when(strategy == "combine",
                  F.when(F.coalesce(native, F.lit("")) == "", extracted)
                   .when(extracted == "", native)
                   .otherwise(F.concat(native, F.lit("\n"), extracted)))
            .when(strategy == "prefer_extracted", F.when(extracted != "", extracted).otherwise(native))
            .when(strategy == "only_extracted", extracted))


def strip_stash(formatted: Column) -> Column:
    """drop the private stash entry from both groups (NULL stays NULL)."""
    keep = lambda e: e["name"] != meta.STASH_TAG
    return F.when(formatted.isNotNull(), F.struct(
        F.filter(formatted["visible"], keep).alias("visible"),
        F.filter(formatted["collapsed"], keep).alias("collapsed")))


def stash(properties: Column) -> Column:
    """M4: extracted properties as the opaque value kept beside native metadata (object form)."""
    return F.struct(properties.alias("metadata"))


def stash_json(properties: Column) -> Column:
    """M4: the same after a JSON round trip (array form)."""
    return F.concat(F.lit('{"metadata":'), properties_json(properties), F.lit("}"))


def unstash(df: DataFrame, stashed: str, out: str) -> DataFrame:
    """M4 importer: properties from a stash of either form (a struct, or its JSON);
    NULL when there is none, or when the JSON has no ``metadata``."""
    if isinstance(df.schema[stashed].dataType, T.StructType):
        return df.withColumn(out, F.col(stashed)["metadata"])
    keep = [c for c in df.columns if c != out]
    p = parse_responses(df.select(F.struct(*keep).alias("_row"), F.get_json_object(stashed, "$.metadata").alias("_json")), "_json")
    return p.select("_row.*", F.when(F.col("parsed_ok"), F.col("properties")).alias(out))


def _lines_native(formatted: Column) -> Column:
    entries = F.concat(F.coalesce(formatted["visible"], meta.empty_entries()),
                       F.coalesce(formatted["collapsed"], meta.empty_entries()))
    entries = F.filter(entries, lambda e: e["name"] != meta.STASH_TAG)
    return F.transform(entries, lambda e: F.concat(e["name"], F.lit(": "), F.coalesce(e["value"], F.lit("")), F.lit("\n")))


def _lines_extracted(mapped: Column) -> Column:
    return F.transform(mapped, lambda m: F.concat(m["name"], F.lit(": "), join_values(m["values"]), F.lit("\n")))


def metadata_text_lines(df: DataFrame, strategy: str, mapped: str, native_meta: str, out: str) -> DataFrame:
    """M5 + A4 + X6: metadata lines for search text into column ``out``
    (NULL when none). ``mapped``: mapped extracted properties (NULL = none
    extracted); ``native_meta``: native formatted metadata (NULL = none)."""
    st = F.col(strategy)
    empty = F.array().cast("array<string>")
    df = df.withColumns({
        "_nat_lines": F.when(F.col(native_meta).isNotNull() & (st != "only_extracted"),
                             _lines_native(F.col(native_meta))).otherwise(empty),
        "_ext_lines": F.when(F.col(mapped).isNotNull() & (st != "no_extracted"),
                             _lines_extracted(F.col(mapped))).otherwise(empty)})
    nat, ext = F.col("_nat_lines"), F.col("_ext_lines")
    lines = (F.when(st == "no_extracted", nat)
             .when(st == "prefer_native", F.when(F.size(nat) > 0, nat).otherwise(ext))
             .when(st == "combine", F.concat(ext, nat))
             .when(st == "prefer_extracted", F.when(F.size(ext) > 0, ext).otherwise(nat))
             .when(st == "only_extracted", ext))
    df = df.withColumn("_lines", lines)
    return df.withColumn(out, F.when(F.size("_lines") > 0, F.array_join("_lines", ""))) \
             .drop("_nat_lines", "_ext_lines", "_lines")


def _sort_entries(arr: Column) -> Column:
    """O1: by name, ASCII case-insensitive; stable (position breaks ties)."""
    def cmp(a, b):
        la, lb = ascii_lower(a["name"]), ascii_lower(b["name"])
        return (F.when(la < lb, -1).when(la > lb, 1)
                .when(a["pos"] < b["pos"], -1).when(a["pos"] > b["pos"], 1).otherwise(0))
    return F.array_sort(arr, cmp)


def _entry_of(m: Column) -> Column:
    return F.struct(m["id"].alias("id"), m["name"].alias("name"), display_value(m["values"]).alias("value"))


def extracted_display(properties: Column, mapped: Column, visible_fields=DEFAULT_VISIBLE_FIELDS) -> Column:
    """M6 (extracted side) + J7 + A5 + O1: ``struct<visible, collapsed>``;
    NULL when there are no extracted properties at all (before mapping)."""
    vis = F.array(*[F.lit(v) for v in visible_fields]) if visible_fields else F.array().cast("array<string>")
    is_vis = lambda m: F.array_contains(vis, m["visibility_tag"])
    group = lambda keep: F.transform(_sort_entries(F.filter(mapped, keep)), _entry_of)
    out = F.struct(group(is_vis).alias("visible"), group(lambda m: ~is_vis(m)).alias("collapsed"))
    return F.when(properties.isNotNull() & (F.size(properties) > 0), out)


def merge_display(strategy: Column, extracted: Column, native: Column) -> Column:
    """M7 + U1: merge of two formatted metadata structs."""
    both = F.struct(
        F.concat(F.coalesce(native["visible"], meta.empty_entries()),
                 F.coalesce(extracted["visible"], meta.empty_entries())).alias("visible"),
        F.concat(F.coalesce(native["collapsed"], meta.empty_entries()),
                 F.coalesce(extracted["collapsed"], meta.empty_entries())).alias("collapsed"))
    return (F.when(strategy == "no_extracted", native)
            .when(strategy == "prefer_native", F.coalesce(native, extracted))
            .when(strategy == "combine", F.when(native.isNull() & extracted.isNull(), F.lit(None)).otherwise(both))
            .when(strategy == "prefer_extracted", F.coalesce(extracted, native))
            .when(strategy == "only_extracted", extracted))


def metadata_display(df: DataFrame, strategy: str, properties: str, mapped: str, native_meta: str,
                     out: str, visible_fields=DEFAULT_VISIBLE_FIELDS) -> DataFrame:
    """M6: F10 → short circuit → map/sort → M7, into column ``out``."""
    st = F.col(strategy)
    df = df.withColumns({"_nat_disp": strip_stash(F.col(native_meta)),
                         "_ext_disp": extracted_display(F.col(properties), F.col(mapped), visible_fields)})
    nat = F.col("_nat_disp")
    short = (st == "no_extracted") | ((st == "prefer_native") & nat.isNotNull())
    df = df.withColumn(out, F.when(short, nat).otherwise(merge_display(st, F.col("_ext_disp"), nat)))
    return df.drop("_nat_disp", "_ext_disp")
