"""Routing and request kinds (F1 F3 F4 F5 F13), as column expressions over
files joined to their profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ROUTES = ["none", "native", "solo", "wrapping"]
REQUEST_RANK = {"none": 0, "metadata": 1, "full": 2}


def route(profile_ok: Column, handler_strategy: Column, has_native: Column) -> Column:
    """none / native / solo / wrapping."""
    return (F.when(~F.coalesce(profile_ok, F.lit(False)),
                   F.when(has_native, "native").otherwise("none"))
            .when(handler_strategy == "fallback", F.when(has_native, "native").otherwise("solo"))
            .when(handler_strategy == "override", F.lit("solo"))
            .when(handler_strategy == "wrapping", F.when(has_native, "wrapping").otherwise("solo")))


def apply_route(df: DataFrame, native_cols=("native_text", "native_meta")) -> DataFrame:
    """Add ``route``; under ``solo`` the native inputs are forced to NULL, under
    ``wrapping`` empty ones are NULL (S7: an empty text or a formatted metadata
    without entries is none). The native route keeps its handler's values."""
    df = df.withColumn("route", route(F.col("profile_ok"), F.col("handler_strategy"), F.col("has_native")))
    for c in native_cols:
        if c in df.columns:
            empty = F.col(c) == "" if c == "native_text" else F.size(F.col(c)["visible"]) + F.size(F.col(c)["collapsed"]) <= 0
            df = df.withColumn(c, F.when((F.col("route") != "solo") & ~((F.col("route") == "wrapping") & F.coalesce(empty, F.lit(False))), F.col(c)))
    return df


def _ours(route_col: Column) -> Column:
    return route_col.isin("solo", "wrapping")


def content_request(route_col: Column, strategy: Column, composition: Column,
                    native_text: Column) -> Column:
    """F3 + F5: ``none`` when the strategy will not use extracted text,
    else ``metadata`` for a metadata composition, else ``full``."""
    skip = (strategy == "no_extracted") | ((strategy == "prefer_native") & native_text.isNotNull())
    return (F.when(_ours(route_col) & ~skip,
                   F.when(composition == "metadata", "metadata").otherwise("full"))
            .otherwise("none"))


def metadata_request(route_col: Column, strategy: Column, native_meta: Column) -> Column:
    """metadata extraction unless the strategy will not use it."""
    skip = (strategy == "no_extracted") | ((strategy == "prefer_native") & native_meta.isNotNull())
    return F.when(_ours(route_col) & ~skip, F.lit("metadata")).otherwise("none")


def ocr_flags(request: Column, allow_ocr: Column, ocr_languages: Column):
    """OCR only on full requests of profiles that allow it; languages
    are handed over whenever a request is made and the list is non-empty."""
    ocr = (request == "full") & F.coalesce(allow_ocr, F.lit(False))
    langs = F.when((request != "none") & (ocr_languages != ""), ocr_languages)
    return ocr, langs


def add_requests(df: DataFrame) -> DataFrame:
    """All request columns for files with profile and route attached."""
    cr = content_request(F.col("route"), F.col("content_strategy"), F.col("content_composition"),
                         F.col("native_text"))
    mr = metadata_request(F.col("route"), F.col("metadata_strategy"), F.col("native_meta"))
    df = df.withColumn("content_request", cr).withColumn("metadata_request", mr)
    ocr, langs = ocr_flags(F.col("content_request"), F.col("allow_ocr"), F.col("ocr_languages"))
    return df.withColumn("ocr", ocr).withColumn("ocr_languages_sent", langs)


def strongest_request(*reqs: Column) -> Column:
    """Rank of the strongest of several request kinds (full > metadata > none)."""
    rank = lambda r: F.when(r == "full", 2).when(r == "metadata", 1).otherwise(0)
    return F.greatest(*[rank(r) for r in reqs])


def rank_to_request(rank: Column) -> Column:
    return F.when(rank == 2, "full").when(rank == 1, "metadata").otherwise("none")
