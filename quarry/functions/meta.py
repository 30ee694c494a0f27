"""Shapes and fixed names of metadata columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

# ---- fixed values (must equal the reference's for equal results) ----
# Name under which extracted text arrives in an extractor response.
CONTENT_KEY = "X-TIKA:content"
# Name of the private entry that carries extracted metadata inside native
# metadata; it is stripped before display and before search text.
STASH_TAG = "opaque_tatf_tika_metadata"
# Prefix of every mapped property's element id.
ID_PREFIX = "exif-"
# ---- end of fixed values ----

ENTRY = T.StructType([T.StructField("id", T.StringType()),
                      T.StructField("name", T.StringType()),
                      T.StructField("value", T.StringType())])
FORMATTED = T.StructType([T.StructField("visible", T.ArrayType(ENTRY)),
                          T.StructField("collapsed", T.ArrayType(ENTRY))])
PROPERTY = T.StructType([T.StructField("pos", T.IntegerType()),
                         T.StructField("name", T.StringType()),
                         T.StructField("values", T.ArrayType(T.StringType())),
                         T.StructField("is_list", T.BooleanType())])
PROPERTIES = T.ArrayType(PROPERTY)
MAPPED = T.StructType([T.StructField("name", T.StringType()),
                       T.StructField("values", T.ArrayType(T.StringType())),
                       T.StructField("visibility_tag", T.StringType()),
                       T.StructField("id", T.StringType())])


def entry(id_: Column | str, name: Column | str, value: Column) -> Column:
    lit = lambda v: F.lit(v) if isinstance(v, str) else v
    return F.struct(lit(id_).alias("id"), lit(name).alias("name"), value.cast("string").alias("value"))


def formatted(visible=(), collapsed=()) -> Column:
    """``struct<visible, collapsed>`` from lists of (id, name, value)."""
    def arr(items):
        if not items:
            return F.array().cast(T.ArrayType(ENTRY))
        return F.array(*[entry(*t) for t in items])
    return F.struct(arr(visible).alias("visible"), arr(collapsed).alias("collapsed"))


def empty_entries() -> Column:
    return F.array().cast(T.ArrayType(ENTRY))


def empty_properties() -> Column:
    return F.array().cast(PROPERTIES)
