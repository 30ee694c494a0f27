"""Extractor responses → ordered properties + text.

JSON objects are read into ``map<string, variant>``: the map keeps key
order and duplicate keys, the variant keeps list-ness. Duplicates are
canonicalised in-row (first position, last value), as a JSON decoder that
keeps the last value would do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quarry.functions import meta
from quarry.functions.text import trim_text


def parse_responses(df: DataFrame, body: str = "body") -> DataFrame:
    """Adds ``properties`` (ordered ``(pos, name, values, is_list)``
    without the text key, X10), ``text`` (trimmed, '' when absent, X2) and
    ``parsed_ok`` (false for malformed or non-object bodies).

    The JSON is parsed once into a column; duplicate keys are then resolved
    in-row by two sorts, not by comparing all keys with each other.
    """
    df = df.withColumn("_m", F.from_json(F.col(body), "map<string,variant>"))
    df = df.withColumn("_e", F.transform(F.map_entries("_m"), lambda x, i: F.struct(
        i.alias("idx"), x["key"].alias("key"), x["value"].alias("value"))))
    # Sorted by key and position, the first and the last of equal keys stand at the ends of a run.
    df = df.withColumn("_s", F.array_sort("_e", lambda x, y: F.when(x["key"] < y["key"], -1).when(x["key"] > y["key"], 1)
                                          .otherwise(F.signum(x["idx"] - y["idx"]).cast("int"))))
    s, n = F.col("_s"), F.size("_s")
    firsts = F.filter(s, lambda x, i: (i == 0) | (F.get(s, i - 1)["key"] != x["key"]))
    lasts = F.filter(s, lambda x, i: (i == n - 1) | (F.get(s, i + 1)["key"] != x["key"]))
    canon = F.zip_with(firsts, lasts, lambda a, b: F.struct(a["idx"].alias("idx"), a["key"].alias("key"), b["value"].alias("value")))
    df = df.withColumn("_c", F.array_sort(canon, lambda x, y: F.signum(x["idx"] - y["idx"]).cast("int")))
    c = F.col("_c")

    def prop(x, i):
        arr = F.try_variant_get(x["value"], "$", "array<string>")
        vals = F.coalesce(arr, F.array(F.try_variant_get(x["value"], "$", "string")))
        return F.struct(i.alias("pos"), x["key"].alias("name"), vals.alias("values"), arr.isNotNull().alias("is_list"))
    props = F.transform(F.filter(c, lambda x: x["key"] != meta.CONTENT_KEY), prop)
    txt = F.try_element_at(F.filter(c, lambda x: x["key"] == meta.CONTENT_KEY), F.lit(1))["value"]
    return (df.withColumn("properties", props)
              .withColumn("text", trim_text(F.try_variant_get(txt, "$", "string")))
              .withColumn("parsed_ok", F.col("_m").isNotNull())
              .drop("_m", "_e", "_s", "_c"))

