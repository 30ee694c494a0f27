"""Scans of the given Parquet tables (S1 for table-shaped inputs)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from quarry.functions import meta

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table; column pruning and filters reach the Parquet scan."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# ---- fixed values ----
# MIME types by file name ending, for files that come without one.
MIME_BY_ENDING = {"txt": "text/plain", "html": "text/html", "htm": "text/html", "pdf": "application/pdf",
                  "doc": "application/msword", "jpg": "image/jpeg", "jpeg": "image/jpeg", "mp3": "audio/mpeg"}
# ---- end of fixed values ----


def files_of(raw: DataFrame, mime_by_ending: dict | None = None) -> DataFrame:
    """Rows of a ``binaryFile`` scan as files: ``file_id`` (hash of the path),
    path, MIME (by the name's ending, else ``application/octet-stream``), content;
    there is no native handler."""
    known = mime_by_ending or MIME_BY_ENDING
    table_ = F.create_map(*[F.lit(x) for kv in known.items() for x in kv])
    ending = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    return raw.select(
        F.xxhash64("path").alias("file_id"), "path", F.coalesce(F.try_element_at(table_, ending), F.lit("application/octet-stream")).alias("mime"),
        F.lit(False).alias("has_native"), F.lit(None).cast("string").alias("native_text"), F.lit(None).cast(meta.FORMATTED).alias("native_meta"), "content")


def read_files(spark: SparkSession, path_glob: str) -> DataFrame:
    """Raw files of a shared folder. ``binaryFile`` lists and reads them in
    parallel on the executors; content is only read when it is selected."""
    return files_of(spark.read.format("binaryFile").load(path_glob))


def stream_files(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    """Streaming variant of :func:`read_files` (T1 input)."""
    return files_of(spark.readStream.format("binaryFile").option("maxFilesPerTrigger", max_files).load(folder))
