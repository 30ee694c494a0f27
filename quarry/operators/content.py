"""Content identity: hashing, dedupe, path index."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quarry.functions.keys import content_key


def with_content_key(files: DataFrame, content_col: str = "content") -> DataFrame:
    """Add ``sha1`` (narrow; no shuffle)."""
    return files.withColumn("sha1", content_key(F.col(content_col)))


def distinct_content(keys: DataFrame, rank_col: str | None = None, by=("sha1",)) -> DataFrame:
    """A1: one row per distinct content: file count, representative file
    (smallest id) and, if given, the strongest request rank.

    Partial aggregation combines a hot hash map-side, so a hash shared by a
    third of all files costs one row per task in the shuffle.
    """
    aggs = [F.count(F.lit(1)).alias("n_files"), F.min("file_id").alias("representative")]
    if rank_col:
        aggs.append(F.max(rank_col).alias("request_rank"))
    return keys.groupBy(*by).agg(*aggs)


def path_conflicts(path_log: DataFrame) -> DataFrame:
    """paths that were seen with more than one content hash.

    ``count_distinct`` is planned as a two-level aggregation (first by
    (path, sha1), then by path), so a path with very many uploads is
    pre-aggregated before it reaches one task.
    """
    return (path_log.groupBy("path").agg(F.count_distinct("sha1").alias("n_hashes"))
            .where(F.col("n_hashes") > 1))


def latest_path_index(path_log: DataFrame, order_col: str = "upload_id") -> DataFrame:
    """The path index: latest known hash per path (partial max_by)."""
    return path_log.groupBy("path").agg(F.max_by("sha1", order_col).alias("known_sha1"))


def resolve_path_keys(files: DataFrame, index: DataFrame) -> DataFrame:
    """The known hash of a path, else the one computed from the content
    (computed where the file is read, so that no content is shuffled)."""
    keyed = files.withColumn("computed_sha1", content_key(F.col("content"))).drop("content")
    j = keyed.join(index, "path", "left")
    return j.withColumn("sha1", F.coalesce(F.col("known_sha1"), F.col("computed_sha1"))) \
            .withColumn("sha1_source", F.when(F.col("known_sha1").isNotNull(), "index").otherwise("computed")) \
            .drop("known_sha1", "computed_sha1")
