"""Content keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def content_key(content) -> Column:
    """SHA-1 of the content, 40 lower-case hex characters.

    Works on ``binary`` and on ``string`` (UTF-8 bytes) columns alike.
    """
    c = F.col(content) if isinstance(content, str) else content
    return F.sha1(c)


def shard(sha1) -> Column:
    """Two-character shard of a key, for ``partitionBy``."""
    c = F.col(sha1) if isinstance(sha1, str) else sha1
    return F.substring(c, 1, 2)
