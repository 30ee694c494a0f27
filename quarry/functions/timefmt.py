"""RFC 3339 time stamps with milliseconds."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# ---- fixed values ----
# Stored stamps: RFC 3339 with milliseconds and a numeric offset, e.g.
# 2021-02-14T20:54:32.171+00:00.
TS_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"
TS_OUT = "yyyy-MM-dd'T'HH:mm:ss.SSSxxx"
# ---- end of fixed values ----


def parse_ts(c) -> Column:
    """Text → timestamp; NULL when the text is not in the stored format."""
    c = F.col(c) if isinstance(c, str) else c
    return F.try_to_timestamp(c, F.lit(TS_PATTERN))


def format_ts(c) -> Column:
    """Timestamp → text in the stored format (session time zone UTC)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, TS_OUT)
