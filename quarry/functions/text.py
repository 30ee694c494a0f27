"""Scalar text functions (X2-X7, X13) as Column builders."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# ---- fixed values ----
# Characters removed by the reference's trim of extracted text:
# space, tab, newline, carriage return, NUL, vertical tab.
TRIM_CHARS = " \t\n\r\x00\x0b"
# ---- end of fixed values ----

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = "abcdefghijklmnopqrstuvwxyz"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_text(c) -> Column:
    """Trim of extracted text; absent text becomes ''."""
    return F.btrim(F.coalesce(_c(c), F.lit("")), F.lit(TRIM_CHARS))


def escape_html(c) -> Column:
    """HTML-escape, ``&`` first; quotes as ``&quot;`` and ``&#039;``."""
    c = _c(c)
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#039;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def ascii_lower(c) -> Column:
    """Lower-case ASCII letters only (locale-free)."""
    return F.translate(_c(c), _UPPER, _LOWER)


def join_values(values) -> Column:
    """Values joined by one space; a NULL element renders as ''."""
    return F.array_join(F.transform(_c(values), lambda x: F.coalesce(x, F.lit(""))), " ")


def append_metadata(content, metadata_text) -> Column:
    """``content ' ' metadata`` when metadata text is non-empty."""
    c, m = _c(content), _c(metadata_text)
    return F.when(m.isNotNull() & (m != ""), F.concat(c, F.lit(" "), m)).otherwise(c)


def display_value(values) -> Column:
    """One value as itself, several as an HTML unordered list."""
    v = _c(values)
    items = F.array_join(F.transform(v, lambda x: F.concat(F.lit("<li>"), F.coalesce(x, F.lit("")), F.lit("</li>"))), "\n")
    return F.when(F.size(v) == 1, F.coalesce(v[0], F.lit(""))).otherwise(
        F.concat(F.lit("<ul>"), items, F.lit("</ul>")))
