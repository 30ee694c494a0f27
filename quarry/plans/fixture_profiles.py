"""The profile configuration used by the catalogue queries (FIXTURES.md
``profile_labels`` / ``profile_params``): complete block, alias, chain, off
switch, loop, dangling reference, incomplete block."""

from quarry.operators.profiles import DEFAULTS, ProfileConfig

LABELS = [
    ("defaults", "block", None),
    ("*", "ref", "defaults"),
    ("application/pdf", "block", "*"),
    ("image/jpeg", "block", "defaults"),
    ("application/msword", "ref", "application/pdf"),
    ("application/x-blocked", "off", None),
    ("loop-a", "ref", "loop-b"),
    ("loop-b", "ref", "loop-a"),
    ("partial", "block", None),
    ("dangling", "ref", "nowhere"),
]
PARAMS = [
    ("defaults", "handler_strategy", "fallback"), ("defaults", "allow_ocr", "false"),
    ("defaults", "ocr_languages", ""), ("defaults", "content_strategy", "combine"),
    ("defaults", "content_composition", "text"), ("defaults", "metadata_strategy", "prefer_other"),
    ("defaults", "ignore_content_service_errors", "false"),
    ("defaults", "ignore_content_parsing_errors", "false"),
    ("defaults", "ignore_metadata_service_errors", "false"),
    ("defaults", "ignore_metadata_parsing_errors", "false"),
    ("defaults", "cache_expire_success_before", "false"),
    ("defaults", "cache_expire_failure_before", "false"),
    ("defaults", "cache_file_backend", "main"),
    ("application/pdf", "handler_strategy", "wrapping"),
    ("application/pdf", "content_composition", "text_and_metadata"),
    ("application/pdf", "metadata_strategy", "combine"),
    ("application/pdf", "cache_expire_success_before", "2024-01-15T00:00:00.000+00:00"),
    ("application/pdf", "cache_file_backend", "pdf-store"),
    ("image/jpeg", "handler_strategy", "override"), ("image/jpeg", "allow_ocr", "true"),
    ("image/jpeg", "ocr_languages", "eng+fra"), ("image/jpeg", "content_strategy", "only_tika"),
    ("image/jpeg", "ignore_content_parsing_errors", "true"),
    ("partial", "handler_strategy", "override"),
]

# For the queries on failing extraction: all error flags, all compositions, contents shared across profiles.
FAILURE_LABELS = [("*", "block", None), ("application/pdf", "block", "*"), ("image/jpeg", "block", "*"),
                  ("application/msword", "block", "*"), ("application/x-blocked", "off", None), ("audio/mpeg", "ref", "*")]
FAILURE_PARAMS = [("*", p, v) for p, v in {**DEFAULTS, "metadata_strategy": "combine"}.items()] + [
    ("application/pdf", "handler_strategy", "wrapping"), ("application/pdf", "content_composition", "metadata"),
    ("application/pdf", "ignore_metadata_parsing_errors", "true"), ("application/pdf", "cache_file_backend", "pdf-store"),
    ("image/jpeg", "handler_strategy", "override"), ("image/jpeg", "ignore_content_service_errors", "true"),
    ("image/jpeg", "ignore_metadata_service_errors", "true"),
    ("application/msword", "ignore_content_parsing_errors", "true")]


def failure_config() -> ProfileConfig:
    return ProfileConfig(labels=list(FAILURE_LABELS), params=list(FAILURE_PARAMS))


def config() -> ProfileConfig:
    return ProfileConfig(labels=list(LABELS), params=list(PARAMS))


def values_sql(rows, cols) -> str:
    """The same rows as a SQL VALUES list (for the DuckDB oracle)."""
    def lit(v):
        return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"
    body = ",\n  ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES\n  {body}\n) AS t({', '.join(cols)})"
