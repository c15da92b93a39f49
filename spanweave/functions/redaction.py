"""Removing a project token from log text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Schema family pattern and the shortest token that may be detected automatically.
SCHEMA_PATTERN = r"^(.+)-manifest-v\d+$"
MIN_AUTO_TOKEN = 4


def detect_token(schema: Column) -> Column:
    """Name part of ``<name>-manifest-vN``; null when the schema does not follow that form."""
    name = F.trim(F.regexp_extract(schema, SCHEMA_PATTERN, 1))
    return F.when(F.length(name) > 0, name)


def _literal_pattern(token: Column) -> Column:
    quoted = F.regexp_replace(token, r"([^\p{L}\p{N}_])", r"\\$1")
    return F.concat(F.lit("(?iu)"), quoted)


def redact(text: Column, token: Column, replacement: str | Column = "redacted") -> Column:
    """Replace every case-insensitive literal occurrence of ``token``; the token may be a column."""
    if not isinstance(replacement, Column):
        replacement = F.lit(replacement)
    safe = F.regexp_replace(replacement, r"([\\$])", r"\\$1")
    return F.when(
        F.length(token) > 0, F.regexp_replace(text, _literal_pattern(token), safe)
    ).otherwise(text)


def redact_count(text: Column, token: Column) -> Column:
    return F.when(
        F.length(token) > 0, F.regexp_count(text, _literal_pattern(token))
    ).otherwise(F.lit(0)).cast("bigint")
