"""Canonical JSON text: sorted keys, compact separators, UTF-8 kept.

Hashes cover the exact bytes of this text, and Spark's own writer differs from it in control
characters, null handling and floats. Payloads authored here are therefore concatenated from
already-encoded values; foreign documents are canonicalised once at ingest.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

GENESIS = "0" * 64

# The wrapper keys of a per-file record.
WRAPPER_KEYS = ("file_index", "operation", "payload", "start_ms")

_SHORT_ESCAPES = {8: "\\b", 9: "\\t", 10: "\\n", 12: "\\f", 13: "\\r"}


def canonical_text(obj) -> str:
    """The canonical encoding of one Python value (driver-side constants, ingest batches)."""
    return json.dumps(obj, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def sha256_hex(value: Column) -> Column:
    return F.sha2(value, 256)


def json_string(value: Column) -> Column:
    """A JSON string literal, byte-equal to Python's ``json.dumps(..., ensure_ascii=False)``."""
    text = F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    escaped = text
    for code in range(32):
        escaped = F.replace(
            escaped, F.lit(chr(code)), F.lit(_SHORT_ESCAPES.get(code, f"\\u{code:04x}"))
        )
    body = F.when(value.rlike("[\\x00-\\x1f]"), escaped).otherwise(text)
    return F.when(value.isNull(), F.lit("null")).otherwise(
        F.concat(F.lit('"'), body, F.lit('"'))
    )


def json_value(value: Column) -> Column:
    """Integers, booleans and nulls as JSON; anything else must be encoded by its own helper."""
    return F.coalesce(value.cast("string"), F.lit("null"))


@F.pandas_udf(T.StringType())
def json_number(value: pd.Series) -> pd.Series:
    """Shortest round-trip float text; the JVM prints doubles differently."""
    return value.map(lambda x: "null" if x is None or x != x else json.dumps(float(x)))


def pairs_json(pairs: Column) -> Column:
    """``[[a,b],...]`` from an array of ``(start_ms, end_ms)`` structs."""
    return F.to_json(F.transform(pairs, lambda p: F.array(p["start_ms"], p["end_ms"])))


def canonical_object(fields: Mapping[str, Column]) -> Column:
    """One canonical object from already-encoded values, keys sorted."""
    parts: list[Column] = []
    for i, key in enumerate(sorted(fields)):
        parts.append(F.lit(("{" if i == 0 else ",") + json.dumps(key) + ":"))
        parts.append(fields[key])
    parts.append(F.lit("}" if fields else "{}"))
    return F.concat(*parts)


def wrap_record(file_index: Column, start_ms: Column, operation: Column, payload: Column) -> Column:
    """The nested form of a record that belongs to one file."""
    return canonical_object(
        {
            "file_index": json_value(file_index),
            "start_ms": json_value(start_ms),
            "operation": json_string(operation),
            "payload": payload,
        }
    )


def unwrap_record(operation: Column, payload: Column) -> Column:
    """Inner payload of a per-file record, else the payload itself (``{}`` if not an object).

    Unwraps only when the keys are exactly the wrapper's, the inner operation repeats the outer
    one and the inner payload is an object.
    """
    inner = F.get_json_object(payload, "$.payload")
    keys = F.json_object_keys(payload)
    wrapped = (
        (F.array_sort(keys) == F.array(*[F.lit(k) for k in WRAPPER_KEYS]))
        & F.get_json_object(payload, "$.operation").eqNullSafe(operation)
        & inner.startswith("{")
        & payload.rlike(r'"payload":\s*\{')
    )
    return (
        F.when(wrapped, inner)
        .when(F.ltrim(payload).startswith("{"), payload)
        .otherwise(F.lit("{}"))
    )
