"""Chain verification as a stream: one row per violation, as records arrive."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from spanweave.functions.canonical import GENESIS, sha256_hex
from spanweave.operators.audit import (
    BAD_ENTRY,
    BAD_PAYLOAD,
    BAD_PREVIOUS,
    BAD_SCHEMA,
    BAD_SEQ,
    SCHEMA_SUFFIX,
    entry_sha256,
)
from spanweave.sources.logs import parse_records, session_of_file

AUDIT_SCHEMA = (
    "session_id string, seq bigint, operation string, payload string, audit string, "
    "prev_sha256 string, payload_sha256 string, entry_sha256 string, schema string"
)
_OUT = "session_id {key}, index bigint, seq bigint, reason string"
_STATE = "index bigint, prev_sha256 string"
# Files of a micro-batch: what a session's step holds is a part of these.
MAX_FILES = 64


def read_audit_stream(
    spark: SparkSession, path: str, schema: str = AUDIT_SCHEMA, max_files: int | None = MAX_FILES
) -> DataFrame:
    """Audit rows appended as Parquet under ``path``."""
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def read_log_stream(spark: SparkSession, path: str, max_files: int | None = MAX_FILES) -> DataFrame:
    """Audit rows from JSON-lines logs growing under ``path``, by new part files per session."""
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.load(path).select(
        session_of_file(F.col("_metadata.file_path")).alias("session_id"),
        F.lit(0).cast("bigint").alias("position"),
        F.col("value").alias("line"),
    )
    # Unreadable lines surface as a broken chain.
    return parse_records(lines).drop("position", "error")


def _advance(
    key: tuple, batches: Iterator[pd.DataFrame], state: GroupState
) -> Iterator[pd.DataFrame]:
    index, prev = state.get if state.exists else (0, GENESIS)
    rows = pd.concat(list(batches)).sort_values("seq", kind="stable")
    found = []
    rows["seq"] = rows["seq"].fillna(-1)
    columns = ("seq", "prev_sha256", "entry_sha256", "schema_ok", "payload_ok", "entry_ok")
    for seq, stored_prev, entry, schema_ok, payload_ok, entry_ok in zip(*[rows[c] for c in columns]):
        if index == 0 and not schema_ok:
            reason = BAD_SCHEMA
        elif not payload_ok:
            reason = BAD_PAYLOAD
        elif stored_prev != prev:
            reason = BAD_PREVIOUS
        elif not entry_ok:
            reason = BAD_ENTRY
        elif seq != index:
            reason = BAD_SEQ
        else:
            reason = None
        if reason:
            found.append((key[0], index, int(seq), reason))
        index, prev = index + 1, entry
    state.update((index, prev))
    yield pd.DataFrame(found, columns=["session_id", "index", "seq", "reason"])


def checked_records(stream: DataFrame, *more: Column | str) -> DataFrame:
    """``seq``, the two stored hashes of the chain and whether schema, payload and entry are right."""
    payload_sha = sha256_hex(F.coalesce("payload", F.lit("null")))
    return stream.select(
        "session_id",
        "seq",
        "prev_sha256",
        "entry_sha256",
        F.coalesce("schema", F.lit(SCHEMA_SUFFIX)).endswith(SCHEMA_SUFFIX).alias("schema_ok"),
        payload_sha.eqNullSafe(F.col("payload_sha256")).alias("payload_ok"),
        entry_sha256(
            F.col("prev_sha256"), payload_sha, F.col("seq"), F.col("operation"), F.col("audit")
        )
        .eqNullSafe(F.col("entry_sha256"))
        .alias("entry_ok"),
        *more,
    )


def verify_audit_stream(stream: DataFrame) -> DataFrame:
    """Violations of each session's chain, with the index and reason ``chain_breaks`` would give.

    Both hashes are recomputed on the JVM before the stateful step, which then sees seven short
    columns per record and keeps only (records seen, last hash) per session. Records of one
    micro-batch are put in ``seq`` order; a gap or a late record is a violation and is not waited
    for, so the trigger's size bounds what a session's step holds.
    """
    checked = checked_records(stream)
    key_type = stream.schema["session_id"].dataType.simpleString()
    return checked.groupBy("session_id").applyInPandasWithState(
        _advance, _OUT.format(key=key_type), _STATE, "append", GroupStateTimeout.NoTimeout
    )
