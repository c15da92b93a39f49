"""Hash-chained audit logs: build, verify, fingerprint, compare, extract."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanweave.functions.canonical import GENESIS, sha256_hex, unwrap_record
from spanweave.operators.intervals import END, START
from spanweave.operators.scan import CHUNK, CHUNK_BITS
from spanweave.operators.timeline import SESSION

# The log's schema family and the operations of one complete session.
SCHEMA_SUFFIX = "-manifest-v1"
DEFAULT_SCHEMA = "session-manifest-v1"
REQUIRED_OPERATIONS = (
    "session_start", "environment", "model_checksums", "layer0_file", "layer0_vad",
    "layer0_summary", "layer1_click", "layer1_enrollment_windows", "layer1_seed",
    "layer2_window", "layer2_file_summary", "layer2_summary", "layer3_file_summary",
    "output_hash", "session_end",
)
SEGMENT_OPERATION = "layer3_segment"
# Why a record fails a check, in the order of the checks.
BAD_SCHEMA = "unexpected schema"
BAD_PAYLOAD = "payload hash mismatch"
BAD_PREVIOUS = "prev_sha256 mismatch"
BAD_ENTRY = "entry hash mismatch"
BAD_SEQ = "seq out of order"
NULL_TYPE_TEXT = "None"
_TAIL = "_tail"


def entry_sha256(prev: Column, payload_sha: Column, seq: Column, op: Column, audit: Column) -> Column:
    return sha256_hex(
        F.concat(
            prev,
            payload_sha,
            F.coalesce(seq.cast("string"), F.lit(NULL_TYPE_TEXT)),
            F.coalesce(op, F.lit("")),
            F.coalesce(audit, F.lit("{}")),
        )
    )


def ordered_fold(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    fold: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
    schema: T.StructType | str,
) -> DataFrame:
    """Run ``fold`` over rows arriving key by key in order, batch by batch.

    For steps that are sequential by definition (a hash over everything before it). Memory stays at
    one Arrow batch: rows stream from an external sort and the fold carries only its running state,
    so a key of any size passes, at the speed of one core.
    """
    return (
        df.repartition(key).sortWithinPartitions(key, *order).mapInPandas(fold, schema)
    )


def chain_tails(audit: DataFrame, session: str = "session_id") -> DataFrame:
    """``session, n_records, tail_sha256``: what a chain needs to be continued."""
    last = F.max_by("entry_sha256", "seq")
    return audit.groupBy(session).agg((F.max("seq") + 1).alias("n_records"), last.alias("tail_sha256"))


def chain_build(
    records: DataFrame, order: Sequence[str], session: str = "session_id", tails: DataFrame | None = None
) -> DataFrame:
    """Number and hash-chain each session's records in ``order``.

    With ``tails`` (of :func:`chain_tails`) the chains of sessions that have one go on there.

    ``records``: session, order columns, ``operation``, ``payload`` and ``audit`` (canonical text).
    Nulls come first; records of equal order follow each other by their content. A null payload is
    hashed as ``null``, a null operation or audit block as ``chain_breaks`` reads them. Payloads
    are hashed in parallel first and only pass through the serial fold.
    """
    order = list(order)
    body = ["operation", "payload", "audit"]
    hashed = records.select(
        session, *order, *body, sha256_hex(F.coalesce("payload", F.lit("null"))).alias("payload_sha256")
    )
    ties = [c for c in ("payload_sha256", "operation", "audit") if c not in order]
    links = T.StructType(
        [hashed.schema[session], T.StructField("seq", T.LongType())]
        + [hashed.schema[c] for c in body]
        + [T.StructField(c, T.StringType()) for c in ("prev_sha256", "payload_sha256", "entry_sha256")]
    )

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, seq, prev = object(), 0, GENESIS
        for batch in batches:
            column = lambda c: batch.column(c).to_pylist()  # noqa: E731, B023
            seqs, prevs, entries, stored = [], [], [], []
            for key, op, audit, payload_sha, at in zip(
                column(session), column("operation"), column("audit"), column("payload_sha256"), column(_TAIL)
            ):
                if key != current:
                    current, seq, prev = key, 0, GENESIS
                stored.append(at is not None)
                if stored[-1]:  # the tail comes before the records that follow it
                    seq, prev = at, payload_sha
                    continue
                text = f"{prev}{payload_sha}{seq}{op or ''}{'{}' if audit is None else audit}"
                entry = hashlib.sha256(text.encode("utf-8")).hexdigest()
                seqs.append(seq)
                prevs.append(prev)
                entries.append(entry)
                seq, prev = seq + 1, entry
            if any(stored):
                batch = batch.filter(pa.array([not x for x in stored], pa.bool_()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(session),
                    pa.array(seqs, pa.int64()),
                    *(batch.column(c) for c in body),
                    pa.array(prevs, pa.string()),
                    batch.column("payload_sha256"),
                    pa.array(entries, pa.string()),
                ],
                links.names,
            )

    hashed = hashed.withColumn(_TAIL, F.lit(None).cast("bigint"))
    if tails is not None:
        ends = tails.select(
            F.col(session).cast(hashed.schema[session].dataType).alias(session),
            F.col("tail_sha256").alias("payload_sha256"), F.col("n_records").alias(_TAIL),
        )
        hashed = hashed.unionByName(ends, allowMissingColumns=True)
    placed = hashed.repartition(session).sortWithinPartitions(
        session, F.col(_TAIL).isNull(), *order, *ties
    )
    return placed.mapInArrow(fold, links).withColumn(
        "schema", F.when(F.col("seq") == 0, F.lit(DEFAULT_SCHEMA))
    )


def chain_checks(
    audit: DataFrame,
    keys: Sequence[str] = SESSION,
    position: str = "seq",
    bits: int = CHUNK_BITS,
) -> DataFrame:
    """Every record with its 0-based index in the log, and why it fails a check or null.

    ``position`` is the record's place in the file (line number); it need only be ordered and
    unique. Each record is checked from its own columns and the stored hash of its predecessor,
    in parallel. Predecessor and index come from chunks of positions plus one summary row per
    chunk, so no session is confined to one task.
    """
    keys = list(keys)
    rows = audit.withColumn(
        CHUNK, F.shiftright(F.coalesce(F.col(position).cast("bigint"), F.lit(0).cast("bigint")), bits)
    )
    by_chunk = Window.partitionBy(*keys, CHUNK).orderBy(position)
    payload_sha = sha256_hex(F.coalesce("payload", F.lit("null")))
    local = rows.select(
        *keys,
        CHUNK,
        F.col("seq").alias("seq"),
        "operation",
        "audit",
        "schema",
        "prev_sha256",
        "entry_sha256",
        payload_sha.alias("_payload_sha"),
        payload_sha.eqNullSafe(F.col("payload_sha256")).alias("_payload_ok"),
        F.lag("entry_sha256").over(by_chunk).alias("_lag"),
        F.row_number().over(by_chunk).alias("_rn"),
    )
    summary = rows.groupBy(*keys, CHUNK).agg(
        F.count(F.lit(1)).alias("_n"), F.max_by("entry_sha256", position).alias("_tail")
    )
    by_key = Window.partitionBy(*keys).orderBy(CHUNK)
    carry = summary.select(
        *keys,
        CHUNK,
        F.coalesce(
            F.sum("_n").over(by_key.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_before"),
        F.lag("_tail").over(by_key).alias("_prev_tail"),
    )
    prev = F.when(F.col("_rn") > 1, F.col("_lag")).otherwise(
        F.when(F.col("_before") > 0, F.col("_prev_tail")).otherwise(F.lit(GENESIS))
    )
    index = F.col("_before") + F.col("_rn") - 1
    checked = (
        local.join(carry, [*keys, CHUNK]).withColumn("_prev", prev).withColumn("index", index)
    )
    entry = entry_sha256(
        F.col("_prev"), F.col("_payload_sha"), F.col("seq"), F.col("operation"), F.col("audit")
    )
    reason = (
        F.when(
            (F.col("index") == 0) & ~F.coalesce("schema", F.lit(SCHEMA_SUFFIX)).endswith(SCHEMA_SUFFIX),
            BAD_SCHEMA,
        )
        .when(~F.col("_payload_ok"), BAD_PAYLOAD)
        .when(~F.col("prev_sha256").eqNullSafe(F.col("_prev")), BAD_PREVIOUS)
        .when(~entry.eqNullSafe(F.col("entry_sha256")), BAD_ENTRY)
        .when(~F.col("seq").eqNullSafe(F.col("index")), BAD_SEQ)
    )
    return checked.select(*keys, "index", "seq", reason.alias("reason"))


def chain_breaks(
    audit: DataFrame,
    keys: Sequence[str] = SESSION,
    position: str = "seq",
    bits: int = CHUNK_BITS,
) -> DataFrame:
    """Every record that fails a check, with its 0-based index in the log and the reason."""
    return chain_checks(audit, keys, position, bits).where(F.col("reason").isNotNull())


def chain_verify(
    audit: DataFrame,
    keys: Sequence[str] = SESSION,
    position: str = "seq",
    bits: int = CHUNK_BITS,
) -> DataFrame:
    """One verdict per session: record count, ``valid``, and the first break if there is one."""
    keys = list(keys)
    broken = F.when(F.col("reason").isNotNull(), F.struct("index", "seq", "reason"))
    verdicts = chain_checks(audit, keys, position, bits).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_records"), F.min(broken).alias("_b")
    )
    return verdicts.select(
        *keys,
        "n_records",
        F.col("_b").isNull().alias("valid"),
        F.col("_b.index").alias("broken_index"),
        F.col("_b.seq").alias("broken_seq"),
        F.col("_b.reason").alias("reason"),
    )


def output_fingerprint(
    hashes: DataFrame, key: str = "session_id", sha: str = "sha256"
) -> DataFrame:
    """SHA-256 of the canonical JSON array of each session's sorted hashes, duplicates kept.

    The array is hashed as it streams out of an external sort; it is never assembled.
    """
    cols = hashes.select(key, F.col(sha).alias("_sha")).where(F.col("_sha").isNotNull())
    return ordered_digest(cols, key, ["_sha"], "_sha", quoted=True).select(
        key,
        F.col("n").alias("n_outputs"),
        F.col("digest").alias("output_fingerprint"),
    )


def ordered_digest(
    df: DataFrame, key: str, order: Sequence[str], element: str, quoted: bool = False
) -> DataFrame:
    """``(key, n, digest)``: SHA-256 of ``[e1,e2,...]`` over each key's elements in order."""
    schema = T.StructType(
        [df.schema[key], T.StructField("n", T.LongType()), T.StructField("digest", T.StringType())]
    )
    q = '"' if quoted else ""

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, n, state = None, 0, None
        for pdf in batches:
            done = []
            for value, group in pdf.groupby(key, sort=False):
                if state is None or value != current:
                    if state is not None:
                        state.update(b"]")
                        done.append((current, n, state.hexdigest()))
                    current, n, state = value, 0, hashlib.sha256(b"[")
                body = (q + "," + q).join(group[element])
                state.update(((("," if n else "") + q) + body + q).encode("utf-8"))
                n += len(group)
            yield pd.DataFrame(done, columns=[key, "n", "digest"])
        if state is not None:
            state.update(b"]")
            yield pd.DataFrame([(current, n, state.hexdigest())], columns=[key, "n", "digest"])

    unique = list(dict.fromkeys([*order, element]))
    return ordered_fold(df.select(key, *unique), key, order, fold, schema)


def log_completeness(
    audit: DataFrame,
    required: Sequence[str] = REQUIRED_OPERATIONS,
    keys: Sequence[str] = SESSION,
) -> DataFrame:
    """Required operations absent from each log, its last operation, and whether it is complete.

    Complete: nothing missing, ``session_end`` last, and its fingerprint equal to the
    ``output_hash`` record's. Presence is kept as one flag per required name, not as a set.
    """
    keys = list(keys)
    flags = [F.max(F.col("operation") == op).alias(f"_has{i}") for i, op in enumerate(required)]
    mark = lambda op: F.max(
        F.when(
            F.col("operation") == op, F.get_json_object("payload", "$.output_fingerprint")
        )
    )
    seen = audit.groupBy(*keys).agg(
        *flags,
        F.max_by("operation", "seq").alias("last_operation"),
        mark("output_hash").alias("_f0"),
        mark("session_end").alias("_f1"),
    )
    missing = F.filter(
        F.array(
            *[F.when(~F.col(f"_has{i}"), F.lit(op)) for i, op in enumerate(required)]
        ),
        lambda x: x.isNotNull(),
    )
    matches = F.coalesce(F.col("_f0") == F.col("_f1"), F.lit(False))
    return seen.select(
        *keys,
        F.array_join(missing, ",").alias("missing"),
        "last_operation",
        matches.alias("fingerprint_matches"),
        (
            (F.size(missing) == 0) & (F.col("last_operation") == "session_end") & matches
        ).alias("complete"),
    )


def diff_runs(a: DataFrame, b: DataFrame, keys: Sequence[str] = SESSION) -> DataFrame:
    """Positions at which two logs of the same input differ in content; custody may differ."""
    on = [*keys, "seq"]
    left = a.select(*on, F.col("payload_sha256").alias("a_payload_sha256"), F.lit(True).alias("_a"))
    right = b.select(*on, F.col("payload_sha256").alias("b_payload_sha256"), F.lit(True).alias("_b"))
    return (
        left.join(right, on, "full")
        .where(
            F.col("_a").isNull()
            | F.col("_b").isNull()
            | ~F.col("a_payload_sha256").eqNullSafe(F.col("b_payload_sha256"))
        )
        .select(*on, "a_payload_sha256", "b_payload_sha256")
    )


def extract_segments(audit: DataFrame, keys: Sequence[str] = SESSION) -> DataFrame:
    """Accepted segments recorded in a log, on the session clock.

    Records lacking a global bound, with non-numeric fields or of no length are skipped; the
    decision is reported but not filtered on.
    """
    body = unwrap_record(F.col("operation"), F.col("payload"))
    field = lambda name: F.get_json_object("_body", "$." + name)
    kind = lambda name: F.schema_of_variant(
        F.try_variant_get(F.try_parse_json("_body"), "$." + name, "variant")
    )
    whole = lambda name: python_int(field(name), kind(name) == "STRING")
    names = F.json_object_keys("_body")
    extra = [c for c in ("seq",) if c in audit.columns]
    has_duration = F.array_contains(names, "duration_ms")
    g0, g1 = whole("start_global_ms"), whole("end_global_ms")
    duration = F.when(has_duration, whole("duration_ms")).otherwise(g1 - g0)
    return (
        audit.where(F.col("operation") == SEGMENT_OPERATION)
        .select(*keys, *extra, body.alias("_body"))
        .select(
            *keys,
            *extra,
            g0.alias(START),
            g1.alias(END),
            duration.alias("duration_ms"),
            F.when(F.array_contains(names, "decision"), field("decision"))
            .otherwise(F.lit("CLEAN"))
            .alias("decision"),
        )
        .where((F.col(END) > F.col(START)) & F.col("duration_ms").isNotNull())
    )


def python_int(text: Column, quoted: Column) -> Column:
    """A JSON scalar as an integer the way ``int()`` reads it, else null.

    Numbers truncate, booleans are 1 and 0; a string must hold a whole number.
    """
    return (
        F.when(text.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(text).try_cast("bigint"))
        .when(F.coalesce(quoted, F.lit(False)), F.lit(None))
        .when(text.isin("true", "false"), (text == "true").cast("bigint"))
        .otherwise(text.try_cast("double").try_cast("bigint"))
    )
