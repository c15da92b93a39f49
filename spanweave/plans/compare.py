"""Comparing audit logs with turns of another system, and redacting logs."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanweave.functions.redaction import MIN_AUTO_TOKEN, detect_token, redact, redact_count
from spanweave.operators import agreement as ag
from spanweave.operators import audit as au
from spanweave.operators import timeline as tl
from spanweave.operators.lineage import materialize
from spanweave.sources.logs import has_text, read_lines

SESSION = list(tl.SESSION)


@dataclass(frozen=True)
class Comparison:
    segments: DataFrame  # recorded segments with covered ms, share and verdict
    matched: DataFrame  # best speaker per session
    inventory: DataFrame
    agreement: DataFrame
    lanes: DataFrame  # columns of the target, of the matched speaker and of every other speaker
    diff: DataFrame  # both / a / b / neither per column


def compare(
    audit: DataFrame,
    turns: DataFrame,
    width: int = 100,
    ordinals: bool = False,
    keep: Callable[[DataFrame], DataFrame] = materialize,
) -> Comparison:
    """Line up each session's recorded segments with the best matching speaker's turns.

    ``keep`` is applied to the three tables that all others read: the segments, the match and the
    lanes.
    """
    width = max(1, int(width))
    segments = keep(au.extract_segments(audit))
    target = segments.select(*SESSION, "start_ms", "end_ms")
    spoken = turns.select(*SESSION, "speaker_id", "start_ms", "end_ms")
    matched = keep(ag.match_best_overlap(target, spoken))
    best = spoken.join(matched.select(*SESSION, "speaker_id"), [*SESSION, "speaker_id"], "left_semi")
    best = best.select(*SESSION, "start_ms", "end_ms")

    bounds = tl.session_bounds([target, spoken])
    lane = lambda df, name: df.select(*SESSION, name.alias("lane"), "start_ms", "end_ms")
    rows = (
        lane(target, F.lit("target"))
        .unionByName(lane(best, F.lit("matched")))
        .unionByName(lane(spoken, F.concat(F.lit("speaker:"), F.col("speaker_id"))))
    )
    lanes = keep(tl.bucket_lanes(rows, bounds, width))
    return Comparison(
        ag.segment_agreement(segments, best, ordinals=ordinals, order=("start_ms", "end_ms", "seq")),
        matched,
        ag.speaker_inventory(spoken, matched),
        ag.agreement(target, best),
        lanes,
        tl.bucket_diff(lanes, "target", "matched"),
    )


def sanitize(
    lines: DataFrame, replacement: str = "redacted", forced_token: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(clean, failures)`` from log lines ``(session_id, position, line)``.

    The token comes from the schema of each log's first non-blank line unless forced. A log without
    a token, or with a detected one too short to be replaced safely, is left out and reported.
    """
    first = (
        lines.where(has_text(F.col("line")))
        .groupBy(*SESSION)
        .agg(F.min_by("line", "position").alias("_first"))
    )
    if forced_token:
        tokens = lines.select(*SESSION).distinct().select(
            *SESSION, F.lit(forced_token).alias("token"), F.lit(None).cast("string").alias("reason")
        )
    else:
        found = detect_token(F.get_json_object("_first", "$.schema"))
        all_logs = lines.select(*SESSION).distinct().join(first, SESSION, "left")
        tokens = all_logs.select(*SESSION, found.alias("token")).select(
            *SESSION,
            "token",
            F.when(F.col("token").isNull(), "no name token in the schema")
            .when(F.length("token") < MIN_AUTO_TOKEN, "detected token is too short")
            .alias("reason"),
        )
    usable = tokens.where(F.col("reason").isNull()).select(*SESSION, "token")
    clean = lines.join(usable, SESSION).select(
        *SESSION,
        "position",
        redact(F.col("line"), F.col("token"), replacement).alias("line"),
        redact_count(F.col("line"), F.col("token")).alias("n_redacted"),
    )
    return clean, tokens.where(F.col("reason").isNotNull()).select(*SESSION, "reason")


def sanitize_logs(
    spark: SparkSession,
    in_path: str,
    out_path: str,
    replacement: str = "redacted",
    forced_token: str | None = None,
) -> DataFrame:
    """Redact every log under ``in_path`` into ``out_path``; returns failures.

    Writing over the source is refused. Parts are range-partitioned by line, as in ``write_audit``.
    """
    if PurePosixPath(in_path) == PurePosixPath(out_path):
        raise ValueError("refusing to overwrite the source logs")
    clean, failures = sanitize(read_lines(spark, in_path), replacement, forced_token)
    (
        clean.repartitionByRange(*SESSION, "position")
        .sortWithinPartitions(*SESSION, "position")
        .select(*SESSION, "line")
        .write.mode("errorifexists")
        .partitionBy(*SESSION)
        .text(out_path)
    )
    return failures
