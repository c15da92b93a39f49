"""Comparing two timelines of the same sessions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanweave.functions.timecode import pct
from spanweave.operators.intervals import (
    AT,
    END,
    START,
    UNTIL,
    coverage,
    covered_before,
    depth,
    merge_intervals,
    merged_edges,
    sweep,
)
from spanweave.operators.numbering import number_rows
from spanweave.operators.scan import CHUNK_BITS
from spanweave.operators.timeline import SESSION

# Lower bounds, in percent, of the two covered verdicts.
AGREE_PCT, PARTIAL_PCT = 80, 20


def agreement(
    a: DataFrame, b: DataFrame, keys: Sequence[str] = SESSION, bits: int = CHUNK_BITS
) -> DataFrame:
    """All headline metrics of two interval sets per key, from a single sweep."""
    in_a, in_b = depth("a") > 0, depth("b") > 0
    length = F.col(UNTIL) - F.col(AT)
    ms = lambda cond, name: F.coalesce(
        F.sum(F.when(cond, length)), F.lit(0).cast("bigint")
    ).alias(name)
    totals = (
        sweep({"a": a, "b": b}, keys, bits=bits)
        .where(in_a | in_b)
        .groupBy(*keys)
        .agg(
            ms(in_a, "a_ms"),
            ms(in_b, "b_ms"),
            ms(in_a & in_b, "intersection_ms"),
            ms(in_a | in_b, "union_ms"),
            ms(in_a & ~in_b, "a_only_ms"),
            ms(in_b & ~in_a, "b_only_ms"),
        )
    )
    return totals.select(
        "*",
        F.when(F.col("union_ms") != 0, F.col("intersection_ms") / F.col("union_ms"))
        .otherwise(F.lit(0.0))
        .alias("iou"),
        pct("intersection_ms", "a_ms").alias("a_covered_pct"),
        pct("intersection_ms", "b_ms").alias("b_covered_pct"),
    )


def iou(a: DataFrame, b: DataFrame, keys: Sequence[str] = SESSION) -> DataFrame:
    return agreement(a, b, keys).select(*keys, "iou")


def speaker_overlap(
    target: DataFrame, turns: DataFrame, keys: Sequence[str] = SESSION, bits: int = CHUNK_BITS
) -> DataFrame:
    """Milliseconds each speaker shares with the target; speakers sharing none are kept.

    The overlap is the target's prefix length taken at the speaker's ends minus its starts, so the
    target is never replicated per speaker.
    """
    keys = list(keys)
    by_speaker = [*keys, "speaker_id"]
    edges = merged_edges(turns.select(*by_speaker, START, END), by_speaker, bits)
    marks = edges.rows.select(*by_speaker, AT, (-F.col("d")).alias("w"))
    prefix = covered_before(target, marks.select(*keys, AT), keys, bits)
    return (
        marks.join(prefix, [*keys, AT])
        .groupBy(*keys, "speaker_id")
        .agg(F.sum(F.col("w") * F.col("covered_ms")).alias("overlap_ms"))
    )


def match_best_overlap(
    target: DataFrame, turns: DataFrame, keys: Sequence[str] = SESSION, bits: int = CHUNK_BITS
) -> DataFrame:
    """Per session, the speaker sharing most time with the target; ties go to the lowest id.

    A session whose speakers share nothing still gets its first speaker.
    """
    return best_speaker(speaker_overlap(target, turns, keys, bits), keys)


def best_speaker(overlap: DataFrame, keys: Sequence[str] = SESSION) -> DataFrame:
    rank = F.struct(-F.col("overlap_ms"), F.col("speaker_id"))
    return overlap.groupBy(*keys).agg(
        F.min_by("speaker_id", rank).alias("speaker_id"), F.max("overlap_ms").alias("overlap_ms")
    )


def speaker_inventory(
    turns: DataFrame, matched: DataFrame, keys: Sequence[str] = SESSION, bits: int = CHUNK_BITS
) -> DataFrame:
    """Per speaker: union length, merged turn count and whether it is the matched one."""
    keys = list(keys)
    best = matched.select(*keys, F.col("speaker_id").alias("_best"))
    return (
        merge_intervals(turns.select(*keys, "speaker_id", START, END), [*keys, "speaker_id"], bits)
        .groupBy(*keys, "speaker_id")
        .agg(
            F.sum(F.col(END) - F.col(START)).alias("speech_ms"),
            F.count(F.lit(1)).alias("n_turns"),
        )
        .join(best, keys, "left")
        .select(
            *keys,
            "speaker_id",
            "speech_ms",
            "n_turns",
            F.coalesce(F.col("speaker_id") == F.col("_best"), F.lit(False)).alias("matched"),
        )
    )


def segment_agreement(
    segments: DataFrame,
    cover: DataFrame,
    keys: Sequence[str] = SESSION,
    bits: int = CHUNK_BITS,
    ordinals: bool = False,
    order: Sequence[str] = (START, END),
) -> DataFrame:
    """Per recorded segment: covered ms, share of its *recorded* duration, verdict.

    The share may exceed 100 because the recorded duration is not recomputed. ``ordinals`` adds
    the 1-based row number in ``order`` (an eager step, see ``number_rows``).
    """
    share = pct("covered_ms", "duration_ms")
    verdicts = coverage(segments, cover, keys, bits).select(
        "*",
        share.alias("covered_pct"),
        F.when(share >= AGREE_PCT, "AGREE")
        .when(share >= PARTIAL_PCT, "PARTIAL")
        .otherwise("MISS")
        .alias("verdict"),
    )
    return number_rows(verdicts, keys, order, "ordinal") if ordinals else verdicts
