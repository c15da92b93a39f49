"""The library's input tables as views over the driver tables (whole tables, no sampling)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanweave.functions.canonical import canonical_object, json_string
from spanweave.functions.timecode import int_div, utc_stamp


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_micros() -> Column:
    return F.unix_micros(F.col("ts").cast("timestamp"))


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as intervals: the value is a length in minutes."""
    start = int_div(event_micros(), F.lit(1000))
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("session_id"),
        F.col("event_type").alias("speaker_id"),
        start.alias("start_ms"),
        (start + F.floor(F.col("value") * 60000)).alias("end_ms"),
    )


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as clips, 10 ms per character."""
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("session_id"),
        F.col("turn").cast("int").alias("file_index"),
        F.col("role").alias("source"),
        (F.length("text") * 10).cast("bigint").alias("duration_ms"),
    )


FRAMES_PER_DAY = 96
FRAME_MS = 15 * 60 * 1000
DAY_MS = 86_400_000


def masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One window per user and day, a speaker per event type, a frame per quarter of an hour."""
    ms = int_div(event_micros(), F.lit(1000))
    day, frame = int_div(ms, F.lit(DAY_MS)), int_div(F.pmod(ms, F.lit(DAY_MS)), F.lit(FRAME_MS))
    events = table(spark, sf_dir, "events").select(
        "user_id", day.alias("day"), "event_type", frame.cast("int").alias("frame")
    )
    cells = events.groupBy("user_id", "day", "event_type").agg(F.collect_set("frame").alias("_on"))
    # At most one entry per event type and window; speakers are numbered by type within a window.
    windows = cells.groupBy("user_id", "day").agg(
        F.array_sort(F.collect_list(F.struct("event_type", "_on"))).alias("_s")
    )
    activity = F.transform(
        F.sequence(F.lit(0), F.lit(FRAMES_PER_DAY - 1)),
        lambda f: F.array_contains("_e._on", f).cast("tinyint"),
    )
    return windows.select("user_id", "day", F.posexplode("_s").alias("speaker_idx", "_e")).select(
        F.col("user_id").alias("session_id"),
        F.lit(0).alias("file_index"),
        (F.col("day") * DAY_MS).alias("window_start_ms"),
        ((F.col("day") + 1) * DAY_MS).alias("window_end_ms"),
        "speaker_idx",
        F.lit(FRAME_MS).alias("frame_ms"),
        activity.alias("activity"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings in sessions by label and windows of ten."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("label").alias("session_id"),
        int_div(F.col("vec_id"), F.lit(10)).alias("window_start_ms"),
        F.pmod("vec_id", F.lit(10)).cast("int").alias("speaker_idx"),
        "vec_id",
        F.col("embedding").cast("array<double>").alias("embedding"),
    )


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as face boxes; the order is the frame."""
    part = F.col("l_partkey") % 400
    return table(spark, sf_dir, "lineitem").select(
        F.lit(0).alias("session_id"),
        F.lit(0).alias("file_index"),
        F.col("l_orderkey").alias("pts_ms"),
        part.cast("int").alias("x1"),
        (F.col("l_suppkey") * 3).cast("int").alias("y1"),
        (part + F.col("l_quantity") * 8).cast("int").alias("x2"),
        (F.col("l_suppkey") * 3 + F.col("l_quantity") * 6).cast("int").alias("y2"),
        F.col("l_discount").alias("score"),
    )


def other_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second detector: the same boxes, moved by line number and stretched."""
    shift = F.col("l_linenumber") * 4
    part = F.col("l_partkey") % 400
    return table(spark, sf_dir, "lineitem").select(
        F.lit(0).alias("session_id"),
        F.lit(0).alias("file_index"),
        F.col("l_orderkey").alias("pts_ms"),
        (part + shift).cast("int").alias("x1"),
        (F.col("l_suppkey") * 3 + shift).cast("int").alias("y1"),
        (part + shift + F.col("l_quantity") * 7).cast("int").alias("x2"),
        (F.col("l_suppkey") * 3 + shift + F.col("l_quantity") * 7).cast("int").alias("y2"),
        F.col("l_tax").alias("score"),
    )


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.lit(0).alias("session_id"),
        F.lit(0).alias("file_index"),
        F.col("o_orderkey").alias("pts_ms"),
        F.lit("speaking").alias("kind"),
        (F.col("o_custkey") % 600).cast("int").alias("x"),
        (F.col("o_orderkey") * 7 % 450).cast("int").alias("y"),
    )


def faces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as embedded faces on a quarter-second grid, one session per supplier."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("session_id"),
        F.lit(0).alias("file_index"),
        (F.col("l_orderkey") % 2000 * 250 + 125).alias("pts_ms"),
        F.array(
            F.col("l_quantity"), F.col("l_discount") * 100, F.col("l_tax") * 100
        ).alias("embedding"),
    )


def face_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per supplier a target and, for odd ones, an anti vector."""
    key = F.col("s_suppkey").alias("session_id")
    odd = F.col("s_suppkey") % 2 == 1
    anti = F.array(F.lit(1.0), F.lit(10.0), F.lit(10.0))
    return table(spark, sf_dir, "supplier").select(
        key,
        F.array(F.lit(30.0), (F.col("s_nationkey") % 11).cast("double"), F.lit(4.0)).alias("target"),
        F.when(odd, anti).alias("anti"),
    )


def speech(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speech intervals of one to three samples, one session per supplier."""
    start = F.col("l_partkey") % 1990 * 250
    return (
        table(spark, sf_dir, "lineitem")
        .select(
            F.col("l_suppkey").alias("session_id"),
            F.lit(0).alias("file_index"),
            start.alias("start_ms"),
            (start + (F.col("l_linenumber") % 3 + 1) * 250).alias("end_ms"),
        )
        .distinct()
    )


def audit_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as audit records, one log per user; ordered by (ts_us, event_id)."""
    stamp = utc_stamp(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("session_id"),
        event_micros().alias("ts_us"),
        "event_id",
        F.col("event_type").alias("operation"),
        F.replace("props", F.lit(": "), F.lit(":")).alias("payload"),
        canonical_object({"timestamp_utc": json_string(stamp)}).alias("audit"),
    )


AUDIT_ORDER = ("ts_us", "event_id")

PCM_RATE = 8000


def pcm_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as mono PCM clips: the UTF-8 bytes of the text, an odd last byte dropped."""
    raw = F.encode("text", "UTF-8")
    even = int_div(F.octet_length(raw), F.lit(2)).cast("int") * 2
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("session_id"),
        F.col("doc_id").cast("int").alias("file_index"),
        F.lit(PCM_RATE).alias("sample_rate"),
        F.lit(1).alias("channels"),
        F.substring(raw, F.lit(1), even).alias("pcm"),
    )


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as ``(path, content)`` files."""
    return table(spark, sf_dir, "documents").select(
        F.format_string("%s/%d.txt", "lang", "doc_id").alias("path"),
        F.encode("text", "UTF-8").alias("content"),
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry of all documents: some hashes wrong or blank, some paths leading nowhere."""
    folder = F.when(F.col("doc_id") % 70 == 69, F.lit("gone")).otherwise(F.col("lang"))
    sha = F.sha2(F.encode("text", "UTF-8"), 256)
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc"), F.col("doc_id")).alias("name"),
        F.format_string("%s/%d.txt", folder, "doc_id").alias("path"),
        F.when(F.col("doc_id") % 50 == 49, F.sha2(sha.cast("binary"), 256))
        .when(F.col("doc_id") % 90 == 89, F.lit(""))
        .otherwise(sha)
        .alias("sha256"),
    )
