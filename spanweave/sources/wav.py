"""WAV files."""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanweave.functions.timecode import samples_to_ms

TARGET_RATE = 16000

_PARSED = (
    "path string, sample_rate int, channels int, sample_width int, n_frames bigint, "
    "sha256 string, pcm binary"
)


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for path, content, sha in zip(pdf["path"], pdf["content"], pdf["sha256"]):
            try:
                with wave.open(io.BytesIO(bytes(content))) as w:
                    head = (w.getframerate(), w.getnchannels(), w.getsampwidth(), w.getnframes())
                    rows.append((path, *head, sha, w.readframes(head[3])))
            except (wave.Error, EOFError):
                rows.append((path, None, None, None, None, sha, None))
        yield pd.DataFrame(
            rows,
            columns=[
                "path", "sample_rate", "channels", "sample_width", "n_frames", "sha256", "pcm",
            ],
        )


def parse_wavs(files: DataFrame) -> DataFrame:
    """Header, duration, hash and PCM of ``(path, content)`` rows; unreadable files get nulls."""
    hashed = files.select("path", "content", F.sha2("content", 256).alias("sha256"))
    return hashed.mapInPandas(_parse, _PARSED).withColumn("duration_ms", duration_ms())


def duration_ms() -> Column:
    """Null without a rate: a duration of an unreadable file would be an error before it is named."""
    return F.when(F.col("sample_rate") > 0, samples_to_ms("n_frames", "sample_rate"))


def split_wavs(parsed: DataFrame, rate: int = TARGET_RATE) -> tuple[DataFrame, DataFrame]:
    """``(clips, errors)``: 16-bit mono at ``rate``, and everything else with a reason."""
    reason = (
        F.when(F.col("sample_rate").isNull(), "unreadable wav")
        .when(F.col("sample_width") != 2, "not 16-bit")
        .when((F.col("sample_rate") != rate) | (F.col("channels") != 1), f"not {rate} Hz mono")
    )
    judged = parsed.withColumn("reason", reason)
    clips = judged.where(F.col("reason").isNull()).drop("reason", "sample_width")
    return clips, judged.where(F.col("reason").isNotNull()).select("path", "reason")


def read_clips(
    spark: SparkSession, path: str, rate: int = TARGET_RATE, strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Read a folder of WAV files as ``(clips, errors)``; ``strict`` raises on the first error."""
    parsed = parse_wavs(
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.wav")
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    clips, errors = split_wavs(parsed, rate)
    if strict:
        ok = (
            (F.col("sample_rate") == rate) & (F.col("channels") == 1) & (F.col("sample_width") == 2)
        )
        bad = F.raise_error(F.concat(F.col("path"), F.lit(f": not a 16-bit {rate} Hz mono wav")))
        clips = parsed.withColumn(
            "path", F.when(F.coalesce(ok, F.lit(False)), F.col("path")).otherwise(bad)
        ).drop("sample_width")
    return clips, errors


def write_clips(cut: DataFrame, path: str) -> None:
    """Store cut clips (``name``, ``wav``, ``sha256``) as Parquet, one folder per session."""
    cut.write.mode("errorifexists").partitionBy("session_id").parquet(path)
