"""PCM slices, WAV encoding and the batch-model seam."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.resource import ResourceProfile
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanweave.functions.timecode import ms_to_samples
from spanweave.operators.timeline import FILE

# Fixed values.
SAMPLE_WIDTH = 2
MIN_SAMPLES = 640
PCM_SCALE = 32768.0


def _little_endian(value: Column, n_bytes: int) -> Column:
    digits = F.lpad(F.hex(value.cast("bigint")), 2 * n_bytes, "0")
    return F.unhex(
        F.concat(*[F.substring(digits, 2 * i + 1, 2) for i in range(n_bytes - 1, -1, -1)])
    )


def wav_bytes(pcm: Column, sample_rate: Column, channels: Column) -> Column:
    """16-bit PCM wrapped in the 44-byte RIFF header."""
    size = F.octet_length(pcm).cast("bigint")
    frame = channels.cast("bigint") * SAMPLE_WIDTH
    raw = lambda text: F.lit(text.encode("ascii"))
    return F.concat(
        raw("RIFF"),
        _little_endian(size + 36, 4),
        raw("WAVEfmt "),
        _little_endian(F.lit(16), 4),
        _little_endian(F.lit(1), 2),
        _little_endian(channels, 2),
        _little_endian(sample_rate, 4),
        _little_endian(sample_rate.cast("bigint") * frame, 4),
        _little_endian(frame, 2),
        _little_endian(F.lit(8 * SAMPLE_WIDTH), 2),
        raw("data"),
        _little_endian(size, 4),
        pcm,
    )


def pcm_slice(pcm: Column, start_ms: Column, end_ms: Column, rate: Column, channels: Column) -> Column:
    """Byte-exact ``[start_ms, end_ms)`` on the sample grid; never reads past the buffer."""
    width = channels.cast("bigint") * SAMPLE_WIDTH
    first = ms_to_samples(start_ms, rate)
    count = F.greatest(F.lit(0).cast("bigint"), ms_to_samples(end_ms, rate) - first)
    return F.substring(pcm, (first * width + 1).cast("int"), (count * width).cast("int"))


def clip_name(file_index: Column, start_global: Column, end_global: Column) -> Column:
    return F.format_string("target_f%03d_%09d-%09d.wav", file_index, start_global, end_global)


def cut_clips(segments: DataFrame, clips: DataFrame, keys: Sequence[str] = FILE) -> DataFrame:
    """Cut ``segments`` (local and global bounds) out of ``clips`` (with ``pcm``) as WAV files.

    Adds ``name``, ``wav`` (BINARY) and ``sha256`` of the file bytes.
    """
    source = clips.select(*keys, "pcm", "sample_rate", "channels")
    wav = wav_bytes(
        pcm_slice(
            F.col("pcm"),
            F.col("start_local_ms"),
            F.col("end_local_ms"),
            F.col("sample_rate"),
            F.col("channels"),
        ),
        F.col("sample_rate"),
        F.col("channels"),
    )
    return (
        segments.join(source.hint("merge"), list(keys))
        .select(
            *segments.columns,
            clip_name(
                F.col("file_index"), F.col("start_global_ms"), F.col("end_global_ms")
            ).alias("name"),
            wav.alias("wav"),
        )
        .withColumn("sha256", F.sha2("wav", 256))
    )


def map_model(
    df: DataFrame,
    factory: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]],
    schema: T.StructType | str,
) -> DataFrame:
    """Apply a user's batch function to rows; the model is built once per Python task.

    The function maps a batch to a frame of the same length and order. Filter before this step:
    predicates are not pushed through it.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()
        for pdf in batches:
            if len(pdf) == 0:
                continue
            out = model(pdf)
            if len(out) != len(pdf):
                raise ValueError(f"model returned {len(out)} rows for a batch of {len(pdf)}")
            yield out

    return df.mapInPandas(run, schema)


def length_batches(sizes: Sequence[int], max_bytes: int) -> list[np.ndarray]:
    """Positions dealt into batches of similar size, shortest first.

    A padded batch costs its rows times its largest row, which stays within ``max_bytes``; a larger row
    is a batch of its own. Rows of equal size keep their order.
    """
    sizes = np.asarray(sizes, np.int64)
    order = np.argsort(sizes, kind="stable")
    batches, first = [], 0
    for at in range(1, len(order) + 1):
        if at == len(order) or (at + 1 - first) * int(sizes[order[at]]) > max_bytes:
            batches.append(order[first:at])
            first = at
    return batches


def map_model_batched(
    df: DataFrame,
    factory: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]],
    schema: T.StructType | str,
    size: str,
    max_bytes: int = 16 << 20,
    window_bytes: int = 64 << 20,
    profile: ResourceProfile | None = None,
) -> DataFrame:
    """:func:`map_model` in batches of rows of similar length; the output is in the order of the input.

    ``size`` names a column with the bytes of a row (null counts as 0). A task holds the rows of about
    ``window_bytes``, deals them by :func:`length_batches` and restores their order, so that a long row pads
    few others and a batch needs no more memory than ``max_bytes``, or its one row. A function that treats
    rows one by one gives the same result in any batches. Size both to the executor; rows arrive in Arrow
    batches of ``spark.sql.execution.arrow.maxRecordsPerBatch``, which should be short for wide rows.

    ``profile`` asks for executors with given resources for this stage alone, such as one accelerator a
    task; cluster managers need dynamic allocation for it.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()

        def flush(held: list[pd.DataFrame]) -> pd.DataFrame:
            rows = pd.concat(held, ignore_index=True)
            parts, places = [], length_batches(rows[size].fillna(0), max_bytes)
            for place in places:
                out = model(rows.iloc[place].reset_index(drop=True))
                if len(out) != len(place):
                    raise ValueError(f"model returned {len(out)} rows for a batch of {len(place)}")
                parts.append(out)
            back = np.argsort(np.concatenate(places), kind="stable")
            return pd.concat(parts, ignore_index=True).iloc[back].reset_index(drop=True)

        held, total = [], 0
        for pdf in batches:
            ends = pdf[size].fillna(0).astype("int64").cumsum().to_numpy()
            first = 0
            while first < len(pdf):
                # Rows until the window is full, one at least.
                base = ends[first - 1] if first else 0
                last = int(np.searchsorted(ends, base + window_bytes - total, side="right"))
                if last <= first:
                    last = first if held else first + 1
                if last > first:
                    held.append(pdf.iloc[first:last])
                    total += int(ends[last - 1] - base)
                first = last
                if first < len(pdf) or total >= window_bytes:
                    yield flush(held)
                    held, total = [], 0
        if held:
            yield flush(held)

    return df.mapInPandas(run, schema, profile=profile)


def cut_slices(intervals: DataFrame, clips: DataFrame, keys: Sequence[str] = FILE) -> DataFrame:
    """Attach each interval's raw PCM (``slice``) and its ``valid_samples``."""
    source = clips.select(*keys, "pcm", "sample_rate", "channels")
    piece = pcm_slice(
        F.col("pcm"), F.col("start_ms"), F.col("end_ms"), F.col("sample_rate"), F.col("channels")
    )
    return (
        intervals.join(source, list(keys))
        .select(*intervals.columns, piece.alias("slice"))
        .withColumn("valid_samples", (F.octet_length("slice") / SAMPLE_WIDTH).cast("bigint"))
    )


def pad_batch(slices: Sequence[bytes], min_samples: int = MIN_SAMPLES) -> tuple[np.ndarray, np.ndarray]:
    """``(batch, valid)``: float32 rows in [-1, 1), right-padded to the longest or the minimum.

    For use inside a :func:`map_model` function.
    """
    rows = [np.frombuffer(bytes(s), "<i2") for s in slices]
    valid = np.array([len(r) for r in rows], dtype=np.int64)
    if not rows:
        return np.empty((0, 0), np.float32), valid
    batch = np.zeros((len(rows), max(int(min_samples), int(valid.max()))), np.float32)
    for i, r in enumerate(rows):
        batch[i, : len(r)] = r / np.float32(PCM_SCALE)
    return batch, valid
