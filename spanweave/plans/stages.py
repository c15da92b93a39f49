"""The four stages of a session run, each over all sessions at once.

Models stay outside: a stage takes functions from DataFrame to DataFrame (usually a
:func:`spanweave.operators.clips.map_model`) at the places where one is needed, after the filters
that decide what must be computed at all. A session that cannot go on becomes a row in ``failures``.

Tables of sessions, files, windows or segments all grow with the input, and the files they are kept in say little
of their rows in memory. They meet by sort-merge joins, by hint: a side that looks small would be built at the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanweave.functions.timecode import samples_to_ms
from spanweave.operators import audit as au
from spanweave.operators import identity as ident
from spanweave.operators import intervals as iv
from spanweave.operators import timeline as tl
from spanweave.operators.clips import clip_name, cut_clips
from spanweave.sources import media

Model = Callable[[DataFrame], DataFrame]


def lazily(df: DataFrame) -> DataFrame:
    """The default ``keep``: nothing is materialized."""
    return df


# Default parameters of a run.
WINDOW_MS = 10000
HOP_MS = 10000
MIN_SPEAKER_ACTIVE_MS = 250
EDGE_TRIM_MS = 50
MIN_CLEAN_MS = 500

FILE = list(tl.FILE)
SESSION = list(tl.SESSION)
WINDOW = list(tl.WINDOW)


def _length():
    return F.col("end_ms") - F.col("start_ms")


def _zero(name: str):
    return F.coalesce(F.col(name), F.lit(0).cast("bigint")).alias(name)


@dataclass(frozen=True)
class Preprocessed:
    clips: DataFrame  # with duration_ms and offset_ms
    speech: DataFrame  # local, merged per file
    speech_global: DataFrame  # merged per session
    file_summary: DataFrame
    session_summary: DataFrame


def preprocess(clips: DataFrame, vad_segments: DataFrame, keep: Model = lazily) -> Preprocessed:
    """Clock, speech maps and counts from clips and detector output in samples.

    ``clips``: session, file, ``sample_rate``, ``n_frames`` and any metadata.
    ``vad_segments``: session, file, ``start_sample``, ``end_sample``. In every stage ``keep`` is
    applied to the tables that are read more than once, e.g. ``materialize``.
    """
    timed = clips.withColumn("duration_ms", samples_to_ms("n_frames", "sample_rate"))
    clock = keep(tl.session_clock(timed))
    placed = timed.join(clock.select(*FILE, "offset_ms").hint("merge"), FILE)
    in_ms = vad_segments.join(clips.select(*FILE, "sample_rate").hint("merge"), FILE).select(
        *FILE,
        samples_to_ms("start_sample", "sample_rate").alias("start_ms"),
        samples_to_ms("end_sample", "sample_rate").alias("end_ms"),
    )
    speech = keep(iv.merge_intervals(in_ms, FILE))
    speech_global = keep(iv.merge_intervals(tl.to_global(speech, clock), SESSION))
    per_file = speech.groupBy(*FILE).agg(
        F.count(F.lit(1)).alias("n_segments"), F.sum(_length()).alias("speech_ms")
    )
    file_summary = clock.join(per_file.hint("merge"), FILE, "left").select(
        *FILE, "duration_ms", "offset_ms", _zero("n_segments"), _zero("speech_ms")
    )
    spoken = speech_global.groupBy(*SESSION).agg(F.sum(_length()).alias("speech_ms"))
    session_summary = (
        tl.session_totals(timed)
        .join(spoken.hint("merge"), SESSION, "left")
        .select(*SESSION, "n_files", "session_ms", _zero("speech_ms"))
    )
    return Preprocessed(placed, speech, speech_global, file_summary, session_summary)


@dataclass(frozen=True)
class Enrolled:
    clicks: DataFrame  # resolved clicks with box and embedding
    references: DataFrame  # target and anti vector per session
    windows: DataFrame  # clean speech intervals, local
    windows_global: DataFrame
    guard: DataFrame  # counts and failure reason per session
    seeds: DataFrame  # one vector per session that went through
    failures: DataFrame  # session_id, reason


def enroll(
    pre: Preprocessed,
    clicks: DataFrame,
    detections: DataFrame,
    embed: Model,
    threshold: float = ident.FACE_MATCH_THRESHOLD,
    sample_ms: int = ident.SAMPLE_MS,
    seed_min_ms: int = ident.SEED_MIN_MS,
    keep: Model = lazily,
) -> Enrolled:
    """Target identity from clicks, clean windows, and the pooled voice seed.

    ``detections``: session, file, ``pts_ms``, ``box_idx``, box, ``score``, ``embedding`` (null when
    the embedder found no face). ``embed`` adds ``embedding`` to the windows of sessions that pass.
    """
    resolved = keep(ident.resolve_clicks(clicks, detections, carry=("score", "embedding")))
    missed = ident.click_failures(resolved)
    lacking = ident.target_failures(pre.clips, resolved).join(missed.select(*SESSION).hint("merge"), list(SESSION), "left_anti")
    references = (
        resolved.groupBy(*SESSION)
        .agg(
            F.max(F.when(F.col("kind") == "speaking", F.col("embedding"))).alias("target"),
            F.max(F.when(F.col("kind") == "anti", F.col("embedding"))).alias("anti"),
        )
        .where(F.col("target").isNotNull())
    )
    frames = ident.frame_identity(detections, references, threshold)
    windows = keep(ident.clean_windows(pre.speech, frames, sample_ms))
    guard = keep(ident.seed_guard(references, windows, seed_min_ms))
    passed = guard.where(F.col("reason").isNull()).select(*SESSION)
    vectors = embed(windows.join(passed.hint("merge"), SESSION, "left_semi"))
    seeds = keep(ident.pool_vectors(vectors, SESSION))
    failures = missed.unionByName(lacking).unionByName(
        guard.where(F.col("reason").isNotNull()).select(*SESSION, "reason")
    )
    return Enrolled(
        resolved, references, windows, tl.to_global(windows, pre.clips), guard, seeds, failures
    )


@dataclass(frozen=True)
class Tracked:
    windows: DataFrame  # one report row per window
    target: DataFrame  # local, merged per file
    overlap: DataFrame
    target_global: DataFrame  # merged again on the session clock
    overlap_global: DataFrame
    file_summary: DataFrame
    session_summary: DataFrame


def track(
    clips: DataFrame,
    seeds: DataFrame,
    infer: Model,
    embed: Model,
    window_ms: int = WINDOW_MS,
    hop_ms: int = HOP_MS,
    threshold: float = ident.VOICE_MATCH_THRESHOLD,
    min_active_ms: int = MIN_SPEAKER_ACTIVE_MS,
    keep: Model = lazily,
) -> Tracked:
    """Where the target speaks and where voices overlap, for sessions that have a seed.

    ``infer`` turns windows into ``masks`` rows (``speaker_idx``, ``frame_ms``, ``activity``);
    ``embed`` adds ``embedding`` to the runs of speakers with enough activity.
    """
    placed = clips.select(*FILE, "duration_ms", "offset_ms").join(
        seeds.select(*SESSION).hint("merge"), SESSION, "left_semi"
    )
    # Few bytes of clips become many rows of windows, masks and edges, so that tasks by size would be too few.
    parts = int(clips.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = placed.repartition(parts, *FILE)
    windows = tl.window_schedule(placed, window_ms, hop_ms).select(*WINDOW)
    masks = keep(infer(windows))
    overlaps = keep(tl.window_overlaps(masks))

    runs = tl.mask_runs(tl.active_speakers(masks, min_active_ms))
    speaker = [*WINDOW, "speaker_idx"]
    pooled = ident.pool_vectors(embed(runs), speaker, strict=False)
    matched = keep(
        ident.match_identity(pooled, seeds, threshold).where(
            F.col("target_speaker_idx").isNotNull()
        )
    )
    chosen = matched.select(*WINDOW, F.col("target_speaker_idx").alias("speaker_idx"))
    target_runs = runs.join(chosen.hint("merge"), speaker, "left_semi")

    shape = masks.groupBy(*WINDOW).agg(
        F.max("frame_ms").alias("frame_ms"), F.count(F.lit(1)).alias("n_speakers")
    )
    spoken = target_runs.groupBy(*WINDOW).agg(F.sum(_length()).alias("target_ms"))
    crossed = overlaps.groupBy(*WINDOW).agg(F.sum(_length()).alias("overlap_ms"))
    report = (
        windows.join(shape.hint("merge"), WINDOW, "left")
        .join(matched.hint("merge"), WINDOW, "left")
        .join(spoken.hint("merge"), WINDOW, "left")
        .join(crossed.hint("merge"), WINDOW, "left")
        .select(
            *WINDOW,
            "frame_ms",
            _zero("n_speakers"),
            "target_speaker_idx",
            F.coalesce("target_cosine", F.lit(0.0)).alias("target_cosine"),
            _zero("target_ms"),
            _zero("overlap_ms"),
        )
    )
    target = keep(iv.merge_intervals(target_runs.select(*FILE, "start_ms", "end_ms"), FILE))
    overlap = keep(iv.merge_intervals(overlaps.select(*FILE, "start_ms", "end_ms"), FILE))
    target_global = keep(iv.merge_intervals(tl.to_global(target, placed), SESSION))
    overlap_global = keep(iv.merge_intervals(tl.to_global(overlap, placed), SESSION))

    def length_of(df: DataFrame, keys: list[str], name: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.sum(_length()).alias(name)).hint("merge")

    file_summary = (
        placed.select(*FILE)
        .join(windows.groupBy(*FILE).agg(F.count(F.lit(1)).alias("n_windows")).hint("merge"), FILE, "left")
        .join(length_of(target, FILE, "target_ms"), FILE, "left")
        .join(length_of(overlap, FILE, "overlap_ms"), FILE, "left")
        .select(*FILE, _zero("n_windows"), _zero("target_ms"), _zero("overlap_ms"))
    )
    session_summary = (
        placed.groupBy(*SESSION)
        .agg(F.sum("duration_ms").alias("session_ms"))
        .join(length_of(target_global, SESSION, "target_ms"), SESSION, "left")
        .join(length_of(overlap_global, SESSION, "overlap_ms"), SESSION, "left")
        .select(*SESSION, "session_ms", _zero("target_ms"), _zero("overlap_ms"))
    )
    return Tracked(
        report, target, overlap, target_global, overlap_global, file_summary, session_summary
    )


@dataclass(frozen=True)
class Judged:
    segments: DataFrame  # every target segment with its decision; clean ones with name and sha256
    clips: DataFrame | None  # WAV bytes of the clean ones, or the files written
    file_summary: DataFrame
    session_summary: DataFrame  # totals and output fingerprint


def contaminate(
    target: DataFrame,
    overlap: DataFrame,
    clips: DataFrame,
    trim_ms: int = EDGE_TRIM_MS,
    min_clean_ms: int = MIN_CLEAN_MS,
    keep: Model = lazily,
    clips_to: str | None = None,
    source: DataFrame | None = None,
) -> Judged:
    """Drop every target segment that touches overlap, trim the others, drop what is then short.

    Works per file, on local time. ``clips`` carries ``offset_ms`` and ``pcm``, or the places of a WAV
    index (``sources.media``); without either no clips are cut and there is no fingerprint. From an
    index, ``clips_to`` writes WAV files there instead of returning their bytes. ``source`` has the ``pcm`` where
    ``clips`` goes without, so that a single join moves it.
    """
    parts = tl.edge_trim(iv.partition_contaminated(target, overlap, FILE), trim_ms, min_clean_ms)
    bad = F.col("contaminated")
    clean = ~bad & F.col("kept")
    start = F.when(clean, F.col("trim_start_ms")).otherwise(F.col("start_ms"))
    end = F.when(clean, F.col("trim_end_ms")).otherwise(F.col("end_ms"))
    segments = keep(
        parts.join(clips.select(*FILE, "offset_ms").hint("merge"), FILE)
        .select(
            *FILE,
            F.when(bad, "NaN").when(clean, "CLEAN").otherwise("DISCARD").alias("decision"),
            F.col("start_ms").alias("segment_start_ms"),
            start.alias("start_local_ms"),
            end.alias("end_local_ms"),
            (start + F.col("offset_ms")).alias("start_global_ms"),
            (end + F.col("offset_ms")).alias("end_global_ms"),
            (end - start).alias("duration_ms"),
            F.when(
                ~bad & ~F.col("kept"),
                F.greatest(F.lit(0).cast("bigint"), F.col("trim_end_ms") - F.col("trim_start_ms")),
            ).alias("trimmed_ms"),
        )
    )
    cut = None
    source = clips if source is None else source
    if "pcm" in source.columns:
        cut = keep(cut_clips(segments.where(F.col("decision") == "CLEAN"), source))
    elif "data_offset" in clips.columns:
        kept = segments.where(F.col("decision") == "CLEAN")
        if clips_to is None:
            cut = keep(media.clips_from_files(kept, clips))
        else:
            files = media.write_clips_from_files(kept, clips, clips_to)
            name = clip_name(F.col("file_index"), F.col("start_global_ms"), F.col("end_global_ms"))
            key = F.col("session_id").cast("string")
            cut = (
                kept.withColumns({"name": name, "_key": key})
                .join(files.withColumnRenamed("session_id", "_key").hint("merge"), ["_key", "name"])
                .drop("_key")
            )
    if cut is not None:
        segments = segments.join(
            cut.select(*FILE, "segment_start_ms", "name", "sha256").hint("merge"),
            [*FILE, "segment_start_ms"],
            "left",
        )
    is_ = lambda d: F.col("decision") == d
    ms = lambda d: F.coalesce(
        F.sum(F.when(is_(d), F.col("duration_ms"))), F.lit(0).cast("bigint")
    )
    measures = [
        F.count_if(is_("CLEAN")).alias("n_clean"),
        F.count_if(is_("NaN")).alias("n_nan"),
        F.count_if(is_("DISCARD")).alias("n_short"),
        ms("CLEAN").alias("clean_ms"),
        ms("NaN").alias("contaminated_ms"),
    ]
    names = ["n_clean", "n_nan", "n_short", "clean_ms", "contaminated_ms"]
    per_file = segments.groupBy(*FILE).agg(*measures)
    file_summary = clips.select(*FILE).join(per_file.hint("merge"), FILE, "left").select(
        *FILE, *[_zero(n) for n in names]
    )
    session_summary = file_summary.groupBy(*SESSION).agg(
        *[F.sum(n).alias(n) for n in names]
    )
    if cut is not None:
        prints = au.output_fingerprint(segments.where(is_("CLEAN")))
        empty = F.sha2(F.lit("[]"), 256)
        session_summary = session_summary.join(prints.hint("merge"), SESSION, "left").select(
            *SESSION,
            *names,
            _zero("n_outputs"),
            F.coalesce("output_fingerprint", empty).alias("output_fingerprint"),
        )
    return Judged(segments, cut, file_summary, session_summary)
