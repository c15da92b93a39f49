"""A whole run over many sessions, with one hash-chained audit log per session."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanweave.functions.canonical import (
    canonical_object,
    canonical_text,
    json_number,
    json_string,
    json_value,
    pairs_json,
    wrap_record,
)
from spanweave.functions.vectors import vector_sha256
from spanweave.operators import audit as au
from spanweave.operators import identity as ident
from spanweave.operators import registry as rg
from spanweave.operators.lineage import materialize
from spanweave.plans import stages as st

# Names that must be registered, and the detector parameters recorded per clip.
REQUIRED_MODELS = ("eend_m2f", "insightface", "wavlm", "yolov8")
VAD_PARAMS = {"threshold": 0.5, "min_speech_ms": 250, "min_silence_ms": 100, "speech_pad_ms": 30}

# A record's place in its log; unique within a session.
ORDER = ("stage", "file_index", "kind", "at_ms")


@dataclass(frozen=True)
class SessionRun:
    pre: st.Preprocessed
    enrolled: st.Enrolled
    tracked: st.Tracked
    judged: st.Judged
    audit: DataFrame
    failures: DataFrame  # session_id, reason
    gate: Gate | None  # None: the run was not verified


@dataclass(frozen=True)
class Gate:
    verdicts: DataFrame  # session_id, n_models, n_problems, passed, models (JSON of a session that passed)
    problems: DataFrame  # session_id, name, path, status


def gate_sessions(
    sessions: DataFrame,
    registry: DataFrame,
    actual: DataFrame,
    required: Sequence[str] = REQUIRED_MODELS,
) -> Gate:
    """Which sessions may run: every registered file has its hash and every required name is registered.

    ``registry``: ``name, path, sha256``, for all sessions, or with ``session_id`` one per session;
    ``actual``: ``path, sha256`` of the files there are. A session without a registry does not pass.
    A registry is one document, so a session has few rows of it.
    """
    keys = [c for c in st.SESSION if c in registry.columns]
    ids = sessions.select(*st.SESSION).distinct()
    names = F.explode(F.array(*[F.lit(n) for n in required]))
    if not required:
        needed = ()
    elif keys:
        needed = ids.select(*keys, names.alias("name"))
    else:
        needed = tuple(required)
    report = rg.verify_registry(registry, actual, needed, keys=keys)
    bad = F.col("status") != "OK"
    models = F.array_sort(F.collect_list(F.struct("name", F.col("actual").alias("sha256"))))
    found = report.groupBy(*keys).agg(
        F.count_if(~bad).alias("n_models"), F.count_if(bad).alias("n_problems"), F.to_json(models).alias("models")
    )
    problems = report.where(bad).select(*keys, "name", "path", "status")
    if keys:
        verdicts = ids.join(found.hint("merge"), keys, "left")
        problems = problems.join(ids.hint("merge"), keys, "left_semi")
    else:
        # One verdict, and few problems, for every session.
        every = ids.withColumn("_all", F.lit(True))
        verdicts = every.join(found.withColumn("_all", F.lit(True)), "_all").drop("_all")
        problems = every.join(problems.withColumn("_all", F.lit(True)), "_all").drop("_all")
    passed = (F.coalesce("n_problems", F.lit(1)) == 0) & (F.col("n_models") > 0)
    zero = F.lit(0).cast("bigint")
    return Gate(
        verdicts.select(
            *st.SESSION,
            F.coalesce("n_models", zero).alias("n_models"),
            F.coalesce("n_problems", zero).alias("n_problems"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
            F.when(passed, F.col("models")).alias("models"),
        ),
        problems.select(*st.SESSION, "name", "path", "status"),
    )


def gate_failures(gate: Gate) -> DataFrame:
    """``session_id, reason`` of the sessions that may not run: how many problems, and the first."""
    first = gate.problems.groupBy(*st.SESSION).agg(F.min(F.struct("name", "status", "path")).alias("_p"))
    stopped = gate.verdicts.where(~F.col("passed")).join(first.hint("merge"), st.SESSION, "left")
    text = F.concat_ws(" ", F.lit("models not verified:"), F.col("n_problems").cast("string"), F.lit("failing,"), "_p.status", "_p.name", "_p.path")
    return stopped.select(*st.SESSION, F.when(F.col("_p").isNull(), "models not verified: nothing registered").otherwise(text).alias("reason"))


def run_gate(
    registry: DataFrame, actual: DataFrame, required: Sequence[str] = REQUIRED_MODELS
) -> str:
    """Verify the registry before anything else runs; returns the ``models`` list as JSON.

    A registry is one JSON document listing the run's models, so its rows are few by construction.
    The error says how many entries fail and quotes the first; ``registry.verify_registry`` has all.
    """
    report = rg.verify_registry(registry, actual, required)
    bad = report.where(F.col("status") != "OK")
    found = bad.agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("name", "status", "path")).alias("p")).first()
    if found.n:
        raise ValueError(f"{found.n} failing: {found.p['status']} {found.p['name']}: {found.p['path']}")
    models = F.array_sort(F.collect_list(F.struct("name", F.col("actual").alias("sha256"))))
    return report.agg(F.to_json(models).alias("m")).first()["m"]


def _record(
    df: DataFrame,
    stage: int,
    operation: str | Column,
    fields: Mapping[str, Column],
    kind: int | Column = 0,
    at: Column | None = None,
    start: Column | None = None,
    per_file: bool = False,
) -> DataFrame:
    op = F.lit(operation) if isinstance(operation, str) else operation
    zero = F.lit(0).cast("bigint")
    payload = canonical_object(fields)
    file_index = F.lit(0)
    if per_file:
        file_index = F.col("file_index")
        payload = wrap_record(file_index, start if start is not None else zero, op, payload)
    return df.select(
        "session_id",
        F.lit(stage).alias("stage"),
        file_index.cast("int").alias("file_index"),
        (F.lit(kind) if isinstance(kind, int) else kind).cast("int").alias("kind"),
        (at if at is not None else zero).cast("bigint").alias("at_ms"),
        op.alias("operation"),
        payload.alias("payload"),
    )


def _ints(*names: str) -> dict[str, Column]:
    return {n: json_value(F.col(n)) for n in names}


def _text(*names: str) -> dict[str, Column]:
    return {n: json_string(F.col(n)) for n in names}


def _const(value) -> Column:
    return F.lit(canonical_text(value))


def _start_records(clips: DataFrame, gate: Gate | None, environment: Mapping, seed: int) -> list[DataFrame]:
    """A session that the gate stops has its start alone; an unverified one has no checksum record."""
    sessions = clips.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("n_inputs"), F.max("sample_rate").alias("sample_rate")
    )
    start = _record(
        sessions, 0, "session_start", {"seed": _const(seed), **_ints("n_inputs", "sample_rate")}
    )
    going = sessions if gate is None else sessions.join(gate.verdicts.where("passed").hint("merge"), st.SESSION)
    env = _record(going, 1, "environment", {k: _const(x) for k, x in environment.items()})
    if gate is None:
        return [start, env]
    return [start, env, _record(going, 2, "model_checksums", {"models": F.col("models")})]


def _preprocess_records(pre: st.Preprocessed) -> list[DataFrame]:
    clip = _record(
        pre.clips, 3, "layer0_file",
        {
            **_text("source"),
            "wav_sha256": json_string(F.col("sha256")),
            **_ints("sample_rate", "channels", "duration_ms", "offset_ms"),
        },
        per_file=True,
    )
    # A clip's speech list is bounded by the clip: segments are disjoint and of at least 1 ms.
    listed = pre.speech.groupBy(*st.FILE).agg(
        F.array_sort(F.collect_list(F.struct("start_ms", "end_ms"))).alias("_pairs")
    )
    vad = _record(
        pre.file_summary.join(listed.hint("merge"), st.FILE, "left"), 3, "layer0_vad",
        {
            "params": _const(VAD_PARAMS),
            **_ints("n_segments", "speech_ms"),
            "segments_ms": F.coalesce(pairs_json(F.col("_pairs")), F.lit("[]")),
        },
        kind=1,
        per_file=True,
    )
    summary = _record(
        pre.session_summary, 4, "layer0_summary", _ints("n_files", "session_ms", "speech_ms")
    )
    return [clip, vad, summary]


def _enroll_records(en: st.Enrolled, threshold: float, sample_ms: int, seed_min_ms: int) -> list[DataFrame]:
    fail = "layer1_failure"
    speaking = en.clicks.where(F.col("kind") == "speaking")
    click_ints = {"click_file": F.col("file_index")}
    where = {
        "file_index": json_value(F.col("click_file")), **_ints("x", "y", "pts_ms"),
    }
    speaking = speaking.withColumns(click_ints).drop("kind")
    hit = speaking.where(F.col("x1").isNotNull()).join(
        en.references.select("session_id", "anti").hint("merge"), st.SESSION
    )
    click = _record(
        hit, 5, "layer1_click",
        {
            **where,
            "target_box": F.to_json(F.array("x1", "y1", "x2", "y2")),
            "target_box_score": json_number(F.col("score").cast("double")),
            "target_emb_dim": json_value(F.size("embedding")),
            "target_emb_sha256": json_string(vector_sha256(F.col("embedding"))),
            "anti_present": json_value(F.col("anti").isNotNull()),
            "anti_emb_sha256": json_string(vector_sha256(F.col("anti"))),
            "face_match_threshold": _const(threshold),
        },
    )
    missed = _record(
        speaking.where(F.col("x1").isNull()), 5, fail,
        {"reason": _const(ident.CLICK_MISSED), **where, **_ints("n_boxes")},
    )
    # The session-wide list of windows may be of any length: its digest is recorded, the list is a
    # table.
    pair = en.windows_global.select(
        "session_id", "file_index", "start_ms", "end_ms",
        F.concat(F.lit("["), "start_ms", F.lit(","), "end_ms", F.lit("]")).alias("_pair"),
    )
    digest = au.ordered_digest(pair, "session_id", ["file_index", "start_ms", "end_ms"], "_pair")
    found = en.guard.join(digest.select("session_id", "digest").hint("merge"), st.SESSION, "left")
    windows = _record(
        found, 6, "layer1_enrollment_windows",
        {
            **_ints("n_windows", "total_ms"),
            "windows_global_sha256": json_string(F.coalesce("digest", F.sha2(F.lit("[]"), 256))),
            "sample_ms": _const(sample_ms),
            "seed_min_ms": _const(seed_min_ms),
            "threshold": _const(threshold),
        },
    )
    failed = en.guard.where(F.col("reason").isNotNull())
    none = _record(
        failed.where(F.col("n_windows") == 0), 7, fail, {"reason": json_string(F.col("reason"))}
    )
    short = _record(
        failed.where(F.col("n_windows") > 0), 7, fail,
        {**_text("reason"), **_ints("total_ms"), "seed_min_ms": _const(seed_min_ms)},
    )
    seed = _record(
        en.seeds.join(en.guard.select("session_id", "n_windows", "total_ms").hint("merge"), st.SESSION), 7, "layer1_seed",
        {
            "dim": json_value(F.size("embedding")),
            "seed_sha256": json_string(vector_sha256(F.col("embedding"))),
            **_ints("n_windows"),
            "total_enroll_ms": json_value(F.col("total_ms")),
        },
    )
    return [click, missed, windows, none, short, seed]


def _track_records(tr: st.Tracked, threshold: float, min_active_ms: int) -> list[DataFrame]:
    window = _record(
        tr.windows, 8, "layer2_window",
        {
            "window_ms": F.concat(
                F.lit("["), "window_start_ms", F.lit(","), "window_end_ms", F.lit("]")
            ),
            **_ints("frame_ms", "n_speakers", "target_speaker_idx", "target_ms", "overlap_ms"),
            "target_cosine": json_number(F.round("target_cosine", 6)),
            "match_threshold": _const(threshold),
            "min_speaker_active_ms": _const(min_active_ms),
        },
        at=F.col("window_start_ms"),
        start=F.col("window_start_ms"),
        per_file=True,
    )
    files = _record(
        tr.file_summary, 8, "layer2_file_summary",
        _ints("target_ms", "overlap_ms", "n_windows"), kind=1, per_file=True,
    )
    summary = _record(
        tr.session_summary, 9, "layer2_summary", _ints("session_ms", "target_ms", "overlap_ms")
    )
    return [window, files, summary]


def _judge_records(ju: st.Judged, trim_ms: int, min_clean_ms: int) -> list[DataFrame]:
    bounds = _ints("start_global_ms", "end_global_ms", "duration_ms")
    local = _ints("start_local_ms", "end_local_ms")
    at = F.col("segment_start_ms")

    def part(decision: str, operation: str, fields: Mapping[str, Column], kind: int, start: Column):
        rows = ju.segments.where(F.col("decision") == decision)
        return _record(
            rows, 10, operation, {**_text("decision"), **bounds, **fields},
            kind=kind, at=at, start=start, per_file=True,
        )

    blocked = part("NaN", "layer3_nan_block", {"reason": _const("overlap"), **local}, 0, at)
    clean = part(
        "CLEAN", "layer3_segment",
        {
            **local,
            "wav_path": json_string(F.col("name")),
            "wav_sha256": json_string(F.col("sha256")),
            "edge_trim_ms": _const(trim_ms),
        },
        1, F.col("start_local_ms"),
    )
    short = part(
        "DISCARD", "layer3_discard_short",
        {
            "reason": _const("below_min_clean_ms_after_edge_trim"),
            **_ints("trimmed_ms"),
            "edge_trim_ms": _const(trim_ms),
            "min_clean_ms": _const(min_clean_ms),
        },
        1, at,
    )
    files = _record(
        ju.file_summary, 10, "layer3_file_summary",
        _ints("n_clean", "n_nan", "n_short", "clean_ms", "contaminated_ms"), kind=2, per_file=True,
    )
    # Likewise the fingerprint stands for the list of output hashes.
    total = ju.session_summary
    output = _record(
        total, 11, "output_hash",
        {
            **_ints("n_outputs"),
            **_text("output_fingerprint"),
            "clean_ms_total": json_value(F.col("clean_ms")),
            "contaminated_ms_total": json_value(F.col("contaminated_ms")),
        },
    )
    end = _record(
        total, 12, "session_end",
        {
            **_ints("n_outputs", "clean_ms", "contaminated_ms"),
            **_text("output_fingerprint"),
            "discarded_short": json_value(F.col("n_short")),
        },
    )
    return [blocked, clean, short, files, output, end]


def run_sessions(
    clips: DataFrame,
    vad_segments: DataFrame,
    clicks: DataFrame,
    detections: DataFrame,
    infer: st.Model,
    embed_windows: st.Model,
    embed_runs: st.Model,
    registry: DataFrame | None = None,
    hashes: DataFrame | None = None,
    required: Sequence[str] = REQUIRED_MODELS,
    unverified: bool = False,
    environment: Mapping | None = None,
    stamp: Column | None = None,
    seed: int = 0,
    face_threshold: float = ident.FACE_MATCH_THRESHOLD,
    sample_ms: int = ident.SAMPLE_MS,
    seed_min_ms: int = ident.SEED_MIN_MS,
    window_ms: int = st.WINDOW_MS,
    hop_ms: int = st.HOP_MS,
    voice_threshold: float = ident.VOICE_MATCH_THRESHOLD,
    min_active_ms: int = st.MIN_SPEAKER_ACTIVE_MS,
    trim_ms: int = st.EDGE_TRIM_MS,
    min_clean_ms: int = st.MIN_CLEAN_MS,
    keep: st.Model = materialize,
    clips_to: str | None = None,
) -> SessionRun:
    """The gate, all stages and the log.

    ``registry`` and ``hashes`` go to :func:`gate_sessions` before any model runs. A session that does not
    pass is in no later step, its log ends after ``session_start``, and it is in ``failures``. Running
    without a registry takes ``unverified=True``, and such a log lacks ``model_checksums``, so it never
    counts as complete.

    ``clips`` carries ``pcm``, or is an index of WAV files (``sources.media``) that are read by ranges;
    with ``clips_to`` the clean clips are then written there as WAV files. Tables that several later steps read (speech, model output, seeds, segments) are written to the
    shared folder, so that no model runs twice and each step has a small plan. A session that fails
    at enrollment ends its log with the failure; the others are unaffected.
    """
    if (registry is None) != (hashes is None):
        raise ValueError("registry and hashes belong together")
    if (registry is None) != unverified:
        raise ValueError("give a registry and hashes, or unverified=True to run models that nobody checked")
    gate, every = None, clips
    if registry is not None:
        found = gate_sessions(clips, registry, hashes, required)
        gate = Gate(keep(found.verdicts), keep(found.problems))
        passed = gate.verdicts.where("passed").select(*st.SESSION)
        clips, vad_segments, clicks, detections = (
            df.join(passed, st.SESSION, "left_semi") for df in (clips, vad_segments, clicks, detections)
        )
    pre = st.preprocess(clips, vad_segments, keep)
    enrolled = st.enroll(
        pre, clicks, detections, embed_windows, face_threshold, sample_ms, seed_min_ms, keep
    )
    tracked = st.track(
        pre.clips, enrolled.seeds, infer, embed_runs,
        window_ms, hop_ms, voice_threshold, min_active_ms, keep,
    )
    going = pre.clips.drop("pcm").join(enrolled.seeds.select("session_id").hint("merge"), st.SESSION, "left_semi")
    judged = st.contaminate(tracked.target, tracked.overlap, going, trim_ms, min_clean_ms, keep, clips_to, every)

    # Each kind of record is a table of its own: one plan for all would hold every small join side at the driver at once.
    kinds = [
        *_start_records(every, gate, environment or {}, seed),
        *_preprocess_records(pre),
        *_enroll_records(enrolled, face_threshold, sample_ms, seed_min_ms),
        *_track_records(tracked, voice_threshold, min_active_ms),
        *_judge_records(judged, trim_ms, min_clean_ms),
    ]
    records = reduce(DataFrame.unionByName, map(keep, kinds))
    when = stamp if stamp is not None else F.lit("1970-01-01T00:00:00.000Z")
    records = records.withColumn("audit", canonical_object({"timestamp_utc": json_string(when)}))
    audit = keep(au.chain_build(keep(records), ORDER))
    failures = enrolled.failures
    if gate is not None:
        failures = failures.unionByName(gate_failures(gate))
    return SessionRun(pre, enrolled, tracked, judged, audit, failures, gate)
