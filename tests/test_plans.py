import hashlib
import io
import wave

import pytest
from pyspark.sql import functions as F

from spanweave.functions.canonical import canonical_text
from spanweave.operators import audit as au
from spanweave.operators import registry as rg
from spanweave.operators.lineage import materialize
from spanweave.plans import sessions as ss
from spanweave.plans import stages as st
from spanweave.plans.compare import compare

CLIPS = (
    "session_id string, file_index int, source string, sample_rate int, channels int, "
    "n_frames bigint, sha256 string, pcm binary"
)
VAD = "session_id string, file_index int, start_sample bigint, end_sample bigint"
CLICK = "session_id string, kind string, file_index int, x int, y int, pts_ms bigint"
DET = (
    "session_id string, file_index int, pts_ms bigint, box_idx int, x1 int, y1 int, x2 int, y2 int, "
    "score double, embedding array<double>"
)
PCM = b"\x01\x00" * (16000 * 6)
T, O = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]


def test_preprocess(spark):
    clips = spark.createDataFrame(
        [("s", 0, "a", 16000, 1, 16000, "x", None), ("s", 1, "b", 16000, 1, 8000, "y", None)], CLIPS
    )
    vad = spark.createDataFrame([("s", 0, 1600, 8000), ("s", 1, 0, 4000)], VAD)
    pre = st.preprocess(clips, vad)
    assert [(r.duration_ms, r.offset_ms) for r in pre.clips.orderBy("file_index").collect()] == [
        (1000, 0), (500, 1000),
    ]
    assert sorted((r.file_index, r.start_ms, r.end_ms) for r in pre.speech.collect()) == [
        (0, 100, 500), (1, 0, 250),
    ]
    assert sorted((r.start_ms, r.end_ms) for r in pre.speech_global.collect()) == [(100, 500), (1000, 1250)]
    s = pre.session_summary.first()
    assert (s.n_files, s.session_ms, s.speech_ms) == (2, 1500, 650)


def mask_model(speakers, frame_ms=20):
    """Every window gets the same masks."""
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("i"), F.array(*[F.lit(int(x)) for x in a]).cast("array<tinyint>").alias("a"))
            for i, a in enumerate(speakers)
        ]
    )

    def infer(windows):
        return windows.select("*", F.explode(rows).alias("m")).select(
            *windows.columns, F.col("m.i").alias("speaker_idx"), F.lit(frame_ms).alias("frame_ms"),
            F.col("m.a").alias("activity"),
        )

    return infer


def voice(*starts):
    """Target vector for windows or runs starting at the given times."""
    arr = lambda v: F.array(*[F.lit(x) for x in v])
    return lambda df: df.withColumn(
        "embedding", F.when(F.col("start_ms").isin(*starts), arr(T)).otherwise(arr(O))
    )


def test_track(spark):
    on = lambda *spans: [any(a <= f < b for a, b in spans) for f in range(500)]
    clips = spark.createDataFrame(
        [("s", 0, 10000, 0)], "session_id string, file_index int, duration_ms bigint, offset_ms bigint"
    )
    seeds = spark.createDataFrame([("s", T)], "session_id string, embedding array<double>")
    out = st.track(
        clips, seeds, mask_model([on((0, 150), (300, 400)), on((350, 450))]), voice(0, 6000)
    )
    assert sorted((r.start_ms, r.end_ms) for r in out.target.collect()) == [(0, 3000), (6000, 8000)]
    assert [(r.start_ms, r.end_ms) for r in out.overlap_global.collect()] == [(7000, 8000)]
    w = out.windows.first()
    assert (w.target_speaker_idx, w.target_cosine, w.target_ms, w.overlap_ms) == (0, 1.0, 5000, 1000)


def test_track_deals_clips_over_tasks(spark):
    """Clips are few bytes, but their windows, masks and edges are not."""
    clips = spark.createDataFrame(
        [(f"s{i % 5}", i, 10000, 0) for i in range(40)], "session_id string, file_index int, duration_ms bigint, offset_ms bigint"
    ).coalesce(1)
    seeds = spark.createDataFrame([(f"s{i}", T) for i in range(5)], "session_id string, embedding array<double>").coalesce(1)
    seen = []

    def infer(windows):
        seen.append(windows.rdd.getNumPartitions())
        return mask_model([[True] * 500])(windows)

    out = st.track(clips, seeds, infer, voice(0))
    assert seen == [int(spark.conf.get("spark.sql.shuffle.partitions"))] and seen[0] > 1
    assert sum(r.target_ms for r in out.file_summary.collect()) == 40 * 10000


def test_contaminate(spark):
    cols = "session_id string, file_index int, start_ms bigint, end_ms bigint"
    target = spark.createDataFrame([("s", 0, a, b) for a, b in [(0, 2000), (3000, 5000), (5500, 5800)]], cols)
    overlap = spark.createDataFrame([("s", 0, 3500, 4500)], cols)
    clips = spark.createDataFrame(
        [("s", 0, 100, 16000, 1, bytearray(PCM)), ("t", 0, 0, 16000, 1, bytearray(PCM))],
        "session_id string, file_index int, offset_ms bigint, sample_rate int, channels int, pcm binary",
    )
    out = st.contaminate(target, overlap, clips)
    got = {r.decision: r for r in out.segments.collect()}
    clean = got["CLEAN"]
    assert (clean.start_local_ms, clean.end_local_ms, clean.start_global_ms) == (50, 1950, 150)
    assert (got["DISCARD"].start_local_ms, got["DISCARD"].duration_ms, got["DISCARD"].trimmed_ms) == (5500, 300, 200)
    total = {r.session_id: r for r in out.session_summary.collect()}
    assert (total["s"].n_clean, total["s"].contaminated_ms, total["s"].n_short) == (1, 2000, 1)
    with wave.open(io.BytesIO(bytes(out.clips.first().wav))) as w:
        assert w.getnframes() == 1900 * 16
    fp = hashlib.sha256(canonical_text([clean.sha256]).encode()).hexdigest()
    assert total["s"].output_fingerprint == fp
    assert total["t"].output_fingerprint == hashlib.sha256(b"[]").hexdigest()


@pytest.fixture(scope="module")
def run(spark):
    names = ["ok", "offbox", "short"]
    clips = spark.createDataFrame(
        [(s, 0, "clip0.wav", 16000, 1, 96000, "sha", bytearray(PCM)) for s in names], CLIPS
    )
    vad = spark.createDataFrame(
        [(s, 0, *seg) for s in names for seg in ([(0, 64000), (80000, 88000)] if s != "short" else [(0, 8000)])],
        VAD,
    )
    clicks = spark.createDataFrame(
        [(s, "speaking", 0, 10 if s == "offbox" else 150, 150, 1000) for s in names], CLICK
    )
    det = []
    for s in names:
        for pts in [1000, *range(125, 6000, 250)]:
            boxes = [((120, 120, 180, 180), 0.9, T)]
            if pts == 1000:
                boxes.insert(0, ((100, 100, 300, 300), 0.7, O))
            elif pts >= 5000:
                boxes.append(((300, 100, 400, 200), 0.8, O))
            det += [(s, 0, pts, i, *b, score, e) for i, (b, score, e) in enumerate(boxes)]
    detections = spark.createDataFrame(det, DET)
    s0 = [0 <= f < 100 or 150 <= f < 250 for f in range(300)]
    s1 = [175 <= f < 225 for f in range(300)]
    registry = spark.createDataFrame([("m", "p", "00")], "name string, path string, sha256 string")
    hashes = spark.createDataFrame([("p", "00")], "path string, sha256 string")
    out = ss.run_sessions(
        clips, vad, clicks, detections, mask_model([s0, s1]), voice(0, 3000), voice(0, 3000),
        registry=registry, hashes=hashes, required=["m"], environment={"offline_env": {}},
    )
    return out, out.audit


def test_run_sessions_end_to_end(spark, run):
    out, audit = run
    ok = lambda df: df.where("session_id = 'ok'")
    assert sorted((r.start_ms, r.end_ms) for r in ok(out.tracked.target_global).collect()) == [
        (0, 2000), (3000, 5000),
    ]
    assert [(r.start_ms, r.end_ms) for r in out.tracked.overlap_global.collect()] == [(3500, 4500)]
    assert ok(out.judged.session_summary).first().n_outputs == 1
    assert {r.session_id: r.reason for r in out.failures.collect()} == {
        "offbox": "speaking_click did not land on any detected face",
        "short": "clean enrollment audio below seed_min_ms",
    }
    ops = {}
    for r in audit.orderBy("session_id", "seq").collect():
        ops.setdefault(r.session_id, []).append(r.operation)
    head = ["session_start", "environment", "model_checksums", "layer0_file", "layer0_vad", "layer0_summary"]
    assert ops["ok"] == head + [
        "layer1_click", "layer1_enrollment_windows", "layer1_seed", "layer2_window",
        "layer2_file_summary", "layer2_summary", "layer3_nan_block", "layer3_segment",
        "layer3_file_summary", "output_hash", "session_end",
    ]
    assert ops["offbox"] == head + ["layer1_failure"]
    assert ops["short"] == head + ["layer1_click", "layer1_enrollment_windows", "layer1_failure"]
    assert all(r.valid for r in au.chain_verify(audit).collect())
    done = {r.session_id: r.complete for r in au.log_completeness(audit).collect()}
    assert done == {"ok": True, "offbox": False, "short": False}


def test_payloads_are_canonical(run):
    import json

    for r in run[1].collect():
        assert canonical_text(json.loads(r.payload)) == r.payload, r.operation


def test_compare_reads_the_run_back(spark, run):
    turns = spark.createDataFrame(
        [("ok", "SPEAKER_00", 0, 1500), ("ok", "SPEAKER_01", 1500, 6000)],
        "session_id string, speaker_id string, start_ms bigint, end_ms bigint",
    )
    out = compare(run[1], turns, width=10)
    seg = out.segments.collect()
    assert [(r.session_id, r.start_ms, r.end_ms, r.covered_ms, r.verdict) for r in seg] == [
        ("ok", 50, 1950, 1450, "PARTIAL")
    ]
    assert out.matched.first().speaker_id == "SPEAKER_00"
    assert out.agreement.first().intersection_ms == 1450
    diff = {r["col"]: r.verdict for r in out.diff.collect()}
    assert [diff[c] for c in range(5)] == ["both", "both", "both", "a", "neither"]


def test_gate_halts_on_a_problem(spark):
    reg = spark.createDataFrame([("m", "p", "00")], "name string, path string, sha256 string")
    files = spark.createDataFrame([("p", bytearray(b"x"))], "path string, content binary")
    hashes = rg.file_hashes(files)
    with pytest.raises(ValueError, match="MISMATCH m: p"):
        ss.run_gate(reg, hashes, ["m"])
    good = reg.withColumn("sha256", F.sha2(F.lit("x"), 256))
    assert '"name":"m"' in ss.run_gate(good, hashes, ["m"])
    with pytest.raises(ValueError, match="REQUIRED"):
        ss.run_gate(good, hashes)


REGISTRY = "session_id string, name string, path string, sha256 string"


def test_gate_by_session(spark):
    sessions = spark.createDataFrame([(s,) for s in ["good", "bad", "none", "good"]], "session_id string")
    registry = spark.createDataFrame(
        [("good", "m", "p", "AA"), ("good", "n", "q", "bb"), ("bad", "m", "p", "ab"), ("bad", "x", "gone", ""), ("other", "m", "p", "1")],
        REGISTRY,
    )
    hashes = spark.createDataFrame([("p", "aa"), ("q", "bb")], "path string, sha256 string")
    gate = ss.gate_sessions(sessions, registry, hashes, ["m", "n"])
    got = {r.session_id: (r.n_models, r.n_problems, r.passed) for r in gate.verdicts.collect()}
    assert got == {"good": (2, 0, True), "bad": (0, 3, False), "none": (0, 2, False)}
    models = {r.session_id: r.models for r in gate.verdicts.collect()}
    assert models == {"good": '[{"name":"m","sha256":"aa"},{"name":"n","sha256":"bb"}]', "bad": None, "none": None}
    assert sorted(tuple(r) for r in gate.problems.select("session_id", "name", "status").collect()) == [
        ("bad", "m", "MISMATCH"), ("bad", "n", "REQUIRED"), ("bad", "x", "MISSING"),
        ("none", "m", "REQUIRED"), ("none", "n", "REQUIRED"),
    ]
    reasons = {r.session_id: r.reason for r in ss.gate_failures(gate).collect()}
    assert reasons["bad"] == "models not verified: 3 failing, MISMATCH m p" and set(reasons) == {"bad", "none"}
    # Nothing required and nothing registered is no verification either.
    empty = ss.gate_sessions(sessions, registry.limit(0), hashes, [])
    assert {r.passed for r in empty.verdicts.collect()} == {False}
    assert {r.reason for r in ss.gate_failures(empty).collect()} == {"models not verified: nothing registered"}
    one = ss.gate_sessions(sessions, registry.where("session_id = 'good'").drop("session_id"), hashes, ["m"])
    assert [r.passed for r in one.verdicts.collect()] == [True] * 3 and one.problems.count() == 0
    none = ss.gate_sessions(sessions, registry.where("session_id = 'bad'").drop("session_id"), hashes, [])
    assert [r.n_problems for r in none.verdicts.collect()] == [2] * 3 and none.problems.count() == 6


def test_no_run_without_verification(spark, run):
    with pytest.raises(ValueError, match="unverified"):
        ss.run_sessions(*[None] * 7)
    with pytest.raises(ValueError, match="belong together"):
        ss.run_sessions(*[None] * 7, registry=1)
    with pytest.raises(ValueError, match="unverified"):
        ss.run_sessions(*[None] * 7, registry=1, hashes=1, unverified=True)


def test_a_stopped_session_runs_no_model(spark):
    clips = spark.createDataFrame([(s, 0, "clip0.wav", 16000, 1, 96000, "sha", bytearray(PCM)) for s in ("ok", "stopped")], CLIPS)
    vad = spark.createDataFrame([(s, 0, 0, 64000) for s in ("ok", "stopped")], VAD)
    clicks = spark.createDataFrame([(s, "speaking", 0, 150, 150, 1000) for s in ("ok", "stopped")], CLICK)
    registry = spark.createDataFrame([("ok", "m", "p", "00"), ("stopped", "m", "p", "01")], REGISTRY)
    hashes = spark.createDataFrame([("p", "00")], "path string, sha256 string")
    seen = []

    def watched(df):
        seen.extend(r.session_id for r in df.select("session_id").distinct().collect())
        return voice(0, 3000)(df)

    faces = [(s, 0, pts, 0, 120, 120, 180, 180, 0.9, T) for s in ("ok", "stopped") for pts in [1000, *range(125, 4000, 250)]]
    out = ss.run_sessions(
        clips, vad, clicks, spark.createDataFrame(faces, DET),
        mask_model([[True] * 200]), watched, voice(0, 3000), registry=registry, hashes=hashes, required=["m"], seed_min_ms=100,
    )
    logged = {(r.session_id, r.operation) for r in out.audit.collect()}
    assert {o for s, o in logged if s == "stopped"} == {"session_start"} and ("ok", "model_checksums") in logged
    assert {r.session_id: r.reason for r in out.failures.collect()}["stopped"] == "models not verified: 1 failing, MISMATCH m p"
    assert set(seen) == {"ok"}


def test_contaminate_from_files(spark, tmp_path):
    """Clips cut from an index of files equal those cut from PCM in a table."""
    from spanweave.operators.clips import wav_bytes
    from spanweave.sources import media

    cols = "session_id string, file_index int, start_ms bigint, end_ms bigint"
    target = spark.createDataFrame([("s", 0, a, b) for a, b in [(0, 2000), (3000, 5000), (5500, 5800)]], cols)
    overlap = spark.createDataFrame([("s", 0, 3500, 4500)], cols)
    clips = spark.createDataFrame(
        [("s", 0, 100, 16000, 1, bytearray(PCM)), ("t", 0, 0, 16000, 1, bytearray(PCM))],
        "session_id string, file_index int, offset_ms bigint, sample_rate int, channels int, pcm binary",
    )
    whole = clips.select("session_id", F.lit("clip.wav").alias("name"), wav_bytes(F.col("pcm"), F.col("sample_rate"), F.col("channels")).alias("wav"))
    media.write_wav_files(whole, str(tmp_path / "in"))
    index, _ = media.read_clip_index(spark, str(tmp_path / "in"))
    index = index.drop("sample_rate", "channels").withColumn("session_id", F.regexp_extract("path", "session_id=(.)/", 1)).join(clips.drop("pcm"), "session_id")
    rows = lambda df, *c: sorted(tuple(r) for r in df.select(*c).collect())
    want = st.contaminate(target, overlap, clips)
    for out in (st.contaminate(target, overlap, index), st.contaminate(target, overlap, index, clips_to=str(tmp_path / "out"))):
        assert rows(out.session_summary, "*") == rows(want.session_summary, "*")
        assert rows(out.clips, "name", "sha256", "segment_start_ms") == rows(want.clips, "name", "sha256", "segment_start_ms")
    assert len(list((tmp_path / "out").rglob("target_*.wav"))) == 1


def test_the_log_is_made_of_kept_records(spark):
    """No plan joins for all kinds of records at once, whose join sides would be at the driver together."""
    clips = spark.createDataFrame([("ok", 0, "clip0.wav", 16000, 1, 96000, "sha", bytearray(PCM))], CLIPS)
    joins = []

    def keep(df):
        if {"stage", "operation", "payload"} <= set(df.columns):
            joins.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join "))
        return materialize(df)

    faces = [("ok", 0, pts, 0, 120, 120, 180, 180, 0.9, T) for pts in [1000, *range(125, 4000, 250)]]
    out = ss.run_sessions(
        clips, spark.createDataFrame([("ok", 0, 0, 64000)], VAD),
        spark.createDataFrame([("ok", "speaking", 0, 150, 150, 1000)], CLICK), spark.createDataFrame(faces, DET),
        mask_model([[True] * 200]), voice(0, 3000), voice(0, 3000), unverified=True, seed_min_ms=100, keep=keep,
    )
    assert max(joins) <= 8 and 0 in joins
    assert "session_end" in {r.operation for r in out.audit.collect()}


def test_no_kept_table_is_broadcast(spark):
    """What joins grows with the sessions, even if it looks small: no side goes to the driver but the totals of chunks."""
    clips = spark.createDataFrame([("ok", 0, "clip0.wav", 16000, 1, 96000, "sha", bytearray(PCM))], CLIPS)
    plans = []

    def keep(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return materialize(df)

    faces = [("ok", 0, pts, 0, 120, 120, 180, 180, 0.9, T) for pts in [1000, *range(125, 4000, 250)]]
    ss.run_sessions(
        clips, spark.createDataFrame([("ok", 0, 0, 64000)], VAD),
        spark.createDataFrame([("ok", "speaking", 0, 150, 150, 1000)], CLICK), spark.createDataFrame(faces, DET),
        mask_model([[True] * 200]), voice(0, 3000), voice(0, 3000), unverified=True, seed_min_ms=100, keep=keep,
    )
    assert sum(p.count("SortMergeJoin") for p in plans) >= 20
    joins = [line for p in plans for line in p.splitlines() if "Broadcast" in line and "Join" in line]
    assert not [j for j in joins if "_chunk" not in j]


def test_registries_of_all_sessions_are_not_broadcast(spark):
    listed = materialize(spark.createDataFrame([("a", "m"), ("b", "m"), ("b", "n")], "session_id string, name string"))
    absent = rg.missing_names(listed, listed.where("name = 'm'"), ["session_id"])
    assert "Broadcast" not in absent._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in absent.collect()] == [("b", "n")]
