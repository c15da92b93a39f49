import io
import json
import wave

import pytest
from pyspark.sql import functions as F

from spanweave.operators import audit as au
from spanweave.operators import clips as cl
from spanweave.operators import registry as rg
from spanweave.plans.compare import sanitize, sanitize_logs
from spanweave.sources import documents as docs
from spanweave.sources import logs, media
from spanweave.sources import wav as wavs
from tests.test_audit import records


def wav(n_frames, rate=16000, channels=1, width=2):
    buf = io.BytesIO()
    with wave.open(buf, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(width)
        w.setframerate(rate)
        w.writeframes(bytes(i % 251 for i in range(n_frames * channels * width)))
    return buf.getvalue()


def test_read_clips(spark, tmp_path):
    good = {"a.wav": wav(16000), "b.wav": wav(8001)}
    bad = {"c.wav": wav(10, rate=8000), "d.wav": wav(10, channels=2), "e.wav": wav(10, width=1), "f.wav": b"no"}
    for name, data in {**good, **bad}.items():
        (tmp_path / name).write_bytes(data)
    clips, errors = wavs.read_clips(spark, str(tmp_path))
    got = {r.path.rsplit("/", 1)[1]: r for r in clips.collect()}
    assert {k: (r.n_frames, r.duration_ms) for k, r in got.items()} == {"a.wav": (16000, 1000), "b.wav": (8001, 500)}
    assert bytes(got["a.wav"].pcm) == good["a.wav"][44:]
    reasons = {r.path.rsplit("/", 1)[1]: r.reason for r in errors.collect()}
    assert reasons == {
        "c.wav": "not 16000 Hz mono", "d.wav": "not 16000 Hz mono", "e.wav": "not 16-bit",
        "f.wav": "unreadable wav",
    }
    with pytest.raises(Exception, match="not a 16-bit"):
        wavs.read_clips(spark, str(tmp_path), strict=True)[0].collect()


def test_unreadable_clips_have_null_durations(spark, tmp_path):
    (tmp_path / "f.wav").write_bytes(b"no")
    files = spark.read.format("binaryFile").load(str(tmp_path))
    for parsed in (wavs.parse_wavs(files), media.index_wavs(files)):
        assert [(r.sample_rate, r.duration_ms) for r in parsed.collect()] == [(None, None)]
    with pytest.raises(Exception, match="f.wav: not a 16-bit"):
        wavs.read_clips(spark, str(tmp_path), strict=True)[0].collect()


def test_cut_clips_are_byte_exact(spark):
    data = wav(96000)
    clips = spark.createDataFrame(
        [("s", 0, 16000, 1, bytearray(data[44:]))],
        "session_id string, file_index int, sample_rate int, channels int, pcm binary",
    )
    seg = spark.createDataFrame(
        [("s", 0, 50, 1950, 1050, 2950), ("s", 0, 5900, 9000, 6900, 10000)],
        "session_id string, file_index int, start_local_ms bigint, end_local_ms bigint, "
        "start_global_ms bigint, end_global_ms bigint",
    )
    cut = cl.cut_clips(seg, clips).orderBy("start_local_ms").collect()
    assert cut[0]["name"] == "target_f000_000001050-000002950.wav"
    for row, (a, b) in zip(cut, [(800, 31200), (94400, 96000)]):
        buf = io.BytesIO()
        with wave.open(buf, "wb") as w:
            w.setnchannels(1)
            w.setsampwidth(2)
            w.setframerate(16000)
            w.writeframes(data[44 + 2 * a : 44 + 2 * b])
        assert bytes(row.wav) == buf.getvalue()


def test_batches_by_length():
    sizes = [5, 100, 1, 5, 7, 0, 40]
    batches = [list(b) for b in cl.length_batches(sizes, 30)]
    assert sorted(sum(batches, [])) == list(range(7)) and batches[-1] == [1] and batches[-2] == [6]
    assert all(len(b) == 1 or len(b) * max(sizes[i] for i in b) <= 30 for b in batches)
    assert cl.length_batches([], 30) == []


@pytest.mark.parametrize("window", [1, 50, 10_000])
def test_batched_model_keeps_order_and_bounds(spark, window):
    rows = [(i, "y" * ((i * 37) % 23) if i % 9 else None) for i in range(120)]
    df = spark.createDataFrame(rows, "id bigint, s string").coalesce(1).withColumn("size", F.octet_length("s"))

    def factory():
        def run(pdf):
            sizes = pdf["size"].fillna(0)
            assert len(pdf) == 1 or len(pdf) * sizes.max() <= 60
            return pdf[["id"]].assign(y=sizes.astype("int64") + pdf["id"])

        return run

    batched = cl.map_model_batched(df, factory, "id bigint, y bigint", "size", 60, window).collect()
    assert [tuple(r) for r in batched] == [(i, i + len(s or "")) for i, s in rows]  # as row by row, in input order
    assert cl.map_model_batched(df.limit(0), factory, "id bigint, y bigint", "size").count() == 0
    short = lambda: lambda p: p.iloc[:0][["id"]].assign(y=0)
    with pytest.raises(Exception, match="returned 0 rows"):
        cl.map_model_batched(df, short, "id bigint, y bigint", "size").collect()


def test_pad_batch_and_map_model(spark):
    batch, valid = cl.pad_batch([b"\x00\x40" * 3, b"", b"\x01\x00" * 700])
    assert batch.shape == (3, 700) and list(valid) == [3, 0, 700]
    assert batch[0, 2] == 0.5 and batch[0, 3] == 0
    assert cl.pad_batch([b"\x00\x00"])[0].shape == (1, 640)

    df = spark.range(100).repartition(3)

    def model(scalar):
        def factory():
            def run(pdf):
                if scalar:
                    return pdf.assign(y=[i * 2 for i in pdf["id"]])
                return pdf.assign(y=pdf["id"] * 2)

            return run

        return factory

    a = cl.map_model(df, model(False), "id bigint, y bigint").collect()
    assert sorted(a) == sorted(cl.map_model(df, model(True), "id bigint, y bigint").collect())
    with pytest.raises(Exception, match="returned 0 rows"):
        cl.map_model(df, lambda: lambda p: p.iloc[:0].assign(y=0), "id bigint, y bigint").collect()


def test_turn_documents_round_trip(spark, tmp_path):
    rows = [("s", "B", 5, 9), ("s", "A", 5, 9), ("s", "A", 0, 4000), ("s", "A", 5, 9), ("t", 'q"', 1, 2)]
    turns = spark.createDataFrame(rows, "session_id string, speaker_id string, start_ms bigint, end_ms bigint")
    docs.write_turns(turns, str(tmp_path / "out"))
    (part,) = (tmp_path / "out" / "session_id=s").glob("part-*")
    doc = json.loads(part.read_text())
    assert doc["num_segments"] == 4 and doc["num_speakers"] == 2 and doc["speakers"] == ["A", "B"]
    assert doc["total_speech_ms"] == 4012
    keys = [(d["start_ms"], d["end_ms"], d["speaker_id"]) for d in doc["segments"]]
    assert keys == sorted(keys)
    back = docs.read_turns(spark, str(tmp_path / "out" / "*" / "part-*"))
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows)


def test_read_turns_drops_empty_and_rejects_malformed(spark, tmp_path):
    seg = [{"start_ms": 1, "end_ms": 5, "speaker_id": "a"}, {"start_ms": 5, "end_ms": 5, "speaker_id": "a"}]
    (tmp_path / "x.json").write_text(json.dumps({"segments": seg}, indent=1))
    assert [tuple(r) for r in docs.read_turns(spark, str(tmp_path)).collect()] == [("x", "a", 1, 5)]
    (tmp_path / "x.json").write_text(json.dumps({"segments": [{"start_ms": 1, "speaker_id": "a"}]}))
    with pytest.raises(Exception, match="malformed segment"):
        docs.read_turns(spark, str(tmp_path)).collect()


def test_read_clicks(spark, tmp_path):
    click = {"file_index": 0, "x": "150", "y": 150.7, "pts_ms": 1000}
    (tmp_path / "a.json").write_text(json.dumps({"speaking_click": click, "anti_click": None}))
    (tmp_path / "b.json").write_text(json.dumps({"speaking_click": click, "anti_click": click}))
    got = sorted(tuple(r) for r in docs.read_clicks(spark, str(tmp_path)).collect())
    assert got == [(s, k, 0, 150, 150, 1000) for s, k in [("a", "speaking"), ("b", "anti"), ("b", "speaking")]]
    for broken in ({}, {"speaking_click": {**click, "x": None}}, {"speaking_click": 5}):
        (tmp_path / "b.json").write_text(json.dumps(broken))
        with pytest.raises(Exception, match="malformed click"):
            docs.read_clicks(spark, str(tmp_path)).collect()


def test_registry(spark, tmp_path):
    for name in ("m1", "m2"):
        (tmp_path / name).write_bytes(name.encode())
    files = rg.file_hashes(spark.read.format("binaryFile").load(str(tmp_path / "m*"))).withColumn(
        "path", F.regexp_extract("path", "[^/]+$", 0)
    )
    listed = spark.createDataFrame([("one", "m1"), ("two", "m2")], "name string, path string")
    reg = rg.build_registry(listed, files)
    doc = {r["name"]: {"path": r.path, "sha256": r.sha256.upper()} for r in reg.collect()}
    (tmp_path / "reg.json").write_text(json.dumps(doc))
    read = docs.read_registry(spark, str(tmp_path / "reg.json"))
    assert sorted(read.collect()) == sorted(reg.collect())
    status = lambda r, req=(): {x["name"]: x.status for x in rg.verify_registry(r, files, req).collect()}
    assert status(read, ["one", "zero"]) == {"one": "OK", "two": "OK", "zero": "REQUIRED"}
    edited = read.withColumn("sha256", F.when(F.col("name") == "one", "00").otherwise(""))
    assert status(edited) == {"one": "MISMATCH", "two": "NO-HASH"}
    gone = read.withColumn("path", F.lit("nowhere"))
    assert set(status(gone).values()) == {"MISSING"}
    for bad, how in [(edited, "MISMATCH one"), (gone, "MISSING")]:
        with pytest.raises(Exception, match=how):
            rg.verify_registry(bad, files, strict=True).collect()
    with pytest.raises(Exception, match="file not found"):
        rg.build_registry(gone, files).collect()
    (tmp_path / "reg.json").write_text("{}")
    with pytest.raises(Exception, match="non-empty"):
        docs.read_registry(spark, str(tmp_path / "reg.json")).collect()


def test_audit_log_round_trip(spark, tmp_path):
    chain = au.chain_build(records(spark, {"a": 40, "b": 3}), ["n"]).cache()
    logs.write_audit(chain, str(tmp_path / "logs"))
    # small splits: one log is read in many pieces and must keep its order
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        back, failures = logs.read_audit(spark, str(tmp_path / "logs"))
        rows = back.orderBy("session_id", "position").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [(r.session_id, r.position, r.seq) for r in rows] == (
        [("a", i, i) for i in range(40)] + [("b", i, i) for i in range(3)]
    )
    assert failures.count() == 0
    assert all(r.valid for r in au.chain_verify(back, position="position").collect())
    same = ["session_id", "seq", "operation", "payload", "audit", "prev_sha256", "entry_sha256", "schema"]
    assert sorted(map(str, back.select(*same).collect())) == sorted(map(str, chain.select(*same).collect()))


def test_many_logs_share_files(spark, tmp_path):
    """Two hundred logs in few files, one of them long, with sessions that need escaping; then one append more."""
    sizes = {f"s{i}": 2 for i in range(200)} | {"long": 300, "d+e/f": 3, "tab\there %41": 2}
    whole, path = records(spark, sizes), str(tmp_path / "log")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        logs.append_audit(whole.where("n < 1"), ["n"], path, bundled=True)
        assert logs.append_audit(whole.where("n >= 1"), ["n"], path, bundled=True).count() == 0
        got, failures = appended(spark, path)
        found = logs.read_audit(spark, path)[0].select("session_id", "position", "seq").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = au.chain_build(whole, ["n"])
    assert failures == [] and got == sorted(want.select(got[0].__fields__).collect(), key=str)
    assert sorted((r.session_id, r.seq) for r in found) == sorted((s, i) for s, n in sizes.items() for i in range(n))
    assert all(r.position == r.seq for r in found)
    assert len(list((tmp_path / "log").glob("append=*/**/part-*"))) <= 16


def test_read_audit_reports_bad_logs(spark, tmp_path):
    rec = {"schema": "x-manifest-v1", "seq": 0, "operation": "o", "payload": {"b": 1.50, "a": 1e-5}}
    (tmp_path / "good.manifest.jsonl").write_text("\n" + json.dumps(rec) + "\n\n" + "{broken\n[1]\n")
    (tmp_path / "blank.jsonl").write_text("\n  \n")
    (tmp_path / "foreign.jsonl").write_text('{"seq": 0}\n')
    records_, failures = logs.read_audit(spark, str(tmp_path))
    good = records_.where("session_id = 'good'").collect()
    assert [(r.position, r.payload, r.audit) for r in good] == [(1, '{"a":1e-05,"b":1.5}', "{}")]
    reasons = sorted((r.session_id, r.reason.split(":")[0]) for r in failures.collect())
    assert reasons == [
        ("blank", "log is empty"),
        ("foreign", "first record is not a *-manifest-v1 record"),
        ("good", "line 4 is not valid JSON"),
        ("good", "line 5 is not a JSON object"),
    ]
    with pytest.raises(Exception, match="good line [45] is not"):
        logs.read_audit(spark, str(tmp_path), strict=True)[0].collect()


def test_sanitize(spark, tmp_path):
    lines = {
        "a": ['{"schema":"toolname-manifest-v1","p":"/x/ToolName/y"}', '{"q":1}'],
        "b": ['{"schema":"ab-manifest-v1"}'],
        "c": ['{"schema":"other"}'],
    }
    df = spark.createDataFrame(
        [(s, i, ln) for s, ls in lines.items() for i, ln in enumerate(ls)],
        "session_id string, position bigint, line string",
    )
    clean, failures = sanitize(df, "anon")
    got = clean.orderBy("position").collect()
    assert [(r.line, r.n_redacted) for r in got] == [
        ('{"schema":"anon-manifest-v1","p":"/x/anon/y"}', 2), ('{"q":1}', 0)
    ]
    assert {r.session_id for r in failures.collect()} == {"b", "c"}
    forced, none = sanitize(df, "anon", forced_token="ab")
    assert none.count() == 0 and forced.agg(F.sum("n_redacted")).first()[0] == 1
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.jsonl").write_text("\n".join(lines["a"]) + "\n")
    with pytest.raises(ValueError):
        sanitize_logs(spark, str(src), str(src) + "/")
    assert sanitize_logs(spark, str(src), str(tmp_path / "out"), "anon").count() == 0
    (part,) = (tmp_path / "out" / "session_id=a").glob("part-*.txt")
    assert part.read_text().splitlines() == [r.line for r in got]


def appended(spark, path):
    found, failures = logs.read_audit(spark, path)
    return sorted(found.drop("position").collect(), key=str), failures.collect()


def test_two_appends_equal_one_build(spark, tmp_path):
    whole = records(spark, {"a": 9, "b": 4, "c": 1, "d+e/f": 3})
    want = au.chain_build(whole, ["n"])
    path = str(tmp_path / "log")
    first = whole.where("session_id = 'a' AND n < 5 OR session_id = 'b' AND n < 4")
    assert logs.append_audit(first, ["n"], path).count() == 0
    assert logs.append_audit(whole.subtract(first), ["n"], path).count() == 0
    got, failures = appended(spark, path)
    assert failures == [] and got == sorted(want.select(got[0].__fields__).collect(), key=str)
    state = {r.session_id: (r.n_records, r["append"]) for r in logs.log_state(spark, path).collect()}
    assert state == {"a": (9, 1), "b": (4, 0), "c": (1, 1), "d+e/f": (3, 1)}
    assert {r.session_id: r.tail_sha256 for r in logs.log_state(spark, path).collect()} == {
        r.session_id: r.tail_sha256 for r in au.chain_tails(want).collect()
    }
    # A finished append is left as it is, and none is inserted before it.
    assert logs.append_audit(whole, ["n"], path, append=1).count() == 0 and appended(spark, path)[0] == got
    logs.append_audit(whole.where("session_id = 'c'"), ["n"], path, append=5)
    with pytest.raises(ValueError, match="append 3 after append 5"):
        logs.append_audit(whole, ["n"], path, append=3)
    assert all(r.valid for r in au.chain_verify(logs.read_audit(spark, path)[0], position="position").collect())


def test_an_interrupted_append_is_repeated(spark, tmp_path):
    whole = records(spark, {"a": 9, "b": 4})
    path = str(tmp_path / "log")
    logs.append_audit(whole.where("n < 3"), ["n"], path)
    logs.append_audit(whole.where("n >= 3"), ["n"], path)
    (tmp_path / "log" / "_state" / "000000001" / "_SUCCESS").unlink()  # ended before its commit
    logs.append_audit(whole.where("n >= 3"), ["n"], path)
    got, _ = appended(spark, path)
    want = au.chain_build(whole, ["n"])
    assert got == sorted(want.select(got[0].__fields__).collect(), key=str)


def test_a_changed_log_is_not_appended_to(spark, tmp_path):
    whole = records(spark, {"a": 4, "b": 4, "c": 4, "d": 4})
    path = tmp_path / "log"
    logs.append_audit(whole.where("n < 2"), ["n"], str(path))
    for session, change in [("a", lambda t: t.rsplit("\n", 2)[0] + "\n"), ("b", lambda t: t.replace('"k"', '"q"')), ("c", lambda t: "")]:
        for file in (path / "append=000000000" / f"session_id={session}").glob("part-*"):
            file.write_text(change(file.read_text()))
            for crc in file.parent.glob(f".{file.name}.crc"):
                crc.unlink()
    failures = logs.append_audit(whole.where("n >= 2"), ["n"], str(path))
    assert {r.session_id for r in failures.collect()} == {"a", "b", "c"}
    sizes = {r.session_id: r.n_records for r in logs.log_state(spark, str(path)).collect()}
    assert sizes == {"a": 2, "b": 2, "c": 2, "d": 4}


def test_appending_stream(spark, tmp_path):
    whole = records(spark, {"a": 6, "b": 5})
    for lo, hi in [(0, 2), (3, 9)]:
        whole.where(F.col("n").between(lo, hi)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    path = str(tmp_path / "log")
    stream = spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    for _ in range(2):  # the second run finds nothing new
        writer = logs.append_stream(stream, ["n"], path, str(tmp_path / "cp"))
        writer.trigger(availableNow=True).start().awaitTermination(180)
    got, _ = appended(spark, path)
    assert got == sorted(au.chain_build(whole, ["n"]).select(got[0].__fields__).collect(), key=str)


def test_broken_turn_documents_are_failures(spark, tmp_path):
    good = {"segments": [{"start_ms": 1.9, "end_ms": "7", "speaker_id": 3}, {"start_ms": 5, "end_ms": 5, "speaker_id": "a"}, {"start_ms": True, "end_ms": 4, "speaker_id": None}]}
    docs_ = {
        "good": good, "named": {"session_id": "other", "segments": [{"start_ms": 9007199254740993, "end_ms": 9007199254740994, "speaker_id": "é"}]},
        "none": {}, "list": [1], "seg": {"segments": 4}, "fraction": {"segments": [{"start_ms": "1.5", "end_ms": 3, "speaker_id": "a"}]},
        "lacking": {"segments": [{"start_ms": 1, "end_ms": 3}]}, "inner": {"segments": [7]},
    }
    for name, doc in docs_.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(doc, indent=1))
    (tmp_path / "text.json").write_text("{")
    turns, failures = docs.load_turns(spark, str(tmp_path))
    assert sorted(tuple(r) for r in turns.collect()) == [
        ("good", "3", 1, 7), ("good", "None", 1, 4), ("other", "é", 9007199254740993, 9007199254740994),
    ]
    got = {r.session_id: r.reason for r in failures.collect()}
    assert got == {
        "list": "not a JSON object", "seg": "segments is no list", "text": "not valid JSON",
        "fraction": 'malformed segment {"end_ms":3,"speaker_id":"a","start_ms":"1.5"}',
        "lacking": 'malformed segment {"end_ms":3,"start_ms":1}', "inner": "malformed segment 7",
    }


def test_broken_clicks_are_failures(spark):
    click = {"file_index": 0, "x": "150", "y": 150.7, "pts_ms": 9007199254740993}
    rows = {
        "ok": {"speaking_click": click, "anti_click": click}, "no_anti": {"speaking_click": click, "anti_click": 5},
        "bad_anti": {"speaking_click": click, "anti_click": {"x": 1}}, "quoted": {"speaking_click": {**click, "x": "3.7"}},
        "null": {"speaking_click": None}, "list": [],
    }
    df = spark.createDataFrame([(k, json.dumps(d)) for k, d in rows.items()] + [("text", "no"), ("nothing", None)], "session_id string, value string")
    clicks, failures = docs.judge_clicks(df)
    assert sorted(tuple(r) for r in clicks.collect()) == [
        (s, k, 0, 150, 150, 9007199254740993) for s, k in [("no_anti", "speaking"), ("ok", "anti"), ("ok", "speaking")]
    ]
    assert {r.session_id: r.reason for r in failures.collect()} == {
        "bad_anti": "malformed click: anti_click", "quoted": "malformed click: speaking_click", "null": "malformed click: speaking_click",
        "list": "not a JSON object", "text": "not valid JSON", "nothing": "not valid JSON",
    }


def test_a_long_turn_document_has_many_parts(spark, tmp_path):
    rows = [("hot", f"s{i % 3}", i, i + 5) for i in range(3000)] + [("a+b/c", "x", 1, 2), ("a+b/c", "x", 1, 2)]
    turns = spark.createDataFrame(rows, "session_id string, speaker_id string, start_ms bigint, end_ms bigint")
    about = spark.createDataFrame(
        [("hot", "in.wav", 16000, {"torch": "2"}, None), ("a+b/c", None, 8000, {}, "m"), ("silent", "s", 1, {}, "m")],
        "session_id string, source string, sample_rate int, library_versions map<string,string>, model string",
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        docs.write_turns(turns, str(tmp_path / "out"), provenance=about)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted((tmp_path / "out" / "session_id=hot").glob("part-*"))
    assert len(parts) > 1
    doc = json.loads("".join(p.read_text() for p in parts))
    assert doc["num_segments"] == 3000 and doc["speakers"] == ["s0", "s1", "s2"]
    assert (doc["source"], doc["sample_rate"], doc["library_versions"], doc["model"]) == ("in.wav", 16000, {"torch": "2"}, None)
    assert [s["start_ms"] for s in doc["segments"]] == list(range(3000))
    silent = json.loads("".join(p.read_text() for p in sorted((tmp_path / "out" / "session_id=silent").glob("part-*"))))
    assert silent["segments"] == [] and silent["speakers"] == [] and silent["total_speech_ms"] == 0
    assert sorted(tuple(r) for r in docs.read_written_turns(spark, str(tmp_path / "out")).collect()) == sorted(rows)
