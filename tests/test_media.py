import io
import wave
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from spanweave.operators import clips as cl
from spanweave.sources import media
from spanweave.sources import wav as wavs
from tests.test_sources import wav

SEGMENT = "session_id string, file_index int, start_local_ms bigint, end_local_ms bigint, start_global_ms bigint, end_global_ms bigint"
RATE = 16000


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("media")
    for i, n in enumerate([16000, 8001, 96000, 0]):
        (root / f"{i}.wav").write_bytes(wav(n))
    (root / "c.wav").write_bytes(wav(10, rate=8000))
    (root / "d.wav").write_bytes(wav(10, channels=2))
    (root / "e.wav").write_bytes(wav(10, width=1))
    (root / "f.wav").write_bytes(b"no")
    (root / "g.wav").write_bytes(b"RIFF____WAVEfmt ")
    (root / "h.wav").write_bytes(wav(500)[:-300])  # cut short: the header promises more
    extra = wav(400)
    (root / "i.wav").write_bytes(extra[:12] + b"LIST\x03\x00\x00\x00abc\x00" + extra[12:])  # an odd chunk first
    return root


def keyed(df):
    return df.select(F.regexp_extract("path", r"([^/]+)\.wav$", 1).alias("k"), *[c for c in df.columns if c != "path"])


def test_index_equals_parsing_whole_files(spark, folder):
    clips, errors = media.read_clip_index(spark, str(folder))
    want, want_errors = wavs.read_clips(spark, str(folder))
    columns = ["k", "sample_rate", "channels", "n_frames", "sha256", "duration_ms"]
    got = {tuple(r) for r in keyed(clips).select(columns).collect()}
    assert got == {tuple(r) for r in keyed(want).select(columns).collect()}
    assert {tuple(r) for r in errors.collect()} == {tuple(r) for r in want_errors.collect()}
    bounds = {r.k: (r.data_offset, r.data_bytes) for r in keyed(clips).collect()}
    assert bounds["0"] == (44, 32000) and bounds["h"] == (44, 700) and bounds["i"] == (56, 800)


def index_of(spark, folder):
    clips, _ = media.read_clip_index(spark, str(folder), digest=False)
    number = F.regexp_extract("path", r"([^/]+)\.wav$", 1)
    return clips.where(number.rlike("^[0-9]$|^h$")).withColumns(
        {"session_id": F.lit("a b/c+d"), "file_index": F.when(number == "h", 9).otherwise(number.cast("int"))}
    )


def segments(spark):
    bounds = [(0, 0, 1000), (0, 50, 950), (1, 100, 9000), (2, 0, 6000), (2, 1, 2), (2, 5999, 6000), (2, 7000, 8000), (3, 0, 5), (9, 0, 31)]
    return spark.createDataFrame([("a b/c+d", f, s, e, s + 1000, e + 1000) for f, s, e in bounds], SEGMENT)


def with_pcm(spark, folder):
    pcm = spark.createDataFrame(
        [(int(p.stem) if p.stem != "h" else 9, bytearray(p.read_bytes()[44:])) for p in map(Path, folder.glob("[0-9h].wav"))],
        "file_index int, pcm binary",
    )
    return index_of(spark, folder).join(pcm, "file_index")


def test_slices_and_clips_equal_those_of_the_table(spark, folder):
    seg, index, table = segments(spark), index_of(spark, folder), with_pcm(spark, folder)
    got = media.clips_from_files(seg, index)
    want = cl.cut_clips(seg, table)
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    cut = seg.select("session_id", "file_index", F.col("start_local_ms").alias("start_ms"), F.col("end_local_ms").alias("end_ms"))
    got, want = media.slices_from_files(cut, index), cl.cut_slices(cut, table)
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_no_media_in_any_shuffle(spark, folder):
    seg, index = segments(spark), index_of(spark, folder)
    executed = media.clips_from_files(seg, index)._jdf.queryExecution().executedPlan().toString()
    (scan,) = [line for line in executed.splitlines() if "binaryFile" in line]
    assert "ReadSchema: struct<path:string,length:bigint>" in scan
    # Media appear only in the map over ranges, above every exchange.
    lines = executed.splitlines()
    exchanges = [i for i, line in enumerate(lines) if "Exchange" in line]
    maps = [i for i, line in enumerate(lines) if "MapInArrow" in line]
    assert exchanges and len(maps) == 2 and maps[0] < exchanges[0] and all(maps[1] > i or "pcm" not in lines[i] for i in exchanges)


def test_written_files_equal_the_table(spark, folder, tmp_path):
    seg, index = segments(spark), index_of(spark, folder)
    out = tmp_path / "out"
    table = media.write_clips_from_files(seg.union(seg.limit(2)), index, str(out))
    want = {(r.session_id, r["name"]): (len(r.wav), r.sha256, bytes(r.wav)) for r in media.clips_from_files(seg, index).collect()}
    got = table.collect()
    assert {(r.session_id, r["name"]): (r.n_bytes, r.sha256) for r in got} == {k: v[:2] for k, v in want.items()} and len(got) == len(want)
    files = {p.name: p.read_bytes() for p in out.rglob("*.wav")}
    assert files == {name: v[2] for (_, name), v in want.items()}
    assert not (out / "_temporary").exists() and (out / "_SUCCESS").exists()
    # The files are read back as clips.
    back, errors = media.read_clip_index(spark, str(out))
    assert errors.count() == 0 and {r.sha256 for r in back.collect()} == {v[1] for v in want.values()}
    with wave.open(io.BytesIO(files["target_f000_000001050-000001950.wav"])) as w:
        assert (w.getframerate(), w.getnchannels(), w.getnframes()) == (RATE, 1, 14400)
    with pytest.raises(Exception, match="not empty"):
        media.write_clips_from_files(seg, index, str(out))


def test_a_failed_job_leaves_nothing(spark, folder, tmp_path):
    seg, index = segments(spark), index_of(spark, folder)
    out = tmp_path / "out"
    rows = media.clips_from_files(seg, index).select("session_id", "name", "wav")
    failing = rows.withColumn("wav", F.when(F.col("name").contains("f009"), F.raise_error(F.lit("lost")).cast("binary")).otherwise(F.col("wav")))
    with pytest.raises(Exception, match="lost"):
        media.write_wav_files(failing, str(out))
    assert not list(tmp_path.rglob("*.wav")) and not list(tmp_path.rglob("part-*"))
    with pytest.raises(ValueError, match="no committed clips"):
        media.written_clips(spark, str(out))
    # The same path can be used again.
    assert media.write_wav_files(rows, str(out)).count() == rows.count()


def test_clips_of_one_name_that_differ_are_refused(spark, tmp_path):
    rows = [("s", "x.wav", bytearray(wav(3))), ("s", "x.wav", bytearray(wav(4)))]
    df = spark.createDataFrame(rows, "session_id string, name string, wav binary").coalesce(1)
    with pytest.raises(Exception, match="two different clips"):
        media.write_wav_files(df, str(tmp_path / "out"))
    with pytest.raises(Exception, match="needs a session"):
        media.write_wav_files(df.withColumn("session_id", F.lit(None).cast("string")), str(tmp_path / "out"))


def test_index_of_written_files_equals_that_of_their_folder(spark, tmp_path):
    """The parts' tables name the files, so that a folder of millions is not listed."""
    out = tmp_path / "a folder+%41"
    rows = [(s, f"clip{i}.wav", bytearray(media.wav_header(2 * i, RATE, 1) + bytes(2 * i))) for s in ("s", "d+e/f %2B") for i in range(9)]
    written = media.write_wav_files(spark.createDataFrame(rows, "session_id string, name string, wav binary"), str(out))
    assert all(f.endswith(media.MANIFEST) for f in written.inputFiles()) and written.count() == 18
    found, _ = media.written_clip_index(spark, str(out), RATE)
    listed, _ = media.read_clip_index(spark, str(out), RATE)
    # Spark lists local paths as URIs of its own spelling.
    bare = lambda df: sorted((r.path.replace("file:", "").replace("//", ""), r.n_frames, r.data_offset, r.sha256) for r in df.collect())
    assert bare(found) == bare(listed) and len(bare(found)) >= 16
    none = media.write_wav_files(spark.createDataFrame([], "session_id string, name string, wav binary"), str(tmp_path / "none"))
    assert none.count() == 0 and media.written_clip_index(spark, str(tmp_path / "none"), RATE)[0].count() == 0


def test_empty_tables(spark, folder, tmp_path):
    index = index_of(spark, folder)
    assert media.clips_from_files(segments(spark).limit(0), index).count() == 0
    assert media.write_clips_from_files(segments(spark).limit(0), index, str(tmp_path / "out")).count() == 0
