"""WAV files read by byte ranges and written as files, without PCM in any shuffle.

An index row has a file's header and where its PCM lies. Segments meet the index, which is small, and are
dealt by (file, first byte): tasks read the byte ranges they need, and a file that holds most segments
spreads over many of them. The sink copies ranges straight into new files.

Files are opened through Arrow's file systems: a local or mounted folder, HDFS, or an object store that
Arrow knows. For stores that only Spark reads, use ``sources.wav`` (PCM as a column).
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from spanweave.functions.timecode import ms_to_samples
from spanweave.operators.clips import SAMPLE_WIDTH, clip_name
from spanweave.operators.timeline import FILE
from spanweave.sources.wav import TARGET_RATE, duration_ms, split_wavs

#: Bytes of media that a task hands over at once (one range may be longer), and reads at once for a hash.
BATCH_BYTES, BLOCK_BYTES = 1 << 25, 1 << 20
#: Tasks per core at most that read headers.
FILE_TASKS = 16
#: Fixed values of RIFF: format codes that mean plain PCM.
PCM_FORMATS = (0x0001, 0xFFFE)
FORMAT = "spanweave-wav"
MANIFEST = "clips.parquet"
_INDEX = (
    "path string, sample_rate int, channels int, sample_width int, n_frames bigint, data_offset bigint, "
    "data_bytes bigint, sha256 string"
)
_RANGE = ("path", "first", "n_bytes", "sample_rate", "channels")
_MANIFEST = pa.schema([("session_id", pa.string()), ("name", pa.string()), ("file", pa.string()), ("n_bytes", pa.int64()), ("sha256", pa.string())])


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark spells it, and the path there."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


class _Opened:
    """The file last opened, kept open while its ranges follow each other."""

    def __init__(self):
        self.path, self.file = None, None

    def at(self, path: str):
        if path != self.path:
            self.close()
            store, place = store_of(path)
            self.path, self.file = path, store.open_input_file(place)
        return self.file

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
        self.path = self.file = None


def wav_header(n_bytes: int, sample_rate: int, channels: int) -> bytes:
    """The 44 bytes before ``n_bytes`` of 16-bit PCM."""
    frame = channels * SAMPLE_WIDTH
    form = struct.pack("<HHIIHH", 1, channels, sample_rate, sample_rate * frame, frame, 8 * SAMPLE_WIDTH)
    return struct.pack("<4sI4s4sI", b"RIFF", n_bytes + 36, b"WAVE", b"fmt ", 16) + form + struct.pack("<4sI", b"data", n_bytes)


def header_of(file, size: int) -> tuple[int, int, int, int, int, int] | None:
    """``rate, channels, sample width, frames, PCM offset, PCM bytes`` read chunk by chunk, or None."""
    if size < 12:
        return None
    riff, _, wave = struct.unpack("<4sI4s", file.read_at(12, 0))
    if (riff, wave) != (b"RIFF", b"WAVE"):
        return None
    at, form = 12, None
    while at + 8 <= size:
        name, length = struct.unpack("<4sI", file.read_at(8, at))
        if name == b"fmt ":
            if length < 16 or at + 24 > size:
                return None
            code, channels, rate, _, _, bits = struct.unpack("<HHIIHH", file.read_at(16, at + 8))
            width = (bits + 7) // 8
            if code not in PCM_FORMATS or not channels or not width:
                return None
            form = (rate, channels, width)
        elif name == b"data":
            if form is None:
                return None
            return (*form, length // (form[1] * form[2]), at + 8, min(length, size - at - 8))
        at += 8 + length + length % 2
    return None


def _sha256(file, size: int) -> str:
    state = hashlib.sha256()
    for at in range(0, size, BLOCK_BYTES):
        state.update(file.read_at(min(BLOCK_BYTES, size - at), at))
    return state.hexdigest()


def _file_tasks(spark: SparkSession) -> int:
    return FILE_TASKS * spark.sparkContext.defaultParallelism


def index_wavs(files: DataFrame, digest: bool = True) -> DataFrame:
    """Headers of the files named by ``path`` and ``length``; an unreadable file gets nulls.

    Only headers are read, and with ``digest`` the files once more, block by block, for their SHA-256.
    """
    schema = pa.schema(
        [("path", pa.string())] + [(n, pa.int32()) for n in ("sample_rate", "channels", "sample_width")]
        + [(n, pa.int64()) for n in ("n_frames", "data_offset", "data_bytes")] + [("sha256", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path, size in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist()):
                opened = _Opened()
                try:
                    head = header_of(opened.at(path), size) or (None,) * 6
                    rows.append((path, *head, _sha256(opened.file, size) if digest else None))
                finally:
                    opened.close()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    # Spark plans a task for every few small files; a Python task each would mostly be start-up.
    return files.select("path", "length").coalesce(_file_tasks(files.sparkSession)).mapInArrow(run, _INDEX).withColumn("duration_ms", duration_ms())


def read_clip_index(spark: SparkSession, path: str, rate: int = TARGET_RATE, digest: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(clips, errors)`` of a folder of WAV files: like ``read_clips``, with places instead of PCM.

    Spark lists the folder and filters on ``path``; no content passes through it. Headers are read
    whenever the index is computed, so write it (``operators.lineage.materialize``) if it is used often.
    """
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").option("recursiveFileLookup", "true").load(path)
    )
    return split_wavs(index_wavs(files, digest), rate)


def ranges(segments: DataFrame, index: DataFrame, start: str, end: str, keys: Sequence[str] = FILE) -> DataFrame:
    """Segments with the bytes ``first, n_bytes`` of ``path`` that hold ``[start, end)`` on the sample grid.

    Dealt by file and place, so that a task reads neighbouring ranges; never past a file's PCM.
    """
    place = index.select(*keys, "path", "sample_rate", "channels", "data_offset", "data_bytes")
    width = F.col("channels").cast("bigint") * SAMPLE_WIDTH
    begin = ms_to_samples(F.col(start), F.col("sample_rate"))
    count = F.greatest(F.lit(0).cast("bigint"), ms_to_samples(F.col(end), F.col("sample_rate")) - begin)
    there = F.greatest(F.lit(0).cast("bigint"), F.col("data_bytes") - begin * width)
    return (
        segments.join(place, list(keys))
        .withColumns({"first": F.col("data_offset") + begin * width, "n_bytes": F.least(count * width, there)})
        .drop("data_offset", "data_bytes")
        .repartitionByRange("path", "first")
        .sortWithinPartitions("path", "first")
    )


def _bounded(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose ranges hold about ``BATCH_BYTES``."""
    start, held = 0, 0
    for i, n in enumerate(batch.column("n_bytes").to_pylist()):
        if i > start and held + n > BATCH_BYTES:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def read_ranges(placed: DataFrame, name: str, header: bool = False) -> DataFrame:
    """Add the bytes of each row's range as column ``name``, as a WAV file with ``header``."""
    kept = [f for f in placed.schema.fields if f.name not in ("path", "first", "n_bytes", name)]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = _Opened()
        try:
            for batch in batches:
                for part in _bounded(batch):
                    found = []
                    for path, first, n, rate, channels in zip(*(part.column(c).to_pylist() for c in _RANGE)):
                        data = opened.at(path).read_at(n, first)
                        found.append(wav_header(len(data), rate, channels) + data if header else data)
                    yield pa.RecordBatch.from_arrays([part.column(c) for c in names] + [pa.array(found, pa.binary())], [*names, name])
        finally:
            opened.close()

    return placed.mapInArrow(run, T.StructType([*kept, T.StructField(name, T.BinaryType())]))


def slices_from_files(intervals: DataFrame, index: DataFrame, keys: Sequence[str] = FILE) -> DataFrame:
    """``operators.clips.cut_slices`` on files: each interval's PCM (``slice``) and ``valid_samples``."""
    placed = ranges(intervals, index, "start_ms", "end_ms", keys)
    cut = read_ranges(placed, "slice").select(*intervals.columns, "slice")
    return cut.withColumn("valid_samples", (F.octet_length("slice") / SAMPLE_WIDTH).cast("bigint"))


def clips_from_files(segments: DataFrame, index: DataFrame, keys: Sequence[str] = FILE) -> DataFrame:
    """``operators.clips.cut_clips`` on files: ``name``, ``wav`` and ``sha256`` of each segment."""
    cut = read_ranges(ranges(segments, index, "start_local_ms", "end_local_ms", keys), "wav", header=True)
    name = clip_name(F.col("file_index"), F.col("start_global_ms"), F.col("end_global_ms"))
    return cut.select(*segments.columns, name.alias("name"), "wav", F.sha2("wav", 256).alias("sha256"))


@dataclass
class _TaskDone(WriterCommitMessage):
    folder: str | None


class _WavWriter(DataSourceArrowWriter):
    """Tasks write below a temporary folder of the job, one folder an attempt; the commit renames the
    folders of the attempts that Spark accepted and deletes the rest."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")
        self.job = uuid.uuid4().hex
        store, place = store_of(self.root)
        found = store.get_file_info(place)
        if found.type == fs.FileType.Directory and store.get_file_info(fs.FileSelector(place)):
            raise ValueError(f"{root} is not empty")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _TaskDone:
        store, place = store_of(self.root)
        folder = f"{place}/_temporary/{self.job}/{uuid.uuid4().hex}"
        opened, manifest, made, sessions = _Opened(), None, {}, set()
        try:
            for batch in iterator:
                rows = []
                for session, name, header, data in self._rows(batch, opened):
                    if session is None or name is None:
                        raise ValueError("a clip needs a session and a name")
                    state = hashlib.sha256(header)
                    state.update(data)
                    sha, inside = state.hexdigest(), f"session_id={quote(session, safe='')}"
                    if (session, name) in made:
                        if made[session, name] != sha:
                            raise ValueError(f"two different clips {name} of session {session}")
                        continue
                    if session not in sessions:
                        store.create_dir(f"{folder}/{inside}", recursive=True)
                        sessions.add(session)
                    with store.open_output_stream(f"{folder}/{inside}/{name}") as out:
                        out.write(header)
                        out.write(data)
                    made[session, name] = sha
                    rows.append((session, name, f"{inside}/{name}", len(header) + len(data), sha))
                if rows:
                    if manifest is None:
                        manifest = pq.ParquetWriter(f"{folder}/{MANIFEST}", _MANIFEST, filesystem=store)
                    manifest.write_batch(pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _MANIFEST)], schema=_MANIFEST))
        finally:
            opened.close()
            if manifest is not None:
                manifest.close()
        return _TaskDone(folder if made else None)

    @staticmethod
    def _rows(batch: pa.RecordBatch, opened: _Opened) -> Iterator[tuple[str, str, bytes, bytes]]:
        """``session, name, header, data`` of a batch of ranges or of whole files."""
        if "wav" in batch.schema.names:
            for session, name, wav in zip(*(batch.column(c) for c in ("session_id", "name", "wav"))):
                yield session.as_py(), name.as_py(), b"", wav.as_buffer()
            return
        for session, name, path, first, n, rate, channels in zip(*(batch.column(c).to_pylist() for c in ("session_id", "name", *_RANGE))):
            data = opened.at(path).read_at(n, first)
            yield session, name, wav_header(len(data), rate, channels), data

    def commit(self, messages: list[_TaskDone | None]) -> None:
        """One rename a task, then a marker with the parts that count."""
        store, place = store_of(self.root)
        store.create_dir(place, recursive=True)
        parts = []
        for number, folder in enumerate(m.folder for m in messages if m is not None and m.folder):
            parts.append(f"part-{number:06d}-{self.job}")
            store.move(folder, f"{place}/{parts[-1]}")
        self._drop(store, place)
        with store.open_output_stream(f"{place}/_SUCCESS") as out:
            out.write(json.dumps({"parts": len(parts)}).encode())

    def abort(self, messages: list[_TaskDone | None]) -> None:
        store, place = store_of(self.root)
        self._drop(store, place)
        for found in store.get_file_info(fs.FileSelector(place, allow_not_found=True)):
            if found.base_name.startswith("part-") and found.base_name.endswith(self.job):
                store.delete_dir(found.path)

    def _drop(self, store: fs.FileSystem, place: str) -> None:
        """Delete this job's attempts, and the folder above if no other job has some."""
        temporary = f"{place}/_temporary"
        if store.get_file_info(f"{temporary}/{self.job}").type != fs.FileType.NotFound:
            store.delete_dir(f"{temporary}/{self.job}")
        if store.get_file_info(temporary).type != fs.FileType.NotFound and not store.get_file_info(fs.FileSelector(temporary)):
            store.delete_dir(temporary)


class WavSink(DataSource):
    """``df.write.format("spanweave-wav")``: one WAV file a row."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: T.StructType, overwrite: bool) -> _WavWriter:
        names = set(schema.names)
        if overwrite or not {"session_id", "name"} <= names or not ("wav" in names or set(_RANGE) <= names):
            raise ValueError("append rows of session_id, name and either wav or " + ", ".join(_RANGE))
        return _WavWriter(self.options["path"])


def write_wav_files(files: DataFrame, path: str) -> DataFrame:
    """Write rows (``session_id, name`` and ``wav``, or a range of another file) as WAV files.

    The files are ``<path>/part-*/session_id=.../<name>``; each part also holds the Parquet table of its
    files, which is returned for all of them (see :func:`written_clips`). The path must be new or
    empty. Attempts of lost, repeated or speculative tasks leave nothing: a file counts only when its
    part was renamed into place by the job's commit. Equal rows that meet in a task are one file.
    """
    spark = files.sparkSession
    spark.dataSource.register(WavSink)
    wanted = ["session_id", "name", *(["wav"] if "wav" in files.columns else _RANGE)]
    rows = files.select(F.col("session_id").cast("string").alias("session_id"), *wanted[1:])
    rows.write.format(FORMAT).mode("append").option("path", path).save()
    return written_clips(spark, path)


def write_clips_from_files(segments: DataFrame, index: DataFrame, path: str, keys: Sequence[str] = FILE) -> DataFrame:
    """Cut segments out of WAV files into new WAV files: bytes go from file to file within a task."""
    placed = ranges(segments, index, "start_local_ms", "end_local_ms", keys)
    name = clip_name(F.col("file_index"), F.col("start_global_ms"), F.col("end_global_ms"))
    return write_wav_files(placed.withColumn("name", name), path)


def written_clips(spark: SparkSession, path: str) -> DataFrame:
    """``session_id, name, file, n_bytes, sha256`` of the files of a committed job."""
    store, place = store_of(path)
    if store.get_file_info(f"{place}/_SUCCESS").type == fs.FileType.NotFound:
        raise ValueError(f"no committed clips under {path}")
    # Only the folders of the parts are listed here: their files may be millions.
    parts = sorted(f.base_name for f in store.get_file_info(fs.FileSelector(place)) if f.base_name.startswith("part-"))
    schema = "session_id string, name string, file string, n_bytes bigint, sha256 string"
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path.rstrip('/')}/{p}/{MANIFEST}" for p in parts])


def written_clip_index(
    spark: SparkSession, path: str, rate: int = TARGET_RATE, digest: bool = True
) -> tuple[DataFrame, DataFrame]:
    """:func:`read_clip_index` of the files of a committed job, which its parts' tables name: no folder is listed."""
    written = written_clips(spark, path)
    folder = F.regexp_replace(F.col("_metadata.file_path"), "[^/]+$", "") if written.inputFiles() else F.lit("")
    place = F.concat(F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B"))), "file")
    files = written.select(place.alias("path"), F.col("n_bytes").alias("length"))
    return split_wavs(index_wavs(files.repartition(_file_tasks(spark)), digest), rate)
