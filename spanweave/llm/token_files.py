"""Token ids as flat binary files with document offsets, written in parallel and memory-mapped.

A data set is a folder of parts. Part ``p`` has

``ids``      the ids of its documents end to end, little-endian unsigned integers, 16 bits wide if
             every id of the vocabulary fits, else 32;
``offsets``  n + 1 little-endian 64-bit integers: where each of its n documents starts in the whole
             data set (not in the part), and where the last one ends;
``docs``     n little-endian 64-bit document ids; ``NO_ID`` stands for null.

Parts follow the order of document ids. The first pass writes ids and counts them by part; prefix sums
over these few counts give every part its base; a second pass writes the offsets. A file's name carries
its task attempt and only files named in the manifest count, so repeated and lost tasks leave no trace
in the data.

Files are opened through Arrow's file systems by the folder's URI, so the folder may be on any shared
storage that Arrow knows. Where that is a file path the files are memory-mapped, else read in ranges.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanweave.llm.bpe import BATCH_BYTES, FragmentEncoder
from spanweave.llm.textbatch import binary_array, slices, span_sums, text_buffer, words
from spanweave.operators.lineage import materialize

NO_ID = -(2**63)
#: Fragments whose ids a worker keeps; some 200 bytes each.
KEPT_FRAGMENTS = 1_000_000
#: Rows that belong to one id are dealt over so many sort keys at most.
SPREAD = 4096
#: Ids that a reading task hands over at once.
READ_IDS = 1 << 20

PART_SCHEMA = "part int, ids_file string, docs_file string, lengths_file string, n_docs long, n_tokens long, width int"
FILE_SCHEMA = "part int, ids_file string, docs_file string, offsets_file string, n_docs long, n_tokens long, width int, base long"


@lru_cache(maxsize=2)
def _encoder(path: str) -> FragmentEncoder:
    return FragmentEncoder(path, KEPT_FRAGMENTS)


_LETTER = np.array([b < 128 and chr(b).isalpha() for b in range(256)])
_STOP = np.isin(np.arange(256), np.frombuffer(b".,;:!?", np.uint8))


def simpler_words(found: pa.Array, at: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Cut words once more between an ASCII letter and one of ``.,;:!?``, and lower A-Z in pure ASCII, so
    that more of them are equal. A special token's text, which has a bar, is left as it is."""
    offsets = np.frombuffer(found.buffers()[1], np.int64)[: len(found) + 1]
    raw = found.buffers()[2]
    flat = np.frombuffer(raw, np.uint8)[: offsets[-1]]
    begins = np.zeros(len(flat) + 1, bool)
    if len(flat):
        begins[1:-1] = _LETTER[flat[:-1]] & _STOP[flat[1:]]
    begins[offsets] = True
    bounds = np.flatnonzero(begins)
    odd = span_sums((flat >= 128) | (flat == ord("|")), bounds) > 0
    upper = (flat >= ord("A")) & (flat <= ord("Z")) & ~np.repeat(odd, np.diff(bounds))
    return binary_array(flat + np.where(upper, np.uint8(32), np.uint8(0)), bounds), np.searchsorted(bounds, offsets)[at]


def _open(root: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)


def _uri(root: str) -> str:
    """``file:/a`` as Spark writes it is ``file:///a`` elsewhere."""
    return "file:///" + root[6:].lstrip("/") if root.startswith("file:/") else root.rstrip("/")


class _Files:
    """The files of one folder, by name."""

    def __init__(self, root: str):
        self.store, self.root = _open(_uri(root))
        self.local = isinstance(self.store, fs.LocalFileSystem)

    def create(self, name: str):
        return self.store.open_output_stream(f"{self.root}/{name}")

    def folder(self) -> None:
        self.store.create_dir(self.root, recursive=True)

    def open(self, name: str):
        path = f"{self.root}/{name}"
        return pa.memory_map(path) if self.local else self.store.open_input_file(path)


def _array(file, dtype: str, start: int, count: int) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.frombuffer(file.read_at(count * size, start * size), dtype)


def write_token_files(
    df: DataFrame, tokenizer: str, root: str, end_id: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Encode every whole text, append ``end_id``, write the files under ``root``; return the manifest.

    For vocabularies whose pre-tokens never contain white space, do not depend on it, never hold an
    ASCII letter before one of ``.,;:!?``, and whose normaliser lowers letters. Documents
    are ordered by id (nulls first); rows of one id by a hash of the text. Repeated rows are all
    written. A null or empty text is the end id alone. An empty table gives an empty manifest.
    """
    id_limit = max(_encoder(tokenizer).tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1)
    dtype = "<u2" if id_limit <= 1 << 16 else "<u4"
    width = np.dtype(dtype).itemsize
    _Files(root).folder()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, encoder, part = _Files(root), _encoder(tokenizer), TaskContext.get().partitionId()
        names = [f"{kind}-{part:06d}-{uuid.uuid4().hex}" for kind in ("ids", "docs", "lengths")]
        outs, n_docs, n_tokens = [], 0, 0
        for batch in batches:
            for piece in slices(batch, "text", BATCH_BYTES):
                outs = outs or [files.create(n) for n in names]
                found, at = simpler_words(*words(*text_buffer(piece.column("text"))))
                ids, lengths = encoder.encode(found)
                ends = np.concatenate([[0], np.cumsum(lengths)])[at[1:]]
                flat = np.insert(ids, ends, end_id).astype(dtype)
                counts = np.diff(ends, prepend=0) + 1
                outs[0].write(flat.tobytes())
                outs[1].write(piece.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                outs[2].write(counts.astype("<i8").tobytes())
                n_docs, n_tokens = n_docs + piece.num_rows, n_tokens + len(flat)
        for out in outs:
            out.close()
        if outs:
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int32()),
                    "ids_file": [names[0]],
                    "docs_file": [names[1]],
                    "lengths_file": [names[2]],
                    "n_docs": [n_docs],
                    "n_tokens": [n_tokens],
                    "width": pa.array([width], pa.int32()),
                }
            )

    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    spread = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SPREAD))
    keys = ["doc_id", "_text", "_row"]
    ordered = (
        rows.withColumns({"_text": F.xxhash64("text"), "_row": spread})
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select("doc_id", "text")
    )
    parts = materialize(ordered.mapInArrow(write, PART_SCHEMA), "token-parts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    based = parts.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(root)
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                with files.open(r["lengths_file"]) as file:
                    lengths = _array(file, "<i8", 0, r["n_docs"])
                offsets = r["base"] + np.concatenate([[0], np.cumsum(lengths)])
                r["offsets_file"] = f"offsets-{r['part']:06d}-{uuid.uuid4().hex}"
                with files.create(r["offsets_file"]) as out:
                    out.write(offsets.astype("<i8").tobytes())
                del r["lengths_file"]
            yield pa.RecordBatch.from_pylist(
                [{k: r[k] for k in FILE_FIELDS} for r in rows], pa.schema(FILE_FIELDS.items())
            )

    # A stated number of tasks: the table is tiny, and tasks by its own size would be one.
    spread_out = based.repartition(max(1, parts.count()), "part")
    return materialize(spread_out.mapInArrow(index, FILE_SCHEMA), "token-manifest")


FILE_FIELDS = {
    "part": pa.int32(),
    "ids_file": pa.string(),
    "docs_file": pa.string(),
    "offsets_file": pa.string(),
    "n_docs": pa.int64(),
    "n_tokens": pa.int64(),
    "width": pa.int32(),
    "base": pa.int64(),
}


def read_token_files(manifest: DataFrame, root: str) -> DataFrame:
    """The documents of a data set: ``doc_id, start, n_tokens, ids``.

    ``ids`` holds little-endian unsigned 32-bit integers, whatever the width in the file.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(root)
        for batch in batches:
            for r in batch.to_pylist():
                dtype = f"<u{r['width']}"
                with files.open(r["docs_file"]) as docs_file, files.open(r["offsets_file"]) as offsets_file, files.open(r["ids_file"]) as ids_file:
                    docs = _array(docs_file, "<i8", 0, r["n_docs"])
                    offsets = _array(offsets_file, "<i8", 0, r["n_docs"] + 1)
                    first = 0
                    while first < len(docs):
                        last = int(np.searchsorted(offsets, offsets[first] + READ_IDS, side="right")) - 1
                        last = min(max(last, first + 1), len(docs))
                        span = offsets[first : last + 1]
                        ids = _array(ids_file, dtype, int(span[0] - r["base"]), int(span[-1] - span[0]))
                        bounds = ((span - span[0]) * 4).astype(np.int32)
                        raw = pa.py_buffer(ids.astype("<u4").tobytes())
                        part = docs[first:last]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(part, pa.int64(), mask=part == NO_ID),
                                pa.array(span[:-1], pa.int64()),
                                pa.array(np.diff(span), pa.int64()),
                                pa.Array.from_buffers(pa.binary(), last - first, [None, pa.py_buffer(bounds), raw]),
                            ],
                            ["doc_id", "start", "n_tokens", "ids"],
                        )
                        first = last

    spread_out = manifest.repartition(max(1, manifest.count()), "part")
    return spread_out.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")
