"""Whole texts inside Arrow batches, as one byte buffer with document offsets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: The bytes between words, everywhere in this subpackage.
SPACES = b" \t\n\x0b\x0c\r"
SPACE_TABLE = np.isin(np.arange(256), np.frombuffer(SPACES, np.uint8))


#: Rows of an Arrow batch that holds texts.
BATCH_ROWS = 1000


def short_batches(spark: SparkSession) -> None:
    """Make the session's Arrow batches short enough for long texts, if they are not."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def text_buffer(column: pa.Array) -> tuple[bytes, np.ndarray]:
    """The texts' UTF-8 bytes end to end and n + 1 offsets into them; a null counts as empty."""
    column = pc.fill_null(column, "") if column.null_count else column
    if len(column) == 0:
        return b"", np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    starts = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = data.slice(starts[0], starts[-1] - starts[0]).to_pybytes() if data is not None else b""
    return raw, starts - starts[0]


def slices(batch: pa.RecordBatch, name: str, budget: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts hold about ``budget`` bytes; one text is never cut."""
    sizes = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[start] + budget, side="right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def binary_array(raw: bytes | np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The spans between ``bounds`` of a buffer, not copied."""
    offsets = pa.py_buffer(np.ascontiguousarray(bounds, np.int64))
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, offsets, pa.py_buffer(raw)])


def words(raw: bytes, offsets: np.ndarray, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of all texts end to end, and n + 1 offsets into them.

    ``lower`` maps A-Z to a-z and nothing else.
    """
    raw = raw.lower() if lower else raw
    flat = np.frombuffer(raw, np.uint8)
    inside = ~SPACE_TABLE[flat]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < len(flat)]
    begins[firsts] = inside[firsts]  # a text may end without a space
    kept = np.zeros(len(flat) + 1, np.int64)
    np.cumsum(inside, out=kept[1:])
    bounds = np.append(kept[:-1][begins], kept[-1])
    return binary_array(flat[inside], bounds), np.concatenate([[0], np.cumsum(begins)])[offsets]


def span_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over the spans between offsets, empty spans included."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def gather_spans(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``flat[s : s + n]`` of every span, end to end."""
    ends = np.cumsum(lengths)
    shift = np.repeat(starts - (ends - lengths), lengths)
    return flat[np.arange(int(ends[-1]) if len(ends) else 0) + shift]


def list_array(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
