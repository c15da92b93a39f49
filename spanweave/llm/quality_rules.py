"""Quality rules: base measures of a text, and lines that too many documents of a host share.

Lines are normalised (lower case, digits as 0, white space as single spaces) and hashed with their
host; a shuffle counts in how many distinct documents of the host each occurs. Lines above the limit
are removed, and a document of which too little is left is rejected.

Copies are one document here: equal texts of a host count once, and so do texts without anything of their
own. Otherwise the lines of an article with a thousand edited copies would count as boilerplate and all its
copies would go. What tells is never how much a text shares, but what is left beside it: lines that stand in
no other text of the host. If these are versions of shared lines (the first or last five words are
those of a shared line), the text is an edited copy; if they are new, it is a document of its own, however
small they are. An article that differs from its copies by new lines is therefore a document too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanweave.llm.textbatch import (
    SPACE_TABLE,
    list_array,
    slices,
    span_sums,
    text_buffer,
    words,
)
from spanweave.operators.lineage import materialize

#: Fixed value: the characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
SYMBOL_TABLE = np.isin(np.arange(256), np.frombuffer(SYMBOLS, np.uint8))
#: Base rule: fewer words fail, and so does a larger percentage of words in repeated windows.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A line in more distinct documents of its host than this is removed.
MAX_DOCS_PER_LINE = 20
#: A document of which a smaller share of words is left is rejected.
MIN_WORDS_LEFT = 0.3
#: A text is an edited copy if of the words on its own lines at least this share is on versions of shared lines.
EDITED_SHARE = 0.5
#: Two lines of this many words or more are versions of each other if they begin or end with the same ones.
VERSION_WORDS = 5
#: A copy votes as its shared line at this place of its words, from the rarest line to the commonest: those of the
#: article come before those of the host.
ANCHOR_AT = 0.25
BATCH_BYTES = 1 << 19

_DIGITS = re.compile(r"[0-9]")


def repeated_words(ids: np.ndarray) -> int:
    """Words inside three-word windows that occur at least twice, each word once."""
    if len(ids) < 4:
        return 0
    base = int(ids.max()) + 1
    pair = np.unique(ids[:-1].astype(np.int64) * base + ids[1:], return_inverse=True)[1]
    triple = pair[:-1].astype(np.int64) * base + ids[2:]
    _, at, count = np.unique(triple, return_inverse=True, return_counts=True)
    inside = np.zeros(len(ids), bool)
    windows = np.flatnonzero(count[at] > 1)
    for shift in range(3):
        inside[windows + shift] = True
    return int(inside.sum())


def _key(plain: list[str]) -> int:
    return xxhash.xxh64_intdigest(" ".join(plain).encode()) - (1 << 63)


def line_keys(line: bytes) -> tuple[int, int, int]:
    """Signed 64-bit hashes of a normalised line, of its first words and of its last; the line's own for
    these if it is short."""
    plain = _DIGITS.sub("0", line.decode("utf-8", "replace").lower()).split()
    whole = _key(plain)
    if len(plain) < VERSION_WORDS:
        return whole, whole, whole
    return whole, _key(["first", *plain[:VERSION_WORDS]]), _key(["last", *plain[-VERSION_WORDS:]])


def line_key(line: bytes) -> int:
    return line_keys(line)[0]


def line_table(text: bytes) -> tuple[int, dict[bytes, int]]:
    """How many lines with a word equal an earlier one, and the words on each different line."""
    duplicates, found = 0, {}
    for line in text.split(b"\n"):
        n = len(line.split())
        if n:
            duplicates += line in found
            found[line] = found.get(line, 0) + n
    return duplicates, found


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
LINE_FIELDS = [T.StructField(m, T.LongType(), False) for m in MEASURES] + [
    T.StructField("_keys", T.ArrayType(T.LongType(), False), False),
    T.StructField("_line_words", T.ArrayType(T.LongType(), False), False),
    T.StructField("_firsts", T.ArrayType(T.LongType(), False), False),
    T.StructField("_lasts", T.ArrayType(T.LongType(), False), False),
]


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the base measures, and the distinct normalised lines with their words."""
    new = {f.name for f in LINE_FIELDS}
    kept = [f for f in df.schema.fields if f.name not in new]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, BATCH_BYTES):
                raw, offsets = text_buffer(part.column(text))
                flat = np.frombuffer(raw, np.uint8)
                found, at = words(raw, offsets)
                ids = found.dictionary_encode().indices.to_numpy()
                code_points = (flat & 0xC0) != 0x80
                edges, spans = offsets.tolist(), at.tolist()
                repeats = [repeated_words(ids[a:b]) for a, b in zip(spans[:-1], spans[1:])]
                duplicates, keys, counts, firsts, lasts, ends = [], [], [], [], [], [0]
                for a, b in zip(edges[:-1], edges[1:]):
                    n, lines = line_table(raw[a:b])
                    merged: dict[int, int] = {}
                    for line, n_words in lines.items():
                        key, first, last = line_keys(line)
                        if key not in merged:
                            firsts.append(first)
                            lasts.append(last)
                        merged[key] = merged.get(key, 0) + n_words
                    duplicates.append(n)
                    keys += merged.keys()
                    counts += merged.values()
                    ends.append(len(keys))
                bounds = np.array(ends)
                columns = [part.column(n) for n in names]
                columns += [
                    pa.array(np.diff(at), pa.int64()),
                    pa.array(span_sums(code_points & ~SPACE_TABLE[flat], offsets), pa.int64()),
                    pa.array(span_sums(SYMBOL_TABLE[flat], offsets), pa.int64()),
                    pa.array(duplicates, pa.int64()),
                    pa.array(repeats, pa.int64()),
                    list_array(np.array(keys, np.int64), bounds, pa.int64()),
                    list_array(np.array(counts, np.int64), bounds, pa.int64()),
                    list_array(np.array(firsts, np.int64), bounds, pa.int64()),
                    list_array(np.array(lasts, np.int64), bounds, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, [*names, *new_names])

    new_names = [f.name for f in LINE_FIELDS]
    return df.select(*names).mapInArrow(run, T.StructType(kept + LINE_FIELDS))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def judge(
    df: DataFrame,
    host: str = "source",
    text: str = "text",
    carry: tuple[str, ...] = ("doc_id",),
    max_docs: int = MAX_DOCS_PER_LINE,
    min_left: float = MIN_WORDS_LEFT,
) -> DataFrame:
    """One row per row of ``df``: ``carry``, ``_text_hash``, ``host``, the base measures,
    ``removed_keys`` (lines above the limit), ``words_left``, ``base_failed`` and ``kept``.

    Null hosts are one host. A null or empty text has no words and fails the base rule. Equal lines
    of one document count once, repeated rows are copies. Texts of any length are read whole. An empty table stays
    empty.
    """
    wanted = df.select(
        *carry, F.col(host).cast("string").alias("host"), F.col(text).cast("string").alias("_text"),
        F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("_text_hash"),
    )
    docs = materialize(
        measure(wanted, "_text").drop("_text").withColumn("_row", F.monotonically_increasing_id()), "quality-lines"
    )
    of_host = (F.coalesce("host", F.lit("")), F.col("host").isNull())
    lines = docs.select(
        "_row", "host", F.xxhash64(*of_host, F.col("_text_hash")).alias("_text"),
        F.explode(F.arrays_zip("_keys", "_line_words", "_firsts", "_lasts")).alias("l"),
    ).select(
        "_row", "_text", F.xxhash64(*of_host, "l._keys").alias("line"), F.col("l._keys").alias("key"), F.col("l._line_words").alias("words"),
        F.array(F.xxhash64(*of_host, "l._firsts"), F.xxhash64(*of_host, "l._lasts")).alias("versions"),
    )
    # Lines in two different texts or more: the extremes of the texts' hashes tell, at any group size.
    shared = lines.groupBy("line").agg(F.min("_text").alias("lo"), F.max("_text").alias("hi")).where("lo <> hi")
    shared = materialize(shared.select("line"), "quality-shared")
    on_shared = materialize(lines.join(shared, "line", "left_semi"), "quality-shared-lines")
    texts = on_shared.select("line", "_text").distinct().groupBy("line").agg(F.count(F.lit(1)).alias("n_texts"))
    texts = materialize(texts, "quality-line-texts")
    common = texts.where(F.col("n_texts") > max_docs)
    # Only texts with lines that may be too frequent have a vote that matters; equal texts have one.
    voters = on_shared.join(common.select("line"), "line", "left_semi").groupBy("_text").agg(F.min("_row").alias("_row"))
    voters = materialize(voters, "quality-voters")
    rows = voters.select("_row")
    own = lines.join(rows, "_row", "left_semi").join(shared, "line", "left_anti")
    own = materialize(own.select("_row", "line", "words", "versions"), "quality-own-lines")
    known = materialize(on_shared.select(F.explode("versions").alias("version")).distinct(), "quality-versions")
    edited = (
        own.select("_row", "line", "words", F.explode("versions").alias("version")).join(known, "version", "left_semi")
        .select("_row", "line", "words").distinct().groupBy("_row").agg(F.sum("words").alias("edited"))
    )
    originals = (
        own.groupBy("_row").agg(F.sum("words").alias("own")).join(edited, "_row", "left")
        .where(F.coalesce("edited", F.lit(0)) < EDITED_SHARE * F.col("own")).select("_row")
    )
    copies = voters.join(originals, "_row", "left_anti")
    # A window over the lines of one text.
    up = Window.partitionBy("_text").orderBy("n_texts", "line")
    anchors = (
        on_shared.join(copies, ["_row", "_text"], "left_semi").join(texts, "line")
        .withColumn("up_to", F.sum("words").over(up))
        .withColumn("all", F.sum("words").over(Window.partitionBy("_text")))
        .where(F.col("up_to") >= ANCHOR_AT * F.col("all"))
        .groupBy("_text").agg(F.min_by("line", F.struct("n_texts", "line")).alias("anchor"))
    )
    frequent = (
        on_shared.join(common.select("line"), "line", "left_semi").select("line", "_text").distinct()
        .join(materialize(anchors, "quality-anchors"), "_text", "left")
        .select("line", F.coalesce("anchor", "_text").alias("document"))
        .distinct()
        .groupBy("line").agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > max_docs)
        .select("line")
    )
    frequent = materialize(frequent, "quality-frequent")  # as a plain table, a skewed join can split the other side
    removed = on_shared.join(frequent, "line", "left_semi").groupBy("_row").agg(
        F.sum("words").alias("removed_words"), F.collect_set("key").alias("removed_keys")
    )
    left = F.col("n_words") - F.coalesce("removed_words", F.lit(0))
    return (
        docs.join(removed, "_row", "left")
        .withColumn("words_left", left)
        .withColumn("base_failed", base_failed())
        .select(
            *carry, "host", "_text_hash", *MEASURES, "words_left",
            F.coalesce("removed_keys", F.array().cast("array<bigint>")).alias("removed_keys"),
            "base_failed",
            (~F.col("base_failed") & (F.col("words_left") >= min_left * F.col("n_words"))).alias("kept"),
        )
    )


def without_lines(df: DataFrame, text: str = "text", keys: str = "removed_keys") -> DataFrame:
    """Drop from every text the lines whose normalised hash is in ``keys``; that column goes too."""
    kept = [f for f in df.schema.fields if f.name != keys]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for whole, gone in zip(batch.column(text), batch.column(keys).to_pylist()):
                whole = whole.as_py()
                if whole is not None and gone:
                    gone = set(gone)
                    lines = whole.split("\n")
                    whole = "\n".join(x for x in lines if not x.split() or line_key(x.encode("utf-8", "surrogatepass")) not in gone)
                out.append(whole)
            columns = [pa.array(out, pa.string()) if n == text else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names)

    return df.mapInArrow(run, T.StructType(kept))
