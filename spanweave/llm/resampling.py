"""Importance resampling towards a target corpus, by hashed word n-grams.

Words come from an untrained pre-tokeniser of the tokenizers library: a split at spaces over the text with
A-Z lowered and whatever parts words made a space, which returns every word with its offsets. A feature is
a run of one to three words, joined by one space; its bucket is a CRC of its bytes, put together from the
CRCs of its words. Two histograms over the buckets, of the raw corpus and of the target, give every bucket
a gain (the logarithm of the ratio of smoothed shares), and a document's weight is the sum of the gains of
its features. A draw without replacement by these weights is a top-k of weight plus a Gumbel variable hashed
from the document's id.

Texts are read once. Their buckets, two bytes a feature, are written and serve both the histogram and
the sums. What reaches the driver is one histogram of ``n_buckets`` counts a corpus.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanweave.llm.textbatch import binary_array, slices
from spanweave.operators.lineage import materialize
from spanweave.operators.numbering import number_rows

#: What a word is, how many words a feature has at most.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MAX_WORDS = 3
#: Buckets are kept in two bytes.
MOST_BUCKETS = 1 << 16
#: Characters of one text that are pre-tokenised at once; cuts fall between words.
PIECE_CHARS = 1 << 18
#: Bytes of texts that a worker holds at once, and one text more.
BATCH_BYTES = 1 << 20
#: Rows of one id are dealt over so many sort keys at most.
SPREAD = 4096

#: Bytes of A-Z become a-z, those between words a space; bytes over 0x7F, of wider characters, stay.
_FOLDED = bytes(b if b > 0x7F or re.match(WORD, chr(b).lower()) else 0x20 for b in range(256)).lower()
_GAP = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")


@lru_cache(maxsize=1)
def splitter():
    """One per worker process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import pre_tokenizers

    return pre_tokenizers.CharDelimiterSplit(" ")


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """The text in parts of about ``size`` characters that cut no word."""
    start = 0
    while len(text) - start > size:
        gap = _GAP.search(text, start + size)
        if gap is None:
            break
        yield text[start : gap.start()]
        start = gap.start()
    yield text[start:]


def words_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The CRCs of a text's words and their bytes."""
    crcs, widths = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
    for piece in pieces(text.encode().translate(_FOLDED).decode()):
        found = splitter().pre_tokenize_str(piece)
        if not found:
            continue
        spans = np.array([span for _, span in found], np.int64)
        if not piece.isascii():
            codes = np.frombuffer(piece.encode("utf-32-le"), np.uint32)
            sizes = 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)
            spans = np.concatenate([[0], np.cumsum(sizes)])[spans]
        words = " ".join([word for word, _ in found]).encode().split(b" ")
        crcs.append(np.fromiter(map(crc32, words), np.uint32, len(words)))
        widths.append(spans[:, 1] - spans[:, 0])
    return np.concatenate(crcs), np.concatenate(widths)


def moved(crcs: np.ndarray, table: np.ndarray) -> np.ndarray:
    """CRCs after the zero bytes that ``table`` stands for."""
    return table[0][crcs & 255] ^ table[1][crcs >> 8 & 255] ^ table[2][crcs >> 16 & 255] ^ table[3][crcs >> 24]


@lru_cache(maxsize=64)
def zeros(k: int) -> np.ndarray:
    """What moves a CRC over ``2**k`` zero bytes, by each of its four bytes: CRCs are linear in their bits."""
    if k == 0:
        return np.array([[crc32(b"\0", b << 8 * i) ^ crc32(b"\0") for b in range(256)] for i in range(4)], np.uint32)
    return moved(zeros(k - 1), zeros(k - 1))


def joined(left: np.ndarray, right: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """The CRCs of strings set end to end, from their CRCs and the right ones' bytes, as zlib's crc32_combine."""
    left = left.copy()
    for k in range(int(widths.max(initial=0)).bit_length()):
        at = np.flatnonzero(widths >> k & 1)
        left[at] = moved(left[at], zeros(k))
    return left ^ right


def buckets_of(texts: list[str | None], n_buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How many words and features every text has, and the features' buckets, text by text, repeats included.

    Only words are hashed; the CRCs of longer features follow from those.
    """
    made = [words_of(text or "") for text in texts]
    n_words = np.array([len(crcs) for crcs, _ in made], np.int64)
    crcs, widths = (np.concatenate(parts) for parts in zip(*made))
    runs = np.zeros((len(crcs), MAX_WORDS), "<u2")  # row: the first word; column: how many follow
    run = crcs
    for n in range(min(MAX_WORDS, len(crcs))):
        if n:
            run = joined(moved(run[:-1], zeros(0)) ^ np.uint32(crc32(b" ")), crcs[n:], widths[n:])
        runs[: len(run), n] = run % np.uint32(n_buckets)
    left = np.repeat(np.cumsum(n_words), n_words) - np.arange(len(crcs))  # words up to the text's end
    n_features = sum(np.maximum(n_words - n, 0) for n in range(MAX_WORDS))
    return n_words, n_features, runs[np.arange(MAX_WORDS) < left[:, None]]


def featurize(df: DataFrame, n_buckets: int, doc_id: str | None, text: str) -> DataFrame:
    """``doc_id, n_words, buckets`` of every whole text; ``buckets`` is binary, two bytes a feature."""
    if not 0 < n_buckets <= MOST_BUCKETS:
        raise ValueError(f"between 1 and {MOST_BUCKETS} buckets are possible")
    own_id = F.col(doc_id).cast("long") if doc_id else F.lit(None).cast("long")
    rows = df.select(own_id.alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                n_words, n_features, found = buckets_of(part.column("text").to_pylist(), n_buckets)
                bounds = found.itemsize * np.concatenate([[0], np.cumsum(n_features)])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(n_words),
                        binary_array(found, bounds).cast(pa.binary()),
                    ],
                    ["doc_id", "n_words", "buckets"],
                )

    return rows.mapInArrow(run, "doc_id long, n_words long, buckets binary")


def histogram(features: DataFrame, n_buckets: int) -> np.ndarray:
    """Features by bucket: every task counts its own rows, so ``n_buckets`` rows a task are shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_buckets, np.int64)
        for batch in batches:
            for value in batch.column("buckets"):
                total += np.bincount(np.frombuffer(value.as_buffer(), "<u2"), minlength=n_buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], ["bucket", "n"])

    counted = features.select("buckets").mapInArrow(count, "bucket int, n long")
    table = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # n_buckets rows at most
    found = np.zeros(n_buckets, np.int64)
    found[table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    return found


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of the ratio of shares, each bucket smoothed by one, floored."""
    n = len(raw)
    ratio = ((target + 1.0) * float(raw.sum() + n)) / ((raw + 1.0) * float(target.sum() + n))
    return np.floor(1000.0 * np.log(ratio)).astype(np.int64)


def weigh(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """``doc_id, n_words, n_features, weight``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(v.as_buffer(), "<u2") for v in batch.column("buckets")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("n_words"),
                    pa.array([len(b) for b in found], pa.int64()),
                    pa.array([int(gain[b].sum()) for b in found], pa.int64()),
                ],
                ["doc_id", "n_words", "n_features", "weight"],
            )

    return features.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int) -> Column:
    """Thousandths of a standard Gumbel variable from a hash of seed and id, floored."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(uniform))).cast("long")


def resample(
    df: DataFrame,
    target: DataFrame,
    percent: int = 5,
    min_words: int = 20,
    n_buckets: int = 10_000,
    seed: int = 42,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
) -> DataFrame:
    """Draw ``percent`` of the documents with ``min_words`` words, those most like ``target``.

    Returns ``doc_id, n_words, n_features, weight, score, rank``, one row per row of ``df``; ``rank`` counts
    the drawn ones from 1 by falling score and is null for the others. Of equal scores the smaller id
    comes first, a null id before all; repeated rows are documents of their own, in any order among
    themselves. A null or empty text has no features and weight 0. Texts are whole, however long. An
    empty table gives no rows, an empty target leaves all smoothed shares of it equal. Other columns
    are left out; join on the id for them.
    """
    features = materialize(featurize(df, n_buckets, doc_id, text), "resample-features")
    wanted = histogram(featurize(target, n_buckets, None, target_text), n_buckets)
    gain = gains(histogram(features, n_buckets), wanted)
    scored = (
        weigh(features, gain)
        .withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
        .withColumns(
            {
                "_short": F.col("n_words") < min_words,
                "_order": -F.col("score"),
                "_row": F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SPREAD)),
            }
        )
    )
    # All rows in one order, those that may be drawn first, so that no join has to find a row again.
    numbered = number_rows(scored, [], ["_short", "_order", "doc_id", "_row"], "rank")
    drawn = features.where(F.col("n_words") >= min_words).count() * percent // 100
    rank = F.when(~F.col("_short") & (F.col("rank") <= drawn), F.col("rank"))
    return numbered.select("doc_id", "n_words", "n_features", "weight", "score", rank.alias("rank"))
