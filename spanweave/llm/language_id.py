"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams by language in one pass with map-side sums. The log-probability matrix has
``buckets`` rows and one column per language, so its size is known before it is broadcast; batches of
whole texts are scored with numpy as sparse rows of that matrix.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Hash buckets, n-gram lengths, additive smoothing and the largest number of languages.
BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
ALPHA = 0.5
MAX_LANGUAGES = 256
#: Characters of a long text hashed at once.
CHUNK_CHARS = 1 << 19
#: Products of the sparse batch held at once, over all languages; one text may need more.
SPARSE_ENTRIES = 1 << 18
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _codes(text: str) -> tuple[np.ndarray, bool]:
    """Lower-case letters with one space between words and around the text; whether any is there."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return np.zeros(0, np.uint32), False
    kept = letter.copy()
    kept[1:] |= letter[:-1]  # the first character after a word stands for the gap
    codes = np.where(letter, codes, 32)[kept]
    return np.concatenate([[32], codes, [32] if codes[-1] != 32 else []]).astype(np.uint32), True


def ngram_buckets(codes: np.ndarray) -> Iterator[np.ndarray]:
    """Hash buckets of all n-grams of one text, in pieces."""
    longest = max(ORDERS)
    for start in range(0, len(codes), CHUNK_CHARS):
        piece = codes[start : start + CHUNK_CHARS + longest - 1].astype(np.uint64)
        for n in ORDERS:
            count = min(len(codes) - start - n + 1, CHUNK_CHARS)
            if count <= 0:
                continue
            hashed = np.full(count, n, np.uint64)
            for i in range(n):
                hashed = (hashed ^ piece[i : i + count]) * np.uint64(0x9E3779B97F4A7C15)
                hashed ^= hashed >> np.uint64(29)
            yield (hashed & np.uint64(BUCKETS - 1)).astype(np.int64)


NO_BUCKETS = np.zeros(0, np.int64)


def sparse_counts(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buckets in use of one text, ascending, and how often each occurs; long texts in pieces."""
    pieces = list(ngram_buckets(codes)) if len(codes) <= CHUNK_CHARS else None
    if pieces is not None and sum(map(len, pieces)) < BUCKETS // 4:
        return np.unique(np.concatenate(pieces), return_counts=True)
    dense = np.zeros(BUCKETS, np.int64)
    for buckets in pieces if pieces is not None else ngram_buckets(codes):
        dense += np.bincount(buckets, minlength=BUCKETS)
    used = np.flatnonzero(dense)
    return used, dense[used]


@dataclass
class LanguageModel:
    """Languages in name order, their log priors, and log P(bucket | language)."""

    languages: list[str]
    prior: np.ndarray
    matrix: np.ndarray

    def predict(self, texts: Iterable[str | None]) -> tuple[list[str], list[float]]:
        """Most probable languages of texts and their posterior probabilities.

        The texts' n-gram counts are the rows of a sparse matrix, multiplied by the log probabilities
        a bounded number of entries at a time.
        """
        labels: list[str] = []
        scores: list[float] = []
        columns: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        held = 0

        def flush() -> None:
            bounds = np.concatenate([[0], np.cumsum([len(c) for c in columns])])
            starts = bounds[:-1][np.diff(bounds) > 0]
            logs = np.tile(self.prior, (len(columns), 1))
            if len(starts):
                weighted = self.matrix[np.concatenate(columns)] * np.concatenate(counts)[:, None]
                logs[np.diff(bounds) > 0] += np.add.reduceat(weighted, starts)
            best = logs.argmax(axis=1)
            top = 1.0 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
            for i, own in enumerate(columns):
                labels.append(self.languages[best[i]] if len(own) else UNKNOWN)
                scores.append(float(top[i]) if len(own) else 0.0)
            columns.clear()
            counts.clear()

        for text in texts:
            codes, any_letter = _codes(text or "")
            used, times = sparse_counts(codes) if any_letter and self.languages else (NO_BUCKETS, NO_BUCKETS)
            if not self.languages:
                labels.append(UNKNOWN)
                scores.append(0.0)
                continue
            if columns and held + len(used) > SPARSE_ENTRIES // max(1, len(self.languages)):
                flush()
                held = 0
            columns.append(used)
            counts.append(times)
            held += len(used)
        if columns:
            flush()
        return labels, scores


def train(df: DataFrame, text: str = "text", language: str = "lang") -> LanguageModel:
    """Learn from all rows with a language; a null or letterless text adds to the prior alone.

    What comes to the driver is one summed row per (language, bucket) in use, at most
    ``MAX_LANGUAGES * BUCKETS``; more languages are an error, found before any text is read. No rows give a model
    of no language.
    """
    rows = df.select(F.col(text).cast("string").alias("text"), F.col(language).cast("string").alias("lang"))
    rows = rows.where("lang IS NOT NULL")
    if rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, whole in zip(batch.column("lang").to_pylist(), batch.column("text")):
                if lang not in sums:
                    sums[lang] = np.zeros(BUCKETS + 1, np.int64)
                own = sums[lang]
                own[BUCKETS] += 1
                for buckets in ngram_buckets(_codes(whole.as_py() or "")[0]):
                    own[:BUCKETS] += np.bincount(buckets, minlength=BUCKETS)
        for lang, own in sums.items():
            used = np.flatnonzero(own)
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(used), "bucket": used, "n": own[used]})

    counted = rows.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = counted.toArrow()
    languages = sorted(set(table["lang"].to_pylist()))
    counts = np.zeros((BUCKETS + 1, len(languages)))
    column = {lang: i for i, lang in enumerate(languages)}
    at = np.fromiter((column[x] for x in table["lang"].to_pylist()), np.int64, len(table))
    counts[table["bucket"].to_numpy(), at] = table["n"].to_numpy()
    grams = counts[:BUCKETS] + ALPHA
    docs = counts[BUCKETS]
    return LanguageModel(languages, np.log(docs / max(docs.sum(), 1)), np.log(grams / grams.sum(axis=0)) if languages else grams)


def predict(df: DataFrame, model: LanguageModel, text: str = "text", label: str = "lang_pred", score: str = "score") -> DataFrame:
    """Add the most probable language of every whole text and its posterior probability.

    Null texts and texts without a letter get ``und`` and 0. Ties go to the first name. Texts of any length are
    scored whole, repeated rows alike; all n-grams count as independent, so that the probability of all but very
    short texts is close to 1. Columns of ``df`` with the new names are replaced. Rows are scored where they are, without a shuffle.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in df.schema.fields if f.name not in (label, score)]
    names = [f.name for f in kept]
    schema = T.StructType(kept + [T.StructField(label, T.StringType(), False), T.StructField(score, T.DoubleType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            found, sure = own.predict(t.as_py() for t in batch.column(text))
            columns = [batch.column(n) for n in names]
            columns += [pa.array(found, pa.string()), pa.array(sure, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*names, label, score])

    return df.select(*names).mapInArrow(run, schema)
