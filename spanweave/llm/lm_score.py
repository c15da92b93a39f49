"""Log probabilities of texts under a bigram model with deleted interpolation.

P(w | h) = a * c(h, w) / c(h) + b * c(w) / N + d / (V + 1), where the weights (a, b, d) depend on how
often the context h was seen (a power of two each bucket) and are learned by expectation-maximisation
on held-out counts: documents of a small fold count apart, and are predicted from the others.

Counts cover the whole corpus and never meet in one place. Texts are read once and packed into blocks of
about ``BLOCK_TOKENS`` tokens. A block sends its distinct n-grams, as sorted hashes with counts, to
shards of the hash space; a shard adds up all blocks' counts and answers each block for the n-grams it
asked for; a block then has all counts that its texts need. What is shuffled is one entry per block and
distinct n-gram, not one per token, and a word of any frequency is one entry per block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanweave.llm.textbatch import slices, span_sums, text_buffer, words
from spanweave.operators.lineage import materialize

BLOCK_TOKENS = 1 << 20
BATCH_BYTES = 2 << 20
#: One training document in so many is held out for the weights.
HELD_OUT = 16
#: Context buckets: unseen, then one for each power of two.
BUCKETS = 48
#: Bins a factor of ten for the two probabilities of a held-out event, down to MIN_LOG.
BINS, MIN_LOG = 20, -14
EM_ROUNDS = 50
#: Keys keep the upper bits of a hash; sorted, they then differ by less than 2^40 and pack well.
KEY_BITS = 56
#: Fixed keys: a document's end and its start. Words cannot hold a space.
END_KEY = xxhash.xxh64_intdigest(b" end") >> (64 - KEY_BITS)
START_KEY = xxhash.xxh64_intdigest(b" start") >> (64 - KEY_BITS)

UNIGRAM, BIGRAM = 1, 2
BLOCK_SCHEMA = "block long, weighing boolean, doc_ids array<bigint>, training array<boolean>, ends binary, tokens binary, vocabulary binary"
KEY_SCHEMA = "block long, weighing boolean, n int, shard int, keys binary, main binary, extra binary"
REPLY_SCHEMA = "block long, weighing boolean, n int, shard int, main binary, extra binary, n_tokens long, n_types long, main_tokens long, main_types long"


def pack_counts(values: np.ndarray) -> bytes:
    """Counts in a byte each; larger ones follow in eight."""
    large = values >= 255
    return len(values).to_bytes(8, "little") + np.where(large, 255, values).astype(np.uint8).tobytes() + values[large].astype("<i8").tobytes()


def unpack_counts(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:8], "little")
    values = np.frombuffer(raw, np.uint8, n, 8).astype(np.int64)
    values[values == 255] = np.frombuffer(raw, "<i8", -1, 8 + n)
    return values


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, lowest bytes of all first, so that the empty bytes compress."""
    return np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack_keys(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def bigram_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    x = first * np.uint64(0x9E3779B97F4A7C15) + second
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) >> np.uint64(64 - KEY_BITS)


class _Block:
    """Texts gathered until there are enough tokens for a block."""

    def __init__(self, weighing: bool):
        self.weighing = weighing
        self.clear()

    def clear(self) -> None:
        self.doc_ids, self.training, self.lengths, self.words, self.size = [], [], [], [], 0

    def add(self, doc_ids: list, training: list, found: pa.Array, at: np.ndarray) -> None:
        self.doc_ids += doc_ids
        self.training += training
        self.lengths.append(np.diff(at) + 1)
        self.words.append(found)
        self.size += len(found) + len(doc_ids)

    def row(self, number: int) -> pa.RecordBatch:
        coded = pa.chunked_array(self.words).combine_chunks().dictionary_encode()
        ids, known = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        # Frequent words first: small numbers compress better.
        order = np.argsort(-np.bincount(ids, minlength=len(known)), kind="stable")
        rank = np.empty(len(known), np.int64)
        rank[order] = np.arange(1, len(known) + 1)
        ends = np.cumsum(np.concatenate(self.lengths))
        tokens = np.insert(rank[ids], ends - np.arange(1, len(ends) + 1), 0)  # number 0 ends a text
        keys = [END_KEY] + [xxhash.xxh64_intdigest(known[i]) >> (64 - KEY_BITS) for i in order]
        planes = tokens.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
        out = {
            "block": [number],
            "weighing": [self.weighing],
            "doc_ids": pa.array([self.doc_ids], pa.list_(pa.int64())),
            "training": [self.training],
            "ends": [ends.astype("<i8").tobytes()],
            "tokens": [planes],
            "vocabulary": [np.array(keys, "<u8").tobytes()],
        }
        self.clear()
        return pa.RecordBatch.from_pydict(out)


def to_blocks(df: DataFrame) -> DataFrame:
    """``doc_id, training, weighing, text`` as blocks; held-out documents have blocks of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = {w: _Block(w) for w in (False, True)}
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for w, block in blocks.items():
                own = batch.filter(pc.equal(batch.column("weighing"), w))
                for part in slices(own, "text", BATCH_BYTES):
                    found, at = words(*text_buffer(part.column("text")), lower=True)
                    block.add(part.column("doc_id").to_pylist(), part.column("training").to_pylist(), found, at)
                    if block.size >= BLOCK_TOKENS:
                        yield block.row(number)
                        number += 1
        for block in blocks.values():
            if block.doc_ids:
                yield block.row(number)
                number += 1

    return df.mapInArrow(run, BLOCK_SCHEMA)


class BlockTokens:
    """A block's texts as numbers: tokens, their contexts, and the distinct n-grams in key order."""

    def __init__(self, row: dict):
        planes = np.frombuffer(row["tokens"], np.uint8).reshape(4, -1)
        self.tokens = np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)
        self.ends = np.frombuffer(row["ends"], "<i8")
        vocabulary = np.frombuffer(row["vocabulary"], "<u8")
        starts = np.concatenate([[0], self.ends[:-1]])
        # The context of a first token is the start, which has the number behind all words.
        self.contexts = np.concatenate([[0], self.tokens[:-1]])
        self.contexts[starts] = len(vocabulary)
        self.word_keys, self.word_at = np.unique(np.append(vocabulary, np.uint64(START_KEY)), return_inverse=True)
        pair = bigram_keys(self.word_keys[self.word_at[self.contexts]], vocabulary[self.tokens])
        self.pair_keys, self.pair_at = np.unique(pair, return_inverse=True)
        self.training = np.repeat(np.array(row["training"], bool), np.diff(self.ends, prepend=0))


def shard_count(spark) -> int:
    """A power of two, so that a shard is a range of keys."""
    return 1 << max(0, math.ceil(math.log2(int(spark.conf.get("spark.sql.shuffle.partitions")))))


def key_rows(blocks: DataFrame, shards: int) -> DataFrame:
    """What every block asks and tells each shard: its distinct n-grams and their training counts."""
    shift = np.uint64(KEY_BITS - int(math.log2(shards)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                own = BlockTokens(row)
                out = []
                for n, keys, at in (
                    (UNIGRAM, own.word_keys, own.word_at[own.tokens]),
                    (BIGRAM, own.pair_keys, own.pair_at),
                ):
                    counts = np.bincount(at[own.training], minlength=len(keys))
                    bounds = np.searchsorted((keys >> shift).astype(np.int64), np.arange(shards + 1))
                    none = np.zeros(len(keys), np.int64)
                    main, extra = (none, counts) if row["weighing"] else (counts, none)
                    for shard in np.flatnonzero(np.diff(bounds)):
                        span = slice(bounds[shard], bounds[shard + 1])
                        out.append(
                            {
                                "block": row["block"], "weighing": row["weighing"], "n": n, "shard": int(shard),
                                "keys": pack_keys(keys[span]), "main": pack_counts(main[span]), "extra": pack_counts(extra[span]),
                            }
                        )
                yield pa.RecordBatch.from_pylist(out, _KEY_ARROW)

    return blocks.mapInArrow(run, KEY_SCHEMA)


_KEY_ARROW = pa.schema(
    [("block", pa.int64()), ("weighing", pa.bool_()), ("n", pa.int32()), ("shard", pa.int32())]
    + [(c, pa.binary()) for c in ("keys", "main", "extra")]
)


def _answer(asked: pd.DataFrame) -> pd.DataFrame:
    """One shard: add up the counts of all blocks and give each block those of its keys."""
    parts = [unpack_keys(k) for k in asked["keys"]]
    keys, at = np.unique(np.concatenate(parts), return_inverse=True)
    sums = {}
    for name in ("main", "extra"):
        own = np.concatenate([unpack_counts(c) for c in asked[name]])
        sums[name] = np.zeros(len(keys), np.int64)
        np.add.at(sums[name], at, own)
    both = sums["main"] + sums["extra"]
    edges = np.cumsum([0] + [len(p) for p in parts])
    out = asked[["block", "weighing", "n", "shard"]].copy()
    for name, values in sums.items():
        out[name] = [pack_counts(values[at[a:b]]) for a, b in zip(edges[:-1], edges[1:])]
    out["n_tokens"], out["n_types"] = 0, 0
    out["main_tokens"], out["main_types"] = 0, 0
    totals = [int(both.sum()), int((both > 0).sum()), int(sums["main"].sum()), int((sums["main"] > 0).sum())]
    out.loc[out.index[0], ["n_tokens", "n_types", "main_tokens", "main_types"]] = totals
    return out


class BlockCounts:
    """Counts of a block's n-grams from its replies; with the held-out fold's share or without."""

    def __init__(self, own: BlockTokens, replies: pd.DataFrame, with_extra: bool):
        found = {}
        for n, part in replies.sort_values(["n", "shard"]).groupby("n"):
            found[n] = np.concatenate([unpack_counts(x) for x in part["main"]])
            if with_extra:
                found[n] = found[n] + np.concatenate([unpack_counts(x) for x in part["extra"]])
        words_, pairs = found[UNIGRAM], found[BIGRAM]
        by_number = words_[own.word_at]
        by_number[-1] = by_number[0]  # a text has one start and one end
        self.word = by_number[own.tokens]
        self.context = by_number[own.contexts]
        self.pair = pairs[own.pair_at]


def context_bucket(counts: np.ndarray) -> np.ndarray:
    return np.where(counts > 0, np.minimum(np.log2(np.maximum(counts, 1)).astype(np.int64) + 1, BUCKETS - 1), 0)


def _bin(p: np.ndarray) -> np.ndarray:
    """Bin number of a probability; -1 for zero."""
    logs = np.log10(np.where(p > 0, p, 1.0))
    return np.where(p > 0, np.maximum((logs - MIN_LOG) * BINS, 0).astype(np.int64), -1)


def learn_weights(events: pd.DataFrame, n_types: int, rounds: int = EM_ROUNDS) -> np.ndarray:
    """BUCKETS x 3 weights of bigram, unigram and uniform by expectation-maximisation.

    ``events(bucket, pair_bin, word_bin, n)`` counts held-out tokens. A pseudo-event for each weight
    keeps all above zero where little was seen.
    """
    weights = np.full((BUCKETS, 3), 1 / 3)
    if not len(events):
        return weights
    bucket, n = events["bucket"].to_numpy(), events["n"].to_numpy(float)
    value = lambda b: np.where(b < 0, 0.0, 10.0 ** ((b + 0.5) / BINS + MIN_LOG))
    parts = np.stack(
        [value(events["pair_bin"].to_numpy()), value(events["word_bin"].to_numpy()), np.full(len(events), 1 / (n_types + 1))], axis=1
    )
    for _ in range(rounds):
        shares = weights[bucket] * parts
        shares *= (n / shares.sum(axis=1))[:, None]
        sums = np.ones((BUCKETS, 3))
        np.add.at(sums, bucket, shares)
        weights = sums / sums.sum(axis=1, keepdims=True)
    return weights


def score(
    df: DataFrame, training: Column, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``df``: ``doc_id, n_tokens, n_known, train_tokens, base_score, score``.

    A-Z are lowered; tokens are the words and one end. ``training`` marks the rows to learn from (null:
    no); all are scored. ``base_score`` is the add-one unigram score, ``score`` the model's, both log10.
    A null or empty text is its end alone. Repeated rows each count. Without training rows every count
    is zero. At the driver are the weights, two totals and at most one row per bucket and bins.
    """
    fold = F.crc32(F.concat(F.lit("weights "), F.coalesce(F.col(doc_id).cast("string"), F.lit("")) ).cast("binary"))
    learn = F.coalesce(training, F.lit(False))
    rows = df.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        learn.alias("training"),
        (learn & (fold % HELD_OUT == 0)).alias("weighing"),
        F.col(text).cast("string").alias("text"),
    )
    blocks = materialize(to_blocks(rows), "lm-blocks")
    asked = key_rows(blocks, shard_count(df.sparkSession))
    replies = materialize(asked.groupBy("n", "shard").applyInPandas(_answer, REPLY_SCHEMA), "lm-replies")
    total = (
        replies.where(F.col("n") == UNIGRAM)
        .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_tokens", "n_types", "main_tokens", "main_types")])
        .first()
    )

    def events(key, block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        own = BlockTokens(block.iloc[0].to_dict())
        c = BlockCounts(own, answers, with_extra=False)
        held = pd.DataFrame(
            {
                "bucket": context_bucket(c.context),
                "pair_bin": _bin(c.pair / np.maximum(c.context, 1)),
                "word_bin": _bin(c.word / max(total.main_tokens, 1)),
            }
        )
        return held.value_counts().rename("n").reset_index()

    weighing = F.col("weighing")
    answered = replies.select("block", "weighing", "n", "shard", "main", "extra")
    seen = (
        blocks.where(weighing).groupBy("block").cogroup(answered.where(weighing).groupBy("block"))
        .applyInPandas(events, "bucket long, pair_bin long, word_bin long, n long")
        .groupBy("bucket", "pair_bin", "word_bin").agg(F.sum("n").alias("n"))
    )
    weights = learn_weights(seen.toPandas(), total.main_types)
    n_tokens, n_types = total.n_tokens, total.n_types

    def scored(key, block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row = block.iloc[0].to_dict()
        own = BlockTokens(row)
        c = BlockCounts(own, answers, with_extra=True)
        mix = weights[context_bucket(c.context)]
        p = mix[:, 0] * c.pair / np.maximum(c.context, 1) + mix[:, 1] * c.word / max(n_tokens, 1) + mix[:, 2] / (n_types + 1)
        base = np.log10((c.word + 1) / (n_tokens + n_types + 1))
        starts = np.concatenate([[0], own.ends[:-1]])
        return pd.DataFrame(
            {
                "doc_id": pd.array(row["doc_ids"], "Int64"),
                "n_tokens": own.ends - starts,
                "n_known": span_sums(c.word > 0, np.append(0, own.ends)),
                "train_tokens": n_tokens,
                "base_score": np.add.reduceat(base, starts),
                "score": np.add.reduceat(np.log10(p), starts),
            }
        )

    return (
        blocks.groupBy("block").cogroup(answered.groupBy("block"))
        .applyInPandas(scored, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    )
