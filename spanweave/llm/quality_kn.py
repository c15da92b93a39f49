"""Quality classifier: perplexity under an interpolated modified Kneser-Ney trigram model.

The model is fitted to trusted text, of which nothing is left out: a hash of the id puts a trusted document into
one of two halves; all texts of one half are counted, and all of the other give the thresholds. Documents whose mean
log probability is below a quantile of the trusted documents of their language that were not counted are rejected.
A language with too few of these has no quantile and nothing of it is rejected.

Neither counts nor model ever meet in one place. Learned texts are packed into blocks of about ``BLOCK_TOKENS``
tokens. For every order, from trigrams down, a block sends its distinct n-grams, as sorted hashes with what it knows
of their counts, to shards of the hash space; a shard adds up all blocks' counts. Lower orders count different
contexts: of the blocks that hold an n-gram, the shard names one that counts it for the next order. The shards' sums
are the model. All texts are then scored in at most ``ROUNDS`` rounds: their blocks ask the shards for the counts of
all their n-grams. What is shuffled is one entry per block and distinct n-gram, and an n-gram of any frequency is one
entry per block; a round's files are gone before the next, so that the disk never holds all of these at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanweave.llm.lm_score import (
    BATCH_BYTES,
    BLOCK_TOKENS,
    END_KEY,
    KEY_BITS,
    START_KEY,
    bigram_keys,
    pack_counts,
    pack_keys,
    shard_count,
    unpack_counts,
    unpack_keys,
)
from spanweave.llm.textbatch import free_name, slices, text_buffer, words
from spanweave.operators.lineage import discard, materialize

#: Trusted documents below this share of their language's distribution would be rejected.
QUANTILE = 0.01
#: In a language with fewer trusted documents to calibrate on nothing is rejected: the model hardly knows its
#: words, and other languages' perplexities say nothing about it.
MIN_TRUSTED = 50
#: Short texts are drawn to their language's mean by so many average tokens.
PRIOR_TOKENS = 20
MAX_LANGUAGES = 10_000
#: Texts are scored in a round for every so many bytes, at most in ``ROUNDS``.
ROUND_BYTES, ROUNDS = 16 << 20, 8
WORD, PAIR, TRIGRAM = 1, 2, 3
#: Of an n-gram: its count, and as a context the numbers of n-grams that follow once, twice and more often, and all.
COUNTS = ("c", "n1", "n2", "n3", "total")
#: With the totals of a shard: how many counts are 1 to 4, how many there are, and their sum.
TOTALS = ("seen1", "seen2", "seen3", "seen4", "kinds", "seen")
BLOCK_SCHEMA = "block long, keys array<binary>, ends binary, tokens binary, vocabulary binary"
ASK_SCHEMA = "block long, n int, shard int, keys binary"
COUNT_SCHEMA = ", ".join(f"{c} binary" for c in COUNTS)
TOLD_SCHEMA = f"{ASK_SCHEMA}, {COUNT_SCHEMA}"
#: Replies to blocks, and one row a shard without a block: all its n-grams and their counts.
SUM_SCHEMA = f"{TOLD_SCHEMA}, " + ", ".join(f"{t} long" for t in TOTALS)
REPLY_SCHEMA = f"block long, n int, shard int, {COUNT_SCHEMA}"


def text_key(text: Column) -> Column:
    """What equal texts share, and others don't."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


def packed(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpacked(raw: bytes) -> bytes:
    return pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), "zstd", asbytes=True)


def planes(values: np.ndarray) -> bytes:
    """Numbers with the lowest bytes of all first, so that the empty bytes compress."""
    return packed(np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes())


def from_planes(raw: bytes, dtype: str) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(unpacked(raw), np.uint8).reshape(width, -1).T).view(dtype).ravel()


def to_blocks(rows: DataFrame) -> DataFrame:
    """Rows ``key, text`` as blocks: tokens are numbers of a block's words, of which 0 ends a text."""

    def block(number: int, held: list) -> pa.RecordBatch:
        keys, lengths, found = (sum((list(h[i]) for h in held), []) for i in range(3))
        coded = pa.chunked_array(found).combine_chunks().dictionary_encode()
        at, known = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        # Frequent words first: small numbers compress better.
        order = np.argsort(-np.bincount(at, minlength=len(known)), kind="stable")
        rank = np.empty(len(known), np.int64)
        rank[order] = np.arange(1, len(known) + 1)
        ends = np.cumsum(np.array(lengths, np.int64))
        tokens = np.insert(rank[at], ends - np.arange(1, len(ends) + 1), 0)
        vocabulary = [END_KEY] + [xxhash.xxh64_intdigest(known[i]) >> (64 - KEY_BITS) for i in order]
        out = {
            "block": [number], "keys": pa.array([keys], pa.list_(pa.binary())), "ends": [planes(ends.astype("<i8"))],
            "tokens": [planes(tokens.astype("<u4"))], "vocabulary": [planes(np.array(vocabulary, "<u8"))],
        }
        return pa.RecordBatch.from_pydict(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                found, at = words(*text_buffer(part.column("text")))
                held.append((part.column("key").to_pylist(), np.diff(at) + 1, [found]))
                size += len(found) + part.num_rows
                if size >= BLOCK_TOKENS:
                    yield block(number, held)
                    number, held, size = number + 1, [], 0
        if size:
            yield block(number, held)

    return rows.select("key", "text").mapInArrow(run, BLOCK_SCHEMA)


class BlockGrams:
    """A block's tokens with the contexts of one and two words, and its distinct n-grams in key order.

    ``keys`` has the n-grams of an order, ``at`` the number of each token's n-gram, ``context`` that of the n-gram
    without its last word, ``first`` a token of every n-gram.
    """

    def __init__(self, row: dict):
        self.ends = from_planes(row["ends"], "<i8")
        tokens = from_planes(row["tokens"], "<u4").astype(np.int64)
        vocabulary = from_planes(row["vocabulary"], "<u8")
        self.starts = np.concatenate([[0], self.ends[:-1]])
        # Before a text are two starts, which have the number behind all words.
        before = np.concatenate([[0], tokens[:-1]])
        before[self.starts] = len(vocabulary)
        word_keys, word_at = np.unique(np.append(vocabulary, np.uint64(START_KEY)), return_inverse=True)
        start = np.array([START_KEY], np.uint64)
        pair = bigram_keys(word_keys[word_at[before]], word_keys[word_at[tokens]])
        # The two starts are a context, but no n-gram of a text.
        pair_keys, pair_at = np.unique(np.append(pair, bigram_keys(start, start)), return_inverse=True)
        pair_at, starts_at = pair_at[:-1], pair_at[-1]
        context = np.concatenate([[0], pair_at[:-1]])
        context[self.starts] = starts_at
        gram_keys, gram_first, gram_at = np.unique(
            bigram_keys(pair_keys[context], word_keys[word_at[tokens]]), return_index=True, return_inverse=True
        )
        pair_first = np.zeros(len(pair_keys), np.int64)
        pair_first[pair_at] = np.arange(len(tokens))
        self.keys = {WORD: word_keys, PAIR: pair_keys, TRIGRAM: gram_keys}
        self.at = {WORD: word_at[tokens], PAIR: pair_at, TRIGRAM: gram_at}
        self.context = {PAIR: word_at[before], TRIGRAM: context}
        self.first = {PAIR: pair_first, TRIGRAM: gram_first}

    def told(self, order: int, answers: pd.DataFrame | None) -> dict[str, np.ndarray]:
        """What a learned block knows of the counts of an order, given the counts of the order above."""
        n = len(self.keys[order])
        if order == TRIGRAM:
            return {"c": np.bincount(self.at[TRIGRAM], minlength=n)}
        above = answered(answers)
        own = np.flatnonzero(above["c"] & 1)
        c, first = above["c"][own] >> 1, self.first[order + 1][own]
        follows = self.context[order + 1][first]
        return {
            "c": np.bincount(self.at[order][first], minlength=n),
            **{f"n{i}": np.bincount(follows[np.minimum(c, 3) == i], minlength=n) for i in (1, 2, 3)},
            "total": np.bincount(follows, c, minlength=n).astype(np.int64),
        }

    def by_shard(self, order: int, shards: int) -> Iterator[tuple[int, slice]]:
        """The shards of an order's n-grams, which are ranges of keys."""
        at = (self.keys[order] >> np.uint64(KEY_BITS - (shards.bit_length() - 1))).astype(np.int64)
        bounds = np.searchsorted(at, np.arange(shards + 1))
        return ((int(s), slice(bounds[s], bounds[s + 1])) for s in np.flatnonzero(np.diff(bounds)))


def packed_counts(counts: dict[str, np.ndarray], at: slice) -> list[bytes | None]:
    """Counts that an order does not have are null."""
    return [packed(pack_counts(counts[c][at])) if c in counts else None for c in COUNTS]


def summed_counts(parts: pd.DataFrame) -> dict[str, np.ndarray]:
    """The counts of all rows, end to end."""
    known = [c for c in COUNTS if len(parts) and parts[c].iloc[0] is not None]
    return {c: np.concatenate([unpack_counts(unpacked(x)) for x in parts[c]]) for c in known}


def answered(answers: pd.DataFrame) -> dict[str, np.ndarray]:
    """The counts of a block's n-grams of one order."""
    return summed_counts(answers.sort_values("shard"))


def _tell(order: int, shards: int) -> Callable[[pd.DataFrame, pd.DataFrame | None], pd.DataFrame]:
    """One learned block's distinct n-grams of an order and what it knows of their counts, a row a shard."""

    def tell(block: pd.DataFrame, answers: pd.DataFrame | None) -> pd.DataFrame:
        grams = BlockGrams(block.iloc[0].to_dict())
        told = grams.told(order, answers)
        out = [
            (block["block"].iloc[0], order, s, packed(pack_keys(grams.keys[order][at])), *packed_counts(told, at))
            for s, at in grams.by_shard(order, shards)
        ]
        return pd.DataFrame(out, columns=["block", "n", "shard", "keys", *COUNTS])

    return tell


def _sum(told: pd.DataFrame) -> pd.DataFrame:
    """One shard: add up the counts of all blocks, give each block the count of its keys, twice and one more for the
    one block that is to count a key for the next order, and keep the sums of all keys."""
    parts = [unpack_keys(unpacked(k)) for k in told["keys"]]
    keys, first, at = np.unique(np.concatenate(parts), return_index=True, return_inverse=True)
    edges = np.cumsum([0] + [len(p) for p in parts])
    del parts
    sums = {}
    for name, values in summed_counts(told).items():
        sums[name] = np.zeros(len(keys), np.int64)
        np.add.at(sums[name], at, values)
    c = sums["c"]
    values = 2 * c[at]
    values[first] += c > 0
    replies = told[["block", "n", "shard"]].astype({"block": "Int64"})
    replies["c"] = [packed(pack_counts(values[a:b])) for a, b in zip(edges[:-1], edges[1:])]
    whole = {"n": told["n"].iloc[0], "shard": told["shard"].iloc[0], "keys": packed(pack_keys(keys))}
    whole |= dict(zip(COUNTS, packed_counts(sums, slice(None))))
    whole |= dict(zip(TOTALS, [*(int((c == i).sum()) for i in (1, 2, 3, 4)), int((c > 0).sum()), int(c.sum())]))
    columns = ["block", "n", "shard", "keys", *COUNTS, *TOTALS]
    out = pd.concat([replies, pd.DataFrame([whole])], ignore_index=True).reindex(columns=columns)
    out = out.astype({t: "Int64" for t in TOTALS} | {b: object for b in ("keys", *COUNTS)})
    return out.where(out.notna(), None).astype({t: "Int64" for t in ("block", *TOTALS)})


def _ask(shards: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """All distinct n-grams of every block, a row an order and shard."""
    schema = pa.schema([("block", pa.int64()), ("n", pa.int32()), ("shard", pa.int32()), ("keys", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                grams = BlockGrams(row)
                for n in (WORD, PAIR, TRIGRAM):
                    out = [(row["block"], n, s, packed(pack_keys(grams.keys[n][at]))) for s, at in grams.by_shard(n, shards)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def _reply(asked: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
    """One shard and order: the counts of every block's n-grams."""
    out = asked[["block", "n", "shard"]].copy()
    if len(model):
        keys, counts = unpack_keys(unpacked(model["keys"].iloc[0])), summed_counts(model)
    else:
        keys, counts = np.zeros(0, np.uint64), {}
    replies = []
    for raw in asked["keys"]:
        own = unpack_keys(unpacked(raw))
        at = np.minimum(np.searchsorted(keys, own), max(len(keys) - 1, 0))
        known = keys[at] == own if len(keys) else np.zeros(len(own), bool)
        found = {c: np.where(known, values[at], 0) for c, values in counts.items()} if len(keys) else {}
        missing = COUNTS if asked["n"].iloc[0] != TRIGRAM else COUNTS[:1]
        found |= {c: np.zeros(len(own), np.int64) for c in missing if c not in found}
        replies.append(packed_counts(found, slice(None)))
    for i, name in enumerate(COUNTS):
        out[name] = [r[i] for r in replies]
    return out


@dataclass(frozen=True)
class Order:
    """Of one order: Chen and Goodman's D1, D2 and D3+, and the numbers they come from."""

    discounts: tuple[float, float, float]
    seen1: int
    seen2: int
    kinds: int
    seen: int

    @staticmethod
    def of(replies: DataFrame) -> Order:
        """From the shards' totals; only these few numbers come to the driver."""
        row = replies.agg(*[F.coalesce(F.sum(t), F.lit(0)).alias(t) for t in TOTALS]).first()
        n1, n2, n3, n4 = (max(row[f"seen{i}"], 1) for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        found = tuple(min(max(d, 0.1), i) for i, d in ((1, 1 - 2 * y * n2 / n1), (2, 2 - 3 * y * n3 / n2), (3, 3 - 4 * y * n4 / n3)))
        return Order(found, row.seen1, row.seen2, row.kinds, row.seen)

    def left(self, c: np.ndarray) -> np.ndarray:
        """Counts after their discount."""
        d1, d2, d3 = self.discounts
        return np.maximum(c - np.where(c == 1, d1, np.where(c == 2, d2, d3)), 0.0)

    def taken(self, n1, n2, n3):
        """What is discounted from so many counts of one, two and more."""
        return n1 * self.discounts[0] + n2 * self.discounts[1] + n3 * self.discounts[2]


def log_probabilities(grams: BlockGrams, counts: dict[int, dict[str, np.ndarray]], orders: dict[int, Order]) -> np.ndarray:
    """log10 of every token's probability: each order's discounted share, and what it takes times the order below."""
    words_ = orders[WORD]
    total = words_.seen or 1
    taken = words_.taken(words_.seen1, words_.seen2, words_.kinds - words_.seen1 - words_.seen2)
    uniform = (taken / total if words_.kinds else 1.0) / (words_.kinds + 1)
    p = words_.left(counts[WORD]["c"])[grams.at[WORD]] / total + uniform
    for n in (PAIR, TRIGRAM):
        context = {c: values[grams.context[n]] for c, values in counts[n - 1].items()}
        gone = orders[n].taken(context["n1"], context["n2"], context["n3"])
        within = np.maximum(context["total"], 1)
        own = orders[n].left(counts[n]["c"])[grams.at[n]]
        p = np.where(context["total"] > 0, own / within + gone / within * p, p)
    return np.log10(p)


def learn(training: DataFrame) -> tuple[DataFrame, dict[int, Order]]:
    """The model of all rows (``key, text``): a row an order and shard, and each order's numbers."""
    shards = shard_count(training.sparkSession)
    blocks = materialize(to_blocks(training), "kn-learned", once=True)
    sums: dict[int, DataFrame] = {}
    for order in (TRIGRAM, PAIR, WORD):
        tell, each = _tell(order, shards), blocks.groupBy("block")
        if order == TRIGRAM:

            def count(block: pd.DataFrame) -> pd.DataFrame:
                return _tell(TRIGRAM, shards)(block, None)

            told = each.applyInPandas(count, TOLD_SCHEMA)
        else:
            above = sums[order + 1].where("block IS NOT NULL").select("block", "n", "shard", *COUNTS)
            told = each.cogroup(above.groupBy("block")).applyInPandas(tell, TOLD_SCHEMA)
        sums[order] = materialize(told.groupBy("shard").applyInPandas(_sum, SUM_SCHEMA), f"kn-sums-{order}", once=True)
    orders = {n: Order.of(part) for n, part in sums.items()}
    whole = reduce(DataFrame.unionByName, sums.values()).where("block IS NULL")
    model = materialize(whole.select("n", "shard", "keys", *COUNTS), "kn-model", once=True)
    discard(blocks, *sums.values())
    return model, orders


def text_scores(rows: DataFrame, training: DataFrame) -> DataFrame:
    """``key, n_tokens, log_prob`` of every distinct ``key`` of ``rows`` (``key, text``): words and one end, and
    the text's log10 probability under the model of all rows of ``training`` (``key, text``)."""
    spark = rows.sparkSession
    shards = shard_count(spark)
    model, orders = learn(training)

    def scored(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row = block.iloc[0].to_dict()
        grams = BlockGrams(row)
        logs = log_probabilities(grams, {n: answered(part) for n, part in answers.groupby("n")}, orders)
        lengths = np.diff(grams.ends, prepend=0)
        return pd.DataFrame({"key": list(row["keys"]), "n_tokens": lengths, "log_prob": np.add.reduceat(logs, grams.starts)})

    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    rounds = min(max(size // ROUND_BYTES, 1), ROUNDS)
    scores = []
    for i in range(rounds):
        # Equal texts meet in one round.
        own = rows.where(F.pmod(F.xxhash64("key"), F.lit(rounds)) == i) if rounds > 1 else rows
        blocks = materialize(to_blocks(own), "kn-blocks", once=True)
        asked = blocks.mapInArrow(_ask(shards), ASK_SCHEMA)
        replies = materialize(
            asked.groupBy("n", "shard").cogroup(model.groupBy("n", "shard")).applyInPandas(_reply, REPLY_SCHEMA),
            "kn-replies", once=True,
        )
        by_text = (
            blocks.groupBy("block").cogroup(replies.groupBy("block"))
            .applyInPandas(scored, "key binary, n_tokens long, log_prob double")
        )
        best = by_text.groupBy("key").agg(F.max("n_tokens").alias("n_tokens"), F.max("log_prob").alias("log_prob"))
        scores.append(materialize(best, "kn-scores", once=True))
        discard(blocks, replies)
    discard(model)
    return reduce(DataFrame.unionByName, scores)


@dataclass(frozen=True)
class KneserNey:
    """The model of all ``text``s of a table."""

    texts: DataFrame


def fit(trusted: DataFrame, text: str = "text") -> KneserNey:
    """Fit to all rows given; null texts are empty. No rows give a model that knows no word."""
    return KneserNey(trusted.select(F.col(text).cast("string").alias("text")))


def score(df: DataFrame, model: KneserNey, text: str = "text") -> DataFrame:
    """Add ``n_tokens`` (words and one end) and ``log_prob`` (log10) of every whole text."""
    key = free_name(df, "_key")
    keyed = df.drop("n_tokens", "log_prob").withColumn(key, text_key(F.col(text)))
    own = keyed.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    scores = text_scores(own, model.texts.select(text_key(F.col("text")).alias("key"), "text"))
    return keyed.join(scores.withColumnRenamed("key", key), key).select(*[c for c in keyed.columns if c != key], "n_tokens", "log_prob")


def learned_from(doc_id: Column) -> Column:
    """Whether a trusted document is counted; the others give the thresholds."""
    return F.pmod(F.xxhash64(F.lit("fold"), doc_id), F.lit(2)) == 0


def classify(
    df: DataFrame,
    trusted: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    language: str = "lang",
    keep_text: bool = False,
    quantile: float = QUANTILE,
) -> DataFrame:
    """``df``'s rows (without the text, unless asked) with ``n_tokens``, ``log_prob``, ``perplexity``,
    ``threshold`` and ``kept``. ``trusted`` has the ids of trusted documents in a column ``doc_id``.

    The mean log probability that is compared is drawn to the language's mean, as for
    ``PRIOR_TOKENS`` more tokens. Null languages are one language. Null and empty texts are an end
    alone; short as they are, they stay. Null ids are never trusted. Repeated ids in ``trusted`` count
    once. A language with fewer than ``MIN_TRUSTED`` trusted documents to calibrate on has a null
    threshold, and nothing of it is rejected. Columns with the new names are replaced. A document that equals the
    cut is kept, and texts of any length are scored whole. No rows give no rows.
    """
    spark = df.sparkSession
    ids = materialize(trusted.select(F.col("doc_id").cast("long").alias("_id")).where("_id IS NOT NULL").distinct(), "kn-trusted")
    new = ["n_tokens", "log_prob", "perplexity", "threshold", "kept"]
    key = free_name(df, "_key")
    keyed = df.drop(*new).withColumn(key, text_key(F.col(text)))
    rows = keyed.select(F.col(key).alias("key"), F.col(doc_id).cast("long").alias("_id"), F.col(text).cast("string").alias("text"))
    training = rows.join(ids.where(learned_from(F.col("_id"))), "_id", "left_semi")
    scores = text_scores(rows.drop("_id"), training.drop("_id")).withColumnRenamed("key", key)
    scored = (keyed if keep_text else keyed.drop(text)).join(scores, key)
    # One row a document, without its text.
    judged_by = keyed.select(F.col(doc_id).cast("long").alias("_id"), F.col(language).alias("_lang"), key)
    judged_by = judged_by.join(ids.where(~learned_from(F.col("_id"))), "_id", "left_semi")
    held = materialize(judged_by.join(scores, key).select("_lang", "n_tokens", "log_prob"), "kn-held")
    means = held.groupBy("_lang").agg((F.sum("log_prob") / F.sum("n_tokens")).alias("_mean"), F.count(F.lit(1)).alias("n"))
    rows = means.limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    lang_type = scored.schema[language].dataType
    lang, mean, cut = (free_name(scored, n) for n in ("_lang", "_mean", "_cut"))

    def drawn(means: Column) -> Column:
        means = F.coalesce(means, F.lit(0.0))
        return (F.col("log_prob") + PRIOR_TOKENS * means) / (F.col("n_tokens") + PRIOR_TOKENS) - means

    def by_language(rows: list[tuple], *columns: str) -> DataFrame:
        # One row a language: bounded, and checked above.
        fields = [T.StructField(columns[0], lang_type), *(T.StructField(c, T.DoubleType()) for c in columns[1:])]
        return F.broadcast(spark.createDataFrame(rows, T.StructType(fields)))

    known = {r["_lang"]: r["_mean"] for r in rows if r.n >= MIN_TRUSTED}
    centre = by_language([*known.items()], "of", "_mean")
    calibrated = held.join(centre, held["_lang"].eqNullSafe(centre["of"])).withColumn("_drawn", drawn(F.col("_mean")))
    cuts = calibrated.groupBy("_lang").agg(F.percentile_approx("_drawn", quantile, 10_000).alias("cut")).collect()
    limits = by_language([(r["_lang"], known[r["_lang"]], r.cut) for r in cuts], lang, mean, cut)
    found = scored.join(limits, scored[language].eqNullSafe(limits[lang]), "left")
    return found.select(
        *(scored[c] for c in scored.columns if c != key),
        F.pow(F.lit(10.0), -scored["log_prob"] / scored["n_tokens"]).alias("perplexity"),
        limits[cut].alias("threshold"),
        F.coalesce(drawn(limits[mean]) >= limits[cut], F.lit(True)).alias("kept"),
    )
