"""SentencePiece by backtracking, the conversation trie and importance resampling, on plain versions and odd rows."""

import hashlib
import math
import random
import re
import struct
from collections import defaultdict
from zlib import crc32

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from spanweave.llm import prefix_trie, resampling, sentencepiece_bpe

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PIECES = ["a", "b", "the", " ", "  ", "     ", "\n", "\t", "é", "中", "😀", "▁", "▁▁", "<s>", "</s>", "<unk>", "<0x41>", "\x00", "ing", "er", "0", "12", " t", "'s", "ء", "ÿ", "a" * 40, " " * 37, "==", "----", "//", "ﬁ"]
ODD = "doc_id long, text string, ids int, decoded int, rank string, weight string, bucket int, n int, _order int"


def odd_texts():
    long = "lorem Ipsum dolor " * 30_000
    return [None, "", " \n\t ", "One", "one two", "a b c d", "a b c d", "É è ß 中文 ǅ", "x\x00y\x85z  w", long, "ab" * 40_000, "  <s> ▁▁ "]


def odd_rows():
    rows = [(100 - i, t, 1, 2, "r", "w", 3, 4, 5) for i, t in enumerate(odd_texts())]
    return rows + [rows[5], rows[5], (None, "a null id", 1, 2, "r", "w", 3, 4, 5)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), ODD).repartition(3)


@pytest.mark.parametrize("seed", range(4))
def test_backtracking_equals_the_library(seed):
    rng = random.Random(seed)
    alphabet = PIECES if seed % 2 else list("abcdef t ")
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(500)]
    texts += ["", " " * 10_001, "中文" * 5000, "the" * 9000]
    own, library = sentencepiece_bpe.codec(MODEL), SentencePieceProcessor(model_file=MODEL)
    ids, at = own.encode(texts)
    want = [library.encode(t, add_bos=True, add_eos=True) for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == want
    assert own.decode(ids, at) == [library.decode(w) for w in want]


def test_backtracking_takes_back_pieces():
    """Where the longest matches fail, failed positions are remembered and shorter matches follow."""
    own = sentencepiece_bpe.codec(MODEL).vocabulary
    rng, taken_back = random.Random(7), 0
    for _ in range(3000):
        text = "".join(rng.choice("aenrst") for _ in range(12))
        pieces = sentencepiece_bpe.encode_fragment(own, text)
        assert pieces == own.merge(list(text))
        taken_back += len(pieces[0]) < sentencepiece_bpe.longest_matches(own, text)[0]
    assert taken_back > 20


def test_matches_by_windows(monkeypatch):
    own = sentencepiece_bpe.codec(MODEL).vocabulary
    text = "".join(random.Random(3).choice("aenrst") for _ in range(4000))
    whole = sentencepiece_bpe.encode_fragment(own, text)
    monkeypatch.setattr(sentencepiece_bpe, "WINDOW", 5)
    assert sentencepiece_bpe.encode_fragment(own, text) == whole


def test_remembered_forgets_the_oldest():
    kept = sentencepiece_bpe.Remembered(2)
    for key in "abcd":
        kept.keep(key, key)
    assert kept["b"] == "b"  # of the generation before; asked for, it is kept again
    kept.keep("e", "e")
    with pytest.raises(KeyError):
        kept["a"]


def test_sentencepiece_table(odd):
    library = SentencePieceProcessor(model_file=MODEL)
    done = sentencepiece_bpe.encode_and_decode(odd, MODEL)
    got = sorted((str(r["doc_id"]), bytes(r["ids"]), r["decoded"], r["bucket"]) for r in done.collect())
    want = []
    for doc_id, text, *_ in odd_rows():
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        want.append((str(doc_id), struct.pack(f"<{len(ids)}I", *ids), library.decode(ids), 3))
    assert got == sorted(want)
    assert done.columns == [c for c in odd.columns if c not in ("ids", "decoded")] + ["ids", "decoded"]
    assert sentencepiece_bpe.encode_and_decode(odd.limit(0), MODEL).count() == 0


def plain_trie(rows, family=20, most=4):
    logs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            logs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    logs = {c: [t[2:] for t in sorted(v)] for c, v in logs.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(logs):
        h = crc32(str(c).encode()) % most
        seq = tuple(logs.get(c - int(math.fmod(c, family)), [])[:h] + logs[c][h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    children = defaultdict(list)
    for s in members:
        if s:
            children[s[:-1]].append(s)
    leaves, saved = {}, {}
    for s in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", s[-1][1])) if s else 0
        leaves[s] = sum(leaves[k] for k in children[s]) or 1
        saved[s] = (len(members[s]) - 1) * words + sum(saved[k] for k in children[s])
    return sorted(
        (m[0], len(s), members[s[:-1]][0] if s else None, len(m), len(children[s]), leaves[s], saved[s],
         hashlib.sha256(",".join(map(str, ends[s])).encode()).hexdigest())
        for s, m in members.items()
    )


def trie_rows(df, **kw):
    return sorted(tuple(r)[:7] + (r["ends_sha256"],) for r in prefix_trie.conversation_trie(df, **kw).collect())


CONV = "conv_id long, turn long, role string, text string, name string, depth int, _part int, symbol int, h int"


def conversation_rows(seed, n_convs, longest, alphabet):
    rng = random.Random(seed)
    for c in range(n_convs):
        for turn in range(rng.choice([1, 2, longest, rng.randint(1, longest)])):
            yield (c, turn if turn else rng.choice([None, 0]), rng.choice(["u", None]), rng.choice(alphabet))


@pytest.mark.parametrize("seed,n_convs,longest", [(1, 60, 9), (2, 30, 33), (3, 90, 2), (4, 5, 1)])
def test_trie_equals_plain(spark, seed, n_convs, longest):
    rows = list(conversation_rows(seed, n_convs, longest, ["", None, "a b", "c d", "x " * 400]))
    rows += rows[:5] + [(None, 1, "u", "no conversation")]
    rows += [(500 + c, t, "u", "same") for c in range(40) for t in range(6)]
    df = spark.createDataFrame([(*r, "n", 1, 2, 3, 4) for r in rows], CONV).repartition(5)
    assert trie_rows(df) == plain_trie(rows)


def test_trie_without_turns_and_without_rows(spark):
    # Conversation 1 has fewer own turns than the head's turns it loses, and the head is absent.
    taken = next(c for c in range(1, 20) if crc32(str(c).encode()) % 4 == 3)
    rows = [(taken, 0, "u", "a"), (taken, 1, "u", "b")]
    df = spark.createDataFrame([(*r, "n", 1, 2, 3, 4) for r in rows], CONV)
    assert trie_rows(df) == plain_trie(rows)
    assert trie_rows(df)[0][1:7] == (0, None, 1, 0, 1, 0)
    assert trie_rows(df.limit(0)) == []
    assert trie_rows(df, family=1) == plain_trie(rows, family=1)


def test_trie_broadcasts_nothing(spark, monkeypatch):
    plans, keep = [], prefix_trie.materialize

    def plan(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(prefix_trie, "materialize", lambda df, *a, **kw: keep(plan(df), *a, **kw))
    rows = [(c, t, "user", f"{c % 3} {t}") for c in range(12) for t in range(5)]
    plan(prefix_trie.conversation_trie(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    assert sum(p.count("SortMergeJoin") for p in plans) >= 10
    assert not [p for p in plans if "Broadcast" in p]


def test_trie_hash_in_pieces(spark, monkeypatch):
    rows = [(c, t, "u", "same") for c in range(-50, 300) for t in range(3)]
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 7)
    df = spark.createDataFrame([(*r, "n", 1, 2, 3, 4) for r in rows], CONV)
    assert trie_rows(df, family=1) == plain_trie(rows, family=1)


def plain_resample(rows, target, percent=5, min_words=20, n_buckets=10_000, seed=42):
    lower = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}

    def features(text):
        words = re.findall(resampling.WORD, (text or "").translate(lower))
        runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
        return len(words), [crc32(r.encode()) % n_buckets for r in runs]

    made = [(doc_id, *features(text)) for doc_id, text in rows]
    s, t = [0] * n_buckets, [0] * n_buckets
    for _, _, found in made:
        for b in found:
            s[b] += 1
    for text in target:
        for b in features(text)[1]:
            t[b] += 1
    big_s, big_t = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + n_buckets) / ((s[b] + 1) * (big_t + n_buckets)))) for b in range(n_buckets)]
    scored = []
    for doc_id, n, found in made:
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        scored.append((doc_id, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    may = sorted((r for r in scored if r[1] >= min_words), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    rank = [(r, i + 1 if i < percent * len(may) // 100 else None) for i, r in enumerate(may)]
    rank += [(r, None) for r in scored if r[1] < min_words]
    return sorted((str(r[0]), *r[1:], p or 0) for r, p in rank)


def resampled(df, target, **kw):
    return sorted((str(r[0]), *r[1:5], r[5] or 0) for r in resampling.resample(df, target, **kw).collect())


def test_resampling_equals_plain(spark, sf_dir):
    docs, target = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "benchmark"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    texts = [r.text for r in target.collect()]
    assert resampled(docs, target) == plain_resample(rows, texts)
    assert resampled(docs, target, percent=30, min_words=1, n_buckets=7, seed=3) == plain_resample(rows, texts, 30, 1, 7, 3)


def test_resampling_odd_rows(spark, odd, monkeypatch):
    monkeypatch.setattr(resampling, "PIECE_CHARS", 50)
    rows = [(r[0], r[1]) for r in odd_rows()]
    target = spark.createDataFrame([("one two three",), (None,), ("",)], "text string")
    want = plain_resample(rows, ["one two three", None, ""], percent=50, min_words=1)
    assert resampled(odd, target, percent=50, min_words=1) == want
    assert resampled(odd.limit(0), target) == []
    assert resampled(odd, target.limit(0), percent=100, min_words=0) == plain_resample(rows, [], 100, 0)


@pytest.mark.parametrize("size", [1, 3, 10, 1000])
def test_pieces_cut_no_word(size):
    text = "aa bb,cccc é中d  \n x" + "y" * 30 + " z"
    parts = list(resampling.pieces(text, size))
    assert "".join(parts) == text
    found = [w for p in parts for w in re.findall(resampling.WORD, p)]
    assert found == re.findall(resampling.WORD, text)


def test_buckets_of_runs_hash_words_only(monkeypatch):
    texts = ["One two,THREE four one two", None, "é 中文 \U0001f600x a\x00B", "", "one", " . ", "x" * 70_000 + " y " + "é" * 40_000 + " z"]
    plain = [re.findall(resampling.WORD, (t or "").lower()) for t in texts]
    runs = [sorted(crc32(" ".join(w[i : i + n]).encode()) % 997 for n in (1, 2, 3) for i in range(len(w) - n + 1)) for w in plain]
    resampling.zeros(20)  # the tables, once a worker
    hashed = []
    monkeypatch.setattr(resampling, "crc32", lambda raw: hashed.append(raw) or crc32(raw))
    n_words, n_features, found = resampling.buckets_of(texts, 997)
    ends = n_features.cumsum().tolist()
    assert n_words.tolist() == [len(w) for w in plain]
    assert [sorted(found[a:b].tolist()) for a, b in zip([0, *ends], ends)] == runs
    assert len(hashed) <= sum(map(len, plain)) + resampling.MAX_WORDS  # and the spaces


def test_stops_are_cut_without_changing_ids():
    import pyarrow as pa
    from tokenizers import Tokenizer

    from spanweave.llm import bpe, textbatch, token_files

    path = public_tokenizers.path("word_bpe_49k.json")
    rng = random.Random(11)
    bits = ["word", "It's", "e.g.", "x", "...", ".", ",", "!?", "1.5", "é.", "Σa.", "'s,", "<|endoftext|>", "<|ENDOFTEXT|>", "Word", "IT'S", "H\u0331", "I\u0307X", ":", "中.", "'", "-", " ", " ", "\n"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(400)]
    found, at = token_files.simpler_words(*textbatch.words(*textbatch.text_buffer(pa.array(texts))))
    assert len(found) > at[-1] - 1 and at[-1] == len(found)
    ids, lengths = bpe.FragmentEncoder(path).encode(found)
    ends = [0, *lengths.cumsum().tolist()]
    library = Tokenizer.from_file(path)
    got = [ids[ends[a] : ends[b]].tolist() for a, b in zip(at[:-1], at[1:])]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
    empty, none = token_files.simpler_words(*textbatch.words(*textbatch.text_buffer(pa.array(["", None], pa.string()))))
    assert len(empty) == 0 and none.tolist() == [0, 0, 0]


def test_token_files_are_read_by_many_tasks(spark, sf_dir):
    from pyspark.sql import functions as F

    from spanweave.llm import token_files
    from spanweave.operators.lineage import scratch_path

    root = scratch_path(spark, "token-files")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few texts would be one part
    manifest = token_files.write_token_files(docs, public_tokenizers.path("word_bpe_49k.json"), root, end_id=2)
    read = token_files.read_token_files(manifest, root)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert manifest.count() > 1
    assert read.select(F.spark_partition_id()).distinct().count() > 1
