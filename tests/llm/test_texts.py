"""Operators on texts: against plain versions, on the driver's tables and on odd ones."""

import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tests.llm import brute
from tokenizers import Tokenizer

from spanweave.llm import bpe, language_id, lm_score, queries, quality_rules, simhash, textbatch, token_files
from spanweave.operators.lineage import scratch_path

ODD = "doc_id long, text string, source string, lang string, score double, ids string, kept int, _row int, fingerprint int"
LONG = "lorem ipsum dolor " * 40_000


def odd_rows():
    """Nulls, empty and long texts, repeated rows, ids in disorder, and clashing columns."""
    texts = [None, "", " \n\t ", "One", "one two", "a b c d", "a b c d", "É è ß 中文 ǅ", "x\x00y\x85z  w", LONG, "<|endoftext|> it's <|startoftext|>'S"]
    rows = [(100 - i, t, None if i % 3 == 0 else f"h{i % 2}", None if i % 4 == 0 else "en", 0.5, "i", 3, i, 9) for i, t in enumerate(texts)]
    return rows + [rows[5], rows[5], rows[1]]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), ODD).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], ODD)


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}


def tokenizer(name):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.no_truncation()
    t.no_padding()
    return t


PIECES = ["'s", "'", "re", "ll", "<|endoftext|>", "<|startoftext|>", "  ", " ", "\n", "\n\n", "\t", "a", "Z", "é", "é", "1", "23", "٣", "!", "~'",
          " ", " ", "　", "中", "😀", "\r\n", "ß", "s", "t", "<|", "|>", "_", "-", "qz", "\x85", "\x1c", "'S", "Σ", "ΑΣ", "İ", "ǅ"]


def random_texts(seed, n=400):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 30))) for _ in range(n)]


@pytest.mark.parametrize("seed", range(5))
def test_forced_boundaries_equal_the_library(seed):
    texts = random_texts(seed)
    own = bpe.codec(public_tokenizers.path("byte_bpe_50k.json"))
    library = tokenizer("byte_bpe_50k.json")
    ids, at = own.encode(*textbatch.text_buffer(pa.array(texts)))
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == want
    assert own.decode(ids, at) == [library.decode(w, skip_special_tokens=False) for w in want]


def test_encoder_forgets_and_learns_again():
    encoder = bpe.FragmentEncoder(public_tokenizers.path("byte_bpe_50k.json"), kept=3)
    fragments = pa.array([b" one", b" two", b" three", b" four", b" one"], pa.large_binary())
    first = encoder.encode(fragments)
    second = encoder.encode(fragments)
    assert [x.tolist() for x in first] == [x.tolist() for x in second] and len(encoder.index) == 4


def test_decoding_broken_bytes():
    own, library = bpe.codec(public_tokenizers.path("byte_bpe_50k.json")), tokenizer("byte_bpe_50k.json")
    ids = library.encode("中😀é", add_special_tokens=False).ids
    for a in range(len(ids)):
        part = np.array(ids[a:] + ids[: a + 1])
        assert own.decode(part, np.array([0, len(part)])) == [library.decode(part.tolist(), skip_special_tokens=False)]


def test_bpe_query(spark, sf_dir, documents):
    got = by_id(queries.REGISTERED["op8_bpe"](spark, sf_dir), "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == brute.bpe(documents, tokenizer("byte_bpe_50k.json"))


def test_bpe_on_odd_rows(odd, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = bpe.encode_and_decode(odd, path).collect()
    library = tokenizer("byte_bpe_50k.json")
    assert len(rows) == len(odd_rows())
    for r in rows:
        assert r.ids == library.encode(r.text or "", add_special_tokens=False).ids and r.decoded == (r.text or "")
        assert r.kept == 3 and r.score == 0.5
    assert bpe.encode_and_decode(empty, path).count() == 0


def test_token_files_query(spark, sf_dir, documents):
    got = by_id(queries.REGISTERED["op6_token_files"](spark, sf_dir), "start", "n_tokens", "ids_crc32")
    assert got == brute.token_files(documents, tokenizer("word_bpe_49k.json"), 2)


def test_token_files_on_odd_rows(spark, odd, empty):
    path, root = public_tokenizers.path("word_bpe_49k.json"), scratch_path(spark, "odd")
    more = odd.union(spark.createDataFrame([(None, "no id", None, None, 0.0, "", 0, 0, 0)], ODD))
    rows = token_files.read_token_files(token_files.write_token_files(more, path, root, 7), root).collect()
    library = tokenizer("word_bpe_49k.json")
    want = sorted(
        (-(2**63) if r.doc_id is None else r.doc_id, tuple(library.encode(r.text or "", add_special_tokens=False).ids + [7]))
        for r in more.collect()
    )
    key = lambda r: r.start
    got = [(-(2**63) if r.doc_id is None else r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in sorted(rows, key=key)]
    assert [g[0] for g in got] == [w[0] for w in want] and sorted(got) == want
    starts = np.cumsum([0] + [len(g[1]) for g in got])
    assert [r.start for r in sorted(rows, key=key)] == starts[:-1].tolist()
    assert all(r.n_tokens == len(r.ids) // 4 for r in rows)
    root = scratch_path(spark, "none")
    assert token_files.read_token_files(token_files.write_token_files(empty, path, root, 7), root).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_word_pieces_do_not_depend_on_spaces(seed):
    library = tokenizer("word_bpe_49k.json")
    encoder = bpe.FragmentEncoder(public_tokenizers.path("word_bpe_49k.json"))
    for text in random_texts(seed, 200):
        found, _ = textbatch.words(*textbatch.text_buffer(pa.array([text])))
        assert encoder.encode(found)[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_words_equal_the_pattern():
    for seed in range(3):
        texts = [None, *random_texts(seed, 200), ""]
        found, at = textbatch.words(*textbatch.text_buffer(pa.array(texts)), lower=True)
        got = [[w.decode() for w in found[a : b].to_pylist()] for a, b in zip(at[:-1], at[1:])]
        assert got == [brute.words((t or "").translate(brute.LOWER)) for t in texts]


def test_simhash_query(spark, sf_dir, documents):
    got = by_id(queries.REGISTERED["op5_simhash"](spark, sf_dir), "fingerprint", "component_id")
    assert got == brute.simhash(documents)


def test_simhash_finds_every_ball(spark):
    """Fingerprints at 0 to 4 bits from each other, all pairs against the balls."""
    rng = random.Random(3)
    prints = set()
    for _ in range(60):
        base = rng.getrandbits(64)
        prints |= {base}
        for _ in range(4):
            flipped = base
            for b in rng.sample(range(64), rng.randint(1, 4)):
                flipped ^= 1 << b
            prints.add(flipped)
    signed = [(i, [p - (1 << 64) if p >> 63 else p]) for i, p in enumerate(sorted(prints))]
    df = spark.createDataFrame(signed, "id long, fp array<long>")
    links = [(r.src, r.dst) for r in simhash.similar_pairs(df).collect()]
    ids = list(range(len(prints)))
    ordered = sorted(prints)
    close = [(a, b) for a in ids for b in ids[:a] if (ordered[a] ^ ordered[b]).bit_count() <= 2]
    assert {(max(x), min(x)) for x in links} <= set(close)
    assert brute.components(ids, links) == brute.components(ids, close)


def long_prints(spark, prints):
    """A table of 256-bit fingerprints, numbered in order."""
    rows = [(i, [int(x) for x in np.array([(p >> (64 * k)) % 2**64 for k in range(4)], np.uint64).view(np.int64)]) for i, p in enumerate(prints)]
    return spark.createDataFrame(rows, "id long, fp array<long>")


def close_pairs(prints, radius):
    return {(a, b) for b in range(len(prints)) for a in range(b) if (prints[a] ^ prints[b]).bit_count() <= radius}


def flipped(rng, value, bits):
    for b in bits:
        value ^= 1 << b
    return value


@pytest.mark.parametrize("members", [8192, 16])
def test_simhash_verifies_pairs_that_their_head_is_far_from(spark, monkeypatch, members):
    """All share one word with the smallest id and each is too far from it; among each other pairs are close."""
    monkeypatch.setattr(simhash, "MEMBERS", members)
    rng = random.Random(11)
    head = rng.getrandbits(256)
    prints = [head]
    for _ in range(20):
        far = flipped(rng, head, rng.sample(range(32, 256), 90))
        prints += [far, flipped(rng, far, rng.sample(range(32, 256), 35)), flipped(rng, far, rng.sample(range(32, 256), 30))]
    links = [(r.src, r.dst) for r in simhash.similar_pairs(long_prints(spark, prints), 4, 32, 39).collect()]
    close = close_pairs(prints, 39)
    assert set(links) <= close and len(close) >= 40
    ids = list(range(len(prints)))
    assert brute.components(ids, links) == brute.components(ids, close)


@pytest.mark.parametrize(("lanes", "word_bits", "radius"), [(4, 32, 39), (1, 64, 7)])
def test_simhash_reaches_the_whole_radius(spark, lanes, word_bits, radius):
    """Pairs at up to the radius, their bits dealt evenly over the words."""
    rng = random.Random(7)
    prints = []
    for i in range(40):
        base = rng.getrandbits(64 * lanes)
        n = radius + i % 2
        spread = [b * 64 * lanes // n for b in range(n)]
        prints += [base, flipped(rng, base, spread)]
    table = long_prints(spark, prints).withColumn("fp", F.slice("fp", 1, lanes))
    links = {(r.src, r.dst) for r in simhash.similar_pairs(table, lanes, word_bits, radius).collect()}
    assert links == close_pairs(prints, radius) and len(links) >= 20


def test_simhash_on_odd_rows(odd, empty):
    got = simhash.near_duplicates(odd, keep_text=True).collect()
    assert len(got) == len(odd_rows())
    want = brute.simhash([(r.doc_id, r.text) for r in got])
    for r in got:
        assert f"{r.fingerprint[0] % 2**64:016x}" == want[r.doc_id][0] and r.component_id == want[r.doc_id][1]
    heads = [r.component_id for r in got if r.kept]
    assert sorted(heads) == sorted({r.component_id for r in got})
    assert all(r.doc_id == r.component_id for r in got if r.kept)
    assert simhash.near_duplicates(empty).count() == 0
    clash = odd.select("doc_id", "text", "_row", F.lit("h").alias("head"), F.lit("f").alias("fp"))
    found = simhash.near_duplicates(clash)
    assert found.columns == ["doc_id", "_row", "head", "fp", "fingerprint", "component_id", "kept"]
    assert sorted((r.doc_id, r["_row"]) for r in found.collect()) == sorted((r[0], r[7]) for r in odd_rows())


def test_long_fingerprints_find_less_similar_texts(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    base = [[rng.choice(vocabulary) for _ in range(200)] for _ in range(40)]
    rows = []
    for i, text in enumerate(base):
        rows.append((2 * i, " ".join(text)))
        near = list(text)
        for at in rng.sample(range(200), 2):
            near[at] = "changed"
        rows.append((2 * i + 1, " ".join(near)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = simhash.near_duplicates(df, size=5, lanes=4, word_bits=32, radius=38).collect()
    assert all(r.component_id // 2 == r.doc_id // 2 for r in found)
    assert sum(r.kept for r in found) == 40


def test_language_id(spark, sf_dir):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.REGISTERED["op2_language_id"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in docs if brute.remainder(i, 5) == 0}
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in held]) >= 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_predictions_equal_plain_ones(spark, sf_dir, monkeypatch):
    """Against counts of n-grams in plain dictionaries and sums of logarithms; in batches of any size."""
    def plain_buckets(text):
        spaced = " " + " ".join("".join(c if c.isalpha() else " " for c in (text or "").lower()).split()) + " "
        for n in language_id.ORDERS:
            for i in range(len(spaced) - n + 1 if spaced.strip() else 0):
                h = n
                for c in spaced[i : i + n]:
                    h = (h ^ ord(c)) * 0x9E3779B97F4A7C15 % 2**64
                    h ^= h >> 29
                yield h % language_id.BUCKETS

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").orderBy("doc_id").limit(60)
    short = docs.select("doc_id", F.substring("text", 1, 12).alias("text"), "lang")
    rows = docs.collect()
    counts, priors = {}, Counter(r.lang for r in rows if r.lang is not None)
    for r in rows:
        if r.lang is not None:
            counts.setdefault(r.lang, Counter()).update(plain_buckets(r.text))

    def plain(text):
        used = Counter(plain_buckets(text))
        if not used:
            return "und", 0.0
        logs = {}
        for lang in sorted(counts):
            total = sum(counts[lang].values()) + language_id.ALPHA * language_id.BUCKETS
            logs[lang] = math.log(priors[lang] / sum(priors.values())) + math.fsum(
                n * math.log((counts[lang][b] + language_id.ALPHA) / total) for b, n in used.items()
            )
        best = max(logs, key=logs.get)
        return best, 1 / math.fsum(math.exp(x - logs[best]) for x in logs.values())

    model = language_id.train(docs)
    for size in (1, 1 << 18):
        monkeypatch.setattr(language_id, "SPARSE_ENTRIES", size)
        for table in (docs, short):
            own = [r.text for r in table.collect()] + [None, "", "12 !"]
            labels, scores = model.predict(own)
            for text, label, score in zip(own, labels, scores):
                want = plain(text)
                assert label == want[0] and score == pytest.approx(want[1], rel=1e-6)
    monkeypatch.setattr(language_id, "MAX_LANGUAGES", 2)
    with pytest.raises(ValueError, match="more than 2 languages"):
        language_id.train(docs)


def test_language_counts_equal_plain_ones():
    text = "Über alles – déjà-vu!"
    codes, _ = language_id._codes(text)
    assert "".join(map(chr, codes)) == " über alles déjà vu "
    whole = np.concatenate(list(language_id.ngram_buckets(codes)))
    assert len(whole) == sum(len(codes) - n + 1 for n in language_id.ORDERS)
    size, language_id.CHUNK_CHARS = language_id.CHUNK_CHARS, 4
    try:
        assert sorted(np.concatenate(list(language_id.ngram_buckets(codes)))) == sorted(whole)
    finally:
        language_id.CHUNK_CHARS = size


def test_language_id_on_odd_rows(odd, empty):
    model = language_id.train(odd)
    assert model.languages == ["en"]
    for r in language_id.predict(odd, model).collect():
        letters = any(c.isalpha() for c in r.text or "")
        assert r.lang_pred == ("en" if letters else "und") and r.score == float(letters)
    nothing = language_id.train(empty)
    assert {(r.lang_pred, r.score) for r in language_id.predict(odd, nothing).collect()} == {("und", 0.0)}
    assert language_id.predict(empty, model).count() == 0


def test_lm_query_base_scores(spark, sf_dir, documents):
    want = brute.unigram(documents)
    rows = queries.REGISTERED["op9_lm_score"](spark, sf_dir).collect()
    assert len(rows) == len(documents)
    for r in rows:
        n, known, total, base = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.held_out == (brute.remainder(r.doc_id, 7) == 2)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_scores_equal_plain_ones(spark, documents, monkeypatch):
    weights = np.random.default_rng(1).dirichlet([1, 1, 1], lm_score.BUCKETS)
    monkeypatch.setattr(lm_score, "learn_weights", lambda *a: weights)
    monkeypatch.setattr(lm_score, "shard_count", lambda spark: 4)
    df = spark.createDataFrame(documents, "doc_id long, text string").repartition(5)
    rows = lm_score.score(df, training=df["doc_id"] % 3 != 0).collect()
    bucket = lambda c: int(lm_score.context_bucket(np.array([c]))[0])
    want = brute.bigram(documents, [i % 3 != 0 for i, _ in documents], weights, bucket)
    for r in rows:
        assert r.score == pytest.approx(want[r.doc_id], rel=1e-9)


def test_lm_weights_follow_the_held_out_counts():
    import pandas as pd

    sure = pd.DataFrame({"bucket": [3] * 2, "pair_bin": [int(-lm_score.MIN_LOG * lm_score.BINS) - 1, -1], "word_bin": [100, 100], "n": [900, 100]})
    weights = lm_score.learn_weights(sure, 1000)
    assert weights[3, 0] > 0.8 and np.allclose(weights.sum(axis=1), 1) and np.allclose(weights[0], 1 / 3)


def test_lm_packing():
    counts = np.array([0, 1, 254, 255, 256, 10**12])
    assert lm_score.unpack_counts(lm_score.pack_counts(counts)).tolist() == counts.tolist()
    keys = np.sort(np.random.default_rng(0).integers(0, 2**56, 1000).astype(np.uint64))
    assert (lm_score.unpack_keys(lm_score.pack_keys(keys)) == keys).all()


def test_lm_on_odd_rows(odd, empty):
    rows = lm_score.score(odd, training=odd["lang"] == "en").collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        assert np.isfinite(r.score) and np.isfinite(r.base_score) and r.score < 0
    blank = {r.n_tokens for r in rows if r.doc_id in (100, 99, 98)}
    assert blank == {1}
    assert lm_score.score(empty, training=empty["lang"] == "en").count() == 0
    none = lm_score.score(odd, training=odd["lang"] == "xx").collect()
    assert {(r.n_known, r.train_tokens) for r in none} == {(0, 0)}


def test_quality_measures(spark, sf_dir, documents):
    got = by_id(queries.REGISTERED["op10_quality_rules"](spark, sf_dir), *quality_rules.MEASURES, "base_failed", "kept")
    for i, text in documents:
        assert got[i][:6] == brute.measures(text)
        assert not (got[i][5] and got[i][6])


def test_measures_on_odd_texts(odd):
    for r in quality_rules.measure(odd).collect():
        assert tuple(r[m] for m in quality_rules.MEASURES) == brute.measures(r.text)[:5]


def sentences(rng, n):
    return [" ".join("".join(rng.choices("abcdefgh", k=8)) for _ in range(12)) for _ in range(n)]


def test_lines_of_many_documents_go(spark):
    rng = random.Random(2)
    common = "Shared header of 12 words a b c d e f g"
    rows = [(i, "h", "\n".join([common, *sentences(rng, 6)])) for i in range(30)]
    rows += [(100 + i, "other", "\n".join([common, *sentences(rng, 6)])) for i in range(5)]
    rows += [(200, "h", "\n".join([common.upper().replace("12", "99")] * 8 + sentences(rng, 1)))]
    article = sentences(rng, 6)
    rows += [(300 + i, "h", "\n".join(article)) for i in range(40)]  # exact copies
    rows += [(400 + i, None, "\n".join([*article[:5], f"changed {i}", common])) for i in range(40)]  # near copies
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = {r.doc_id: r for r in quality_rules.judge(df).collect()}
    key = quality_rules.line_key(common.encode())
    assert len(got) == len(rows)
    assert all(got[i].removed_keys == [key] and got[i].words_left == 72 and got[i].kept for i in range(30))
    assert all(got[100 + i].removed_keys == [] and got[100 + i].kept for i in range(5))
    assert got[200].words_left == 12 and not got[200].kept
    assert all(got[300 + i].kept and got[300 + i].removed_keys == [] for i in range(40))
    assert all(got[400 + i].kept for i in range(40))


def test_pages_that_share_boilerplate_are_different_documents(spark):
    rng = random.Random(8)
    menu = sentences(rng, 9)
    rows = [(i, "h", "\n".join([*menu[:5], *sentences(rng, 3), *menu[5:]])) for i in range(60)]
    got = quality_rules.judge(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    keys = {quality_rules.line_key(x.encode()) for x in menu}
    assert len(got) == 60
    assert all(set(r.removed_keys) == keys and 4 * r.words_left == r.n_words and not r.kept for r in got)


@pytest.mark.parametrize("percent", [80, 90, 95, 99])
def test_boilerplate_of_any_share_is_found(spark, percent):
    rng = random.Random(percent)
    menu = sentences(rng, 16)
    rows = []
    for i in range(200):  # own texts of unequal length around the given share
        own = round(192 * (100 - percent) / percent) + rng.choice([-1, 0, 1])
        words = ["".join(rng.choices("abcdefgh", k=8)) for _ in range(max(own, 1))]
        rows.append((i, "h", "\n".join([*menu[:9], " ".join(words), *menu[9:]])))
    got = quality_rules.judge(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    keys = {quality_rules.line_key(x.encode()) for x in menu}
    assert len(got) == 200
    assert all(set(r.removed_keys) == keys and not r.kept for r in got)


def test_line_verdicts_by_brute_force(spark):
    rng = random.Random(12)
    rows = []
    for h in ("a", "b", None):
        menu, article = sentences(rng, 4), sentences(rng, 8)
        for i in range(30):
            rows.append((h, "\n".join([*rng.sample(menu, 3), *sentences(rng, rng.randint(0, 3))])))
            words = [x.split() for x in article]  # copies with up to three words changed
            for _ in range(rng.randint(0, 3)):
                rng.choice(words)[rng.randrange(12)] = rng.choice(["other", f"new{i}"])
            rows.append((h, "\n".join([*map(" ".join, words), *(menu[:1] if i % 2 else [])])))
        rows += [(h, "\n".join(article))] * 25 + [(h, None), (h, ""), (h, "one line only")]
    df = spark.createDataFrame([(i, h, t) for i, (h, t) in enumerate(rows)], "doc_id long, source string, text string")
    expected = brute.line_verdicts(rows)
    assert {bool(gone) for gone, _ in expected.values()} == {kept for _, kept in expected.values()} == {True, False}
    for r in quality_rules.judge(df, carry=("doc_id", "text")).collect():
        gone, kept = expected[r.host, r.text or ""]
        assert set(r.removed_keys) == {quality_rules.line_key(" ".join(x).encode()) for x in gone}
        assert r.kept == kept


def test_removed_lines_leave_the_text(spark):
    keys = [quality_rules.line_key(b"Drop  me 7")]
    df = spark.createDataFrame([(1, "keep\ndrop me 3\n\nkeep too", keys), (2, None, keys), (3, "drop me 1", [])], "doc_id long, text string, removed_keys array<long>")
    got = by_id(quality_rules.without_lines(df), "text")
    assert got == {1: ("keep\n\nkeep too",), 2: (None,), 3: ("drop me 1",)}


def test_quality_rules_on_odd_rows(odd, empty):
    rows = quality_rules.judge(odd.drop("kept")).collect()
    assert len(rows) == len(odd_rows()) and all(r.base_failed for r in rows)
    assert quality_rules.judge(empty).count() == 0
