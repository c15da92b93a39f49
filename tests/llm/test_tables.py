"""Operators on vectors, conversations and labelled or mixed documents."""

import math
import random
import sys
import time
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm import brute

from spanweave.llm import chat_format, embedding_dedup, mixing, quality_kn, queries
from spanweave.llm.components import connected_components
from spanweave.operators.lineage import discard, materialize

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

from check import compare, connect  # noqa: E402


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, duck, sf_dir, name):
    result = compare(duck, queries.REGISTERED[name](spark, sf_dir), queries.SQL[name])
    assert result.startswith("ok"), result


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(100, 160)] + [(200, i) for i in range(201, 260)] + [(399, i) for i in range(300, 350)]
    links += [(5, 5), (7, 6), (6, 7)] + [(rng.randrange(500, 700), rng.randrange(500, 700)) for _ in range(120)]
    rng.shuffle(links)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "src long, dst long")).collect()}
    nodes = {n for link in links for n in link if link[0] != link[1]}
    assert got == brute.components(nodes, [x for x in links if x[0] != x[1]])
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


VECTORS = "vec_id long, embedding array<double>, label int, node string, unit int, kept string"


def vector_rows():
    """Groups of near copies from 2 to 150, a chain, equal vectors, single ones, and unusable ones."""
    rng = np.random.default_rng(7)
    rows, vec_id = [], 0

    def add(v):
        nonlocal vec_id
        rows.append((vec_id * 3 % 1009, None if v is None else [None if x is None else float(x) for x in v], 0, "n", 1, "k"))
        vec_id += 1

    for size in (2, 3, 20, 60, 150):
        centre = rng.standard_normal(24)
        for _ in range(size):
            add(centre + 0.15 * rng.standard_normal(24))
    for _ in range(200):
        add(rng.standard_normal(24))
    turn = np.zeros(24)
    for k in range(12):
        angle = math.radians(15 * k)
        turn[0], turn[1] = math.cos(angle), math.sin(angle)
        add(turn.copy())
    for _ in range(40):
        add(np.arange(24) * 1e200)
    for bad in (None, [0.0] * 24, [1.0] * 23, [math.nan] + [1.0] * 23, [math.inf] + [1.0] * 23, [None] + [1.0] * 23, []):
        add(bad)
    return rows


def test_nn_descent_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "EXACT_BLOCK", 16)
    rows = vector_rows()
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, VECTORS).repartition(4)).collect()}
    good = {}
    for i, v, *_ in rows:
        if v and len(v) == 24 and None not in v and np.isfinite(v).all() and any(v):
            x = np.array(v) / np.abs(v).max()
            good[i] = x / np.linalg.norm(x)
    links = [(a, b) for a in good for b in good if a < b and good[a] @ good[b] >= 0.95]
    degree = Counter(x for link in links for x in link)
    group = brute.components([r[0] for r in rows], links)
    assert len(got) == len(rows)
    assert sum(got[i].n_links for i in got) >= 0.99 * 2 * len(links)
    assert all(got[i].n_links <= degree[i] for i in got)
    assert {i: got[i].component_id for i in got} == group
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_a_thin_search_is_noticed_and_extended(spark, monkeypatch):
    """One set of hyperplanes and small blocks lose isolated pairs and split groups of 13 to 47."""
    for name, value in {"TABLES": 1, "BLOCK": 16, "MAX_BLOCK": 16, "FROM_BLOCK": 4, "TARGET_RECALL": 0.99}.items():
        monkeypatch.setattr(embedding_dedup, name, value)
    rng = np.random.default_rng(5)
    sizes = [1] * 300 + [2] * 150 + [13, 20, 30, 47]
    centres = [c for c, size in zip(rng.standard_normal((len(sizes), 16)), sizes) for _ in range(size)]
    units = np.array(centres) + 0.1 * rng.standard_normal((sum(sizes), 16))
    units /= np.linalg.norm(units, axis=1)[:, None]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(units)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(df).collect()}
    linked = units @ units.T >= 0.95
    np.fill_diagonal(linked, False)
    true = linked.sum(axis=1)
    assert np.mean([got[i] / n for i, n in enumerate(true) if n]) >= 0.99
    assert all(got[i] <= n for i, n in enumerate(true))
    monkeypatch.setattr(embedding_dedup, "EXTENSIONS", 0)
    with pytest.warns(UserWarning, match="of the links"):
        embedding_dedup.near_duplicates(df)


def test_nn_descent_on_nothing(spark):
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0
    odd = [(None, [1.0, 0.0], 0, "", 0, ""), (None, [1.0, 0.0], 0, "", 0, ""), (3, [1.0, 0.001], 0, "", 0, ""), (3, [1.0, 0.001], 0, "", 0, ""), (4, None, 0, "", 0, "")]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(odd, VECTORS)).collect()
    assert sorted((r.vec_id or -1, r.n_links, r.component_id) for r in got) == [(-1, 3, 3), (-1, 3, 3), (3, 3, 3), (3, 3, 3), (4, 0, 4)]
    assert sum(r.kept for r in got) == 2


TURNS = "conv_id long, turn long, role string, text string, part string, position int, x int"


def chats(rows):
    """(conv_id, n_turns, n_copies, text) of the maximal conversations, plainly."""
    none_first = lambda x: (x is not None, x or 0) if not isinstance(x, str) else (True, x)
    logs = {}
    for c, turn, role, text, *_ in set(rows):
        if c is not None:
            logs.setdefault(c, set()).add((turn, role, text))
    seq = {}
    for c, turns in logs.items():
        ordered = sorted(turns, key=lambda t: (none_first(t[0]), t[1] is not None, t[1] or "", t[2] is not None, t[2] or ""))
        seq.setdefault(tuple(t[1:] for t in ordered), []).append(c)
    out = set()
    for turns, ids in seq.items():
        if not any(len(o) > len(turns) and o[: len(turns)] == turns for o in seq):
            text = "".join(f"<|{r or 'unknown' if r is None else r}|>\n{t or ''}<|end|>\n" for r, t in turns)
            out.add((min(ids), len(turns), len(ids), text))
    return out


def chat_rows():
    rng = random.Random(9)
    rows = []
    for c in range(0, 60, 3):
        turns = [(rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "", None, "long " * 50])) for _ in range(rng.randint(1, 7))]
        for k, n in enumerate((len(turns), rng.randint(1, len(turns)), len(turns))):
            rows += [(c + k, 10 * i, r, t, "p", 0, 0) for i, (r, t) in enumerate(turns[:n])]
    rows += [(100, None, "user", "no turn", "p", 0, 0), (100, 1, "user", "x", "p", 0, 0), (100, 1, "user", "a tie", "p", 0, 0)]
    rows += [(None, 0, "user", "no conversation", "p", 0, 0)]
    rows += [(101, i, "user", f"{i % 3}", "p", 0, 0) for i in range(2500)] + [(102, i, "user", f"{i % 3}", "p", 0, 0) for i in range(2499)]
    return rows + rows[:40]


def test_chats_equal_plain_ones(spark):
    rows = chat_rows()
    found = chat_format.format_chats(spark.createDataFrame(rows, TURNS).repartition(5)).collect()
    whole = {}
    for r in sorted(found, key=lambda r: r.part):
        whole[r.conv_id] = (r.conv_id, r.n_turns, r.n_copies, whole.get(r.conv_id, (0, 0, 0, ""))[3] + r.text)
    assert set(whole.values()) == chats(rows)
    assert max(r.part for r in found) == 2
    assert chat_format.format_chats(spark.createDataFrame([], TURNS)).count() == 0


def test_chats_run_no_python(spark, sf_dir):
    plan = queries.REGISTERED["op3_chat_format"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def plain_kneser_ney(texts):
    """Log10 probability of a token sequence under interpolated modified Kneser-Ney, order 3."""
    c3 = Counter()
    for t in texts:
        w = ["<s>", "<s>", *t.split(), "</s>"]
        c3.update(zip(w, w[1:], w[2:]))
    c2 = Counter((v, w) for _, v, w in c3)
    c1 = Counter(w for _, w in c2)

    def parts(counts, context):
        n = Counter(counts.values())
        n1, n2, n3, n4 = (max(n[i], 1) for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        d = [0] + [min(max(x, 0.1), i) for i, x in ((1, 1 - 2 * y * n2 / n1), (2, 2 - 3 * y * n3 / n2), (3, 3 - 4 * y * n4 / n3))]
        total, taken = Counter(), Counter()
        for k, c in counts.items():
            total[context(k)] += c
            taken[context(k)] += d[min(c, 3)]
        return d, total, taken

    d1, t1, g1 = parts(c1, lambda k: ())
    d2, t2, g2 = parts(c2, lambda k: k[0])
    d3, t3, g3 = parts(c3, lambda k: k[:2])

    def p1(w):
        c = c1[w]
        return (c - d1[min(c, 3)]) / t1[()] + g1[()] / t1[()] / (len(c1) + 1)

    def p2(v, w):
        c = c2[v, w]
        return (c - d2[min(c, 3)]) / t2[v] + g2[v] / t2[v] * p1(w) if t2[v] else p1(w)

    def p3(u, v, w):
        c = c3[u, v, w]
        return (c - d3[min(c, 3)]) / t3[u, v] + g3[u, v] / t3[u, v] * p2(v, w) if t3[u, v] else p2(v, w)

    def score(text):
        w = ["<s>", "<s>", *text.split(), "</s>"]
        return sum(math.log10(p3(*g)) for g in zip(w, w[1:], w[2:]))

    return score, p3, c1


def some_texts(seed, n):
    rng = random.Random(seed)
    return [" ".join(rng.choice("a b c d e f g h aa bb cc".split()) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_kneser_ney_equals_plain_one(spark):
    texts = some_texts(1, 60)
    model = quality_kn.fit(spark.createDataFrame([(t,) for t in texts], "text string"))
    plain, p3, known = plain_kneser_ney(texts)
    held = some_texts(2, 30) + ["never seen words", "", "a never a"]
    df = spark.createDataFrame(list(enumerate(held)), "doc_id long, text string")
    for r in quality_kn.score(df, model).collect():
        assert r.log_prob == pytest.approx(plain(r.text), rel=1e-5)
        assert r.n_tokens == len(r.text.split()) + 1
    for context in (("a", "b"), ("<s>", "<s>"), ("x", "a"), ("x", "y")):
        assert sum(p3(*context, w) for w in [*known, "unseen"]) == pytest.approx(1)


def test_classifier_learns_from_every_trusted_text(spark):
    """7,000 trusted texts: all that one half of the ids holds are counted, however many."""
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("abcdefgh") + str(i % 97) for _ in range(4)), "en") for i in range(7000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(7)
    fold = df.where(F.expr("pmod(xxhash64('fold', doc_id), 2) = 0")).collect()
    assert len(fold) > 3000
    plain, _, _ = plain_kneser_ney([r.text for r in fold])
    got = quality_kn.classify(df, df.select("doc_id"), keep_text=True).collect()
    assert len(got) == 7000
    for r in got[::50]:
        assert r.log_prob == pytest.approx(plain(r.text), rel=1e-5)


def test_classifier_scores_in_rounds_and_keeps_no_large_table(spark, monkeypatch):
    """Rounds change no figure, and of what they write only the scores are left."""
    texts = some_texts(4, 300)
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    figures = ("doc_id", "n_tokens", "log_prob", "threshold", "kept")
    root = Path(spark.conf.get("spark.checkpoint.dir")) / "spanweave"

    def run():
        before = set(root.glob("*"))
        judged = quality_kn.classify(df, df.select("doc_id"))
        left = {p.name.rpartition("-")[0] for p in set(root.glob("*")) - before}
        return sorted(tuple(r[c] for c in figures) for r in judged.collect()), left

    whole, left = run()
    assert left == {"kn-trusted", "kn-scores", "kn-held"}
    monkeypatch.setattr(quality_kn, "ROUND_BYTES", 1000)
    monkeypatch.setattr(quality_kn, "ROUNDS", 3)
    assert run() == (whole, left)


def test_table_written_once_leaves_no_shuffle(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        blocks = disk.getAllBlocks()
        return {n for n in (blocks.apply(i).name() for i in range(blocks.size())) if n.startswith("shuffle_")}

    before = shuffles()
    table = materialize(spark.range(1000).repartition(5).groupBy((F.col("id") % 7).alias("k")).count(), once=True)
    assert table.agg(F.sum("count")).first()[0] == 1000
    written = {n.split("_")[1] for n in shuffles() - before}
    for _ in range(40):
        if len(written) <= 1:  # of the sum, which is collected
            break
        time.sleep(0.25)
        written = {n.split("_")[1] for n in shuffles() - before}
    assert len(written) <= 1
    discard(table)
    assert not [f for f in table.inputFiles() if Path(f.removeprefix("file:")).exists()]


def quality_rows():
    rng = random.Random(3)
    words = [f"word{i}" for i in range(300)]
    rows = []
    for i in range(600):
        lang = ("en", "fr", None)[i % 3]
        if i % 10 == 9:
            text = " ".join("".join(rng.choices("#!?xyz", k=8)) for _ in range(60))
        else:
            text = " ".join(f"{lang}{rng.choice(words)}" for _ in range(rng.randint(40, 120)))
        rows.append((i, text, lang, 1.0, "k"))
    return rows + [(900, None, "en", 1.0, "k"), (901, "", None, 1.0, "k"), (None, "", "xx", 1.0, "k"), rows[0], rows[0]]


def test_classifier_rejects_noise(spark):
    rows = quality_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, threshold double, kept string")
    ids = [(i,) for i in range(600) if i % 10 != 9] + [(3,), (None,), (12345,)]
    trusted = spark.createDataFrame(ids, "doc_id long")
    got = quality_kn.classify(df, trusted).collect()
    assert len(got) == len(rows)
    good = [r.kept for r in got if r.doc_id is not None and r.doc_id < 600 and r.doc_id % 10 != 9]
    assert sum(good) >= 0.95 * len(good)
    assert not any(r.kept for r in got if r.doc_id is not None and r.doc_id % 10 == 9 and r.doc_id < 600)
    assert all(r.kept for r in got if r.doc_id in (900, 901, None))
    assert all(r.kept for r in quality_kn.classify(df, trusted.limit(0)).collect())
    assert quality_kn.classify(df.limit(0), trusted).count() == 0


def test_classifier_keeps_languages_without_trusted_documents(spark):
    rng = random.Random(12)
    word = lambda mark: mark + str(rng.randint(1, 60))
    text = lambda mark: " ".join(word(mark) for _ in range(40))
    rows = [(i, text("a"), "en") for i in range(400)] + [(1000 + i, text("b"), None if i % 2 else "rare") for i in range(60)]
    rows += [(2000, text("z"), "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trusted = spark.createDataFrame([(i,) for i in [*range(400), *range(1000, 1006)]], "doc_id long")
    got = {r.doc_id: r for r in quality_kn.classify(df, trusted).collect()}
    assert all(got[1000 + i].kept and got[1000 + i].threshold is None for i in range(60))
    assert not got[2000].kept and got[0].threshold is not None


MIXED = "doc_id long, text string, source string, lang string, probability double, tokens int"


def mixed_rows(n=4000):
    rng = random.Random(6)
    rows = []
    for i in range(n):
        source = rng.choices(["big", "mid", "small", None], [70, 20, 8, 2])[0]
        lang = rng.choices(["en", "de", None], [80, 15, 5])[0]
        rows.append((i, " ".join(["w" * rng.randint(2, 9)] * rng.randint(1, 60)), source, lang, 0.1, 1))
    return rows + [(n, None, "big", "en", 0.1, 1), (n + 1, "", "only empty", "en", 0.1, 1), rows[0], rows[0]]


def test_mixture_meets_its_targets(spark):
    rows = mixed_rows()
    df = spark.createDataFrame(rows, MIXED).repartition(4)
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    total = sum(r.n_words for r in got)
    for axis in ("_source", "_lang", "_topic"):
        have, expected, drawn = Counter(), Counter(), Counter()
        for r in got:
            have[r[axis]] += r.n_words
            expected[r[axis]] += r.n_words * r.probability
            drawn[r[axis]] += r.n_words * r.sampled
        goal = plain_targets(have, mixing.KEEP, mixing.TEMPERATURE)
        for k in have:
            if have[k]:
                assert expected[k] == pytest.approx(goal[k], rel=0.02)
                assert abs(drawn[k] - expected[k]) <= 6 * math.sqrt(60 * have[k])
    assert sum(r.n_words * r.probability for r in got) == pytest.approx(mixing.KEEP * total, rel=0.01)
    assert all(0 < r.probability <= 1 for r in got)
    again = {(r.doc_id, r.sampled) for r in mixing.mix(df.repartition(7)).collect()}
    assert again == {(r.doc_id, r.sampled) for r in got}
    assert mixing.mix(df.limit(0)).count() == 0


def test_mixture_meets_stated_weights(spark):
    df = spark.createDataFrame(mixed_rows(), MIXED).withColumn("c_source", F.lit("mine")).repartition(3)
    have = Counter()
    for r in mixing.mix(df).collect():
        have[r["_lang"]] += r.n_words
    langs = sorted((k for k in have if k and have[k]), key=have.get)[:2]
    stated = {langs[0]: 1.0, langs[1]: 3.0, "absent": 7.0}
    keep = 0.5 * have[langs[0]] / sum(have.values())
    got = mixing.mix(df, keep=keep, weights={"language": stated}, temperature=1.0).collect()
    expected = Counter()
    for r in got:
        expected[r["_lang"]] += r.n_words * r.probability
        assert r.c_source == "mine"
        assert r["_lang"] in langs or not r.n_words or not r.sampled
    assert expected[langs[1]] == pytest.approx(3 * expected[langs[0]], rel=0.02)
    assert sum(expected.values()) == pytest.approx(keep * sum(have.values()), rel=0.02)
    with pytest.raises(ValueError, match="no such axis"):
        mixing.mix(df, weights={"host": {}})
    with pytest.raises(ValueError, match="below zero"):
        mixing.mix(df, weights={"topic": {None: -1.0}, "source": {"a": -1.0}, "language": {langs[0]: -1.0}})


def plain_targets(have, keep, temperature):
    """By bisection of the one scale."""
    lo, hi = 0.0, sum(have.values())
    for _ in range(200):
        mid = (lo + hi) / 2
        if sum(min(h, mid * h**temperature) for h in have.values()) < keep * sum(have.values()):
            lo = mid
        else:
            hi = mid
    return {k: min(h, hi * h**temperature) for k, h in have.items()}


def plain_raking(cells, goals, rounds=300):
    weight = dict(cells)
    for _ in range(rounds):
        for axis, goal in enumerate(goals):
            sums = Counter()
            for k, w in weight.items():
                sums[k[axis]] += w
            weight = {k: min(cells[k], w * goal[k[axis]] / sums[k[axis]]) for k, w in weight.items()}
    return weight


def test_raking_equals_plain_one(spark):
    rng = random.Random(8)
    cells = {(a, b): rng.randint(50, 1000) for a in "xyz" for b in "pq"}
    goals = [plain_targets(Counter({v: sum(n for k, n in cells.items() if k[i] == v) for v in {k[i] for k in cells}}), 0.5, 0.4) for i in (0, 1)]
    df = spark.createDataFrame([(*k, n) for k, n in cells.items()], "a string, b string, tokens long")
    tables = {axis: spark.createDataFrame(list(goal.items()), f"{axis} string, target double") for axis, goal in zip("ab", goals)}
    got = {(r.a, r.b): r.weight for r in mixing.rake(df, tables, tolerance=1e-6).collect()}
    assert got == pytest.approx(plain_raking(cells, goals), rel=1e-4)


def test_pipeline_runs_whole(spark, sf_dir):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    n, names = docs.count(), [name for name, _ in pipeline.STAGES]
    assert names == ["quality_classifier", "quality_rules", "near_duplicates", "mixture", "tokens"]
    out = pipeline.run(spark, sf_dir)
    rows = out.collect()
    assert 0 < len(rows) < n and len({r.doc_id for r in rows}) == len(rows)
    assert all(r.n_tokens == len(r.ids) for r in rows)


def test_pipeline_stages_on_odd_documents(spark, sf_dir):
    pipeline = pytest.importorskip("corpus_pipeline")
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    word = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [(i, f"{word} {i} " * 12 + f"tail{i * 7919}", "en", None if i % 2 else "s", None) for i in range(8)]
    rows += [(None, None, None, None, None), (20, "", "en", "s", 0), rows[0], (21, rows[0][1], None, "s", 1)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in pipeline.STAGES:
        for part in (docs, docs.limit(0)):
            got = stage(spark, part, sf_dir)
            if name != "tokens":
                assert got.columns == docs.columns
            found = got.collect()
            assert len(found) <= part.count()
    kept = pipeline.STAGES[2][1](spark, docs, sf_dir).collect()
    texts = [r.text for r in kept]
    assert texts.count(rows[0][1]) <= 1 and sum(not t for t in texts) == 1
