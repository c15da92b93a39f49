"""The operators over the whole driver tables: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanweave.llm import (
    bpe,
    chat_format,
    embedding_dedup,
    language_id,
    lm_score,
    mixing,
    prefix_trie,
    quality_kn,
    quality_rules,
    resampling,
    sentencepiece_bpe,
    simhash,
    token_files,
)
from spanweave.llm.textbatch import short_batches
from spanweave.operators.lineage import scratch_path

REGISTERED: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(fn):
    REGISTERED[fn.__name__] = fn
    return fn


def tokenizer_path(name: str) -> str:
    """A public tokenizer's file as installed beside the library; workers have the same path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    short_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(doc_id: str, n: int) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % n


def _crc32_sql(digits: str) -> str:
    """Unsigned CRC-32 in SQL of the bytes whose hexadecimal digits ``digits`` gives: eight steps a byte."""
    byte = f"CAST('0x' || {digits}[2*i+1:2*i+2] AS BIGINT)"
    steps = f"flatten([[{byte}, 0, 0, 0, 0, 0, 0, 0] FOR i IN range(0, len({digits}) // 2)])"
    one = "xor(xor(c, b) // 2, CASE WHEN xor(c, b) % 2 = 1 THEN 3988292384 ELSE 0 END)"
    return f"xor(list_reduce({steps}, lambda c, b: {one}, CAST(4294967295 AS BIGINT)), 4294967295)"


@register
def op1_embedding_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


SQL["op1_embedding_dedup"] = """
WITH RECURSIVE
     v AS (
       SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
       WHERE embedding IS NOT NULL AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding])
         AND list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) > 0),
     links AS (
       SELECT a.vec_id AS src, b.vec_id AS dst FROM v a, v b
       WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
     reach AS (
       SELECT vec_id AS node, vec_id AS met FROM embeddings
       UNION SELECT r.node, l.dst FROM reach r JOIN links l ON l.src = r.met),
     named AS (SELECT node, min(met) AS component_id FROM reach GROUP BY node),
     counted AS (SELECT src, count(*) AS n FROM links GROUP BY src)
SELECT node AS vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, node = component_id AS kept
FROM named LEFT JOIN counted ON src = node
"""


@register
def op2_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", F.coalesce(_remainder("doc_id", 5) == 0, F.lit(False)))
    model = language_id.train(docs.where(_remainder("doc_id", 5) != 0))
    return language_id.predict(docs.select("doc_id", "held_out", "text"), model).drop("text")


@register
def op3_chat_format(spark, sf_dir):
    return chat_format.format_chats(_table(spark, sf_dir, "conversations"))


SQL["op3_chat_format"] = """
WITH distinct_turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
     logs AS (
       SELECT conv_id, list({'r': role, 't': text} ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS turns
       FROM distinct_turns GROUP BY conv_id),
     whole AS (SELECT turns, min(conv_id) AS conv_id, count(*) AS n_copies FROM logs GROUP BY turns),
     prefixes AS (
       SELECT DISTINCT turns[1:k] AS turns FROM (SELECT turns, unnest(range(1, len(turns))) AS k FROM whole)),
     kept AS (SELECT * FROM whole ANTI JOIN prefixes USING (turns)),
     numbered AS (
       SELECT conv_id, n_copies, len(turns) AS n_turns, unnest(range(0, len(turns))) AS position, unnest(turns) AS u FROM kept)
SELECT conv_id, position // 1024 AS part, n_turns, CAST(n_copies AS BIGINT) AS n_copies,
       string_agg('<|' || coalesce(u.r, 'unknown') || '|>' || chr(10) || coalesce(u.t, '') || '<|end|>' || chr(10), '' ORDER BY position) AS text
FROM numbered GROUP BY ALL
"""


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents labelled good and not toxic."""
    return _table(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0").select("doc_id")


@register
def op4_quality_classifier(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality_kn.classify(docs, trusted_ids(spark, sf_dir)).select(
        "doc_id", "lang", "n_tokens", "log_prob", "perplexity", "threshold", "kept"
    )


@register
def op5_simhash(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs, size=3, lanes=1, word_bits=64, radius=2)
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex(F.col("fingerprint")[0])), 16, "0").alias("fingerprint"), "component_id"
    )


@register
def op6_token_files(spark, sf_dir):
    root = scratch_path(spark, "token-files")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    manifest = token_files.write_token_files(docs, tokenizer_path("word_bpe_49k.json"), root, end_id=2)
    read = token_files.read_token_files(manifest, root)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@register
def op7_mixing(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    mixed = mixing.mix(docs)
    return mixed.select("doc_id", "source", "lang", F.col("_topic").alias("topic"), "n_words", "probability", "sampled")


@register
def op8_bpe(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    done = bpe.encode_and_decode(docs, tokenizer_path("byte_bpe_50k.json"))
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@register
def op9_lm_score(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = lm_score.score(docs, training=_remainder("doc_id", 7) != 2)
    return scored.withColumn("held_out", F.coalesce(_remainder("doc_id", 7) == 2, F.lit(False)))


@register
def op10_quality_rules(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return quality_rules.judge(docs).select("doc_id", *quality_rules.MEASURES, "base_failed", "kept")


@register
def op11_sentencepiece(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    done = sentencepiece_bpe.encode_and_decode(docs, tokenizer_path("piece_bpe_32k.model"))
    return done.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@register
def op12_prefix_trie(spark, sf_dir):
    nodes = prefix_trie.conversation_trie(_table(spark, sf_dir, "conversations"))
    return nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved_words").alias("saved_tokens"), "ends_sha256",
    )

SQL["op12_prefix_trie"] = f"""
WITH turns AS (
       SELECT conv_id AS c, {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS u,
              row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
       FROM conversations WHERE conv_id IS NOT NULL),
     logs AS (SELECT c, list(u ORDER BY i) AS own, hex(encode(CAST(c AS VARCHAR))) AS digits FROM turns GROUP BY c),
     taken AS (SELECT c, own, c - c % 20 AS head, {_crc32_sql("digits")} % 4 AS h FROM logs),
     convs AS (
       SELECT a.c, list_concat(coalesce(b.own, [])[1:a.h], a.own[a.h+1:]) AS s
       FROM taken a LEFT JOIN logs b ON b.c = a.head),
     prefixes AS (SELECT c, d, s[1:d] AS s, len(s) = d AS last FROM (SELECT *, unnest(range(0, len(s) + 1)) AS d FROM convs)),
     nodes AS (
       SELECT min(c) AS conv_id, d, s, count(*) AS n_convs,
              sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (last), '')) AS ends_sha256
       FROM prefixes GROUP BY d, s),
     children AS (SELECT d - 1 AS d, s[1:d-1] AS s, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
     alone AS (
       SELECT nodes.*, coalesce(n, 0) AS n_children, n IS NULL AS leaf,
              (n_convs - 1) * CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(s[d].t, '[^\\x20\\x09-\\x0D]+')) END AS saved
       FROM nodes LEFT JOIN children USING (d, s)),
     sums AS (
       SELECT k AS d, s[1:k] AS s, count(*) FILTER (leaf) AS n_leaves, sum(saved) AS saved_tokens
       FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM alone) GROUP BY k, s[1:k])
SELECT a.conv_id, CAST(a.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, a.n_convs, a.n_children,
       n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, a.ends_sha256
FROM alone a JOIN sums USING (d, s) LEFT JOIN nodes p ON p.d = a.d - 1 AND p.s = a.s[1:a.d-1]
"""


@register
def op13_resampling(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    drawn = resampling.resample(docs, _table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


_WORDS_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL["op13_resampling"] = f"""
WITH docs AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
     target AS (SELECT {_WORDS_SQL} AS w FROM benchmark),
     grams AS (
       SELECT doc_id, w[i+1] AS g FROM (SELECT *, unnest(range(0, len(w))) AS i FROM docs)
       UNION ALL SELECT doc_id, w[i+1] || ' ' || w[i+2] FROM (SELECT *, unnest(range(0, len(w) - 1)) AS i FROM docs)
       UNION ALL SELECT doc_id, w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] FROM (SELECT *, unnest(range(0, len(w) - 2)) AS i FROM docs)),
     wanted AS (
       SELECT w[i+1] AS g FROM (SELECT *, unnest(range(0, len(w))) AS i FROM target)
       UNION ALL SELECT w[i+1] || ' ' || w[i+2] FROM (SELECT *, unnest(range(0, len(w) - 1)) AS i FROM target)
       UNION ALL SELECT w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] FROM (SELECT *, unnest(range(0, len(w) - 2)) AS i FROM target)),
     raw_counts AS (SELECT g, count(*) AS n FROM grams GROUP BY g),
     target_counts AS (SELECT g, count(*) AS n FROM wanted GROUP BY g),
     digits AS (SELECT g, hex(encode(g)) AS x FROM (SELECT g FROM raw_counts UNION SELECT g FROM target_counts)),
     bucketed AS MATERIALIZED (SELECT g, {_crc32_sql("x")} % 10000 AS bucket FROM digits),
     s AS (SELECT bucket, sum(n) AS s FROM raw_counts JOIN bucketed USING (g) GROUP BY bucket),
     t AS (SELECT bucket, sum(n) AS t FROM target_counts JOIN bucketed USING (g) GROUP BY bucket),
     gains AS (
       SELECT bucket, CAST(floor(1000 * ln(
                (CAST(coalesce(t, 0) AS DOUBLE) + 1) * ((SELECT coalesce(CAST(sum(s) AS DOUBLE), 0) FROM s) + 10000)
                / ((CAST(coalesce(s, 0) AS DOUBLE) + 1) * ((SELECT coalesce(CAST(sum(t) AS DOUBLE), 0) FROM t) + 10000)))) AS BIGINT) AS gain
       FROM s FULL JOIN t USING (bucket)),
     weights AS (
       SELECT doc_id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight
       FROM grams JOIN bucketed USING (g) JOIN gains USING (bucket) GROUP BY doc_id),
     scored AS (
       SELECT doc_id, len(w) >= 20 AS may, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
              coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('42:' || doc_id)[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
       FROM docs LEFT JOIN weights USING (doc_id)),
     ranked AS (SELECT *, row_number() OVER (PARTITION BY may ORDER BY score DESC, doc_id) AS r, count(*) FILTER (may) OVER () AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN may AND r <= 5 * n // 100 THEN r END AS rank FROM ranked
"""
