"""A corpus from raw documents to token ids: five stages over the table ``documents``.

1. ``quality_classifier``  documents that trusted text finds improbable go
2. ``quality_rules``       lines that many documents of a source share go, then broken or depleted documents
3. ``near_duplicates``     one document of each group of near copies stays
4. ``mixture``             documents are drawn so that sources, languages and topics meet their targets
5. ``tokens``              ids of every text that is left, and the text they decode to

Near copies are found on five-word shingles. A similarity of 0.8 between shingle sets is a cosine of
2 * 0.8 / 1.8, an angle of 27 degrees, and 39 differing bits of 256; fingerprints of that length are
searched by words of at most 32 bits, short enough that no pair within 39 bits is missed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanweave.llm import bpe, mixing, quality_kn, quality_rules, queries, simhash
from spanweave.llm.textbatch import free_name, short_batches
from spanweave.operators.lineage import discard_written, scratch_path, tables_written

SHINGLE_WORDS, LANES, WORD_BITS, MAX_BITS = 5, 4, 32, 39


_before = 0


def _begin(spark: SparkSession, docs: DataFrame, first: bool = False) -> None:
    """A stage begins when the one before has written its result and needs its tables no more."""
    global _before
    short_batches(spark)
    if not first:
        discard_written(spark, _before, docs)
    _before = tables_written()


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _begin(spark, docs, first=True)
    judged = quality_kn.classify(docs, queries.trusted_ids(spark, sf_dir), keep_text=True)
    return judged.where("kept").select(*docs.columns)


def rule_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Equal rows share a verdict, so that it is found again by what it was made from."""
    _begin(spark, docs)
    hashed_as, keys_as = free_name(docs, "_hash"), free_name(docs, "removed_keys")
    verdicts = (
        quality_rules.judge(docs).where("kept")
        .groupBy(F.col("doc_id").alias("_id"), F.col("host").alias("_host"), "_text_hash")
        .agg(F.first("removed_keys").alias("removed_keys"))
    )
    hashed = docs.withColumn(hashed_as, F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    same = (
        (hashed[hashed_as] == verdicts["_text_hash"])
        & hashed["doc_id"].eqNullSafe(verdicts["_id"])
        & hashed["source"].cast("string").eqNullSafe(verdicts["_host"])
    )
    kept = hashed.join(verdicts, same).select(
        *[hashed[c] for c in docs.columns], verdicts["removed_keys"].alias(keys_as)
    )
    cleaned = quality_rules.without_lines(kept, keys=keys_as)
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _begin(spark, docs)
    found = simhash.near_duplicates(docs, size=SHINGLE_WORDS, lanes=LANES, word_bits=WORD_BITS, radius=MAX_BITS, keep_text=True)
    return found.where("kept").select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _begin(spark, docs)
    return mixing.mix(docs).where("sampled").select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _begin(spark, docs)
    return bpe.encode_and_decode(docs, queries.tokenizer_path("byte_bpe_50k.json")).select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded"
    )


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", rule_filter),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("tokens", tokens),
]

#: SQL expresses neither the language model nor fingerprints, raking and byte pairs.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
