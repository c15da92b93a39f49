import hashlib
import random

import pytest
from pyspark.sql import functions as F

from spanweave.functions.canonical import GENESIS, canonical_text
from spanweave.operators import audit as au

REC = "session_id string, n int, operation string, payload string, audit string"


def records(spark, sizes, clock="2026-01-01"):
    rows = [
        (s, i, f"op{i % 3}", canonical_text({"k": i, "é": "ü"}), canonical_text({"timestamp_utc": f"{clock}T{i}"}))
        for s, n in sizes.items()
        for i in range(n)
    ]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, REC)


def by_hand(rows):
    prev, out = GENESIS, []
    for seq, (op, payload, audit) in enumerate(rows):
        p = hashlib.sha256(payload.encode()).hexdigest()
        prev = hashlib.sha256((prev + p + str(seq) + op + audit).encode()).hexdigest()
        out.append((seq, p, prev))
    return out


@pytest.fixture(scope="module")
def chain(spark):
    df = au.chain_build(records(spark, {"a": 9, "b": 1, "c": 5}), ["n"]).cache()
    df.count()
    return df


def test_chain_build_matches_a_plain_walk(spark, chain):
    got = chain.where("session_id = 'a'").orderBy("seq").collect()
    want = by_hand([(r.operation, r.payload, r.audit) for r in got])
    assert [(r.seq, r.payload_sha256, r.entry_sha256) for r in got] == want
    assert [r.schema for r in got] == [au.DEFAULT_SCHEMA] + [None] * 8


def test_two_clocks_same_content(spark, chain):
    other = au.chain_build(records(spark, {"a": 9, "b": 1, "c": 5}, "2027-01-01"), ["n"])
    assert au.diff_runs(chain, other).count() == 0
    assert chain.join(other, ["session_id", "seq", "entry_sha256"]).count() == 0
    assert au.diff_runs(chain, other.where("seq < 4")).count() == 6


# Chunks of one, two and many positions.
@pytest.mark.parametrize("bits", [0, 1, 22])
def test_verify_finds_the_first_break(spark, chain, bits):
    def verdict(df):
        return {r.session_id: (r.valid, r.broken_index, r.reason)
                for r in au.chain_verify(df, bits=bits).collect()}

    clean = {s: (True, None, None) for s in "abc"}
    assert verdict(chain) == clean
    hit = (F.col("session_id") == "a") & (F.col("seq") == 4)

    def edit(col, new):
        return chain.withColumn(col, F.when(hit, F.lit(new)).otherwise(F.col(col)))

    cases = [
        (edit("payload", '{"k":777}'), 4, "payload hash mismatch"),
        (edit("audit", '{"timestamp_utc":"x"}'), 4, "entry hash mismatch"),
        (edit("operation", "other"), 4, "entry hash mismatch"),
        (edit("prev_sha256", GENESIS), 4, "prev_sha256 mismatch"),
        (edit("entry_sha256", GENESIS), 4, "entry hash mismatch"),
        (chain.where(~hit), 4, "prev_sha256 mismatch"),
        (chain.where(~((F.col("session_id") == "a") & (F.col("seq") == 0))), 0, "prev_sha256 mismatch"),
    ]
    for df, index, reason in cases:
        assert verdict(df) == {**clean, "a": (False, index, reason)}
    foreign = chain.withColumn("schema", F.when(F.col("schema").isNotNull(), "other-v9"))
    assert verdict(foreign)["b"] == (False, 0, "unexpected schema")
    # Cutting the tail is not a break of the chain; completeness is a separate question.
    assert verdict(chain.where("session_id <> 'a' or seq < 8")) == clean


def test_fingerprint_streams_over_batches(spark):
    rng = random.Random(5)
    rows = [(rng.choice("xy"), hashlib.sha256(str(rng.randrange(50)).encode()).hexdigest()) for _ in range(300)]
    df = spark.createDataFrame(rows, "session_id string, sha256 string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {r.session_id: (r.n_outputs, r.output_fingerprint) for r in au.output_fingerprint(df).collect()}
        chained = au.chain_build(records(spark, {"z": 40}), ["n"]).orderBy("seq").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for s in "xy":
        mine = sorted(h for k, h in rows if k == s)
        assert got[s] == (len(mine), hashlib.sha256(canonical_text(mine).encode()).hexdigest())
    assert chained[-1].entry_sha256 == by_hand([(r.operation, r.payload, r.audit) for r in chained])[-1][2]


def test_extract_segments_skips_what_is_malformed(spark):
    good = {"start_global_ms": 1000, "end_global_ms": 3000, "duration_ms": 1500, "decision": "NaN"}
    payloads = [
        good,
        {"file_index": 0, "start_ms": 0, "operation": "layer3_segment",
         "payload": {"start_global_ms": 5000, "end_global_ms": 6000}},
        {"start_global_ms": "7000", "end_global_ms": 7500.9},
        {"start_global_ms": 1}, {"start_global_ms": "x", "end_global_ms": 9},
        {"start_global_ms": 5, "end_global_ms": 5}, {**good, "duration_ms": None},
    ]
    rows = [("s", i, "layer3_segment", canonical_text(p)) for i, p in enumerate(payloads)]
    rows.append(("s", 99, "layer3_nan_block", canonical_text(good)))
    df = spark.createDataFrame(rows, "session_id string, seq bigint, operation string, payload string")
    got = au.extract_segments(df).orderBy("start_ms").collect()
    assert [(r.start_ms, r.end_ms, r.duration_ms, r.decision) for r in got] == [
        (1000, 3000, 1500, "NaN"), (5000, 6000, 1000, "CLEAN"), (7000, 7500, 500, "CLEAN"),
    ]


def test_log_completeness(spark):
    ops = list(au.REQUIRED_OPERATIONS)
    fp = canonical_text({"output_fingerprint": "f"})

    def log(session, names, end=fp):
        return [(session, i, o, fp if o == "output_hash" else end if o == "session_end" else "{}")
                for i, o in enumerate(names)]

    rows = log("ok", ops) + log("cut", ops[:-1]) + log("bad", ops, canonical_text({"output_fingerprint": "g"}))
    df = spark.createDataFrame(rows, "session_id string, seq bigint, operation string, payload string")
    got = {r.session_id: (r.missing, r.complete) for r in au.log_completeness(df).collect()}
    assert got == {"ok": ("", True), "cut": ("session_end", False), "bad": ("", False)}
