"""Inputs that are odd, repeated, empty, wide or held by one session."""

import json
import time

import pytest
from pyspark.sql import functions as F

from spanweave.functions.vectors import l2_normalize, masked_mean
from spanweave.operators import audit as au
from spanweave.operators import identity as ident
from spanweave.operators.lineage import scratch_root
from spanweave.operators.salting import salted_join
from spanweave.sources import logs

REC = "session_id string, n int, operation string, payload string, audit string"


def test_chain_keeps_records_of_null_and_equal_order(spark):
    rows = [
        ("s", None, "a", '{"k":1}', "{}"),
        ("s", None, "a", '{"k":1}', "{}"),
        ("s", 1, None, None, None),
        ("s", 1, "b", None, "{}"),
        ("t", 5, "a", '{"k":2}', None),
    ]
    chain = au.chain_build(spark.createDataFrame(rows, REC), ["n"]).cache()
    got = sorted((r.session_id, r.seq, r.operation or "") for r in chain.collect())
    # Equal order and payload: the null operation comes first.
    assert got == [("s", 0, "a"), ("s", 1, "a"), ("s", 2, ""), ("s", 3, "b"), ("t", 0, "a")]
    assert chain.count() == len(rows)
    assert {(r.session_id, r.valid) for r in au.chain_verify(chain).collect()} == {("s", True), ("t", True)}


def test_logs_without_a_byte_are_failures(spark, tmp_path):
    (tmp_path / "empty.jsonl").write_bytes(b"")
    (tmp_path / "blank.jsonl").write_text("\t\n  \n")
    record = {"seq": 0, "operation": "a", "payload": None, "audit": {}, "schema": "x-manifest-v1"}
    (tmp_path / "a+b.jsonl").write_text("\t\n" + json.dumps(record) + "\n")
    (tmp_path / "c d.jsonl").write_text(json.dumps(record) + "\n")
    records, failures = logs.read_audit(spark, str(tmp_path))
    assert sorted((r.session_id, r.reason) for r in failures.collect()) == [
        ("blank", "log is empty"),
        ("empty", "log is empty"),
    ]
    assert sorted(r.session_id for r in records.collect()) == ["a+b", "c d"]


def test_equal_clicks_stay_apart(spark):
    clicks = spark.createDataFrame([("s", 0, 0, 5, 5)] * 2 + [("s", 0, 0, 50, 50)], "session_id string, file_index int, pts_ms int, x int, y int")
    boxes = spark.createDataFrame(
        [("s", 0, 0, 0, 0, 10, 10, 0), ("s", 0, 0, 0, 0, 20, 20, 1)],
        "session_id string, file_index int, pts_ms int, x1 int, y1 int, x2 int, y2 int, box_idx int",
    )
    got = sorted((r.x, r.box_idx, r.n_boxes) for r in ident.resolve_clicks(clicks, boxes).collect() if r.box_idx is not None)
    assert got == [(5, 0, 2), (5, 0, 2)]
    assert ident.resolve_clicks(clicks, boxes).count() == 3


def test_sessions_without_a_target_are_named(spark):
    sessions = spark.createDataFrame([(s,) for s in "abcd"], "session_id string")
    resolved = spark.createDataFrame(
        [("a", "speaking", 1, [1.0]), ("b", "speaking", None, None), ("c", "speaking", 1, None), ("d", "anti", 1, [1.0])],
        "session_id string, kind string, x1 int, embedding array<double>",
    )
    got = {r.session_id: r.reason for r in ident.target_failures(sessions, resolved).collect()}
    assert got == {"b": ident.CLICK_MISSED, "c": ident.NO_EMBEDDING, "d": ident.NO_CLICK}


@pytest.mark.parametrize(
    ("value", "want"),
    [(12, 12), (12.7, 12), ("12", 12), (" 12 ", 12), ("12.5", None), ("true", None), (True, 1), (None, None), ([1], None), (2**60 + 1, 2**60 + 1)],
)
def test_json_numbers_as_whole_numbers(spark, value, want):
    body = {"start_global_ms": value, "end_global_ms": 2**62, "duration_ms": 5}
    df = spark.createDataFrame([("s", 0, au.SEGMENT_OPERATION, json.dumps(body))], "session_id string, seq long, operation string, payload string")
    got = [r.start_ms for r in au.extract_segments(df).collect()]
    assert got == ([] if want is None else [want])


def test_salted_join_equals_a_plain_one(spark):
    many = spark.createDataFrame([(i % 3 if i % 5 else None, i) for i in range(300)], "k int, v int")
    one = spark.createDataFrame([(0, "a"), (1, "b")], "k int, w string")
    for how in ("inner", "left"):
        want = sorted(many.join(one, ["k"], how).collect(), key=str)
        assert sorted(salted_join(many, one, ["k"], ["v"], how).collect(), key=str) == want


def test_hot_sessions_are_split(spark):
    """No aggregate reads a join on the session alone."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        vectors = spark.createDataFrame([("s", 0, i, i, 0, [1.0, 0.0]) for i in range(50)], "session_id string, file_index int, start_ms int, end_ms int, speaker_idx int, embedding array<double>")
        seeds = spark.createDataFrame([("s", [1.0, 0.0])], "session_id string, embedding array<double>")
        df = ident.match_identity(vectors, seeds, group=["session_id", "file_index", "start_ms", "end_ms"])
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("_salt") and "hashpartitioning(session_id" in plan
        assert "hashpartitioning(session_id#" in plan and "file_index" in plan.split("SortMergeJoin")[0].split("Exchange hashpartitioning")[-1]
        assert df.where("target_speaker_idx = 0").count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def seconds(df):
    best = None
    for _ in range(3):
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        took = time.perf_counter() - t0
        best = took if best is None else min(best, took)
    return best


@pytest.mark.parametrize("kind", ["norm", "mean"])
def test_vectors_cost_in_proportion_to_their_dimension(spark, kind):
    def run(dim):
        row = F.transform(F.sequence(F.lit(1), F.lit(dim)), lambda i: (i + F.col("id")).cast("double"))
        df = spark.range(0, 400, 1, 2).select(row.alias("v"))
        if kind == "mean":
            return df.select(masked_mean(F.array("v", "v", "v"), F.lit(960)).alias("m"))
        return df.select(l2_normalize(F.col("v")).alias("m"))

    assert seconds(run(1024)) < 6 * max(seconds(run(256)), 0.1)


def test_pooling_wide_and_uneven_vectors(spark):
    rows = [("a", [float(i + 1) for i in range(1024)]), ("a", [1.0] * 1024), ("b", [3.0, 4.0])]
    df = spark.createDataFrame(rows * 30, "k string, embedding array<double>").repartition(7)
    got = {r.k: r for r in ident.pool_vectors(df, ["k"]).collect()}
    assert got["b"].embedding == pytest.approx([0.6, 0.8]) and got["a"].n_vectors == 60
    uneven = spark.createDataFrame([("a", [1.0]), ("a", [1.0, 2.0])], "k string, embedding array<double>")
    with pytest.raises(Exception, match="inconsistent dimension"):
        ident.pool_vectors(uneven, ["k"]).collect()


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    class Fake:
        def __init__(self, master):
            self.conf = {"spark.master": master}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(Fake("yarn"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(Fake("local-cluster[2,1,1024]"))
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
