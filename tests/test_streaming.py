import random
import time

import pytest
from pyspark.sql import functions as F

from spanweave.operators import audit as au
from spanweave.sources.logs import write_audit
from spanweave.streaming import late, read_audit_stream, read_log_stream, verify_audit_stream, verify_late_stream
from spanweave.streaming.late import PROVIDER, ROCKSDB
from tests.test_audit import records

OUT = "session_id string, index bigint, seq bigint, reason string"


def test_stream_finds_what_the_batch_check_finds(spark, tmp_path):
    chain = au.chain_build(records(spark, {"a": 12, "b": 4, "c": 9}), ["n"])
    hit = lambda s, q: (F.col("session_id") == s) & (F.col("seq") == q)
    edited = (
        chain.withColumn("payload", F.when(hit("a", 3), '{"k":777}').otherwise(F.col("payload")))
        .withColumn("audit", F.when(hit("a", 9), "{}").otherwise(F.col("audit")))
        .withColumn("schema", F.when(hit("b", 0), "other").otherwise(F.col("schema")))
        .where(~hit("c", 5))
        .checkpoint()
    )
    # Three files, in seq order, one micro-batch each.
    for i, (lo, hi) in enumerate([(0, 3), (4, 7), (8, 99)]):
        part = edited.where(F.col("seq").between(lo, hi)).coalesce(1)
        part.write.mode("append").parquet(str(tmp_path / "log"))
    found = verify_audit_stream(read_audit_stream(spark, str(tmp_path / "log"), max_files=1))
    query = (
        found.writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(180)
    got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    want = sorted(tuple(r) for r in au.chain_breaks(edited).collect())
    assert got == want and len(got) >= 5
    assert ("b", 0, 0, au.BAD_SCHEMA) in got
    assert ("a", 3, 3, "payload hash mismatch") in got and ("c", 5, 6, "prev_sha256 mismatch") in got


def test_stream_over_json_lines(spark, tmp_path):
    chain = au.chain_build(records(spark, {"a": 6, "b": 5}), ["n"])
    hit = (F.col("session_id") == "b") & (F.col("seq") == 2)
    edited = chain.withColumn("operation", F.when(hit, "other").otherwise(F.col("operation")))
    write_audit(edited, str(tmp_path / "log"))
    query = (
        verify_audit_stream(read_log_stream(spark, str(tmp_path / "log")))
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(180)
    got = [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert got == [("b", 2, 2, "entry hash mismatch")]


def late_session(spark):
    own = spark.newSession()
    own.conf.set(PROVIDER, ROCKSDB)
    own.conf.set("spark.sql.shuffle.partitions", "2")
    return own


def drain(found, tmp_path):
    query = (
        found.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination(240)
    assert query.exception() is None


def test_late_records_are_waited_for(spark, tmp_path):
    chain = au.chain_build(records(spark, {"a": 14, "b": 4, "c": 9, "d": 3}), ["n"])
    hit = lambda s, q: (F.col("session_id") == s) & (F.col("seq") == q)
    edited = (
        chain.withColumn("payload", F.when(hit("a", 3), '{"k":777}').otherwise(F.col("payload")))
        .withColumn("audit", F.when(hit("a", 9), "{}").otherwise(F.col("audit")))
        .withColumn("schema", F.when(hit("b", 0), "other").otherwise(F.col("schema")))
        .where(~hit("c", 5) & ~hit("d", 0))
        .withColumn("at", F.timestamp_seconds(F.col("seq") + 1000))
        .checkpoint()
    )
    # Three files in no order; a record may come two files before its predecessors.
    for i in range(3):
        part = edited.where((F.col("seq") * 7 + 2) % 3 == i).coalesce(1)
        part.write.mode("append").parquet(str(tmp_path / "log"))
    own = late_session(spark)
    stream = read_audit_stream(own, str(tmp_path / "log"), edited.schema, max_files=1)
    drain(verify_late_stream(stream, 3_600_000, "at"), tmp_path)
    early = [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert ("a", 3, 3, au.BAD_PAYLOAD) in early and not [r for r in early if r[0] == "d"]
    # A heartbeat two hours later, and a record that comes after its gap was closed.
    beat = edited.limit(1).withColumns({"session_id": F.lit(None).cast("string"), "at": F.timestamp_seconds(F.lit(9000))})
    beat.write.mode("append").parquet(str(tmp_path / "log"))
    drain(verify_late_stream(stream, 3_600_000, "at"), tmp_path)
    got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    want = sorted(tuple(r) for r in au.chain_breaks(edited.drop("at")).collect())
    assert got == want and len(got) >= 7
    late = chain.where(hit("c", 5)).withColumn("at", F.timestamp_seconds(F.lit(9001)))
    again = chain.where(hit("a", 4)).withColumn("at", F.timestamp_seconds(F.lit(9001)))
    late.unionByName(again).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    drain(verify_late_stream(stream, 3_600_000, "at"), tmp_path)
    more = [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(set(more) - set(got)) == [("a", None, 4, au.BAD_SEQ), ("c", None, 5, au.BAD_SEQ)]


def test_late_records_by_the_clock(spark, tmp_path):
    chain = au.chain_build(records(spark, {"a": 6, "b": 5}), ["n"]).checkpoint()
    lacking = chain.where("NOT (session_id = 'b' AND seq = 2)")
    for i in (1, 0):
        lacking.where(F.col("seq") % 2 == i).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    own = late_session(spark)
    found = verify_late_stream(read_audit_stream(own, str(tmp_path / "log"), chain.schema, max_files=1), 4000)
    query = (
        found.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(processingTime="1 second").start()
    )
    want = sorted(tuple(r) for r in au.chain_breaks(lacking).collect())
    got = []
    try:
        for _ in range(60):
            time.sleep(1)
            if query.exception() is not None:
                raise query.exception()
            if (tmp_path / "out" / "_spark_metadata").exists():
                got = sorted(tuple(r) for r in spark.read.schema(OUT).parquet(str(tmp_path / "out")).collect())
            if got == want:
                break
    finally:
        query.stop()
    assert got == want and got


def test_late_stream_needs_its_state_store(spark, tmp_path):
    plain = spark.newSession()
    plain.conf.unset(PROVIDER)
    chain = au.chain_build(records(spark, {"a": 2}), ["n"])
    chain.write.parquet(str(tmp_path / "log"))
    with pytest.raises(ValueError, match="RocksDB"):
        verify_late_stream(read_audit_stream(plain, str(tmp_path / "log"), chain.schema), 10)


class _Calls:
    """The state of one session in memory, which counts the calls made to it."""

    def __init__(self):
        self.calls, self.value, self.map, self.timers = 0, None, {}, set()

    def getValueState(self, *schema):
        return self

    getMapState = getValueState

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    def getValue(self, key):
        self.calls += 1
        return self.map.get(key)

    def containsKey(self, key):
        self.calls += 1
        return key in self.map

    def updateValue(self, key, value):
        self.calls += 1
        self.map[key] = value

    def removeKey(self, key):
        self.calls += 1
        self.map.pop(key, None)

    def iterator(self):
        return iter(list(self.map.items()))

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.discard(at)


class _Now:
    def __init__(self, at):
        self.at = at

    def getCurrentWatermarkInMs(self):
        return self.at

    getExpiryTimeInMs = getCurrentWatermarkInMs


@pytest.mark.parametrize("held", [50, 100_000])
def test_waiting_records_are_kept_with_few_calls(held, monkeypatch):
    monkeypatch.setattr(late, "HELD", held)
    state, session = _Calls(), late._Session("session_id", True, 10)
    session.init(state)
    lacking = {0, 500, 501, 1700}

    def row(i):
        good = {"schema_ok": True, "payload_ok": i != 900, "entry_ok": True}
        return {"seq": i, "prev_sha256": str(i - 1) if i else late.GENESIS, "entry_sha256": str(i), "at_ms": 1000 + i, **good}

    rows = [row(i) for i in range(2000) if i not in lacking]
    random.Random(5).shuffle(rows)
    got = []
    for i in range(0, len(rows), 700):
        got += session.handleInputRows(("a",), iter(rows[i : i + 700]), None)
    got += session.handleInputRows(("a",), iter([row(3), {**row(3), "seq": None}]), None)
    assert [(r["index"], r["seq"], r["reason"]) for r in got] == [(None, 3, late.BAD_SEQ), (None, None, late.BAD_SEQ)]
    if held > 2000:
        assert state.calls < 100 and len(state.timers) == 1
    # The watermark passes the records up to 1099, which those up to the next gap follow; then all of them.
    got = []
    for now in (2100, 9000):
        while due := sorted(t for t in state.timers if t < now):
            state.timers.discard(due[0])
            got += session.handleExpiredTimer(("a",), _Now(now), _Now(due[0]))
        assert not [r for r in got if now == 2100 and r["seq"] > 1700]
    # A gap breaks the chain at the record after it; the numbers differ from the places from there on.
    want = [(i - sum(j < i for j in lacking), i) for i in range(2000) if i not in lacking]
    assert [(r["index"], r["seq"]) for r in got] == want
    reasons = {r["seq"]: r["reason"] for r in got}
    assert reasons[900] == late.BAD_PAYLOAD and reasons[502] == late.BAD_PREVIOUS and reasons[503] == late.BAD_SEQ
    assert not state.map and not state.timers
    assert [*session.handleInputRows(("a",), iter([row(2000)]), None)][0]["index"] == 1996
