"""Chain verification of records that arrive out of order, with a bounded wait for late ones."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from spanweave.functions.canonical import GENESIS
from spanweave.operators.audit import BAD_ENTRY, BAD_PAYLOAD, BAD_PREVIOUS, BAD_SCHEMA, BAD_SEQ
from spanweave.streaming.verify import checked_records

#: Records of one session that a step holds in memory before it writes them to the state store.
HELD = 100_000
#: Numbers of one entry of the map of waiting records. A call to the state store costs far more than a record.
BLOCK = 256
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_FIELDS = ("prev_sha256", "entry_sha256", "schema_ok", "payload_ok", "entry_ok")
_PLACE = "index bigint, expected bigint, prev string, waiting bigint, due bigint"
_PENDING = (
    "records array<struct<seq: bigint, prev_sha256: string, entry_sha256: string, schema_ok: boolean, "
    "payload_ok: boolean, entry_ok: boolean, due: bigint>>"
)


class _Session(StatefulProcessor):
    """State of one session: where its chain stands, and the records that came before their turn.

    These lie in blocks of ``BLOCK`` numbers, each read at most once a step and written at its end. The session
    has one timer, at the time at which the first of them is due.
    """

    def __init__(self, key_name: str, event_time: bool, wait_ms: int):
        self.key_name, self.event_time, self.wait_ms = key_name, event_time, wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.place = handle.getValueState("place", _PLACE)
        self.pending = handle.getMapState("pending", "block bigint", _PENDING)

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if key[0] is None:  # heartbeats; a filter would be pushed below the watermark, which then missed them
            return
        self._load()
        now = None if self.event_time else timerValues.getCurrentProcessingTimeInMs()
        for row in rows:
            seq = row["seq"]
            if seq is None or seq < self.expected or seq in self._block(seq):
                # No place in the chain: no number, or a number that another record has or had.
                yield self._row(key, None, seq, BAD_SEQ)
                continue
            record = (*(row[f] for f in _FIELDS), row["at_ms"] if now is None else now + self.wait_ms)
            if seq == self.expected:
                yield from self._take(key, seq, record)
                while self.waiting and self.expected in self._block(self.expected):
                    yield from self._take(key, self.expected, self._pop(self.expected))
            else:
                self._block(seq)[seq] = record
                self.changed.add(seq // BLOCK)
                self.held += 1
                self.waiting += 1
                self.due = record[5] if self.due is None else min(self.due, record[5])
        self._store()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """The gap before every record that is due is closed: the chain goes on there."""
        self._load()
        now = timerValues.getCurrentWatermarkInMs() if self.event_time else timerValues.getCurrentProcessingTimeInMs()
        reached = max(expiredTimerInfo.getExpiryTimeInMs(), now - 1)
        blocks, last, self.due, self.timer = [], -1, None, None
        for block, value in self.pending.iterator() if self.waiting else ():
            blocks.append(block[0])
            for record in value[0]:
                if record[6] <= reached:
                    last = max(last, record[0])
                else:
                    self.due = record[6] if self.due is None else min(self.due, record[6])
        for block in sorted(blocks):
            if block > last // BLOCK and block != self.expected // BLOCK:
                break
            for seq in sorted(self._block(block * BLOCK)):
                if seq <= last or seq == self.expected:
                    yield from self._take(key, seq, self._pop(seq))
        self._store()

    def _load(self) -> None:
        found = self.place.get()
        first = (0, 0, GENESIS, 0, None)
        self.index, self.expected, self.prev, self.waiting, self.due = first if found is None else tuple(found)
        self.timer = self.due
        self.blocks, self.changed, self.held, self.stored = {}, set(), 0, self.waiting > 0

    def _store(self) -> None:
        self._write()
        if not self.waiting:
            self.due = None
        if self.due != self.timer:
            if self.timer is not None:
                self.handle.deleteTimer(self.timer)
            if self.due is not None:
                self.handle.registerTimer(self.due)
        self.place.update((self.index, self.expected, self.prev, self.waiting, self.due))

    def _block(self, seq: int) -> dict[int, tuple]:
        """The waiting records of the block that ``seq`` belongs to."""
        at = seq // BLOCK
        if at not in self.blocks:
            if self.held > HELD:
                self._write()
            found = self.pending.getValue((at,)) if self.stored else None
            self.blocks[at] = {r[0]: tuple(r[1:]) for r in found[0]} if found is not None else {}
            self.held += len(self.blocks[at])
        return self.blocks[at]

    def _pop(self, seq: int) -> tuple:
        record = self._block(seq).pop(seq)
        self.changed.add(seq // BLOCK)
        self.waiting -= 1
        return record

    def _write(self) -> None:
        for at in sorted(self.changed):
            if self.blocks[at]:
                self.pending.updateValue((at,), ([(seq, *record) for seq, record in self.blocks[at].items()],))
                self.stored = True
            elif self.stored:
                self.pending.removeKey((at,))
        self.blocks, self.changed, self.held = {}, set(), 0

    def _take(self, key, seq: int, record: tuple) -> Iterator[Row]:
        stored_prev, entry, schema_ok, payload_ok, entry_ok, _ = record
        if self.index == 0 and not schema_ok:
            reason = BAD_SCHEMA
        elif not payload_ok:
            reason = BAD_PAYLOAD
        elif stored_prev != self.prev:
            reason = BAD_PREVIOUS
        elif not entry_ok:
            reason = BAD_ENTRY
        elif seq != self.index:
            reason = BAD_SEQ
        else:
            reason = None
        if reason:
            yield self._row(key, self.index, seq, reason)
        self.index, self.expected, self.prev = self.index + 1, seq + 1, entry

    def _row(self, key, index: int | None, seq: int | None, reason: str) -> Row:
        return Row(**{self.key_name: key[0], "index": index, "seq": seq, "reason": reason})


def verify_late_stream(stream: DataFrame, wait_ms: int, event_time: str | None = None) -> DataFrame:
    """Violations of each session's chain, for records that arrive in any order.

    A record that comes before its turn waits in the session's state (a map of blocks of records, in RocksDB)
    until its predecessors are there, for at most ``wait_ms``: then a timer closes the gap before it,
    which is the violation that ``chain_breaks`` finds without the missing records. If everything
    arrives within the wait, the result equals ``chain_breaks`` of the whole log. Records without a number, of
    a number seen before, or whose gap was already closed have no place in the chain; they
    are reported with a null index and change nothing.

    The wait counts by the clock, or by the column ``event_time``, where it ends when the watermark (the latest
    time seen less ``wait_ms``) passes the waiting record; rows older than the watermark are dropped by Spark
    and so count as missing. Rows without a session are heartbeats: they only move that time. The session
    must use the RocksDB state store.
    """
    spark = stream.sparkSession
    if spark.conf.get(PROVIDER, "") != ROCKSDB:
        raise ValueError(f"set {PROVIDER} to {ROCKSDB}")
    at = F.lit(0).cast("bigint")
    if event_time is not None:
        stream = stream.withWatermark(event_time, f"{wait_ms} milliseconds")
        at = F.unix_millis(F.col(event_time))
    carried = [event_time] if event_time else []
    rows = checked_records(stream, at.alias("at_ms"), *carried)
    key = stream.schema["session_id"].dataType.simpleString()
    return rows.groupBy("session_id").transformWithState(
        _Session("session_id", event_time is not None, wait_ms),
        f"session_id {key}, index bigint, seq bigint, reason string",
        "Append",
        "EventTime" if event_time else "ProcessingTime",
    )
