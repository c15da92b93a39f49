"""Audit logs as JSON lines."""

from __future__ import annotations

import json
import logging
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanweave.functions.canonical import canonical_object, canonical_text, json_string, json_value, sha256_hex
from spanweave.operators.audit import SCHEMA_SUFFIX, chain_build, chain_tails, entry_sha256
from spanweave.operators.lineage import materialize
from spanweave.operators.timeline import SESSION

_RECORD = (
    "seq bigint, operation string, payload string, audit string, prev_sha256 string, "
    "payload_sha256 string, entry_sha256 string, schema string, error string"
)
_RECORD_NAMES = [f.split(" ")[0] for f in _RECORD.split(", ")]
#: Folder of part files that hold many logs each, and what a null or empty session is called, as by Spark's writer.
BUNDLE, NO_SESSION = "bundle=all", "__HIVE_DEFAULT_PARTITION__"


def _decoded(name: Column) -> Column:
    # A plus sign is itself: only %XX stands for something else here.
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def session_of_file(path: Column, uri: bool = True) -> Column:
    """Session of a log file: its ``session_id=...`` folder, else its name without suffixes.

    Folder names are escaped when they are written; a file's URI (``_metadata.file_path``) escapes all
    names once more, a plain ``path`` does not.
    """
    folder = F.regexp_extract(path, r"/session_id=([^/]+)/", 1)
    stem = F.regexp_replace(
        F.regexp_extract(path, r"([^/]+)$", 1), r"(\.manifest)?\.jsonl$|\.txt$", ""
    )
    if uri:
        folder, stem = _decoded(folder), _decoded(stem)
    return F.when(folder != "", _decoded(folder)).otherwise(stem)


def _is_bundle(path: Column) -> Column:
    return path.rlike(f"/{BUNDLE}/[^/]+$")


def has_text(line: Column) -> Column:
    """Whether a line holds more than white space."""
    return line.rlike(r"(?U)\S")


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(session_id, position, line)`` of every line of every log under ``path``, in file order.

    Large files stay splittable: a line's place is (append, part number in the file's name, file, block
    offset, order within the block). ``position`` orders lines within a log and is unique; blank lines are
    counted. One log is a file, a folder ``session_id=...`` of ordered part files, or the lines of its session in
    a folder of bundled logs (see ``write_audit``).
    """
    raw = spark.read.option("recursiveFileLookup", "true").text(path)
    # monotonically_increasing_id follows the order in which a task reads its blocks.
    tagged = raw.select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )
    # In a bundle a line is the escaped session, a tab and the log's line; a log's lines follow each other.
    mixed = _is_bundle(F.col("_file"))
    head = F.substring_index("value", "\t", 1)
    session = F.when(mixed, F.url_decode(head)).otherwise(session_of_file(F.col("_file")))
    line = F.when(mixed, F.expr("substring(value, locate('\\t', value) + 1)")).otherwise(F.col("value"))
    number = lambda pattern: F.coalesce(
        F.regexp_extract("_file", pattern, 1).try_cast("bigint"), F.lit(0)
    )
    # One row per block: the number of lines before it in its log.
    where = ["session_id", "_append", "_part", "_file", "_block"]
    placed = tagged.select(
        session.alias("session_id"),
        number(r"/append=(\d+)/").alias("_append"),
        number(r"/part-(\d+)-[^/]*$").alias("_part"),
        "_file", "_block", "_row", line.alias("line"),
    )
    blocks = placed.groupBy(*where).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first")
    )
    before = (
        Window.partitionBy("session_id")
        .orderBy("_append", "_part", "_file", "_block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    shifts = blocks.select(
        *where,
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    return placed.join(shifts, where).select(
        "session_id", (F.col("_row") + F.col("_shift")).alias("position"), "line"
    )


def _record(line: str) -> tuple:
    try:
        rec = json.loads(line)
    except json.JSONDecodeError as exc:
        return (None,) * 8 + (f"not valid JSON: {exc.msg}",)
    if not isinstance(rec, dict):
        return (None,) * 8 + ("not a JSON object",)
    text = lambda k: rec[k] if isinstance(rec.get(k), str) else None
    seq = rec.get("seq")
    return (
        seq if isinstance(seq, int) and not isinstance(seq, bool) else None,
        text("operation"),
        canonical_text(rec.get("payload")),
        canonical_text(rec.get("audit", {})),
        text("prev_sha256"),
        text("payload_sha256"),
        text("entry_sha256"),
        text("schema"),
        None,
    )


def parse_records(lines: DataFrame) -> DataFrame:
    """Audit columns of ``(session_id, position, line)`` rows.

    Payload and audit block come out as canonical text, so that their hashes can be recomputed on
    the JVM. A line that is no JSON object has ``error`` set.
    """
    schema = f"session_id string, position bigint, {_RECORD}"

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pd.DataFrame([_record(s) for s in pdf["line"]], columns=_RECORD_NAMES)
            out["seq"] = out["seq"].astype("Int64")
            out.insert(0, "session_id", pdf["session_id"].to_numpy())
            out.insert(1, "position", pdf["position"].to_numpy())
            yield out

    return (
        lines.where(has_text(F.col("line")))
        .select(F.col("session_id").cast("string"), "position", "line")
        .mapInPandas(parse, schema)
    )


def read_audit(spark: SparkSession, path: str, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(records, failures)`` of the logs under ``path``.

    Failures: lines that are no JSON object (with their 1-based number), empty logs, and first
    records outside the ``*-manifest-v1`` family. ``strict`` raises on an unreadable line.
    """
    lines = read_lines(spark, path)
    parsed = parse_records(lines)
    bad = parsed.where(F.col("error").isNotNull()).select(
        "session_id",
        F.concat(F.lit("line "), F.col("position") + 1, F.lit(" is "), F.col("error")).alias(
            "reason"
        ),
    )
    # A file of no bytes has no line and is in no scan, so that logs are taken from the file listing,
    # which the reader has made at the driver anyway.
    listed = spark.read.option("recursiveFileLookup", "true").text(path).inputFiles()
    files = spark.createDataFrame([(f,) for f in listed], "path string")
    single = files.where(~_is_bundle(F.col("path")))
    logs = single.select(session_of_file(F.col("path")).alias("session_id")).distinct()
    lineless = logs.join(lines.select("session_id"), "session_id", "left_anti").select(
        "session_id", F.lit("log is empty").alias("reason")
    )
    empty = (
        lines.groupBy("session_id")
        .agg(F.max(has_text(F.col("line"))).alias("_any"))
        .where(~F.col("_any"))
        .select("session_id", F.lit("log is empty").alias("reason"))
    )
    known = F.coalesce(F.col("schema").endswith(SCHEMA_SUFFIX), F.lit(False))
    foreign = (
        parsed.where(F.col("error").isNull())
        .groupBy("session_id")
        .agg(F.min_by(known, "position").alias("_known"))
        .where(~F.col("_known"))
        .select("session_id", F.lit(f"first record is not a *{SCHEMA_SUFFIX} record").alias("reason"))
    )
    records = parsed.where(F.col("error").isNull()).drop("error")
    if strict:
        fine = F.when(F.col("error").isNull(), F.col("session_id")).otherwise(
            F.raise_error(
                F.concat_ws(
                    " ",
                    "session_id",
                    F.lit("line"),
                    (F.col("position") + 1).cast("string"),
                    F.lit("is"),
                    "error",
                )
            )
        )
        records = parsed.withColumn("session_id", fine).drop("error")
    return records, bad.unionByName(empty).unionByName(lineless).unionByName(foreign)


def record_line() -> Column:
    """The canonical JSON line of an audit row."""
    fields = {
        "seq": json_value(F.col("seq")),
        "operation": json_string(F.col("operation")),
        "payload": F.col("payload"),
        "audit": F.col("audit"),
        "prev_sha256": json_string(F.col("prev_sha256")),
        "payload_sha256": json_string(F.col("payload_sha256")),
        "entry_sha256": json_string(F.col("entry_sha256")),
    }
    return F.when(
        F.col("schema").isNull(), canonical_object(fields)
    ).otherwise(canonical_object({**fields, "schema": json_string(F.col("schema"))}))


def write_audit(
    audit: DataFrame,
    path: str,
    keys: tuple[str, ...] = SESSION,
    mode: str = "errorifexists",
    bundled: bool = False,
) -> None:
    """One log per session under ``path/session_id=...``, records in ``seq`` order.

    Rows are range-partitioned, so a long log spreads over several part files whose numbers follow
    ``seq``; read in that order they are the log. Many short logs make as many files, which cost more than their
    records: ``bundled`` writes them (by one key) into shared part files under ``path/bundle=all``, in the same order,
    each line after its session, escaped as in an URL, and a tab. Readers here take both.
    """
    rows = audit.withColumn("line", record_line()).repartitionByRange(*keys, "seq").sortWithinPartitions(*keys, "seq")
    if bundled:
        (key,) = keys
        session = F.coalesce(F.nullif(F.url_encode(F.col(key).cast("string")), F.lit("")), F.lit(NO_SESSION))
        folder, value = BUNDLE.split("=")
        rows = rows.select(F.lit(value).alias(folder), F.concat_ws("\t", session, "line").alias("line"))
        rows.write.mode(mode).partitionBy(folder).text(path)
    else:
        rows.select(*keys, "line").write.mode(mode).partitionBy(*keys).text(path)


# ---------------------------------------------------------------- appending

_STATE = "session_id string, n_records bigint, tail_sha256 string, append bigint"


def _appends(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the finished appends, ascending. One folder each is listed, at the driver."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_state")
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    found = [s.getPath() for s in files.listStatus(place)]
    done = [p for p in found if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(p.getName()) for p in done)


def log_state(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """``session_id, n_records, tail_sha256, append``: where each log of an appended folder ends, and in
    which append its last record lies."""
    numbers = [n for n in _appends(spark, path) if before is None or n < before]
    if not numbers:
        return spark.createDataFrame([], _STATE)
    return spark.read.schema(_STATE).parquet(f"{path}/_state/{numbers[-1]:09d}")


def changed_tails(spark: SparkSession, path: str, state: DataFrame) -> DataFrame:
    """``session_id, reason`` of the logs in ``state`` that do not end in files as the state says.

    Only the appends that hold these logs' last records are read, and of them the last record by log,
    whose hashes are computed again.
    """
    numbers = [r["append"] for r in state.select("append").distinct().collect()]  # few: one an append
    if not numbers:
        return spark.createDataFrame([], "session_id string, reason string")
    lines = read_lines(spark, [f"{path}/append={n:09d}" for n in sorted(numbers)])
    lines = lines.join(state.select("session_id"), "session_id", "left_semi")
    last = lines.where(has_text(F.col("line"))).groupBy("session_id").agg(F.max_by("line", "position").alias("line"))
    parsed = parse_records(last.select("session_id", F.lit(0).cast("bigint").alias("position"), "line"))
    payload_sha = sha256_hex(F.coalesce("payload", F.lit("null")))
    entry = entry_sha256(F.col("prev_sha256"), payload_sha, F.col("seq"), F.col("operation"), F.col("audit"))
    intact = (
        (F.col("seq") == F.col("n_records") - 1)
        & (F.col("entry_sha256") == F.col("tail_sha256"))
        & (entry == F.col("tail_sha256"))
    )
    return (
        state.join(parsed, "session_id", "left")
        .where(~F.coalesce(intact, F.lit(False)))
        .select("session_id", F.lit("the log's last record is not the one appended last").alias("reason"))
    )


def append_audit(
    records: DataFrame, order: Sequence[str], path: str, append: int | None = None, bundled: bool = False
) -> DataFrame:
    """Chain ``records`` (as for ``chain_build``) onto the logs under ``path``; return failures.

    Every call writes one folder ``append=...`` of part files, which ``read_audit`` reads in order,
    and then the state of all logs, which is the commit: a call that was interrupted is repeated with
    the same number and replaces what it had written. ``append`` defaults to the next number; a
    number that is finished is left as it is, so that a stream may pass its batch ids. Sessions are text.
    A log whose last record in the files is not what the state says is not appended to; such
    sessions are the failures (``session_id, reason``), and the rest goes on. One writer at a time.
    ``bundled`` is passed on to ``write_audit``; appends of one folder may differ in it.
    """
    spark = records.sparkSession
    finished = _appends(spark, path)
    number = append if append is not None else (finished[-1] + 1 if finished else 0)
    none = spark.createDataFrame([], "session_id string, reason string")
    if number in finished:
        return none
    if finished and number < finished[-1]:
        raise ValueError(f"append {number} after append {finished[-1]}")
    rows = records.withColumn("session_id", F.col("session_id").cast("string"))
    state = log_state(spark, path, before=number)
    open_ = state.join(rows.select("session_id").distinct(), "session_id", "left_semi")
    failures = none
    if finished:
        open_ = materialize(open_, "log-tails")
        failures = materialize(changed_tails(spark, path, open_), "log-failures")
        rows = rows.join(failures.select("session_id"), "session_id", "left_anti")
        open_ = open_.join(failures.select("session_id"), "session_id", "left_anti")
    grown = materialize(chain_build(rows, order, tails=open_), "log-append")
    write_audit(grown, f"{path}/append={number:09d}", mode="overwrite", bundled=bundled)
    tails = chain_tails(grown).withColumn("append", F.lit(number).cast("bigint"))
    others = state.join(tails.select("session_id"), "session_id", "left_anti")
    others.unionByName(tails).write.mode("overwrite").parquet(f"{path}/_state/{number:09d}")
    return failures


def append_stream(stream: DataFrame, order: Sequence[str], path: str, checkpoint: str):
    """Append a stream's records to the logs under ``path``, one append a micro-batch.

    A micro-batch that is repeated after a failure has the same number, so nothing is logged twice.
    Returns the writer, to be given a trigger and started. Failures are logged as warnings.
    """

    def step(batch: DataFrame, number: int) -> None:
        for row in append_audit(batch, order, path, number).limit(10).collect():
            logging.getLogger(__name__).warning("%s: %s", row["session_id"], row["reason"])

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
