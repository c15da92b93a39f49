"""JSON documents: speaker turns, operator clicks, checksum registries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanweave.functions.canonical import json_string
from spanweave.functions.timecode import seconds_to_ms
from spanweave.operators.audit import NULL_TYPE_TEXT, python_int
from spanweave.operators.timeline import SESSION
from spanweave.sources.logs import session_of_file

_TURNS = (
    "session_id string, source string, model string, device string, seed bigint, "
    "segments array<struct<start_ms:bigint,end_ms:bigint,speaker_id:string>>"
)
_REGISTRY = "map<string,struct<path:string,sha256:string>>"


def _required(value: Column, what: str) -> Column:
    return F.coalesce(value, F.raise_error(F.lit("malformed " + what)))


def read_turns(spark: SparkSession, path: str) -> DataFrame:
    """``(session_id, speaker_id, start_ms, end_ms)`` from turn documents.

    Empty turns are dropped and malformed ones are an error. A document without ``session_id`` takes its file
    name.
    """
    docs = (
        spark.read.schema(_TURNS)
        .option("multiLine", "true")
        .option("mode", "FAILFAST")
        .json(path)
        .select("*", F.col("_metadata.file_name").alias("_file"))
    )
    return (
        docs.select(
            F.coalesce("session_id", F.regexp_replace("_file", r"\.json$", "")).alias("session_id"),
            F.explode("segments").alias("s"),
        )
        .select(
            "session_id",
            _required(F.col("s.speaker_id"), "segment").alias("speaker_id"),
            _required(F.col("s.start_ms"), "segment").alias("start_ms"),
            _required(F.col("s.end_ms"), "segment").alias("end_ms"),
        )
        .where("end_ms > start_ms")
    )


def parse_turns(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(turns, failures)`` of ``(session_id, value)`` rows that hold turn documents as JSON text.

    ``turns``: ``session_id, speaker_id, start_ms, end_ms``, empty turns dropped; ``failures``: ``session_id,
    reason`` of documents that are no JSON object, whose ``segments`` is no list, or that have a segment
    without speaker or whole bounds. Such a document gives no turns; the others go on. Bounds are
    read as ``int()`` reads them: numbers truncate, quoted ones must be whole. A document without
    ``session_id`` takes the row's.
    """
    doc = F.try_parse_json("value")
    kind = lambda c: F.schema_of_variant(c)

    def whole(segment: Column, name: str) -> Column:
        text = F.try_variant_get(segment, f"$.{name}", "string")
        return python_int(text, kind(F.try_variant_get(segment, f"$.{name}", "variant")) == "STRING")

    def turn(segment: Column) -> Column:
        who = F.try_variant_get(segment, "$.speaker_id", "variant")
        return F.struct(
            F.when(kind(who) == "VOID", NULL_TYPE_TEXT).otherwise(who.cast("string")).alias("speaker_id"),
            whole(segment, "start_ms").alias("start_ms"),
            whole(segment, "end_ms").alias("end_ms"),
            segment.cast("string").alias("text"),
        )

    given = F.try_variant_get(doc, "$.segments", "variant")
    listed = F.coalesce(F.try_variant_get(doc, "$.segments", "array<variant>"), F.array().cast("array<variant>"))
    read = docs.select(
        F.coalesce(F.try_variant_get(doc, "$.session_id", "string"), F.col("session_id").cast("string")).alias("session_id"),
        kind(doc).alias("_kind"),
        kind(given).alias("_list"),
        F.transform(listed, turn).alias("_turns"),
    )
    broken = F.filter("_turns", lambda t: t["speaker_id"].isNull() | t["start_ms"].isNull() | t["end_ms"].isNull())
    reason = (
        F.when(F.col("_kind").isNull(), "not valid JSON")
        .when(~F.col("_kind").startswith("OBJECT"), "not a JSON object")
        .when(~F.coalesce(F.col("_list").startswith("ARRAY"), F.lit(True)), "segments is no list")
        .when(F.size(broken) > 0, F.concat(F.lit("malformed segment "), F.coalesce(F.try_element_at(broken, F.lit(1))["text"], F.lit("null"))))
    )
    judged = read.withColumn("reason", reason)
    turns = (
        judged.where(F.col("reason").isNull())
        .select("session_id", F.inline("_turns"))
        .where("end_ms > start_ms")
        .select("session_id", "speaker_id", "start_ms", "end_ms")
    )
    return turns, judged.where(F.col("reason").isNotNull()).select("session_id", "reason")


def load_turns(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(turns, failures)`` of a folder of turn documents, one JSON file each."""
    docs = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias("_file"))
    return parse_turns(docs.select(F.regexp_replace("_file", r"\.json$", "").alias("session_id"), "value"))


def read_written_turns(spark: SparkSession, path: str) -> DataFrame:
    """The turns of documents in parts, as ``write_turns`` leaves them, read line by line.

    A turn is a line of its own, so a session's document of any size is read by many tasks.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    body = F.regexp_extract("value", r'^,?(\{"end_ms":.*\})$', 1)
    turn = F.from_json(body, "start_ms bigint, end_ms bigint, speaker_id string", {"mode": "FAILFAST"})
    return (
        lines.where(body != "")
        .select(session_of_file(F.col("_metadata.file_path")).alias("session_id"), turn.alias("t"))
        .select("session_id", "t.speaker_id", "t.start_ms", "t.end_ms")
    )


def turns_from_seconds(df: DataFrame) -> DataFrame:
    """Model turns in float seconds (``start_s``, ``end_s``, ``speaker_id``) in milliseconds."""
    rest = [c for c in df.columns if c not in ("start_s", "end_s", "speaker_id")]
    return df.select(
        *rest,
        F.col("speaker_id").cast("string").alias("speaker_id"),
        seconds_to_ms("start_s").alias("start_ms"),
        seconds_to_ms("end_s").alias("end_ms"),
    )


def turns_documents(
    turns: DataFrame,
    keys: Sequence[str] = SESSION,
    schema: str = "turns-output-v1",
    provenance: DataFrame | None = None,
) -> DataFrame:
    """Turn documents as text lines: ``(keys, part, start_ms, end_ms, speaker_id, line)``.

    ``provenance`` has one row per session: its other columns (source, wav_sha256, model, seed, ...) become
    fields of the document, in their order; text, numbers, booleans, and maps or structs as
    objects. Its sessions have a document even without turns.

    Sorting a session's lines by those columns and joining them with newlines gives one JSON
    object: sorted segments, distinct speakers, counts and the raw total (overlap counted twice).
    Lines rather than one row per document, so that a session of any size can be written.
    """
    keys = list(keys)
    valid = turns.select(*keys, "speaker_id", "start_ms", "end_ms")
    null_int, null_text = F.lit(None).cast("bigint"), F.lit(None).cast("string")

    speakers = valid.select(*keys, "speaker_id").distinct()
    n_speakers = speakers.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_speakers"))
    totals = valid.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_segments"),
        F.sum(F.col("end_ms") - F.col("start_ms")).alias("speech_ms"),
        F.min("speaker_id").alias("_first_speaker"),
        F.min(F.struct("start_ms", "end_ms", "speaker_id")).alias("_first"),
    )
    heads = totals.join(n_speakers, keys)
    fields = F.lit("")
    if provenance is not None:
        zero = F.lit(0).cast("bigint")
        counts = ["n_segments", "speech_ms", "n_speakers"]
        heads = heads.join(provenance, keys, "right").withColumns({c: F.coalesce(c, zero) for c in counts})
        for field in (f for f in provenance.schema.fields if f.name not in keys):
            fields = F.concat(fields, F.lit(f',"{field.name}":'), _json(F.col(field.name), field.dataType))

    def line(df: DataFrame, part: int, text: Column, start=null_int, end=null_int, who=null_text):
        return df.select(
            *keys,
            F.lit(part).alias("part"),
            start.alias("start_ms"),
            end.alias("end_ms"),
            who.alias("speaker_id"),
            text.alias("line"),
        )

    opening = F.concat(
        F.lit('{"num_segments":'),
        F.col("n_segments"),
        F.lit(',"num_speakers":'),
        F.col("n_speakers"),
        F.lit(f',"schema":"{schema}","session_id":'),
        json_string(F.col(keys[0]).cast("string")),
        F.lit(',"total_speech_ms":'),
        F.col("speech_ms"),
        fields,
        F.lit(',"speakers":['),
    )
    comma = lambda first: F.when(first, F.lit("")).otherwise(F.lit(","))
    speaker_lines = speakers.join(totals.select(*keys, "_first_speaker"), keys)
    # Identical turns combine first, so that "the first" is one row; copies are repeated in text.
    counted = valid.groupBy(*keys, "start_ms", "end_ms", "speaker_id").agg(
        F.count(F.lit(1)).cast("int").alias("_copies")
    )
    body = F.concat(
        F.lit('{"end_ms":'),
        F.col("end_ms"),
        F.lit(',"speaker_id":'),
        json_string(F.col("speaker_id")),
        F.lit(',"start_ms":'),
        F.col("start_ms"),
        F.lit("}"),
    )
    is_first = F.struct("start_ms", "end_ms", "speaker_id") == F.col("_first")
    copies = counted.join(totals.select(*keys, "_first"), keys).select(
        "*", F.posexplode(F.array_repeat(body, F.col("_copies"))).alias("_i", "_body")
    )
    return (
        line(heads, 0, opening)
        .unionByName(
            line(
                speaker_lines,
                1,
                F.concat(
                    comma(F.col("speaker_id") == F.col("_first_speaker")),
                    json_string(F.col("speaker_id")),
                ),
                who=F.col("speaker_id"),
            )
        )
        .unionByName(line(heads, 2, F.lit('],"segments":[')))
        .unionByName(
            line(
                copies,
                3,
                F.concat(comma(is_first & (F.col("_i") == 0)), F.col("_body")),
                F.col("start_ms"),
                F.col("end_ms"),
                F.col("speaker_id"),
            )
        )
        .unionByName(line(heads, 4, F.lit("]}")))
    )


def _json(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        text = json_string(value)
    elif isinstance(kind, (T.MapType, T.StructType, T.ArrayType)):
        text = F.to_json(value)
    elif isinstance(kind, (T.IntegralType, T.FractionalType, T.BooleanType)):
        text = value.cast("string")
    else:
        text = json_string(value.cast("string"))
    return F.coalesce(text, F.lit("null"))


def write_turns(
    turns: DataFrame, path: str, schema: str = "turns-output-v1", provenance: DataFrame | None = None
) -> None:
    """One JSON document per session under ``path/session_id=...``, in numbered part files.

    The parts of a session, end to end in the order of their numbers, are the document. Lines are
    range-partitioned, so that a session of any size is written by many tasks; a small one is one part.
    ``read_written_turns`` reads the turns back.
    """
    lines = turns_documents(turns, schema=schema, provenance=provenance)
    # The copy with the leading comma must follow the one without.
    order = ["session_id", "part", "start_ms", "end_ms", "speaker_id", "_c", "line"]
    (
        lines.withColumn("_c", F.col("line").startswith(","))
        .repartitionByRange(*order[:-1])
        .sortWithinPartitions(*order)
        .select("session_id", "line")
        .write.mode("errorifexists")
        .partitionBy("session_id")
        .text(path)
    )


def read_clicks(spark: SparkSession, path: str) -> DataFrame:
    """``(session_id, kind, file_index, x, y, pts_ms)``; the speaking click is mandatory.

    An absent, null or non-object anti click means none.
    """
    docs = (
        spark.read.text(path, wholetext=True)
        .select("value", F.col("_metadata.file_name").alias("_file"))
    )
    return parse_clicks(
        docs.select(F.regexp_replace("_file", r"\.json$", "").alias("session_id"), "value")
    )


def _clicks(docs: DataFrame) -> DataFrame:
    """``session_id, reason, speaking, anti`` of ``(session_id, value)``; the clicks are structs of integers."""
    doc = F.try_parse_json("value")

    def click(name: str) -> Column:
        def whole(field: str) -> Column:
            at = f"$.{name}.{field}"
            quoted = F.schema_of_variant(F.try_variant_get(doc, at, "variant")) == "STRING"
            return python_int(F.try_variant_get(doc, at, "string"), quoted)

        return F.struct(
            *[whole(f).try_cast("int").alias(f) for f in ("file_index", "x", "y")], whole("pts_ms").alias("pts_ms")
        )

    def lacks(name: str) -> Column:
        return F.exists(F.array(*[F.col(name)[f].isNull() for f in ("file_index", "x", "y", "pts_ms")]), lambda x: x)

    anti_given = F.coalesce(F.schema_of_variant(F.try_variant_get(doc, "$.anti_click", "variant")).startswith("OBJECT"), F.lit(False))
    kind = F.schema_of_variant(doc)
    read = docs.select(
        "session_id", kind.alias("_kind"), anti_given.alias("_has_anti"),
        click("speaking_click").alias("speaking"), click("anti_click").alias("anti"),
    )
    reason = (
        F.when(F.col("_kind").isNull(), "not valid JSON")
        .when(~F.col("_kind").startswith("OBJECT"), "not a JSON object")
        .when(lacks("speaking"), "malformed click: speaking_click")
        .when(F.col("_has_anti") & lacks("anti"), "malformed click: anti_click")
    )
    return read.select("session_id", reason.alias("reason"), "speaking", F.when(F.col("_has_anti"), F.col("anti")).alias("anti"))


def judge_clicks(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(clicks, failures)`` of ``(session_id, value)`` rows holding the JSON text.

    Numbers are read as ``int()`` reads them, so a quoted fraction is malformed. A document that is no
    JSON object or lacks the speaking click gives no clicks and one failure; the others go on.
    """
    judged = _clicks(docs)
    both = F.array(
        F.struct(F.lit("speaking").alias("kind"), F.col("speaking").alias("c")),
        F.struct(F.lit("anti").alias("kind"), F.col("anti").alias("c")),
    )
    clicks = (
        judged.where(F.col("reason").isNull())
        .select("session_id", F.inline(both))
        .where(F.col("c").isNotNull())
        .select("session_id", "kind", "c.file_index", "c.x", "c.y", "c.pts_ms")
    )
    return clicks, judged.where(F.col("reason").isNotNull()).select("session_id", "reason")


def parse_clicks(docs: DataFrame) -> DataFrame:
    """The clicks of :func:`judge_clicks`; a document that fails is an error."""
    judged = _clicks(docs)
    checked = F.when(F.col("reason").isNull(), F.col("session_id")).otherwise(
        F.raise_error(F.concat(F.col("session_id").cast("string"), F.lit(": "), F.col("reason"))).cast(docs.schema["session_id"].dataType)
    )
    both = F.array(
        F.struct(F.lit("speaking").alias("kind"), F.col("speaking").alias("c")),
        F.struct(F.lit("anti").alias("kind"), F.col("anti").alias("c")),
    )
    return (
        judged.select(checked.alias("session_id"), F.inline(both))
        .where(F.col("c").isNotNull())
        .select("session_id", "kind", "c.file_index", "c.x", "c.y", "c.pts_ms")
    )


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    return parse_registry(spark.read.text(path, wholetext=True))


def parse_registry(docs: DataFrame) -> DataFrame:
    """``(name, path, sha256)`` from registry JSON text in ``value``; hashes lower-cased.

    A blank hash is kept (to be filled); an entry without path or hash key is an error, and so is a
    registry that is no object or empty.
    """
    spec = F.from_json("value", _REGISTRY, {"mode": "FAILFAST"})
    checked = F.when(F.size(spec) > 0, spec).otherwise(
        F.raise_error(F.lit("registry must be a non-empty object"))
    )
    return (
        docs.select(checked.alias("m"))
        .select(F.explode("m").alias("name", "spec"))
        .select(
            "name",
            _required(F.col("spec.path"), "registry entry").alias("path"),
            F.lower(_required(F.col("spec.sha256"), "registry entry")).alias("sha256"),
        )
    )
