import json
import math

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from spanweave import functions as fn
from spanweave.functions.canonical import canonical_text, json_number, wrap_record


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_time_conversions(spark):
    lit = F.lit
    row = spark.range(1).select(
        *[fn.ticks_to_ms(lit(p), lit(n), lit(d)) for p, n, d in
          [(90000, 1, 90000), (0, 1, 1000), (1, 1, 1000), (-1, 1, 2000), (2**62, 3, 90000)]],
        *[fn.samples_to_ms(lit(n), lit(16000)) for n in (16000, 8000)],
        *[fn.ms_to_samples(lit(n), lit(16000)) for n in (1000, 500)],
        *[fn.seconds_to_ms(lit(s)) for s in (1.2345, 0.0, 12.0)],
        *[fn.fmt_ms(lit(ms)) for ms in (61234, -5, 6000000)],
        fn.pct(lit(1), lit(4)), fn.pct(lit(1), lit(0)),
    ).first()
    big = (2**62 * 3 * 1000 + 45000) // 90000
    assert list(row) == [
        1000, 0, 1, (-1000 + 1000) // 2000, big, 1000, 500, 16000, 8000, 1234, 0, 12000,
        "01:01.234", "-00:00.005", "100:00.000", 25.0, 0.0,
    ]
    with pytest.raises(Exception, match="must be positive"):
        value(spark, fn.samples_to_ms(lit(1), lit(0)))


def test_geometry(spark):
    box = lambda *b: tuple(F.lit(x) for x in b)
    assert value(spark, fn.point_in_box(F.lit(300), F.lit(100), *box(100, 100, 300, 300)))
    assert value(spark, fn.box_area(*box(5, 5, 1, 9))) == 0
    assert value(spark, fn.box_iou(box(0, 0, 10, 10), box(5, 0, 15, 10))) == pytest.approx(1 / 3)
    assert value(spark, fn.box_iou(box(0, 0, 1, 1), box(5, 5, 6, 6))) == 0.0


def test_vectors(spark):
    vec = lambda *x: F.array(*[F.lit(float(v)) for v in x])
    assert value(spark, fn.l2_normalize(vec(3, 4))) == [0.6, 0.8]
    assert value(spark, fn.l2_normalize(vec(0, 0))) == [0.0, 0.0]
    assert value(spark, fn.cosine(vec(0, 0), vec(1, 0))) == 0.0
    assert value(spark, fn.cosine(vec(1, 0), vec(1, 1))) == pytest.approx(math.sqrt(0.5))
    with pytest.raises(Exception, match="dimension"):
        value(spark, fn.cosine(vec(1, 0), vec(1, 0, 0)))
    null = F.lit(None).cast("double")
    cases = [((1.0, null), True), ((0.0, null), False), ((0.6, 0.6), False), ((0.5, 0.4), True)]
    for (ct, ca), want in cases:
        ca = ca if not isinstance(ca, float) else F.lit(ca)
        assert value(spark, fn.is_target(F.lit(ct), ca, 0.5)) is want
    frames = [(0, 10, 1), (320, 10, 1), (3200, 10, 10), (3200, 5, 5), (1600, 10, 5)]
    for valid, n, want in frames:
        assert value(spark, fn.feature_frames(F.lit(valid), F.lit(n))) == want
    feats = F.array(vec(1, 2), vec(3, 4), vec(100, 100))
    assert value(spark, fn.masked_mean(feats, F.lit(640))) == [2.0, 3.0]


def test_canonical_strings_match_python(spark):
    texts = ['a"b\\c', "\x00\x1f\x0b\x7f\n\t\r\b\f/", "é – 日本 😀", "\\u001F \\\x1f", ""]
    df = spark.createDataFrame([Row(t=t) for t in texts])
    got = [r.v for r in df.select(fn.json_string(F.col("t")).alias("v")).collect()]
    assert got == [json.dumps(t, ensure_ascii=False) for t in texts]
    numbers = [0.1, 1e-5, 1e16, 0.0, 1 / 3, 123456.789]
    df = spark.createDataFrame([Row(x=x) for x in numbers])
    assert [r.v for r in df.select(json_number("x").alias("v")).collect()] == [
        json.dumps(x) for x in numbers
    ]


def test_unwrap_record(spark):
    inner = canonical_text({"end_global_ms": 3000, "start_global_ms": 1000})
    wrapped = spark.range(1).select(
        wrap_record(F.lit(0), F.lit(5), F.lit("op"), F.lit(inner)).alias("p")
    ).first().p
    assert wrapped == canonical_text(
        {"file_index": 0, "start_ms": 5, "operation": "op", "payload": json.loads(inner)}
    )
    other = wrapped.replace('"op"', '"no"')
    extra = wrapped[:-1] + ',"z":1}'
    text = canonical_text(
        {"file_index": 0, "start_ms": 5, "operation": "op", "payload": "{not an object"}
    )
    for payload, want in [
        (wrapped, inner), (other, other), (extra, extra), (text, text), (inner, inner), ("[1]", "{}"),
    ]:
        assert value(spark, fn.unwrap_record(F.lit("op"), F.lit(payload))) == want


def test_redaction(spark):
    df = spark.createDataFrame(
        [Row(t="My.Tool and MY.TOOL in my-tool", k="my.tool"), Row(t="plain", k="my.tool")]
    )
    got = df.select(
        fn.redact(F.col("t"), F.col("k"), "$1\\x").alias("r"),
        fn.redact_count(F.col("t"), F.col("k")).alias("n"),
    ).collect()
    assert [tuple(r) for r in got] == [("$1\\x and $1\\x in my-tool", 2), ("plain", 0)]
    for schema, want in [("abc-manifest-v1", "abc"), ("abc-manifest-vx", None), ("-manifest-v1", None)]:
        assert value(spark, fn.detect_token(F.lit(schema))) == want


def test_vector_sha256_of_odd_vectors(spark):
    import hashlib
    import struct

    rows = [([1.5, -2.0],), (None,), ([],), ([0.0] * 700,), ([3.0],)]
    df = spark.createDataFrame(rows, "v array<double>").coalesce(1)
    got = [r[0] for r in df.select(fn.vector_sha256(F.col("v"))).collect()]
    want = [None if v is None else hashlib.sha256(struct.pack(f"<{len(v)}d", *v)).hexdigest() for v, in rows]
    assert got == want
    floats = df.select(fn.vector_sha256(F.col("v").cast("array<float>"))).collect()
    assert [r[0] for r in floats] == want
