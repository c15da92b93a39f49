import random

import pytest
from pyspark.sql import functions as F

from spanweave.operators import intervals as iv
from tests.model import points, random_set, spans

SCHEMA = "k string, start_ms bigint, end_ms bigint"


def frame(spark, by_key):
    rows = [(k, a, b) for k, ivs in by_key.items() for a, b in ivs]
    return spark.createDataFrame(rows, SCHEMA)


def grouped(df):
    out = {}
    for r in sorted(df.select("k", "start_ms", "end_ms").collect()):
        out.setdefault(r.k, []).append((r.start_ms, r.end_ms))
    return out


def one(spark, ivs):
    return frame(spark, {"s": ivs})


def test_hand_values(spark):
    assert grouped(iv.merge_intervals(one(spark, [(0, 10), (10, 20), (30, 40)]), ["k"])) == {
        "s": [(0, 20), (30, 40)]
    }
    assert iv.total_ms(one(spark, [(0, 10), (5, 20)]), ["k"]).first().total_ms == 20
    a = one(spark, [(0, 10)])
    assert grouped(iv.intersect(a, one(spark, [(5, 15)]), ["k"])) == {"s": [(5, 10)]}
    assert grouped(iv.intersect(a, one(spark, [(10, 20)]), ["k"])) == {}
    assert grouped(iv.subtract(a, one(spark, [(3, 6)]), ["k"])) == {"s": [(0, 3), (6, 10)]}
    assert grouped(iv.union(one(spark, [(0, 5)]), one(spark, [(5, 10)]), ["k"])) == {
        "s": [(0, 10)]
    }


# Chunks of 2, 8 and 2**20 positions: every border case of the two-step scan is hit.
@pytest.mark.parametrize("bits", [1, 3, 20])
def test_algebra_matches_point_sets(spark, bits):
    rng = random.Random(bits)
    a = {f"k{i}": random_set(rng, rng.randrange(0, 14), 60, 25) for i in range(12)}
    b = {f"k{i}": random_set(rng, rng.randrange(0, 14), 60, 25) for i in range(12)}
    da, db = frame(spark, a).cache(), frame(spark, b).cache()

    def expect(fn):
        out = {k: spans(fn(points(a[k]), points(b[k]))) for k in a}
        return {k: v for k, v in out.items() if v}

    assert grouped(iv.merge_intervals(da, ["k"], bits)) == expect(lambda x, y: x)
    assert grouped(iv.intersect(da, db, ["k"], bits)) == expect(lambda x, y: x & y)
    assert grouped(iv.subtract(da, db, ["k"], bits)) == expect(lambda x, y: x - y)
    assert grouped(iv.union(da, db, ["k"], bits)) == expect(lambda x, y: x | y)

    got = {r.k: r.total_ms for r in iv.total_ms(da, ["k"], bits).collect()}
    assert got == {k: len(points(v)) for k, v in a.items() if points(v)}

    deep = grouped(iv.depth_at_least(da, ["k"], 2, bits))
    want = {}
    for k, ivs in a.items():
        pts = {p for p in points(ivs) if sum(s <= p < e for s, e in ivs) >= 2}
        if pts:
            want[k] = spans(pts)
    assert deep == want

    parts = iv.partition_contaminated(da, db, ["k"], bits).collect()
    want_parts = {
        (k, s, e, bool(points([(s, e)]) & points(b[k]))) for k in a for s, e in spans(points(a[k]))
    }
    assert {tuple(r) for r in parts} == want_parts and len(parts) == len(want_parts)

    cov = iv.coverage(iv.valid_intervals(da), db, ["k"], bits).collect()
    want_cov = sorted(
        (k, s, e, len(points([(s, e)]) & points(b[k]))) for k in a for s, e in a[k] if e > s
    )
    assert sorted(tuple(r) for r in cov) == want_cov


def test_long_intervals_over_many_chunks(spark):
    big = 1 << 40
    a = one(spark, [(0, big), (big, big + 5), (3 * big, 3 * big + 1)])
    b = one(spark, [(7, 9), (big - 1, big + 1)])
    assert grouped(iv.merge_intervals(a, ["k"])) == {
        "s": [(0, big + 5), (3 * big, 3 * big + 1)]
    }
    assert grouped(iv.subtract(a, b, ["k"])) == {
        "s": [(0, 7), (9, big - 1), (big + 1, big + 5), (3 * big, 3 * big + 1)]
    }


@pytest.mark.parametrize("levels", [(1, 2, 3), (12, 16)])
def test_overlap_join_is_exact(spark, levels):
    rng = random.Random(7)
    a = {k: random_set(rng, 25, 80, 30) for k in "xyz"}
    b = {k: random_set(rng, 25, 80, 9) for k in "xyw"}
    da = frame(spark, a).withColumn("tag", F.monotonically_increasing_id())
    db = frame(spark, b).withColumn("tag", F.monotonically_increasing_id())
    got = sorted(
        (r.k, r.a_start_ms, r.a_end_ms, r.b_start_ms, r.b_end_ms)
        for r in iv.overlap_join(da, db, ["k"], levels).collect()
    )
    want = sorted(
        (k, s, e, p, q)
        for k in set(a) & set(b)
        for s, e in a[k]
        for p, q in b[k]
        if e > s and q > p and s < q and p < e
    )
    assert got == want
    plain = iv.overlap_join(da, db, ["k"], levels, measure_levels=False)
    assert plain.count() == len(want)


def test_overlap_join_of_mixed_lengths_runs_nothing_when_called(spark):
    """Lengths from 1 ms to a day; empty sides have no grids and no pairs."""
    rng = random.Random(8)
    lengths = (1, 3, 20, 900, 60_000, 86_400_000)

    def some(n):
        out = set()
        while len(out) < n:
            start = rng.randrange(200_000)
            out.add((start, start + rng.choice(lengths)))
        return out

    a, b = some(150), some(150)
    da, db = frame(spark, {"x": a}), frame(spark, {"x": b})
    group = "overlap-join-call"
    spark.sparkContext.setJobGroup(group, "")
    try:
        joined = iv.overlap_join(da, db, ["k"])
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    got = sorted((r.a_start_ms, r.a_end_ms, r.b_start_ms, r.b_end_ms) for r in joined.collect())
    assert got == sorted((s, e, p, q) for s, e in a for p, q in b if s < q and p < e)
    assert iv.overlap_join(da.limit(0), db, ["k"]).count() == iv.overlap_join(da, db.limit(0), ["k"]).count() == 0


def plan_of(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def test_merge_reads_and_shuffles_its_input_once(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    df = events.select(
        F.col("user_id").alias("k"),
        (F.col("event_id") * 10).alias("start_ms"),
        (F.col("event_id") * 10 + 15).alias("end_ms"),
    )
    text = plan_of(iv.merge_intervals(df, ["k"], bits=6))
    assert "CartesianProduct" not in text and "BroadcastNestedLoop" not in text
    assert text.count("FileScan parquet") == 1
    # edges, chunks, chunk summaries, border pieces; everything else reuses these
    assert text.count("+- Exchange hashpartitioning") == 4
    assert text.count("ReusedExchange") >= 2
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in text


def test_no_chunk_exceeds_its_width_under_a_hot_key(spark):
    """Many copies of the same few intervals in one key combine before anything is windowed."""
    hot = spark.range(200_000).select(
        F.lit("hot").alias("k"), (F.col("id") % 50).alias("start_ms"), (F.col("id") % 50 + 3).alias("end_ms")
    )
    seg = iv.sweep({"a": hot}, ["k"], bits=4)
    widest = seg.groupBy("k", "_chunk").count().agg(F.max("count")).first()[0]
    assert widest <= 16
    assert grouped(iv.merge_intervals(hot, ["k"], bits=4)) == {"hot": [(0, 52)]}
    deep = seg.agg(F.max("a_depth")).first()[0]
    assert deep == 12_000
