import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from spanweave.operators import agreement as ag
from spanweave.operators import timeline as tl
from spanweave.operators.numbering import number_rows, rank_rows

IV = "session_id string, start_ms bigint, end_ms bigint"


def test_session_clock(spark):
    rows = [("s", i, d) for i, d in enumerate([10000, 5000, 7000])]
    clips = spark.createDataFrame(rows, "session_id string, file_index int, duration_ms bigint")
    for bits in (0, 1, 22):
        clock = tl.session_clock(clips, bits=bits).orderBy("file_index").collect()
        assert [r.offset_ms for r in clock] == [0, 10000, 15000]
    assert tl.session_totals(clips).first().session_ms == 22000
    local = spark.createDataFrame(
        [("s", 2, 100, 200)], "session_id string, file_index int, start_ms bigint, end_ms bigint"
    )
    moved = tl.to_global(local, tl.session_clock(clips)).first()
    assert (moved.start_ms, moved.end_ms) == (15100, 15200)
    bad = clips.withColumn("duration_ms", F.lit(-1).cast("bigint"))
    with pytest.raises(Exception, match="negative file duration"):
        tl.session_clock(bad).collect()


def test_window_schedule(spark):
    cases = {
        (10000, 10000, 10000): [(0, 10000)],
        (20000, 10000, 10000): [(0, 10000), (10000, 20000)],
        (2500, 1000, 1000): [(0, 1000), (1000, 2000), (1500, 2500)],
        (800, 1000, 1000): [(0, 800)],
        (0, 1000, 1000): [],
    }
    for (total, window, hop), want in cases.items():
        df = spark.createDataFrame([Row(duration_ms=total)])
        got = tl.window_schedule(df, window, hop).orderBy("window_start_ms").collect()
        assert [(r.window_start_ms, r.window_end_ms) for r in got] == want
    with pytest.raises(ValueError):
        tl.window_schedule(spark.range(1), 10, 0)


def test_sample_points(spark):
    df = spark.createDataFrame([("a", 0, 500), ("b", 1000, 1250), ("c", 0, 100)], IV)
    got = {}
    for r in tl.sample_points(df, 250).collect():
        got.setdefault(r.session_id, []).append(r.pts_ms)
    assert {k: sorted(v) for k, v in got.items()} == {"a": [125, 375], "b": [1125], "c": [50]}


MASK = (
    "session_id string, file_index int, window_start_ms bigint, window_end_ms bigint, "
    "speaker_idx int, frame_ms int, activity array<tinyint>"
)


def test_masks(spark):
    def mask(idx, activity, start=100):
        return ("s", 0, start, start + 60, idx, 20, activity)

    one = spark.createDataFrame([mask(0, [0, 1, 1, 0, 1]), mask(1, []), mask(2, [0])], MASK)
    runs = tl.mask_runs(one).orderBy("run").collect()
    assert [(r.start_ms, r.end_ms) for r in runs] == [(120, 160), (180, 200)]

    # Two windows over the same time: a speaker seen in both is not an overlap.
    two = spark.createDataFrame(
        [mask(0, [1, 1, 0]), mask(1, [0, 1, 1, 1]), mask(0, [1, 1, 1], start=120)], MASK
    )
    depth = tl.frame_depth(two).where("window_start_ms = 100").orderBy("frame").collect()
    assert [r.overlapped for r in depth] == [False, True, False]  # axis of speaker 0
    got = tl.window_overlaps(two).collect()
    assert [(r.window_start_ms, r.start_ms, r.end_ms) for r in got] == [(100, 120, 140)]
    active = tl.active_speakers(two, 60).collect()
    assert sorted((r.window_start_ms, r.speaker_idx, r.active_ms) for r in active) == [
        (100, 1, 60), (120, 0, 60),
    ]


@pytest.mark.parametrize("width,span", [(7, 100), (10, 10), (13, 5)])
def test_bucket_lanes_against_definition(spark, width, span):
    rng = random.Random(width)
    ivs = [(a, a + rng.randrange(0, 6)) for a in (rng.randrange(0, span) for _ in range(4))]
    rows = [("s", "x", a, min(b, span)) for a, b in ivs] + [("s", "y", 0, 1), ("s", "y", span - 1, span)]
    df = spark.createDataFrame(rows, "session_id string, lane string, start_ms bigint, end_ms bigint")
    shifted = df.select("session_id", "lane", *[(F.col(c) + 50).alias(c) for c in ("start_ms", "end_ms")])
    bounds = tl.session_bounds([shifted])
    lanes = tl.bucket_lanes(shifted, bounds, width)
    t0, t1 = bounds.first().t0_ms, bounds.first().t1_ms
    assert (t0, t1) == (50, 50 + span)
    want = {}
    for c in range(width):
        c0, c1 = span * c // width, max(span * (c + 1) // width, span * c // width + 1)
        for lane in "xy":
            want[lane, c] = any(
                e > s and s < c1 and e > c0 for _, n, s, e in rows if n == lane
            )
    assert {(r["lane"], r["col"]): r.active for r in lanes.collect()} == want
    diff = {r["col"]: r.verdict for r in tl.bucket_diff(lanes, "x", "y").collect()}
    for c in range(width):
        x, y = want["x", c], want["y", c]
        assert diff[c] == ("both" if x and y else "a" if x else "b" if y else "neither")


def test_worked_comparison(spark):
    a = spark.createDataFrame([("s", x, y) for x, y in [(1000, 5000), (8000, 12000), (20000, 24000)]], IV)
    turns = spark.createDataFrame(
        [("s", "SPEAKER_00", x, y) for x, y in [(900, 5200), (7800, 12500), (19500, 25000)]]
        + [("s", "SPEAKER_01", x, y) for x, y in [(5200, 7800), (12500, 15000), (25000, 29000)]],
        "session_id string, speaker_id string, start_ms bigint, end_ms bigint",
    )
    best = ag.match_best_overlap(a, turns).first()
    assert (best.speaker_id, best.overlap_ms) == ("SPEAKER_00", 12000)
    b = turns.where("speaker_id = 'SPEAKER_00'")
    m = ag.agreement(a, b).first()
    assert (m.intersection_ms, m.union_ms, m.a_only_ms, m.b_only_ms) == (12000, 14500, 0, 2500)
    assert round(m.iou, 3) == 0.828 and m.a_covered_pct == 100.0
    assert round(m.b_covered_pct, 1) == 82.8
    verdicts = ag.segment_agreement(
        a.withColumn("duration_ms", F.col("end_ms") - F.col("start_ms")), b, ordinals=True
    ).orderBy("ordinal").collect()
    assert [(r.ordinal, r.verdict) for r in verdicts] == [(1, "AGREE"), (2, "AGREE"), (3, "AGREE")]
    inv = ag.speaker_inventory(turns, ag.match_best_overlap(a, turns)).orderBy("speaker_id").collect()
    assert [(r.speech_ms, r.n_turns, r.matched) for r in inv] == [(14500, 3, True), (9100, 3, False)]
    assert ag.iou(
        spark.createDataFrame([("s", 0, 10)], IV), spark.createDataFrame([("s", 5, 15)], IV)
    ).first().iou == pytest.approx(1 / 3)


def test_no_overlap_still_names_the_first_speaker(spark):
    a = spark.createDataFrame([("s", 0, 10)], IV)
    turns = spark.createDataFrame(
        [("s", "B", 50, 60), ("s", "A", 70, 80)],
        "session_id string, speaker_id string, start_ms bigint, end_ms bigint",
    )
    assert tuple(ag.match_best_overlap(a, turns).first()) == ("s", "A", 0)


def test_number_rows(spark):
    rng = random.Random(3)
    rows = [(rng.choice("abb"), i) for i in rng.sample(range(1000), 200)]
    df = spark.createDataFrame(rows, "k string, v int")
    want = {}
    for k, v in sorted(rows):
        want[k, v] = 1 + sum(1 for q, w in rows if q == k and w < v)
    assert {(r.k, r.v): r.n for r in number_rows(df, ["k"], ["v"], "n").collect()} == want


def test_rank_rows(spark):
    """Ties, nulls, a hot tie and a hot key; wide columns are not in what is written."""
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", "b", None]), rng.choice([None, 1, 2, 5]), rng.randrange(9), "x" * 50) for _ in range(400)]
    rows += [("b", 3, 3, "hot")] * 300
    df = spark.createDataFrame(rows, "k string, v int, w int, payload string").withColumn("n", F.lit("old"))
    got = rank_rows(df.repartition(5), ["k"], ["v", "w"], "n").collect()
    low = lambda x: (x is not None, x or 0)
    place = lambda r: (low(r[1]), low(r[2]))
    want = sorted((str(r[0]), place(r), r[3], 1 + sum(q[0] == r[0] and place(q) < place(r) for q in rows)) for r in rows)
    assert sorted((str(r.k), place(r), r.payload, r.n) for r in got) == want
    assert [r.n for r in rank_rows(df.limit(3).select("w"), [], ["w"], "n", start=0).orderBy("n").collect()][0] == 0
    assert rank_rows(df.limit(0), ["k"], ["v"], "n").count() == 0


def _frames_leave_last(df):
    """Whether rows are multiplied only above every aggregate of the plan."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.index("Generate") < plan.index("Aggregate") and "Window" not in plan


def test_frames_and_columns_are_not_grouped_row_by_row(spark):
    schema = "session_id string, file_index int, window_start_ms bigint, window_end_ms bigint, speaker_idx int, frame_ms int, activity array<tinyint>"
    masks = spark.createDataFrame(
        [("s", 0, 0, 50, 0, 10, [1, None, 0, 1, 1]), ("s", 0, 0, 50, 1, 10, [1, None, 1, 1]), ("s", 0, 0, 50, 2, 10, [0, None, 1, 0, 1, 1, 1]),
         ("s", 0, 50, 90, 1, 10, [1, 1]), ("s", 0, 90, 99, 0, 10, []), ("s", 0, 90, 99, 1, 10, [1])],
        schema,
    )
    depth = tl.frame_depth(masks)
    assert _frames_leave_last(depth) and _frames_leave_last(tl.window_overlaps(masks))
    got = [(r.frame, r.depth, r.overlapped) for r in depth.orderBy("frame").collect()]
    assert got == [(0, 2, True), (1, None, None), (2, 2, True), (3, 2, True), (4, 2, True)]
    assert sorted((r.start_ms, r.end_ms) for r in tl.window_overlaps(masks).collect()) == [(0, 10), (20, 50)]
    lanes = tl.bucket_lanes(
        spark.createDataFrame([("s", "x", 0, 5), ("s", "x", 3000, 3000), ("s", "x", None, 7), ("s", "y", 2499, 2501), ("s", "z", 9, 8)], "session_id string, lane string, start_ms bigint, end_ms bigint"),
        spark.createDataFrame([("s", 0, 3000)], "session_id string, t0_ms bigint, t1_ms bigint"), 3000,
    )
    assert _frames_leave_last(lanes)
    found = lanes.collect()
    assert len(found) == 9000
    assert sorted((r.lane, r.col) for r in found if r.active) == [*(("x", c) for c in range(5)), ("y", 2499), ("y", 2500)]
    verdicts = {r.col: r.verdict for r in tl.bucket_diff(lanes, "x", "y").collect()}
    assert len(verdicts) == 3000 and (verdicts[4], verdicts[5], verdicts[2500]) == ("a", "neither", "b")
