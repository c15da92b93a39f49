"""Session clock, window schedules, frame masks and bucketed lanes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanweave.functions.timecode import int_div
from spanweave.operators.intervals import END, START
from spanweave.operators.scan import CHUNK_BITS, running_totals, total_col
from spanweave.operators.salting import salted_join

SESSION = ("session_id",)
FILE = ("session_id", "file_index")
WINDOW = ("session_id", "file_index", "window_start_ms", "window_end_ms")
#: Columns of lanes in one number, and in one row of a lane.
WORD, LANE_BLOCK = 64, 1024


def _big(value: int) -> Column:
    return F.lit(value).cast("bigint")


def session_clock(
    clips: DataFrame,
    keys: Sequence[str] = SESSION,
    order: str = "file_index",
    bits: int = CHUNK_BITS,
) -> DataFrame:
    """``(keys, order, duration_ms, offset_ms)``: clips laid end to end in canonical order."""
    duration = F.when(F.col("duration_ms") >= 0, F.col("duration_ms").cast("bigint")).otherwise(
        F.raise_error(F.concat(F.lit("negative file duration: "), F.col("duration_ms")))
    )
    points = clips.select(
        *keys,
        F.coalesce(F.col(order).cast("bigint"), _big(0)).alias(order),
        F.coalesce(duration, _big(0)).alias("duration_ms"),
    )
    scanned = running_totals(points, keys, order, ["duration_ms"], bits)
    return scanned.select(
        *keys,
        F.col(order).cast(clips.schema[order].dataType).alias(order),
        "duration_ms",
        (F.col(total_col("duration_ms")) - F.col("duration_ms")).alias("offset_ms"),
    )


def session_totals(clips: DataFrame, keys: Sequence[str] = SESSION) -> DataFrame:
    return clips.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("duration_ms").alias("session_ms")
    )


def to_global(df: DataFrame, clock: DataFrame, keys: Sequence[str] = FILE) -> DataFrame:
    """Local intervals of each file on the session clock (``start_ms``/``end_ms`` replaced)."""
    return df.join(clock.select(*keys, "offset_ms").hint("merge"), list(keys)).select(
        *[
            (F.col(c) + F.col("offset_ms")).alias(c) if c in (START, END) else F.col(c)
            for c in df.columns
        ]
    )


def lookup_clips(df: DataFrame, clips: DataFrame, keys: Sequence[str] = FILE) -> DataFrame:
    """Attach file metadata; PCM is never dragged along."""
    extra = [c for c in clips.columns if c not in df.columns and c != "pcm"]
    return df.join(clips.select(*keys, *extra), list(keys))


def window_schedule(clips: DataFrame, window_ms: int, hop_ms: int) -> DataFrame:
    """Fixed windows over each clip; the last one is anchored to the clip's end.

    Adds ``window_start_ms``/``window_end_ms``; other columns are kept.
    """
    if window_ms <= 0 or hop_ms <= 0:
        raise ValueError("window_ms and hop_ms must be positive")
    total = F.col("duration_ms").cast("bigint")
    starts = F.concat(
        F.sequence(_big(0), total - _big(window_ms) - 1, _big(hop_ms)),
        F.array(total - _big(window_ms)),
    )
    schedule = (
        F.when(
            total > window_ms,
            F.transform(starts, lambda s: F.struct(s.alias("ws"), (s + window_ms).alias("we"))),
        )
        .when(total > 0, F.array(F.struct(_big(0).alias("ws"), total.alias("we"))))
        .otherwise(F.array().cast("array<struct<ws:bigint,we:bigint>>"))
    )
    return clips.select("*", F.explode(schedule).alias("_w")).select(
        *clips.columns,
        F.col("_w.ws").alias("window_start_ms"),
        F.col("_w.we").alias("window_end_ms"),
    )


def sample_points(df: DataFrame, step_ms: int) -> DataFrame:
    """Sample times inside each interval (``pts_ms``): a grid, or the midpoint of a short one."""
    a, b = F.col(START).cast("bigint"), F.col(END).cast("bigint")
    first = a + step_ms // 2
    mid = int_div(a + b - F.pmod(a + b, F.lit(2)), F.lit(2))
    grid = F.when(first < b, F.sequence(first, b - 1, _big(step_ms))).otherwise(F.array(mid))
    return df.select("*", F.explode(grid).alias("pts_ms"))


def frames_of(masks: DataFrame) -> DataFrame:
    """One row per mask frame."""
    rest = [c for c in masks.columns if c != "activity"]
    return masks.select(*rest, F.posexplode("activity").alias("frame", "active"))


def mask_runs(masks: DataFrame, offset: str = "window_start_ms") -> DataFrame:
    """Runs of active frames as intervals, computed inside each mask row (no shuffle).

    Frame ``f`` spans ``[offset + f*frame_ms, offset + (f+1)*frame_ms)``; runs are not clipped to
    the window's end. ``run`` numbers the runs of a mask from 0.
    """
    n = F.size("activity")
    on = lambda i: F.coalesce(F.get(F.col("activity"), i), F.lit(0)) != 0
    index = F.when(n > 0, F.sequence(F.lit(0), n)).otherwise(F.array().cast("array<int>"))
    rises = F.filter(index, lambda i: on(i) & ~((i > 0) & on(i - 1)))
    falls = F.filter(index, lambda i: ~on(i) & ((i > 0) & on(i - 1)))
    rest = [c for c in masks.columns if c != "activity"]
    frame = F.col("frame_ms").cast("bigint")
    return (
        masks.select("*", rises.alias("_rises"), falls.alias("_falls"))
        .select(*rest, F.posexplode(F.arrays_zip("_rises", "_falls")).alias("run", "_r"))
        .select(
            *rest,
            "run",
            (F.col(offset) + F.col("_r._rises") * frame).alias(START),
            (F.col(offset) + F.col("_r._falls") * frame).alias(END),
        )
    )


def active_ms(activity: Column, frame_ms: Column) -> Column:
    return F.size(F.filter(activity, lambda x: x != 0)).cast("bigint") * frame_ms.cast("bigint")


def active_speakers(masks: DataFrame, min_active_ms: int) -> DataFrame:
    """Masks with at least ``min_active_ms`` of activity, with ``active_ms``."""
    return masks.withColumn("active_ms", active_ms(F.col("activity"), F.col("frame_ms"))).where(
        F.col("active_ms") >= min_active_ms
    )


def _frames(masks: DataFrame, keys: Sequence[str], frames: str) -> DataFrame:
    """One row per window with ``_masks``, all its masks, and ``_index``, the frames of speaker 0.

    Masks meet as arrays, so that a shuffle has no row per frame; a window is as long as one model's input.
    """
    first = F.filter("_masks", lambda m: m["first"])
    n = getattr(F, f"array_{frames}")(F.transform(first, lambda m: F.coalesce(F.size(m["activity"]), F.lit(0))))
    mask = F.struct((F.col("speaker_idx") == 0).alias("first"), "activity")
    return (
        masks.groupBy(*keys, "frame_ms")
        .agg(F.collect_list(mask).alias("_masks"))
        .withColumn("_n", n)
        .where(F.col("_n") > 0)
        .select(*keys, "frame_ms", "_masks", F.sequence(F.lit(0), F.col("_n") - 1).alias("_index"))
    )


def frame_depth(masks: DataFrame, keys: Sequence[str] = WINDOW) -> DataFrame:
    """Active speakers per frame of one window; ``overlapped`` iff two or more.

    Masks are anonymous per window, so depth is never counted across windows. The frame axis is
    speaker 0's.
    """
    at = lambda m, i: F.get(m["activity"], i).cast("bigint")
    none = F.lit(None).cast("bigint")
    total = lambda i: F.aggregate(
        "_masks", none, lambda acc, m: F.coalesce(F.coalesce(acc, _big(0)) + at(m, i), acc)
    )
    return (
        _frames(masks, keys, "max")
        .select(*keys, "frame_ms", F.posexplode(F.transform("_index", total)).alias("frame", "depth"))
        .withColumn("overlapped", F.col("depth") >= 2)
    )


def window_overlaps(masks: DataFrame, keys: Sequence[str] = WINDOW) -> DataFrame:
    """Overlap intervals inside each window, on the frame axis of speaker 0."""
    on = lambda m, i: F.coalesce(F.get(m["activity"], i) > 0, F.lit(False)).cast("int")
    depth = lambda i: F.aggregate("_masks", F.lit(0), lambda acc, m: acc + on(m, i))
    crossed = F.transform("_index", lambda i: (depth(i) >= 2).cast("tinyint"))
    found = _frames(masks, keys, "min").select(*keys, "frame_ms", crossed.alias("activity"))
    return mask_runs(found).select(*keys, START, END)


def edge_trim(df: DataFrame, trim_ms: int, min_ms: int) -> DataFrame:
    """Add the inward-trimmed bounds ``trim_start_ms``/``trim_end_ms`` and ``kept``."""
    t0, t1 = F.col(START) + trim_ms, F.col(END) - trim_ms
    return df.select(
        "*", t0.alias("trim_start_ms"), t1.alias("trim_end_ms"), (t1 - t0 >= min_ms).alias("kept")
    )


def session_bounds(
    sets: Sequence[DataFrame], sessions: DataFrame | None = None, keys: Sequence[str] = SESSION
) -> DataFrame:
    """Smallest start and largest end over several sets; ``(0, 1)`` for listed empty sessions."""
    everything = None
    for df in sets:
        part = df.select(*keys, START, END)
        everything = part if everything is None else everything.unionByName(part)
    bounds = everything.groupBy(*keys).agg(F.min(START).alias("t0_ms"), F.max(END).alias("t1_ms"))
    if sessions is not None:
        bounds = sessions.select(*keys).distinct().join(bounds, list(keys), "left")
    return bounds.select(
        *keys,
        F.coalesce("t0_ms", _big(0)).alias("t0_ms"),
        F.coalesce("t1_ms", _big(1)).alias("t1_ms"),
    )


def bucket_lanes(
    intervals: DataFrame,
    bounds: DataFrame,
    width: int,
    keys: Sequence[str] = SESSION,
    lane: str = "lane",
) -> DataFrame:
    """``(keys, lane, col, active)``: each session's bounds in ``width`` columns.

    A column is active iff any interval of the lane touches its span (at least 1 ms). The columns of an
    interval are bits, which a lane's row gathers by ``or``: a shuffle has one row per lane and 1,024 columns.
    """
    keys, width = list(keys), max(1, int(width))
    w = _big(width)
    span = F.col("t1_ms") - F.col("t0_ms")
    wide = F.greatest(span, _big(1))
    ceil_div = lambda x, y: int_div(x + y - 1, y)  # noqa: E731  (x >= 0)
    a = F.greatest(_big(0), F.col(START) - F.col("t0_ms"))
    b = F.least(span, F.col(END) - F.col("t0_ms"))
    # Column c spans [span*c/w, max(span*(c+1)/w, that + 1)) in floor divisions.
    first = F.least(ceil_div((a + 1) * w, wide) - 1, ceil_div(a * w, wide))
    last = F.least(w - 1, ceil_div(b * w, wide) - 1)
    shown = (span > 0) & (F.col(END) > F.col(START)) & (b > 0) & (a < span)
    block = min(LANE_BLOCK, width)
    words = range((block + WORD - 1) // WORD)

    def bits(word: int) -> Column:
        """The interval's columns within a word of 64."""
        base = F.col("_block") * block + word * WORD
        low = F.greatest(F.col("_first") - base, _big(0)).cast("int")
        high = F.least(F.col("_last") - base, _big(min(WORD, block - word * WORD) - 1)).cast("int")
        ones = F.call_function("shiftrightunsigned", _big(-1), F.lit(WORD - 1) - (high - low))
        some = F.col("_first").isNotNull() & (low <= high) & (low < WORD)
        return F.when(some, F.call_function("shiftleft", ones, low)).otherwise(_big(0))

    placed = (
        salted_join(intervals, bounds, keys, [lane, START, END])
        .select(*keys, lane, F.when(shown, first).alias("_first"), F.when(shown, last).alias("_last"))
        .select("*", F.explode(F.sequence(_big(0), _big((width - 1) // block))).alias("_block"))
    )
    masks = placed.groupBy(*keys, lane, "_block").agg(*[F.bit_or(bits(i)).alias(f"_w{i}") for i in words])
    col = F.col("col")
    inside = col - F.col("_block") * block
    word = F.get(F.array(*[F.col(f"_w{i}") for i in words]), int_div(inside, _big(WORD)).cast("int"))
    start = F.col("_block") * block
    columns = F.sequence(start, F.least(start + block, w) - 1)
    return masks.select("*", F.explode(columns).alias("col")).select(
        *keys, lane, "col", (F.getbit(word, (inside % WORD).cast("int")) == 1).alias("active")
    )


def bucket_diff(
    lanes: DataFrame, lane_a: str, lane_b: str, keys: Sequence[str] = SESSION, lane: str = "lane"
) -> DataFrame:
    """Per column ``verdict``: ``both``, ``a``, ``b`` or ``neither``."""
    place = (F.col("col") % WORD).cast("int")
    bit = F.call_function("shiftleft", _big(1), place)
    of = lambda name: F.bit_or(F.when((F.col(lane) == name) & F.col("active"), bit).otherwise(_big(0)))
    # Columns meet as the bits of words of 64, so that a session has few rows to group.
    words = (
        lanes.where(F.col(lane).isin(lane_a, lane_b))
        .groupBy(*keys, int_div(F.col("col"), _big(WORD)).alias("_word"))
        .agg(of(lane_a).alias("_in_a"), of(lane_b).alias("_in_b"), F.bit_or(bit).alias("_in"))
    )
    has = lambda name, i: F.getbit(F.col(name), i) == 1
    places = F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda i: has("_in", i))
    return (
        words.select("*", F.explode(places).alias("_i"))
        .select(
            *keys,
            (F.col("_word") * WORD + F.col("_i")).alias("col"),
            has("_in_a", F.col("_i")).alias("_a"),
            has("_in_b", F.col("_i")).alias("_b"),
        )
        .select(
            *keys,
            "col",
            F.when(F.col("_a") & F.col("_b"), "both")
            .when(F.col("_a"), "a")
            .when(F.col("_b"), "b")
            .otherwise("neither")
            .alias("verdict"),
        )
    )
