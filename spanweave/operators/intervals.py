"""Interval-set algebra on half-open ``[start_ms, end_ms)`` rows keyed by any columns.

Everything but :func:`overlap_join` rests on one plan: turn intervals into +1/-1 edges, combine
equal edges before and during the shuffle, take running depths with
:func:`~spanweave.operators.scan.running_totals`, and read the answer off the elementary segments
between consecutive edges. No interval is ever compared with another one, so cost is linear in the
input and independent of how intervals overlap or how rows spread over keys.

Touching intervals merge, but do not intersect. Keys must be non-null.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanweave.operators.scan import CHUNK, CHUNK_BITS, LAST, NEXT, running_totals, total_col

START, END = "start_ms", "end_ms"
AT, UNTIL = "at_ms", "until_ms"


def valid_intervals(df: DataFrame) -> DataFrame:
    """Keep intervals of positive length."""
    return df.where(F.col(END) > F.col(START))


def depth(name: str) -> Column:
    """Depth of a set on the elementary segment."""
    return F.col(name + "_depth")


def depth_before(name: str) -> Column:
    """Depth of a set just before the elementary segment."""
    return F.col(name + "_before")


def _position(name: str) -> Column:
    """A non-null axis position (nulls are filtered before).

    A nullable one would make the optimizer add null filters to one side of a self-join only, and
    the two sides would no longer share their shuffle.
    """
    return F.coalesce(F.col(name).cast("bigint"), F.lit(0).cast("bigint"))


@dataclass(frozen=True)
class Edges:
    """A set given by its edges: keys, ``at_ms`` and ``d`` (+1 where one opens, -1 where one closes).

    What one sweep finds can enter the next one this way, without being paired into intervals.
    """

    rows: DataFrame


def edges_of(df: DataFrame, keys: Sequence[str]) -> Edges:
    """Edges of raw intervals."""
    one = F.lit(1).cast("bigint")
    edge = F.explode(
        F.array(
            F.struct(_position(START).alias(AT), one.alias("d")),
            F.struct(_position(END).alias(AT), (-one).alias("d")),
        )
    )
    return Edges(valid_intervals(df).select(*keys, edge.alias("e")).select(*keys, "e.at_ms", "e.d"))


def changes(segments: DataFrame, keys: Sequence[str], state: Column, state_before: Column) -> Edges:
    """Edges of the maximal intervals over which ``state`` holds."""
    return Edges(
        segments.where(state != state_before).select(
            *keys, AT, F.when(state, 1).otherwise(-1).cast("bigint").alias("d")
        )
    )


def merged_edges(df: DataFrame, keys: Sequence[str], bits: int = CHUNK_BITS) -> Edges:
    """Edges of the merged intervals."""
    return changes(sweep({"a": df}, keys, bits=bits), keys, depth("a") > 0, depth_before("a") > 0)


def sweep(
    sets: Mapping[str, DataFrame | Edges],
    keys: Sequence[str],
    points: DataFrame | None = None,
    bits: int = CHUNK_BITS,
) -> DataFrame:
    """Elementary segments ``[at_ms, until_ms)`` with the depth of every named set.

    The last segment of a key has a null ``until_ms`` and depth 0. ``points`` (keys + ``at_ms``)
    forces extra cuts.
    """
    keys, names = list(keys), list(sets)
    zero = F.lit(0).cast("bigint")
    marks: DataFrame | None = None
    for name, given in sets.items():
        rows = (given if isinstance(given, Edges) else edges_of(given, keys)).rows
        part = rows.select(
            *keys, AT, *[(F.col("d") if n == name else zero).alias(n) for n in names]
        )
        marks = part if marks is None else marks.unionByName(part)
    is_point = F.lit(False)
    if points is not None:
        part = points.select(*keys, _position(AT).alias(AT), *[zero.alias(n) for n in names])
        marks = marks.withColumn("_p", F.lit(0)).unionByName(part.withColumn("_p", F.lit(1)))
        is_point = F.col("_p") == 1
    grouped = marks.groupBy(*keys, AT).agg(
        *[F.sum(n).alias(n) for n in names],
        *([F.max("_p").alias("_p")] if points is not None else []),
    )
    # Where ends meet starts nothing changes.
    moves = is_point
    for n in names:
        moves = moves | (F.col(n) != 0)
    scanned = running_totals(grouped.where(moves).drop("_p"), keys, AT, names, bits)
    return scanned.select(
        *keys,
        AT,
        F.col(NEXT).alias(UNTIL),
        CHUNK,
        LAST,
        *[F.col(total_col(n)).alias(n + "_depth") for n in names],
        *[(F.col(total_col(n)) - F.col(n)).alias(n + "_before") for n in names],
    )


_COMBINE = {"sum": F.sum, "max": F.max, "min": F.min}


def runs(
    segments: DataFrame,
    keys: Sequence[str],
    state: Column,
    state_before: Column,
    measures: Mapping[str, tuple[Column, str]] | None = None,
) -> DataFrame:
    """Maximal intervals over which ``state`` holds, with measures combined over each.

    ``measures`` maps an output name to ``(column, 'sum' | 'max' | 'min')``. Runs are formed inside
    chunks; only the at most two pieces per chunk that reach over its border are combined per key.
    """
    keys, measures = list(keys), dict(measures or {})
    active = segments.where(state).select(
        *keys,
        CHUNK,
        AT,
        UNTIL,
        LAST,
        F.when(state_before, 0).otherwise(1).alias("_starts"),
        *[c.alias(n) for n, (c, _) in measures.items()],
    )
    by_chunk = (
        Window.partitionBy(*keys, CHUNK)
        .orderBy(AT)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    combined = [_COMBINE[how](n).alias(n) for n, (_, how) in measures.items()]
    pieces = (
        active.withColumn("_run", F.sum("_starts").over(by_chunk))
        .groupBy(*keys, CHUNK, "_run")
        .agg(
            F.min(AT).alias(START),
            F.max(UNTIL).alias(END),
            F.max(LAST).alias("_tail"),
            *combined,
        )
        .withColumn("_head", F.col("_run") == 0)
    )
    out = [*keys, START, END, *measures]
    inside = pieces.where(~F.col("_head") & ~F.col("_tail")).select(*out)
    by_key = (
        Window.partitionBy(*keys)
        .orderBy(START)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    across = (
        pieces.where(F.col("_head") | F.col("_tail"))
        .withColumn("_run", F.sum(F.when(F.col("_head"), 0).otherwise(1)).over(by_key))
        .groupBy(*keys, "_run")
        .agg(F.min(START).alias(START), F.max(END).alias(END), *combined)
        .select(*out)
    )
    return inside.unionByName(across)


def merge_intervals(df: DataFrame, keys: Sequence[str], bits: int = CHUNK_BITS) -> DataFrame:
    """Drop empty intervals and coalesce overlapping and touching ones."""
    segments = sweep({"a": df}, keys, bits=bits)
    return runs(segments, keys, depth("a") > 0, depth_before("a") > 0)


def depth_at_least(
    df: DataFrame | Edges, keys: Sequence[str], minimum: int, bits: int = CHUNK_BITS
) -> DataFrame:
    """Maximal regions covered by ``minimum`` or more of the given intervals."""
    segments = sweep({"a": df}, keys, bits=bits)
    return runs(segments, keys, depth("a") >= minimum, depth_before("a") >= minimum)


def total_ms(df: DataFrame, keys: Sequence[str], bits: int = CHUNK_BITS) -> DataFrame:
    """Length of the union of each key's intervals."""
    return (
        sweep({"a": df}, keys, bits=bits)
        .where(depth("a") > 0)
        .groupBy(*keys)
        .agg(F.sum(F.col(UNTIL) - F.col(AT)).alias("total_ms"))
    )


def overlaps(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """True iff two single intervals share positive length."""
    return (a_start < b_end) & (b_start < a_end)


def intersect(a: DataFrame, b: DataFrame, keys: Sequence[str], bits: int = CHUNK_BITS) -> DataFrame:
    segments = sweep({"a": a, "b": b}, keys, bits=bits)
    return runs(
        segments,
        keys,
        (depth("a") > 0) & (depth("b") > 0),
        (depth_before("a") > 0) & (depth_before("b") > 0),
    )


def subtract(a: DataFrame, b: DataFrame, keys: Sequence[str], bits: int = CHUNK_BITS) -> DataFrame:
    """Parts of ``a`` not covered by ``b``."""
    segments = sweep({"a": a, "b": b}, keys, bits=bits)
    return runs(
        segments,
        keys,
        (depth("a") > 0) & (depth("b") == 0),
        (depth_before("a") > 0) & (depth_before("b") == 0),
    )


def union(a: DataFrame, b: DataFrame, keys: Sequence[str], bits: int = CHUNK_BITS) -> DataFrame:
    cols = [*keys, START, END]
    return merge_intervals(a.select(*cols).unionByName(b.select(*cols)), keys, bits)


def partition_contaminated(
    target: DataFrame | Edges,
    overlap: DataFrame | Edges,
    keys: Sequence[str],
    bits: int = CHUNK_BITS,
    min_depth: int = 1,
) -> DataFrame:
    """Merged target intervals, each flagged ``contaminated`` as a whole if any overlap touches it.

    An overlap is where at least ``min_depth`` of the second set's intervals lie.
    """
    segments = sweep({"t": target, "o": overlap}, keys, bits=bits)
    return runs(
        segments,
        keys,
        depth("t") > 0,
        depth_before("t") > 0,
        {"contaminated": (depth("o") >= min_depth, "max")},
    )


def covered_before(
    cover: DataFrame | Edges, points: DataFrame, keys: Sequence[str], bits: int = CHUNK_BITS
) -> DataFrame:
    """``(keys, at_ms, covered_ms)``: length of the union of ``cover`` before each point."""
    keys = list(keys)
    segments = sweep({"c": cover}, keys, points=points, bits=bits)
    lengths = segments.select(
        *keys,
        AT,
        CHUNK,
        F.when(depth("c") > 0, F.col(UNTIL) - F.col(AT)).otherwise(0).alias("len"),
    )
    return running_totals(lengths, keys, AT, ["len"], bits).select(
        *keys, AT, (F.col(total_col("len")) - F.col("len")).alias("covered_ms")
    )


def coverage(
    targets: DataFrame, cover: DataFrame, keys: Sequence[str], bits: int = CHUNK_BITS
) -> DataFrame:
    """Every target row with ``covered_ms``, the length of it that ``cover`` covers.

    A difference of two prefix lengths per row, so no target is paired with any cover interval.
    """
    keys = list(keys)
    ends = F.explode(F.array(F.col(START).cast("bigint"), F.col(END).cast("bigint")))
    points = targets.select(*keys, ends.alias(AT))
    prefix = covered_before(cover, points, keys, bits)
    at_start = prefix.select(*keys, F.col(AT).alias(START), F.col("covered_ms").alias("_c0"))
    at_end = prefix.select(*keys, F.col(AT).alias(END), F.col("covered_ms").alias("_c1"))
    return (
        targets.join(at_start, [*keys, START])
        .join(at_end, [*keys, END])
        .select(
            *targets.columns,
            F.greatest(F.lit(0).cast("bigint"), F.col("_c1") - F.col("_c0")).alias("covered_ms"),
        )
    )


# Grids for overlap_join: cell widths 2**4 ms to 2**40 ms (35 years), 16-fold apart.
LEVEL_BITS = tuple(range(4, 41, 4))


def _own_level(levels: Sequence[int]) -> Column:
    """The finest grid whose cells are at least as long as the interval."""
    length = F.col(END) - F.col(START)
    own = F.lit(levels[-1])
    for bits in reversed(levels[:-1]):
        own = F.when(length <= F.lit(1 << bits), F.lit(bits)).otherwise(own)
    return own


def _levels_in_use(df: DataFrame, levels: Sequence[int]) -> Column:
    """Grids on which intervals sit, at most ``len(levels)`` numbers: a subquery of the plan, not an action."""
    used = valid_intervals(df).select(_own_level(levels).alias("_own"))
    return used.agg(F.collect_set("_own").alias("_used")).scalar()


def _cells(
    df: DataFrame, levels: Sequence[int], visits: Column, probe_role: int
) -> DataFrame:
    """One row per grid cell an interval is registered in.

    An interval sits on its own grid and visits the grids of longer intervals of the other side; it
    lies in at most two cells of each. Role 0: the right side sits, the left visits, equal grids
    included. Role 1: the reverse, equal grids excluded, so that every pair meets on one grid.
    """
    own = F.col("_own")
    reach = (lambda b: b >= own) if probe_role == 0 else (lambda b: b > own)
    placed = F.concat(
        F.transform(
            F.filter("_visits", reach),
            lambda b: F.struct(F.lit(probe_role).alias("role"), b.alias("bits")),
        ),
        F.array(F.struct(F.lit(1 - probe_role).alias("role"), own.alias("bits"))),
    )
    spread = df.withColumns({"_own": _own_level(levels), "_visits": visits}).select("*", F.explode(placed).alias("_g"))
    cell = lambda c: F.call_function("shiftright", c.cast("bigint"), F.col("_g.bits"))
    # Only an interval longer than the coarsest cell lies in more than two.
    return spread.select(
        *df.columns,
        F.col("_g.role").alias("_role"),
        F.col("_g.bits").alias("_bits"),
        F.explode(F.sequence(cell(F.col(START)), cell(F.col(END) - 1))).alias("_cell"),
    )


def overlap_join(
    a: DataFrame,
    b: DataFrame,
    keys: Sequence[str],
    levels: Sequence[int] = LEVEL_BITS,
    measure_levels: bool = True,
) -> DataFrame:
    """All pairs of overlapping intervals, with the other columns of both sides.

    Columns of ``a`` and ``b`` other than the keys come out prefixed ``a_`` and ``b_``. An
    equi-join on (key, grid, cell): each pair meets on the grid of its longer member, so copies per
    row are bounded by the number of grids and not by interval length, and only neighbours of
    comparable scale are tested. AQE splits a cell that is still too full.

    With ``measure_levels`` the plan has one more aggregate over each side, which learns the grids in use (a
    handful of integers), and no row then visits a grid on which nobody sits. Nothing runs when this is called.
    """
    keys, levels = list(keys), list(levels)
    every = F.array(*[F.lit(b) for b in levels]).cast("array<int>")
    a_levels, b_levels = (_levels_in_use(a, levels), _levels_in_use(b, levels)) if measure_levels else (every, every)

    def side(df: DataFrame, prefix: str, visits: Column, role: int) -> DataFrame:
        rest = [c for c in df.columns if c not in keys]
        cells = _cells(valid_intervals(df), levels, visits, role)
        return cells.select(
            *keys, "_role", "_bits", "_cell", *[F.col(c).alias(prefix + c) for c in rest]
        )

    left, right = side(a, "a_", b_levels, 0), side(b, "b_", a_levels, 1)
    first_common = F.call_function(
        "shiftright", F.greatest("a_" + START, "b_" + START).cast("bigint"), F.col("_bits")
    )
    return (
        left.join(right, [*keys, "_role", "_bits", "_cell"])
        .where(
            overlaps(
                F.col("a_" + START), F.col("a_" + END), F.col("b_" + START), F.col("b_" + END)
            )
            & (F.col("_cell") == first_common)
        )
        .drop("_role", "_bits", "_cell")
    )
