"""Running totals that do not depend on how many rows one key holds.

``sum() over (partition by key order by t)`` puts a whole key into one task. Here the integer axis
is cut into chunks of ``2**bits`` positions and the total is taken in two steps: inside each
``(key, chunk)``, and over one summary row per chunk. Rows are unique per axis position (callers
pre-aggregate, with map-side combining), so a chunk never holds more than ``2**bits`` rows, and a
key never has more summary rows than its axis has chunks, whatever share of the table it owns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CHUNK_BITS = 22  # 2**22 ms is about 70 minutes

CHUNK = "_chunk"
NEXT = "_next"
LAST = "_last"  # last row of its chunk


def total_col(measure: str) -> str:
    return measure + "_total"


def running_totals(
    points: DataFrame,
    keys: Sequence[str],
    axis: str,
    measures: Sequence[str],
    bits: int = CHUNK_BITS,
) -> DataFrame:
    """Add, per row, the inclusive running total of each measure along ``axis`` within the key.

    Also adds the next axis position of the key (``_next``, null at its end), the chunk number and
    whether the row is the last of its chunk. ``points`` must be unique on ``keys + [axis]`` with
    non-null keys; ``axis`` is a BIGINT.
    """
    keys = list(keys)
    # A second scan of the same axis keeps the chunk column, and with it the partitioning.
    if CHUNK not in points.columns:
        # One explicit exchange feeds both the local totals and the summary below.
        points = points.withColumn(CHUNK, F.shiftright(F.col(axis), bits)).repartition(*keys, CHUNK)
    points = points.drop(NEXT, LAST)

    by_chunk = Window.partitionBy(*keys, CHUNK).orderBy(axis)
    so_far = by_chunk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = points.select(
        "*",
        *[F.sum(m).over(so_far).alias("_in_" + m) for m in measures],
        F.lead(axis).over(by_chunk).alias("_lead"),
    )

    summary = points.groupBy(*keys, CHUNK).agg(
        F.min(axis).alias("_first"), *[F.sum(m).alias("_sum_" + m) for m in measures]
    )
    by_key = Window.partitionBy(*keys).orderBy(CHUNK)
    before = by_key.rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(
        *keys,
        CHUNK,
        F.lead("_first").over(by_key).alias("_next_first"),
        *[
            F.coalesce(F.sum("_sum_" + m).over(before), F.lit(0)).alias("_carry_" + m)
            for m in measures
        ],
    )

    joined = local.join(carry, [*keys, CHUNK])
    return joined.select(
        *points.columns,
        F.coalesce("_lead", "_next_first").alias(NEXT),
        F.col("_lead").isNull().alias(LAST),
        *[(F.col("_carry_" + m) + F.col("_in_" + m)).alias(total_col(m)) for m in measures],
    )
