"""1-based row numbers within a key that do not need the key to fit into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanweave.operators.lineage import materialize


def number_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, start: int = 1
) -> DataFrame:
    """Number rows ``start, start+1, ...`` within ``keys`` by ``order``.

    Rows are range-partitioned on ``keys + order``, so a key of any size spreads over many tasks.
    The placed rows are written out first: range bounds come from sampling, and the counts below
    must see the very partitions the positions were taken from. ``order`` should be unique in its key.
    """
    keys, order = list(keys), list(order)
    placed = materialize(
        df.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_pos", F.monotonically_increasing_id()),
        "numbered",
    )
    part = F.shiftright("_pos", 33)  # partition number of monotonically_increasing_id
    counts = placed.groupBy(*keys, part.alias("_part")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first")
    )
    before = (
        Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = counts.select(
        *keys,
        "_part",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    return (
        placed.withColumn("_part", part)
        .join(offsets, [*keys, "_part"])
        .select(*df.columns, (F.col("_pos") + F.col("_shift") + start).alias(name))
    )


def rank_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, start: int = 1
) -> DataFrame:
    """Add SQL's ``rank()`` within ``keys`` by ``order``: equal rows share a number, the next one skips.

    Only different keys and orders, with how often they occur, are placed and written; the other columns
    (vectors, texts) move once, in the join that gives each row its rank. ``df`` is therefore read twice and
    should be cheap to read. Nulls are keys and come first. Equal rows are counted before they are placed, so
    neither a hot key nor a hot tie is one task's work.
    """
    keys, order = list(keys), list(order)
    counted = df.groupBy(*dict.fromkeys([*keys, *order])).agg(F.count(F.lit(1)).alias("_n"))
    placed = materialize(
        counted.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id()), "ranked"
    )
    # Ranges come in the order of their partitions: what is in those before is one row for a key and range.
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy(*keys, "_part").agg(F.sum("_n").alias("_n")).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col("_part").alias("_at"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"),
    )
    inside = Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    same = F.col("_part") == F.col("_at")
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    names = list(dict.fromkeys([*keys, *order]))
    ranks = (
        placed.withColumn("_within", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .join(offsets, same)
        .select(
            *[F.col(c).alias(f"_c{i}") for i, c in enumerate(names)],
            (F.col("_within") + F.col("_shift") + start).alias("_rank"),
        )
    )
    found = F.lit(True)
    for i, c in enumerate(names):
        found &= df[c].eqNullSafe(F.col(f"_c{i}"))
    return df.join(ranks, found).select(*[df[c] for c in df.columns if c != name], F.col("_rank").alias(name))
