"""Axis-aligned box predicates on integer pixel columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def point_in_box(x: Column, y: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Inclusive on all four sides."""
    return x.between(x1, x2) & y.between(y1, y2)


def box_area(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    zero = F.lit(0).cast("bigint")
    return F.greatest(zero, (x2 - x1).cast("bigint")) * F.greatest(zero, (y2 - y1).cast("bigint"))


def box_iou(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Intersection over union of two ``(x1, y1, x2, y2)`` column tuples; 0 when disjoint."""
    inter = box_area(
        F.greatest(a[0], b[0]), F.greatest(a[1], b[1]), F.least(a[2], b[2]), F.least(a[3], b[3])
    )
    union = box_area(*a) + box_area(*b) - inter
    return F.when((inter > 0) & (union > 0), inter.cast("double") / union.cast("double")).otherwise(
        F.lit(0.0)
    )
