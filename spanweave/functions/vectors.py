"""Vector arithmetic over ``ARRAY<DOUBLE>`` by higher-order functions (JVM-side left folds)."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanweave.functions.timecode import int_div

FEATURE_STRIDE = 320  # input samples per feature frame


def _doubles(v: Column) -> Column:
    return v.cast(T.ArrayType(T.DoubleType()))


def dot(a: Column, b: Column) -> Column:
    """Inner product. Unequal lengths are an error rather than a silent truncation."""
    a, b = _doubles(a), _doubles(b)
    folded = F.aggregate(
        F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, z: acc + z
    )
    return F.when(F.size(a) == F.size(b), folded).when(
        a.isNotNull() & b.isNotNull(), F.raise_error(F.lit("vectors differ in dimension")).cast("double")
    )


def l2_norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(_doubles(v), F.lit(0.0), lambda acc, x: acc + x * x))


def _once(fields: dict[str, Column], use: Callable[[Column], Column]) -> Column:
    """``use`` of a struct whose fields are computed once.

    An expression named inside a lambda over elements would be computed again for each element.
    """
    bound = F.struct(*[c.alias(n) for n, c in fields.items()])
    return F.element_at(F.transform(F.array(bound), use), 1)


def l2_normalize(v: Column) -> Column:
    """Unit vector; a zero vector stays as it is. Linear in the dimension."""
    v = _doubles(v)
    return _once(
        {"v": v, "norm": l2_norm(v)},
        lambda s: F.when(s["norm"] != 0, F.transform(s["v"], lambda x: x / s["norm"])).otherwise(s["v"]),
    )


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 when either norm is zero, null when either vector is null."""
    na, nb = l2_norm(a), l2_norm(b)
    return F.when((na != 0) & (nb != 0), dot(a, b) / (na * nb)).when(
        a.isNotNull() & b.isNotNull(), F.lit(0.0)
    )


def is_target(target_cosine: Column, anti_cosine: Column, threshold: float) -> Column:
    """At or above the threshold, and strictly closer to the target than to the anti reference."""
    return (target_cosine >= F.lit(threshold)) & (
        anti_cosine.isNull() | (anti_cosine < target_cosine)
    )


@F.arrow_udf(T.StringType())
def vector_sha256(v: pa.Array) -> pa.Array:
    """SHA-256 of the little-endian float64 packing (the JVM has no packer).

    All vectors of a batch lie end to end in one buffer, of which each is a span.
    """
    values = pc.fill_null(v.flatten().cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    raw = memoryview(np.ascontiguousarray(values, "<f8")).cast("B")
    ends = 8 * np.cumsum(pc.fill_null(pc.list_value_length(v), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    spans = zip([0, *ends[:-1].tolist()], ends.tolist(), v.is_valid().to_pylist())
    return pa.array([hashlib.sha256(raw[a:b]).hexdigest() if valid else None for a, b, valid in spans], pa.string())


def feature_frames(valid_samples: Column, n_frames: Column) -> Column:
    """Feature frames backed by real samples, clamped to ``[1, n_frames]``."""
    frames = int_div(valid_samples.cast("bigint"), F.lit(FEATURE_STRIDE).cast("bigint"))
    return F.greatest(F.lit(1).cast("bigint"), F.least(n_frames.cast("bigint"), frames))


def masked_mean(features: Column, valid_samples: Column) -> Column:
    """Mean over the frames backed by real samples of an ``ARRAY<ARRAY<FLOAT>>``."""
    features = features.cast(T.ArrayType(T.ArrayType(T.DoubleType())))
    keep = feature_frames(valid_samples, F.size(features)).cast("int")

    def total(s: Column) -> Column:
        return F.aggregate(
            F.slice(s["rows"], F.lit(1), s["keep"]),
            F.transform(F.element_at(s["rows"], 1), lambda x: F.lit(0.0)),
            lambda acc, row: F.zip_with(acc, row, lambda p, q: p + q),
        )

    return _once(
        {"rows": features, "keep": keep},
        lambda s: _once(
            {"total": total(s), "keep": s["keep"]},
            lambda t: F.transform(t["total"], lambda x: x / t["keep"]),
        ),
    )
