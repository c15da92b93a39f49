"""Checksum registries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def file_hashes(files: DataFrame) -> DataFrame:
    """``(path, sha256)`` of files given as ``(path, content BINARY)``."""
    return files.select("path", F.sha2("content", 256).alias("sha256"))


def build_registry(listed: DataFrame, actual: DataFrame, strict: bool = True) -> DataFrame:
    """Hash every listed ``(name, path)``; a missing file is an error, or a null hash if lenient."""
    found = actual.select("path", F.col("sha256"))
    joined = listed.select("name", "path").join(found, ["path"], "left")
    sha = F.col("sha256")
    if strict:
        sha = F.coalesce(
            sha,
            F.raise_error(
                F.concat(F.col("name"), F.lit(": file not found at "), F.col("path"))
            ).cast("string"),
        )
    return joined.select("name", "path", sha.alias("sha256"))


def verify_registry(
    registry: DataFrame,
    actual: DataFrame,
    required: Sequence[str] | DataFrame = (),
    strict: bool = False,
    keys: Sequence[str] = (),
) -> DataFrame:
    """``(name, path, expected, actual, status)`` for every registered or required name.

    Status: ``OK``, ``MISSING`` (no file), ``NO-HASH`` (blank expectation), ``MISMATCH`` or
    ``REQUIRED`` (a required name that is not registered). ``strict`` raises on the first problem.
    With ``keys`` there is one registry per key, and ``required`` is a table of keys and names.
    """
    keys = list(keys)
    expected = F.lower(F.coalesce("expected", F.lit("")))
    got = F.lower("actual")
    checked = (
        registry.select(*keys, "name", "path", F.col("sha256").alias("expected"))
        .join(actual.select("path", F.col("sha256").alias("actual")), ["path"], "left")
        .select(
            *keys,
            "name",
            "path",
            expected.alias("expected"),
            got.alias("actual"),
            F.when(got.isNull(), "MISSING")
            .when(expected == "", "NO-HASH")
            .when(got != expected, "MISMATCH")
            .otherwise("OK")
            .alias("status"),
        )
    )
    if not isinstance(required, DataFrame):
        if not required:
            return _enforce(checked) if strict else checked
        required = registry.sparkSession.createDataFrame([(n,) for n in required], "name string")
    absent = missing_names(required, registry, keys).select(
        *keys,
        "name",
        F.lit(None).cast("string").alias("path"),
        F.lit("").alias("expected"),
        F.lit(None).cast("string").alias("actual"),
        F.lit("REQUIRED").alias("status"),
    )
    report = checked.unionByName(absent)
    return _enforce(report) if strict else report


def missing_names(required: DataFrame, present: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Required names that are not present, by key."""
    on = [*keys, "name"]
    present = present.select(*on)
    # One registry is small; those of all keys grow with the keys.
    return required.select(*on).distinct().join(present.hint("merge") if keys else present, on, "left_anti")


def _enforce(report: DataFrame) -> DataFrame:
    ok = F.when(F.col("status") == "OK", F.col("status")).otherwise(
        F.raise_error(F.concat_ws(" ", "status", "name", "path")).cast("string")
    )
    return report.withColumn("status", ok)
