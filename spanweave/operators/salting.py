"""Joins on a key that may hold a large share of one side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Into how many parts a key is split.
SALTS = 16


def salted_join(
    many: DataFrame, one: DataFrame, keys: Sequence[str], spread: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join ``many`` to ``one``, which has at most one row per key, without a key's rows in one task.

    Rows of ``many`` are dealt by a hash of their ``spread`` columns; ``one`` is copied once per salt.
    An aggregate by the key after a plain join would reuse the join's partitioning, and then nothing
    splits a large key; the salt is in the way of that. The copies are never broadcast: their size is estimated
    from the files below, which know neither the copies nor how far a row grows when it is read.
    """
    keys = list(keys)
    salt = F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int")
    copies = one.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return many.withColumn("_salt", salt).join(copies.hint("merge"), [*keys, "_salt"], how).drop("_salt")
