"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that is greatest by ``order``.

    An aggregate with map-side combining, not a window: a busy key sends one row
    per map task. ``order`` should be unique within a key.
    """
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order))
    picked = df.groupBy(*keys).agg(newest.alias("_row"))
    return picked.select(*[c if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def merge_latest(
    current: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """``current`` after the upsert of ``updates``: newest row per key over both."""
    return latest_per_key(current.unionByName(updates), keys, order)
