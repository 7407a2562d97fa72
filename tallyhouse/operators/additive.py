"""Additive states: sums by key that a load updates by signed changes, without a look at unchanged rows.

A state is any aggregate whose columns add up: sums, counts, and counted values (key, value → count), from which medians,
modes and distinct counts are exact.  What a load changed is the state of its keys' rows after the load minus that before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def summed(rows: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """One row per key; every sum keeps its type."""
    types = {field.name: field.dataType for field in rows.schema.fields}
    return rows.groupBy(*keys).agg(*[F.sum(c).cast(types[c]).alias(c) for c in sums])


def nothing_left(sums: Sequence[str]) -> Column:
    """All sums are zero: the key has no rows any more."""
    found = F.lit(True)
    for c in sums:
        found = found & (F.coalesce(F.col(c), F.lit(0)) == 0)
    return found


def signed_change(before: DataFrame, after: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """What must be added to a state; keys whose sums do not change are left out."""
    minus = before.withColumns({c: (-F.col(c)).cast(before.schema[c].dataType) for c in sums})
    both = after.select(*keys, *sums).unionByName(minus.select(*keys, *sums))
    return summed(both, keys, sums).filter(~nothing_left(sums))


def add_change(state: DataFrame, change: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """The state after a change, without keys that have nothing left."""
    both = state.select(*keys, *sums).unionByName(change.select(*keys, *sums))
    return summed(both, keys, sums).filter(~nothing_left(sums))
