"""Latest-wins deduplication.

A ``row_number() = 1`` filter lets Spark keep one row per key on the map side
(WindowGroupLimit) before the shuffle, so a key that holds a large part of the
table sends one row per input partition, not its whole history.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__row_number"


def newest_first(*columns: str) -> list[Column]:
    """Descending order, NULLs last."""
    return [F.col(c).desc_nulls_last() for c in columns]


def top_per_group(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows per group in the given order, with their position as ``position``."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("position", F.row_number().over(window)).filter(F.col("position") <= k)


def latest_by(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``, which must be a total order within a key."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(window)).filter(F.col(_RN) == 1).drop(_RN)


def is_newest(keys: Sequence[str | Column], order: Sequence[Column]) -> Column:
    """Whether a row is the one that `latest_by` keeps; for rows of which several keys each keep one."""
    return F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) == 1


def newest_load(df: DataFrame, keys: Sequence[str], loaded_at: str = "_loaded_at") -> list[Column]:
    """The newest load first, remaining columns break ties."""
    ties = [F.col(f"`{c}`").asc_nulls_last() for c in df.columns if c not in keys and c != loaded_at]
    return [F.col(loaded_at).desc_nulls_last(), *ties]


def latest_loaded(df: DataFrame, keys: Sequence[str], loaded_at: str = "_loaded_at") -> DataFrame:
    """One row per mandatory key: newest load, remaining columns break ties."""
    return latest_by(df.dropna(subset=list(keys)), keys, newest_load(df, keys, loaded_at))


def current_versions(df: DataFrame, key: str, valid_from: str = "valid_from") -> DataFrame:
    """The current row per key of a versioned dimension."""
    ties = [F.col(c).asc_nulls_last() for c in df.columns if c not in (key, valid_from)]
    return latest_by(df.filter(F.col("is_current")), [key], [*newest_first(valid_from), *ties])


def union_latest(frames: Sequence[DataFrame], keys: Sequence[str], loaded_at: str = "_loaded_at") -> DataFrame:
    """Union of equal shapes by name, then one row per key."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return latest_loaded(merged, keys, loaded_at)


def merge_latest(target: DataFrame, delta: DataFrame, keys: Sequence[str], loaded_at: str = "_loaded_at") -> DataFrame:
    """Upsert a delta into a table by key: the newest load of either side survives."""
    return union_latest([target, delta], keys, loaded_at)
