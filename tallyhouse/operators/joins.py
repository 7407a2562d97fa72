"""Joins that keep the grain of their left side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.dedup import latest_by


def spine_join(spine: DataFrame, *facts: DataFrame, on: Sequence[str]) -> DataFrame:
    """Chain of left joins of per-key facts onto a spine (each fact unique on ``on``)."""
    return reduce(lambda left, right: left.join(right, list(on), "left"), facts, spine)


def join_preaggregated(
    left: DataFrame, right: DataFrame, on: Sequence[str], aggregates: Sequence[Column], how: str = "left"
) -> DataFrame:
    """Fan-out-safe join: the many side is reduced to the join key first.

    The reduction runs partly on the map side, so a hot key reaches the join as one row.
    """
    return left.join(right.groupBy(*on).agg(*aggregates), list(on), how)


def join_latest(
    left: DataFrame, right: DataFrame, on: Sequence[str], order: Sequence[Column], how: str = "left"
) -> DataFrame:
    """Join with the newest right row per key."""
    return left.join(latest_by(right.dropna(subset=list(on)), on, order), list(on), how)


def text_bridge(left: DataFrame, left_text: str, right: DataFrame, right_text: str) -> DataFrame:
    """Inner join of two sources on trimmed, lower-cased text; the right side counts once per text row."""
    key = "__bridge"
    bridged = right.withColumn(key, F.lower(F.trim(F.col(f"`{right_text}`")))).drop(right_text).distinct()
    return left.withColumn(key, F.lower(F.trim(F.col(f"`{left_text}`")))).join(bridged, key).drop(key)


def resolve_key(
    df: DataFrame, on: str, primary: DataFrame, fallback: DataFrame, value: str, keep_unresolved: bool = False
) -> DataFrame:
    """Add ``value`` and ``via`` by looking ``on`` up in the primary source, then in the fallback.

    Both sources hold (on, value); several primary rows per key give several rows.
    """
    first = primary.select(on, F.col(value).alias("__primary"))
    second = fallback.select(on, F.col(value).alias("__fallback"))
    joined = df.join(first, on, "left").join(second, on, "left")
    resolved = joined.withColumn(value, F.coalesce("__primary", "__fallback")).withColumn(
        "via",
        F.when(F.col("__primary").isNotNull(), "primary")
        .when(F.col("__fallback").isNotNull(), "fallback")
        .otherwise("none"),
    )
    resolved = resolved.drop("__primary", "__fallback")
    return resolved if keep_unresolved else resolved.filter(F.col(value).isNotNull())


def horizon_join(
    child: DataFrame, parent: DataFrame, on: Mapping[str, str], parent_date: str, since: date | Column
) -> DataFrame:
    """Child rows whose parent is dated on or after the horizon; orphans are dropped.

    ``on`` maps the child key to the parent key.
    """
    bound = since if isinstance(since, Column) else F.lit(since)
    keys = parent.filter(F.col(parent_date) >= bound).select(*[F.col(p).alias(c) for c, p in on.items()])
    return child.join(keys, list(on), "left_semi")


def periods_per_member(members: DataFrame, periods: DataFrame, period: str) -> DataFrame:
    """Every member row with every distinct period.

    The distinct periods (one per calendar step, so bounded by the time span) become one array
    in a scalar subquery that is exploded per member row: no cross join and no second shuffle.
    """
    values = periods.agg(F.array_sort(F.collect_set(period)).alias(period)).scalar()
    return members.withColumn(period, F.explode(values))


def keep_top(df: DataFrame, key: str, ranking: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Rows whose key is among the first ``n`` of a ranking (IN (… ORDER BY … LIMIT n))."""
    return df.join(ranking.orderBy(*order).limit(n).select(key), key, "left_semi")


def without(df: DataFrame, members: DataFrame, on: str) -> DataFrame:
    """Rows whose key is absent from ``members``."""
    return df.join(members.select(on), on, "left_anti")
