"""Historised dimensions: SCD type 2, point-in-time views, enrichment, golden records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import change_hash, key_hash
from tallyhouse.operators.dedup import current_versions

VERSION_COLUMNS = ("change_hash", "is_current", "valid_from", "valid_to")


def _instant(now: datetime | Column) -> Column:
    return now if isinstance(now, Column) else F.lit(now).cast("timestamp")


def scd2_first_load(staging: DataFrame, key: str, tracked: Sequence[str], now: datetime | Column, sk: str) -> DataFrame:
    """Every staging row becomes the current version of its key."""
    instant = _instant(now)
    return staging.select(
        key_hash(key, instant).alias(sk),
        change_hash(tracked).alias("change_hash"),
        *staging.columns,
        F.lit(True).alias("is_current"),
        instant.alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
    )


def scd2_merge(
    staging: DataFrame, existing: DataFrame, key: str, tracked: Sequence[str], now: datetime | Column, sk: str
) -> DataFrame:
    """New snapshot of a type-2 dimension, from one join of the current versions with the staging rows.

    ``staging`` holds one row per key, ``existing`` the whole dimension.  Unchanged keys and keys
    missing from staging keep their version; a changed key closes its version at ``now`` and opens
    a new one; closed history passes through without a shuffle.  ``change`` tells what happened
    (new, changed, closed, unchanged, historical).
    """
    instant = _instant(now)
    opened = scd2_first_load(staging, key, tracked, now, sk)
    columns = opened.columns
    old, new = F.col("__old"), F.col("__new")
    before = existing.filter(F.col("is_current")).select(F.col(key).alias("__key"), F.struct(*columns).alias("__old"))
    after = opened.select(F.col(key).alias("__key"), F.struct(*columns).alias("__new"))

    known, offered = old.isNotNull(), new.isNotNull()
    changed = known & offered & (old["change_hash"] != new["change_hash"])
    updated = {
        "is_current": ~changed,
        "valid_to": F.when(changed, instant).otherwise(old["valid_to"]),
        "change": F.when(changed, "closed").otherwise("unchanged"),
    }
    kept = F.struct(*[updated.get(c, old[c]).alias(c) for c in columns], updated["change"].alias("change"))
    fresh = F.struct(
        *[new[c].alias(c) for c in columns], F.when(known, "changed").otherwise("new").alias("change")
    )
    outcome = F.array(F.when(known, kept), F.when(offered & (~known | changed), fresh))
    merged = before.join(after, "__key", "full_outer").select(F.inline(F.array_compact(outcome)))
    history = existing.filter(~F.col("is_current")).select(*columns, F.lit("historical").alias("change"))
    return merged.unionByName(history)


def as_of_versions(dim: DataFrame, at: datetime | Column) -> DataFrame:
    """The versions valid at an instant."""
    instant = _instant(at)
    return dim.filter(
        (F.col("valid_from") <= instant) & (F.col("valid_to").isNull() | (F.col("valid_to") > instant))
    )


def changed_rows(old: DataFrame, new: DataFrame, key: str, fingerprint: str = "change_hash") -> DataFrame:
    """Keys added, removed or changed between two states, by fingerprint."""
    before = old.select(key, F.col(fingerprint).alias("old_hash"))
    after = new.select(key, F.col(fingerprint).alias("new_hash"))
    return (
        before.join(after, key, "full_outer")
        .withColumn(
            "change",
            F.when(F.col("old_hash").isNull(), "added")
            .when(F.col("new_hash").isNull(), "removed")
            .when(F.col("old_hash") != F.col("new_hash"), "changed"),
        )
        .filter(F.col("change").isNotNull())
    )


def enrich_current(
    dim: DataFrame, updates: DataFrame, key: str, columns: Sequence[str], score: str, min_score: float
) -> DataFrame:
    """Fill columns of the current versions from scored updates (one per key).

    Updates under the minimum score are ignored; old values stay where there is no update.
    """
    accepted = updates.filter(F.col(score) >= min_score).select(
        F.col(key).alias("__key"), *[F.col(c).alias(f"__{c}") for c in columns]
    )
    joined = dim.join(accepted, (F.col(key) == F.col("__key")) & F.col("is_current"), "left")
    kept = [c for c in dim.columns if c not in columns]
    filled = [
        F.coalesce(F.col(f"__{c}"), F.col(c) if c in dim.columns else F.lit(None)).alias(c) for c in columns
    ]
    return joined.select(*kept, *filled)


def golden_record(
    sources: Mapping[str, DataFrame], priority: Sequence[str], key: str, attributes: Sequence[str]
) -> DataFrame:
    """One row per key; each attribute takes the non-NULL value of the best-ranked source.

    ``priority`` lists the source names, best first.  ``<attribute>_source`` names the winner.
    Several rows of one source per key fall back to the smallest value.
    """
    ranked = reduce(
        DataFrame.unionByName,
        [
            sources[name].select(
                key, *attributes, F.lit(rank).alias("__rank"), F.lit(name).alias("__source")
            )
            for rank, name in enumerate(priority, start=1)
            if name in sources
        ],
    )
    winners = []
    for a in attributes:
        best = F.when(F.col(a).isNotNull(), F.struct("__rank", a))
        winners += [F.min_by(a, best).alias(a), F.min_by("__source", best).alias(f"{a}_source")]
    return ranked.groupBy(key).agg(*winners)


__all__ = [
    "VERSION_COLUMNS", "as_of_versions", "changed_rows", "current_versions", "enrich_current",
    "golden_record", "scd2_first_load", "scd2_merge",
]
