"""Type-2 history from observations that may come in any order, with system time beside business time.

An observation says how a key was at an instant.  All observations are kept, narrow and one per key and instant; a version lasts from
the first observation of a state to the next observation of another one.  An observation that comes late and differs from the
version that covers its instant splits it: the state before, the late one, and, if the old state was seen again later, the
old one again.  Since every version follows from the observations alone, loads in any order give the same history.

`record` keeps what was believed: a version that turns out differently is closed in system time (`recorded_to`) and stays,
the corrected ones are opened.  Versions of keys that a load does not touch, and versions it confirms, are not changed.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import change_hash
from tallyhouse.operators.dedup import latest_by
from tallyhouse.operators.windows import previous_in_chain

HASH = "change_hash"


def merge_observations(known: DataFrame | None, fresh: DataFrame, key: str, at: str, order: Sequence[Column]) -> DataFrame:
    """All observations, one per key and instant: the first in ``order``, remaining columns break ties."""
    every = fresh if known is None else known.unionByName(fresh)
    ties = [F.col(c).asc_nulls_last() for c in every.columns if c not in (key, at)]
    return latest_by(every.dropna(subset=[key, at]), [key, at], [*order, *ties])


def versions(observations: DataFrame, key: str, at: str, tracked: Sequence[str]) -> DataFrame:
    """key, tracked columns, change_hash, valid_from, valid_to (NULL: still so).

    A key with a long history is spread over its months.
    """
    rows = observations.select(key, F.col(at).cast("timestamp").alias("valid_from"), *tracked, change_hash(tracked).alias(HASH))
    before = previous_in_chain(rows, [key], "valid_from", HASH, [], "__before")
    starts = before.filter(F.col("__before").isNull() | (F.col("__before") != F.col(HASH))).drop("__before")
    # The next start is the previous one in mirrored time.
    mirrored = starts.withColumn("__mirror", F.timestamp_micros(-F.unix_micros("valid_from")))
    return previous_in_chain(mirrored, [key], "__mirror", "valid_from", [], "valid_to").drop("__mirror")


def record(known: DataFrame | None, believed: DataFrame, key: str, now: datetime | Column) -> DataFrame:
    """The recorded history after a load; ``believed`` holds all versions of the keys that the load touched."""
    instant = now if isinstance(now, Column) else F.lit(now).cast("timestamp")
    never = F.lit(None).cast("timestamp")
    opened = believed.withColumns({"recorded_from": instant, "recorded_to": never})
    if known is None:
        return opened
    touched = believed.select(key).distinct()
    current = known.filter(F.col("recorded_to").isNull())
    concerned = current.join(touched, key, "left_semi")
    same = [F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in (key, "valid_from", "valid_to", HASH)]
    condition = same[0] & same[1] & same[2] & same[3]
    new, old = opened.alias("n"), concerned.alias("o")
    confirmed = old.join(new, condition, "left_semi")
    corrected = old.join(new, condition, "left_anti").withColumn("recorded_to", instant)
    added = new.join(old, condition, "left_anti")
    passed = known.filter(F.col("recorded_to").isNotNull()).unionByName(current.join(touched, key, "left_anti"))
    return passed.unionByName(confirmed).unionByName(corrected).unionByName(added)


def believed_at(history: DataFrame, instant: datetime | Column) -> DataFrame:
    """The versions as they were recorded at an instant of system time."""
    moment = instant if isinstance(instant, Column) else F.lit(instant).cast("timestamp")
    later = F.col("recorded_to").isNull() | (F.col("recorded_to") > moment)
    return history.filter((F.col("recorded_from") <= moment) & later)
