"""Alert on assignments that start without a declaration in the hours before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW_HOURS = 8


def _slot(time: Column, hours: int) -> Column:
    return F.floor(F.unix_timestamp(time) / (hours * 3600)).cast("long")


def missing_declarations(
    starts: DataFrame, declarations: DataFrame, key: str, hours: int = WINDOW_HOURS
) -> DataFrame:
    """Starts without a declaration of the same key in the ``hours`` before (stream or batch).

    starts: key, started_at, …; declarations: key, declared_at; streams carry their watermark, and rows later
    than it are lost.  For a result that doesn't depend on the order of files, ingest both streams and call this
    on the tables.
    Besides the key the join is on the time slot of the start (a declaration serves its own slot and
    the next one), so one busy key spreads over slots and only nearby events meet.
    """
    left = starts.withColumn("slot", _slot(F.col("started_at"), hours))
    own = _slot(F.col("declared_at"), hours)
    right = declarations.select(
        F.col(key).alias("declared_key"),
        "declared_at",
        F.explode(F.array(own, own + 1)).alias("declared_slot"),
    )
    near = (
        (F.col(key) == F.col("declared_key"))
        & (F.col("slot") == F.col("declared_slot"))
        & (F.col("declared_at") <= F.col("started_at"))
        & (F.col("declared_at") >= F.col("started_at") - F.expr(f"INTERVAL {hours} HOURS"))
    )
    if not starts.isStreaming:
        return left.join(right.distinct(), near, "left_anti").select(*starts.columns)
    joined = left.join(right, near, "left_outer")
    return joined.filter(F.col("declared_at").isNull()).select(*starts.columns)
