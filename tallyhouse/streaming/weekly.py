"""Weekly hours per branch as a stream.

`run_weekly_hours` stores the sums of every micro-batch, folds them by level, and `weekly_totals` adds them up: exact whatever
the order of files and the size of batches.  `weekly_hours` is the live view of weeks that are over, which drops rows later than
the watermark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tallyhouse.streaming import spans


def weekly_hours(
    stream: DataFrame, keys: Sequence[str], event_time: str, hours: str, delay: str = "1 day"
) -> DataFrame:
    """(keys, week): hours and sheets; a week is final once the watermark passed its end.

    Windows start on Monday: the epoch is a Thursday, so they are shifted by four days.
    Rows later than the watermark are dropped.
    """
    week = F.window(event_time, "7 days", startTime="4 days")
    return (
        stream.withWatermark(event_time, delay)
        .groupBy(week, *keys)
        .agg(F.sum(hours).cast("decimal(18,2)").alias("hours"), F.count(F.lit(1)).alias("sheets"))
        .select(*keys, F.to_date("window.start").alias("week"), "hours", "sheets")
    )


def weekly_sums(rows: DataFrame, keys: Sequence[str], event_time: str, hours: str) -> DataFrame:
    """(keys, week): hours and sheets of these rows."""
    week = F.to_date(F.date_trunc("week", event_time)).alias("week")
    return rows.groupBy(*keys, week).agg(F.sum(hours).cast("decimal(18,2)").alias("hours"), F.count("*").alias("sheets"))


def run_weekly_hours(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], event_time: str, hours: str, fan: int = 8
) -> StreamingQuery:
    """Store the sums of each micro-batch as a partition of its own; sums of earlier batches are folded by level."""
    schema = weekly_sums(stream, keys, event_time, hours).schema

    def store(batch: DataFrame, number: int) -> None:
        store_sums(weekly_sums(batch, keys, event_time, hours), path, number, schema, keys, fan)

    query = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(store)
    return query.trigger(availableNow=True).start()


def store_sums(sums: DataFrame, path: str, number: int, schema: StructType, keys: Sequence[str], fan: int = 8) -> None:
    """The sums of one micro-batch; a replayed batch replaces its own, which are never folded before the next batch."""
    spans.write_batch(sums, path, number)
    if number and number % fan == 0:
        spans.fold_batches(sums.sparkSession, path, schema, number, lambda rows: weekly_totals(rows, keys), fan)


def stored_sums(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All sums stored so far."""
    return spans.read_batches(spark, path, schema)


def weekly_totals(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Totals over all micro-batches stored so far."""
    return sums.groupBy(*keys, "week").agg(
        F.sum("hours").cast("decimal(18,2)").alias("hours"), F.sum("sheets").cast("long").alias("sheets")
    )
