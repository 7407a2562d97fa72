"""Change-data capture: latest image per key, kept in a bucketed table.

A micro-batch rewrites only the buckets its keys fall into, so its cost follows the batch,
not the table.  Merging a batch twice gives the same table, so a replayed batch is harmless.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyhouse.operators.dedup import latest_by
from tallyhouse.sources.readers import is_missing
from tallyhouse.sources.scratch import settle
from tallyhouse.sources.writers import overwrite_partitions

BUCKET = "bucket"
# Change kinds (create, update, snapshot read, delete).
UPSERTS, DELETE = ("c", "u", "r"), "d"


def latest_images(changes: DataFrame, keys: Sequence[str], op: str = "op", ts: str = "ts_ms") -> DataFrame:
    """The newest image per key; a deletion is the newest image marked ``is_deleted``.

    At the same instant a deletion wins; remaining columns break ties.
    """
    known = changes.filter(F.col(op).isin(*UPSERTS, DELETE)).withColumn("is_deleted", F.col(op) == DELETE)
    ties = [F.col(c).asc_nulls_last() for c in known.columns if c not in (*keys, ts, op, "is_deleted")]
    order = [F.col(ts).desc(), F.col("is_deleted").desc(), F.col(op).asc(), *ties]
    return latest_by(known.dropna(subset=list(keys)), keys, order)


def bucketed(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def merge_changes(batch: DataFrame, path: str, keys: Sequence[str], buckets: int, spread: int = 1) -> None:
    """Merge one batch of changes into the table at ``path``."""
    spark = batch.sparkSession
    images = settle(bucketed(latest_images(batch, keys), keys, buckets))
    touched = [row[0] for row in images.select(BUCKET).distinct().collect()]  # at most ``buckets`` numbers
    if not touched:
        return
    try:
        stored = spark.read.schema(images.schema).parquet(path).filter(F.col(BUCKET).isin(touched))
        # Spark stages the new buckets while the old ones are read, and swaps them in when the job commits.
        merged = latest_images(stored.unionByName(images), keys).select(images.columns)
    except AnalysisException as error:
        if not is_missing(error):
            raise
        merged = images
    overwrite_partitions(merged, path, [BUCKET], spread=spread)


def live_rows(table: DataFrame) -> DataFrame:
    """The table without deleted keys and bookkeeping columns."""
    return table.filter(~F.col("is_deleted")).drop("is_deleted", BUCKET)


def cdc_upsert(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], buckets: int = 256, spread: int = 4
) -> StreamingQuery:
    """Run a change stream into the table at ``path``."""
    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, _: merge_changes(batch, path, keys, buckets, spread))
        .trigger(availableNow=True)
        .start()
    )


def deduplicated(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str = "5 seconds") -> DataFrame:
    """Drop repeated deliveries of a change within the event-time delay."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))
