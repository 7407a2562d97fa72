"""Change-data capture as a base and appended changes, merged on reading.

A micro-batch writes its own images only (`append_changes`): one narrow partition, whatever the size of the table.  A read takes
the latest image of both sides; only base rows whose key has changes meet them.  `fold_changes` folds the collected changes
into the base: it rewrites the buckets of their keys and then deletes the folded partitions.  All steps give the same rows
when they are repeated, since the latest image of a key stays the latest; a fold that broke off leaves images on both
sides, which a read merges.  Deletions stay in the base as images, so that an older change that comes late revives nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

from tallyhouse.sources.readers import read_optional_table
from tallyhouse.sources.writers import overwrite_partitions
from tallyhouse.streaming import spans
from tallyhouse.streaming.changes import BUCKET, bucketed, latest_images

BASE, CHANGES = "base", "changes"


def image_schema(changes: StructType) -> StructType:
    """Stored images: the columns of a change and whether it deletes."""
    return StructType([*changes.fields, StructField("is_deleted", BooleanType())])


def append_changes(batch: DataFrame, path: str, keys: Sequence[str], number: int, spread: int = 4) -> None:
    """Store the latest images of one micro-batch."""
    spans.write_batch(latest_images(batch, keys), f"{path}/{CHANGES}", number, spread)


def _sides(spark: SparkSession, path: str, changes: StructType) -> tuple[DataFrame, DataFrame]:
    schema = image_schema(changes)
    stored = StructType([*schema.fields, StructField(BUCKET, IntegerType())])
    base = read_optional_table(spark, f"{path}/{BASE}", stored)
    return base, spans.read_batches(spark, f"{path}/{CHANGES}", schema)


def _merged(base: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Latest images; base rows whose key has no change pass as they are."""
    changed = fresh.select(*keys).distinct()
    known = base.join(changed, list(keys), "left_semi").drop(BUCKET)
    return base.join(changed, list(keys), "left_anti").drop(BUCKET).unionByName(latest_images(known.unionByName(fresh), keys))


def current_rows(spark: SparkSession, path: str, changes: StructType, keys: Sequence[str]) -> DataFrame:
    """The table as of the last micro-batch, without deleted keys."""
    base, fresh = _sides(spark, path, changes)
    return _merged(base, fresh, keys).filter(~F.col("is_deleted")).drop("is_deleted")


def fold_changes(
    spark: SparkSession, path: str, changes: StructType, keys: Sequence[str], buckets: int = 256, spread: int = 4
) -> list[int]:
    """Fold all stored changes into the base; returns the buckets rewritten."""
    names = spans.span_names(spark, f"{path}/{CHANGES}")
    if not names:
        return []
    base, fresh = _sides(spark, path, changes)
    touched = sorted(r[0] for r in bucketed(fresh, keys, buckets).select(BUCKET).distinct().collect())  # at most `buckets`
    merged = _merged(base.filter(F.col(BUCKET).isin(touched)), fresh, keys)
    # Spark stages the new buckets while the old ones are read, and swaps them in when the job commits.
    overwrite_partitions(bucketed(merged, keys, buckets), f"{path}/{BASE}", [BUCKET], spread=spread)
    spans.drop_spans(spark, f"{path}/{CHANGES}", names)
    return touched


def cdc_merge_on_read(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], buckets: int = 256, fold_every: int = 16
) -> StreamingQuery:
    """Run a change stream into the table at ``path``, folding after every so many micro-batches."""
    schema = stream.schema

    def store(batch: DataFrame, number: int) -> None:
        append_changes(batch, path, keys, number)
        if (number + 1) % fold_every == 0:
            fold_changes(batch.sparkSession, path, schema, keys, buckets)

    query = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(store)
    return query.trigger(availableNow=True).start()
