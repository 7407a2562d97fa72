"""Writers: raw batches, table overwrite, partition overwrite, checked append."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.dedup import merge_latest
from tallyhouse.operators.joins import horizon_join
from tallyhouse.sources.readers import is_missing, raw_path
from tallyhouse.sources.scratch import settle

ROWS_PER_FILE = 100_000
COMPRESSION = "zstd"


class CopyIncomplete(RuntimeError):
    """Fewer rows arrived than the threshold allows."""


def _table_writer(df: DataFrame, mode: str, partitions: Sequence[str] = ()):
    writer = df.write.mode(mode).option("compression", COMPRESSION)
    return writer.partitionBy(*partitions) if partitions else writer


def overwrite_table(df: DataFrame, path: str, reads_target: bool = False, partitions: Sequence[str] = ()) -> None:
    """Replace a whole table; a result that reads its own target is settled in shared storage first."""
    ready = settle(df) if reads_target else df
    _table_writer(ready, "overwrite", partitions).option("partitionOverwriteMode", "static").parquet(path)


def overwrite_unless_empty(df: DataFrame, path: str) -> bool:
    """Keep the old target when the source delivered nothing."""
    if df.isEmpty():
        return False
    overwrite_table(df, path)
    return True


def overwrite_partitions(
    df: DataFrame,
    path: str,
    partitions: Sequence[str],
    rows_per_file: int | None = None,
    spread: int = 1,
    bloom: Sequence[str] = (),
    gathered: bool = False,
) -> None:
    """Replace only the partitions present in ``df``, so that a re-run gives the same table.

    Rows gather by partition value unless they come ``gathered``; ``spread`` writer tasks share one large partition.  Files get
    bloom filters on the ``bloom`` columns.
    """
    if gathered:
        ready = df
    elif spread > 1:
        salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(spread))
        ready = df.repartition(*[F.col(p) for p in partitions], salt)
    else:
        ready = df.repartition(*[F.col(p) for p in partitions])
    writer = _table_writer(ready, "overwrite", partitions).option("partitionOverwriteMode", "dynamic")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    for column in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", True)
    writer.parquet(path)


def write_by_month(df: DataFrame, path: str, date_column: str, spread: int = 1) -> None:
    """Month-partitioned table on a derived column."""
    overwrite_partitions(df.withColumn("month", F.date_format(date_column, "yyyy-MM")), path, ["month"], spread=spread)


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int) -> None:
    """A catalogue table bucketed and sorted by its join key.

    Tables written with the same keys and bucket count join and aggregate on them without a shuffle.  Rows gather by bucket
    first, so a bucket is one file and a task sorts one bucket.
    """
    writer = df.repartition(buckets, *keys).write.mode("overwrite").option("compression", COMPRESSION).format("parquet")
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)


def upsert_table(target: DataFrame, delta: DataFrame, keys: Sequence[str], path: str) -> None:
    """Merge one load into the table by key; rows absent from the load stay."""
    overwrite_table(merge_latest(target, delta, keys), path, reads_target=True)


def append_checked(df: DataFrame, path: str, threshold: float = 0.99, dry_run: bool = False) -> dict[str, int]:
    """Append and compare the table's growth with the source; fail under the threshold."""
    spark = df.sparkSession
    source_rows = df.count()
    if dry_run:
        return {"source_rows": source_rows, "added_rows": 0}
    before = _rows(spark, path)
    _table_writer(df, "append").parquet(path)
    added = _rows(spark, path) - before
    if added < threshold * source_rows:
        raise CopyIncomplete(f"{path}: {added} of {source_rows} rows arrived")
    return {"source_rows": source_rows, "added_rows": added}


def _rows(spark, path: str) -> int:
    try:
        return spark.read.parquet(path).count()
    except AnalysisException as error:
        if is_missing(error) or error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return 0
        raise


def with_lineage(df: DataFrame, source_table: str, batch_id: str, loaded_at: str | Column) -> DataFrame:
    stamp = loaded_at if isinstance(loaded_at, Column) else F.lit(loaded_at)
    return df.withColumns(
        {"_loaded_at": stamp, "_batch_id": F.lit(batch_id), "_source_table": F.lit(source_table)}
    )


def write_raw(
    df: DataFrame, root: str, table: str, day: date, batch_id: str, loaded_at: str, replace_day: bool = True
) -> None:
    """One batch of a raw table as compressed JSON lines with load lineage; a full load replaces its day."""
    stamped = with_lineage(df, table, batch_id, loaded_at)
    mode = "overwrite" if replace_day else "append"
    writer = stamped.write.mode(mode).option("maxRecordsPerFile", ROWS_PER_FILE).option("compression", "gzip")
    writer.json(raw_path(root, table, day))


def extract_children(
    child: DataFrame, parent: DataFrame, on: dict[str, str], parent_date: str, since: date, columns: Sequence[str]
) -> DataFrame:
    """Whitelisted child rows whose parent is dated on or after ``since`` (the child has no date)."""
    return horizon_join(child, parent, on, parent_date, since).select(*columns)


def write_database(df: DataFrame, options: dict[str, str], table: str) -> None:
    """Truncate and load a database table over JDBC; columns go by name."""
    df.write.format("jdbc").options(**options).option("dbtable", table).option("truncate", True).mode("overwrite").save()
