"""Incremental loading: high-water marks, run history."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.dedup import latest_by, newest_first

# Fixed value: marks "never succeeded" in the watermark state.
EPOCH = datetime(1970, 1, 1)


def delta_extract(df: DataFrame, column: str, since: datetime | Column, include_null: bool = False) -> DataFrame:
    """Rows at or after the high-water mark; optionally rows without a change date too."""
    bound = since if isinstance(since, Column) else F.lit(since)
    keep = F.col(column) >= bound
    return df.filter(keep | F.col(column).isNull()) if include_null else df.filter(keep)


def usable_watermark(state: DataFrame) -> DataFrame:
    """The state with the epoch sentinel read as "no mark"."""
    mark = F.when(F.col("last_success") != F.lit(EPOCH).cast("timestamp"), F.col("last_success"))
    return state.withColumn("last_success", mark)


def resolve_since(state: DataFrame, fallbacks: DataFrame, default: datetime) -> DataFrame:
    """Start of the next delta per table: watermark, else the table's fallback, else the default."""
    marks = usable_watermark(state).select("pipeline", "table_name", "last_success")
    return fallbacks.join(marks, ["pipeline", "table_name"], "left").withColumn(
        "since", F.coalesce("last_success", "fallback_since", F.lit(default).cast("timestamp"))
    )


def apply_watermark_updates(state: DataFrame, updates: DataFrame) -> DataFrame:
    """Upsert load outcomes into the watermark state.

    ``updates``: pipeline, table_name, ok, high_mark, error, rows.  Success moves the mark, clears the
    error and adds to the counters; failure keeps the mark (a first failure writes the epoch sentinel).
    """
    keys = ["pipeline", "table_name"]
    known = state.withColumn("__known", F.lit(True))
    joined = known.join(updates, keys, "full_outer")
    ok = F.col("ok")
    epoch = F.lit(EPOCH).cast("timestamp")
    return joined.select(
        *keys,
        F.when(ok, F.col("high_mark"))
        .when(F.col("__known"), F.col("last_success"))
        .otherwise(epoch)
        .alias("last_success"),
        F.when(ok.isNull(), F.col("last_status")).when(ok, "success").otherwise("failed").alias("last_status"),
        F.when(ok.isNull(), F.col("last_error"))
        .when(~ok, F.col("error"))
        .alias("last_error"),
        (F.coalesce("run_count", F.lit(0)) + F.when(ok, 1).otherwise(0)).cast("long").alias("run_count"),
        (F.coalesce("rows_ingested", F.lit(0)) + F.when(ok, F.coalesce("rows", F.lit(0))).otherwise(0))
        .cast("long")
        .alias("rows_ingested"),
    )


def run_records(runs: DataFrame) -> DataFrame:
    """Run-history rows from raw run statistics: layer, status and duration are derived."""
    status = (
        F.when(F.col("error_count") == 0, "success").when(F.col("tables_processed") > 0, "partial").otherwise("failed")
    )
    layer = F.when(F.contains("pipeline", F.lit("_")), F.substring_index("pipeline", "_", 1)).otherwise("unknown")
    seconds = F.unix_micros("ended_at") - F.unix_micros("started_at")
    return runs.withColumns(
        {"layer": layer, "status": status, "duration_s": (seconds / 1_000_000).cast("decimal(10,3)")}
    )


def last_run_per_pipeline(runs: DataFrame) -> DataFrame:
    ties = [F.col(c).asc_nulls_last() for c in runs.columns if c not in ("pipeline", "started_at")]
    return latest_by(runs, ["pipeline"], [*newest_first("started_at"), *ties])
