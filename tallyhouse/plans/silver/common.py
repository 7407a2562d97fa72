"""Shared column expressions of the silver builders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.dedup import latest_loaded

BATCH, LOADED_AT = "_batch_id", "_loaded_at"


def as_long(c: str) -> Column:
    return F.col(c).try_cast("long")


def as_int(c: str) -> Column:
    return F.col(c).try_cast("int")


def as_date(c: str) -> Column:
    return F.col(c).try_cast("date")


def as_timestamp(c: str) -> Column:
    return F.col(c).try_cast("timestamp")


def as_decimal(c: str, precision: int, scale: int) -> Column:
    return F.col(c).try_cast(f"decimal({precision},{scale})")


def text(c: str) -> Column:
    return F.trim(F.col(c).cast("string"))


def missing(data_type: str) -> Column:
    """Typed NULL for a column the source does not deliver."""
    return F.lit(None).cast(data_type)


def lineage(raw: DataFrame) -> list[Column]:
    batch = F.col(BATCH) if BATCH in raw.columns else missing("string")
    return [batch.alias(BATCH), as_timestamp(LOADED_AT).alias(LOADED_AT)]


def newest(raw: DataFrame, keys: Sequence[str], columns: Sequence[Column]) -> DataFrame:
    """Project first, so that the shuffle carries only the columns kept, then latest wins."""
    return latest_loaded(raw.select(*columns, *lineage(raw)), keys)


def with_columns_present(raw: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add typed NULLs for optional columns the batch lacks."""
    absent = {c: missing(t) for c, t in columns.items() if c not in raw.columns}
    return raw.withColumns(absent) if absent else raw
