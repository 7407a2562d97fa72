"""Partitions of micro-batches, folded by level so that their number stays small.

Every micro-batch is stored as a partition named by its number, ``b…-b…``; a replayed batch replaces it.  Folding writes
one partition for an aligned range of ``fan``, ``fan²``, … batches and then deletes those inside it.  A reader takes the partitions
that no other one covers, so a fold that broke off between the two steps is harmless, and only batches before the running one
are folded, so a replay never meets its own rows in a wider partition.  After n batches at most ``fan`` partitions a level are left.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyhouse.sources.readers import read_optional_table
from tallyhouse.sources.scratch import delete_folder
from tallyhouse.sources.writers import overwrite_partitions

SPAN = "span"


def span_name(first: int, last: int) -> str:
    return f"b{first:012d}-b{last:012d}"


def bounds(name: str) -> tuple[int, int]:
    first, last = name.split("-")
    return int(first[1:]), int(last[1:])


def uncovered(names: Iterable[str]) -> list[str]:
    """The partitions that lie inside no other one."""
    found: list[str] = []
    for name in sorted(set(names), key=lambda n: (bounds(n)[0], -bounds(n)[1])):
        if not found or bounds(name)[1] > bounds(found[-1])[1]:
            found.append(name)
    return found


def write_batch(rows: DataFrame, path: str, number: int, spread: int = 1, gathered: bool = False) -> None:
    """Store one micro-batch; repeating it gives the same table.

    `spread` tasks write it, or those that hold its rows if they are `gathered` already.
    """
    named = rows.withColumn(SPAN, F.lit(span_name(number, number)))
    overwrite_partitions(named, path, [SPAN], spread=spread, gathered=gathered)


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    fields = [field for field in schema.fields if field.name != SPAN]
    return read_optional_table(spark, path, StructType([*fields, StructField(SPAN, StringType())]))


def span_names(spark: SparkSession, path: str) -> list[str]:
    """Names of all partitions: some for each level, plus what a broken fold left."""
    return sorted(row[0] for row in _read(spark, path, StructType([])).select(SPAN).distinct().collect())


def read_batches(spark: SparkSession, path: str, schema: StructType, before: int | None = None) -> DataFrame:
    """The rows of all batches (of those before a number), each once, without the partition column."""
    names = [n for n in uncovered(span_names(spark, path)) if before is None or bounds(n)[1] < before]
    return _read(spark, path, schema).filter(F.col(SPAN).isin(names)).drop(SPAN)


def drop_spans(spark: SparkSession, path: str, names: Iterable[str]) -> None:
    for name in names:
        delete_folder(spark, f"{path}/{SPAN}={name}")


def fold_batches(
    spark: SparkSession, path: str, schema: StructType, before: int, fold: Callable[[DataFrame], DataFrame], fan: int = 8
) -> list[str]:
    """Fold full aligned ranges of batches that end before a number; returns the partitions written."""
    names = span_names(spark, path)
    live = uncovered(names)
    drop_spans(spark, path, set(names) - set(live))
    written, width = [], fan
    while width <= before:
        for start in sorted({bounds(n)[0] // width * width for n in live}):
            if start + width > before:
                break
            inside = [n for n in live if start <= bounds(n)[0] and bounds(n)[1] < start + width]
            target = span_name(start, start + width - 1)
            if len(inside) < 2:  # one partition, however wide, needs no folding
                continue
            rows = _read(spark, path, schema).filter(F.col(SPAN).isin(inside)).drop(SPAN)
            overwrite_partitions(fold(rows).withColumn(SPAN, F.lit(target)), path, [SPAN])
            drop_spans(spark, path, inside)
            live = uncovered([*(n for n in live if n not in inside), target])
            written.append(target)
        width *= fan
    return written
