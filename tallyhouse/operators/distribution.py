"""Median and mode from counts of values.

Rows are first counted per group and value, which a hash aggregate does on the map side; what a group's window then
sees is one row per distinct value, however many rows the group has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_UPTO, _TOTAL = "__upto", "__total"


def with_positions(counted: DataFrame, keys: Sequence[str], value: str, count: str) -> DataFrame:
    """For `median`: how many rows of the group have a value up to this one, and how many have one at all."""
    rows = F.when(F.col(value).isNotNull(), F.col(count)).otherwise(F.lit(0))
    group = Window.partitionBy(*keys)
    upto = group.orderBy(F.col(value).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counted.withColumns({_UPTO: F.sum(rows).over(upto), _TOTAL: F.sum(rows).over(group)})


def median(value: str) -> Column:
    """Exact median of a group, as an aggregate over rows from `with_positions`."""

    def at(position: Column) -> Column:
        return F.min(F.when(F.col(value).isNotNull() & (F.col(_UPTO) > position), F.col(value))).cast("double")

    low, high = F.floor((F.col(_TOTAL) - 1) / 2), F.floor(F.col(_TOTAL) / 2)
    return at(low) * 0.5 + at(high) * 0.5


def with_mode(counted: DataFrame, keys: Sequence[str], value: str, count: str, name: str) -> DataFrame:
    """Adds the group's most frequent value to its row of that value; of several the smallest, NULL elsewhere.

    A maximum over the group then gives the mode.
    """
    order = [F.col(value).isNull(), F.col(count).desc(), F.col(value)]
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) == 1
    return counted.withColumn(name, F.when(first, F.col(value)))


def first_of_value(keys: Sequence[str], value: str) -> Column:
    """The value on one row of each distinct value of a group, else NULL: the count of it is the distinct count.

    For rows that lie gathered by ``keys`` and are summed there anyway, as it needs neither a shuffle nor row copies.
    """
    window = Window.partitionBy(*keys, value).orderBy(value)
    return F.when(F.row_number().over(window) == 1, F.col(value))


def distinct_count(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Distinct values per group from narrow rows; several of them side by side need no row copies (Expand)."""
    return df.select(*keys, value).distinct().groupBy(*keys).agg(F.count(value).alias(name))
