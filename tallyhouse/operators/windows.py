"""Period-over-period windows, rankings and chain detection.

Windows over a key run over one row per key and period, which the calendar
bounds.  Where the number of rows per group is not bounded (clients of a
branch, assignments of a worker) the operators below split the group first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_previous(
    df: DataFrame, keys: Sequence[str], period: str, measures: Sequence[str], steps: int = 1, suffix: str = "_prev"
) -> DataFrame:
    """Attach the measures of the row ``steps`` periods earlier."""
    window = Window.partitionBy(*keys).orderBy(period)
    return df.withColumns({m + suffix: F.lag(m, steps).over(window) for m in measures})


def same_period_last_year(
    df: DataFrame, keys: Sequence[str], period: str, measures: Sequence[str], suffix: str = "_last_year"
) -> DataFrame:
    """Attach the measures of the same month twelve months earlier.

    A range frame on the month number finds exactly that month, so gaps stay NULL (unlike ``lag(12)``)
    and the table is not joined with itself.  One row per key and month.
    """
    number = F.year(period) * 12 + F.month(period)
    window = Window.partitionBy(*keys).orderBy(number).rangeBetween(-12, -12)
    return df.withColumns({m + suffix: F.first(m).over(window) for m in measures})


def active_periods(keys: Sequence[str], period: str, last: int) -> Column:
    """Number of rows among the last ``last`` rows of the key."""
    window = Window.partitionBy(*keys).orderBy(period).rowsBetween(-(last - 1), 0)
    return F.count(F.lit(1)).over(window)


def share_of(measure: str, within: Sequence[str]) -> Column:
    """measure as a share of its group total."""
    total = F.sum(measure).over(Window.partitionBy(*within))
    return F.try_divide(F.col(measure).cast("double"), total.cast("double"))


def value_bin(value: Column) -> Column:
    """A coarse, order-preserving bin of a whole number: its first three digits.

    Needs no sampling, so every evaluation puts a value in the same bin.
    """
    size = F.abs(value)
    width = F.pow(F.lit(10.0), F.greatest(F.length(size.cast("string")) - 3, F.lit(0))).cast("long")
    return (F.signum(value).cast("long") * (size - size % width)).cast("long")


def ranked_values(df: DataFrame, group: Sequence[str], measure: str, scale: int = 2) -> DataFrame:
    """Descending rank of every distinct value of ``measure`` in its group.

    Gives one row per (group, value): ``members`` rows share the value; ``rank`` and
    ``dense_rank`` as the window functions define them; ``group_members`` in all.
    Equal values are counted before the shuffle and a group is spread over value
    bins, so a group with a large part of the rows never meets in one task.
    """
    whole = (F.col(measure) * 10**scale).cast("long")
    values = (
        df.groupBy(*group, measure)
        .agg(F.count(F.lit(1)).alias("members"))
        .withColumn("__bin", value_bin(whole))
    )
    bins = values.groupBy(*group, "__bin").agg(
        F.sum("members").alias("__members"), F.count(F.lit(1)).alias("__distinct")
    )
    above = Window.partitionBy(*group).orderBy(F.desc("__bin")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = bins.select(
        *group,
        "__bin",
        F.coalesce(F.sum("__members").over(above), F.lit(0)).alias("__members_above"),
        F.coalesce(F.sum("__distinct").over(above), F.lit(0)).alias("__distinct_above"),
        F.sum("__members").over(Window.partitionBy(*group)).alias("group_members"),
    )
    in_bin = Window.partitionBy(*group, "__bin").orderBy(F.desc(measure))
    before = F.sum("members").over(in_bin.rowsBetween(Window.unboundedPreceding, -1))
    positioned = values.withColumns(
        {"__before": F.coalesce(before, F.lit(0)), "__dense": F.row_number().over(in_bin)}
    )
    return positioned.join(offsets, [*group, "__bin"]).select(
        *group,
        measure,
        "members",
        (F.col("__members_above") + F.col("__before") + 1).alias("rank"),
        (F.col("__distinct_above") + F.col("__dense")).alias("dense_rank"),
        "group_members",
    )


def percent_rank_of(rank: str = "rank", members: str = "group_members") -> Column:
    """(rank − 1) / (members − 1); 0 in a group of one."""
    return F.when(F.col(members) > 1, (F.col(rank) - 1) / (F.col(members) - 1)).otherwise(F.lit(0.0))


def previous_in_chain(
    df: DataFrame, keys: Sequence[str], date: str, value: str, ties: Sequence[str], name: str
) -> DataFrame:
    """``lag(value)`` per key in (date, ties) order, with the key's rows split by calendar month.

    Within a month the previous row comes from a window; the first row of a month takes the
    last value of the key's preceding month that has rows.  One key's long history is thus
    spread over many tasks, and only one row per key and month crosses months.
    """
    order = [F.col(date), *[F.col(t).asc_nulls_last() for t in ties]]
    month = "__month"
    sliced = df.withColumn(month, F.trunc(date, "month"))
    window = Window.partitionBy(*keys, month).orderBy(*order)
    lagged = sliced.withColumns({name: F.lag(value).over(window), "__first": F.row_number().over(window) == 1})
    per_month = sliced.groupBy(*keys, month).agg(
        F.max_by(value, F.struct(date, *ties)).alias("__last")
    )
    carried = per_month.select(
        *[F.col(k).alias(f"__c_{k}") for k in keys],
        F.col(month).alias("__c_month"),
        F.lag("__last").over(Window.partitionBy(*keys).orderBy(month)).alias("__carry"),
    )
    same = F.col(month) == F.col("__c_month")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__c_{k}"))
    joined = lagged.join(carried, same, "left")
    return joined.withColumn(name, F.when(F.col("__first"), F.col("__carry")).otherwise(F.col(name))).drop(
        month, "__first", "__carry", "__c_month", *[f"__c_{k}" for k in keys]
    )


def latest_period(df: DataFrame, period: str) -> DataFrame:
    """Rows of the newest period (scalar subquery on max)."""
    return df.filter(F.col(period) == df.agg(F.max(period).alias(period)).scalar())


def latest_value(df: DataFrame, period: str, value: Column, name: str) -> DataFrame:
    """An aggregate over the rows of the newest period, as one row, in one pass: a lazy table is computed once.

    NULL if there are no rows with a period.
    """
    return df.groupBy(period).agg(value.alias(name)).agg(F.max_by(name, period).alias(name))
