"""Distinct counts that roll up: bitmaps of numbered members, stored once for the finest grain.

Members (workers, clients) get numbers that lie close together, and a bitmap of 32,768 numbers says which of them a
group holds.  The bitmaps of a day are or-ed to those of its week, month, quarter and year, so one stored table gives exact
distinct counts for all grains, where counts of days could not be added.  Everything is an aggregate in Spark: a hot group
is combined on the map side, and a member however frequent is one bit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAINS = ("day", "week", "month", "quarter", "year")
NUMBER, BUCKET, BITS = "member_number", "member_bucket", "member_bits"


def numbered(members: DataFrame, column: str) -> DataFrame:
    """(member, number) of all different members; store it, as numbers depend on how the members are dealt.

    Members are dealt into ranges and numbered in each of them from a start of its own, so the bitmaps of a range are
    full but for its last one, and no task sees all members.
    """
    different = members.select(column).dropna().distinct()
    return different.repartitionByRange(column).sortWithinPartitions(column).withColumn(NUMBER, F.monotonically_increasing_id())


def new_numbers(known: DataFrame, members: DataFrame, column: str) -> DataFrame:
    """(member, number) of members that have none yet, above all known numbers."""
    fresh = members.select(column).dropna().distinct().join(known, column, "left_anti")
    first = known.agg(F.max(NUMBER)).first()[0]  # one number
    above = F.lit(0 if first is None else (first // (1 << 33) + 1) * (1 << 33)).cast("long")
    return numbered(fresh, column).withColumn(NUMBER, F.col(NUMBER) + above)


def daily_bitmaps(rows: DataFrame, numbers: DataFrame, keys: Sequence[str], day: str, column: str) -> DataFrame:
    """(keys, day, bucket): the bits of the members seen that day."""
    seen = rows.select(*keys, F.col(day).cast("date").alias("day"), column).dropna(subset=["day", column]).distinct()
    known = seen.join(numbers, column)
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(NUMBER)).alias(BITS)
    return known.groupBy(*keys, "day", F.bitmap_bucket_number(NUMBER).alias(BUCKET)).agg(bits)


def _start(grain: str) -> Column:
    return F.col("day") if grain == "day" else F.to_date(F.date_trunc(grain, "day"))


def rolled_up(daily: DataFrame, keys: Sequence[str], name: str, grains: Sequence[str] = GRAINS) -> DataFrame:
    """(keys, grain, period start): distinct members, from one reading of the stored bitmaps."""
    periods = F.array(*[F.struct(F.lit(g).alias("grain"), _start(g).alias("period")) for g in grains])
    spread = daily.select(*keys, F.inline(periods), BUCKET, BITS)
    merged = spread.groupBy(*keys, "grain", "period", BUCKET).agg(F.bitmap_count(F.bitmap_or_agg(BITS)).alias("n"))
    return merged.groupBy(*keys, "grain", "period").agg(F.sum("n").alias(name))


def merge_days(known: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bitmaps of the same days from several loads as one: a member that comes again sets the same bit."""
    both = known.unionByName(fresh)
    return both.groupBy(*keys, "day", BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))
