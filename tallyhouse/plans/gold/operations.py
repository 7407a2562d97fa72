"""Operational marts: hours, FTE, order pipeline, placement delay, declaration compliance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import count_if, days_between, grain, money, round_to
from tallyhouse.operators.distribution import median, with_positions
from tallyhouse.operators.joins import join_preaggregated

KEY = ["worker_id", "contract_id"]
FULL_TIME_WEEK_HOURS = 35.0


def placed_sheets(timesheets: DataFrame, assignments: DataFrame) -> DataFrame:
    """Valid, dated timesheets with branch and client of their assignment."""
    valid = timesheets.filter(F.col("valid") & F.col("modified_at").isNotNull()).select("sheet_id", *KEY, "modified_at")
    places = assignments.filter(F.col("branch_id").isNotNull()).select(*KEY, "branch_id", "client_id")
    return valid.join(places, KEY)


def _with_hours(sheets: DataFrame, lines: DataFrame, how: str) -> DataFrame:
    sums = [F.sum("hours_paid").alias("paid"), F.sum("hours_billed").alias("billed")]
    return join_preaggregated(sheets, lines, ["sheet_id"], sums, how)


def fte_weekly(timesheets: DataFrame, timesheet_lines: DataFrame, assignments: DataFrame) -> DataFrame:
    """(branch, week): sheets, workers, hours and full-time equivalents of valid sheets."""
    hours = F.coalesce(F.sum("paid"), F.lit(0))
    return (
        _with_hours(placed_sheets(timesheets, assignments), timesheet_lines, "left")
        .groupBy("branch_id", grain("modified_at", "week").alias("week"))
        .agg(
            F.count(F.lit(1)).alias("sheets"),
            F.count_distinct("worker_id").alias("workers"),
            money(hours, 12).alias("hours"),
            round_to(hours.cast("double") / FULL_TIME_WEEK_HOURS, 4).alias("fte"),
        )
    )


def weekly_hours(timesheets: DataFrame, timesheet_lines: DataFrame, assignments: DataFrame) -> DataFrame:
    """(branch, client, week): paid and billed hours of valid sheets that have lines."""
    return (
        _with_hours(placed_sheets(timesheets, assignments), timesheet_lines, "inner")
        .filter(F.col("client_id").isNotNull())
        .groupBy("branch_id", "client_id", grain("modified_at", "week").alias("week"))
        .agg(
            money(F.sum("paid"), 12).alias("hours_paid"),
            money(F.sum("billed"), 12).alias("hours_billed"),
            F.count(F.lit(1)).alias("sheets"),
        )
    )


# Rubric patterns of the hour kinds (SQL LIKE, alternatives joined by ',').
RUBRIC_KINDS = {
    "normal_hours": "HN,HNOR",
    "overtime_hours": "HS%",
    "night_hours": "HN%UIT%",
    "sunday_hours": "HD%",
}


def weekly_hours_by_rubric(
    sheets: DataFrame, lines: DataFrame, group: list[str], kinds: dict[str, str] = RUBRIC_KINDS
) -> DataFrame:
    """(group, week): hours split by rubric pattern.

    ``sheets``: sheet_id, group columns, modified_at; ``lines``: sheet_id, rubric, hours_paid.
    """
    zero = F.lit(0).cast("decimal(10,2)")

    def matches(patterns: str):
        hits = [F.col("rubric").like(p) for p in patterns.split(",")]
        found = hits[0]
        for h in hits[1:]:
            found = found | h
        return found

    sums = [F.sum(F.when(matches(p), F.col("hours_paid")).otherwise(zero)).alias(kind) for kind, p in kinds.items()]
    per_sheet = join_preaggregated(sheets.filter(F.col("modified_at").isNotNull()), lines, ["sheet_id"], sums)
    totals = [money(F.sum(F.coalesce(k, zero)), 14).alias(k) for k in kinds]
    weekly = per_sheet.groupBy(*group, grain("modified_at", "week").alias("week")).agg(
        *totals, F.count(F.lit(1)).alias("sheets")
    )
    total = sum((F.col(k) for k in kinds), zero)
    return weekly.withColumn("total_hours", money(total, 14))


def order_pipeline(orders: DataFrame) -> DataFrame:
    """(branch, week): orders placed, filled, open and the fill rate."""
    filled = count_if(F.col("status") == "P")
    return (
        orders.filter(F.col("branch_id").isNotNull() & F.col("order_date").isNotNull())
        .groupBy("branch_id", grain("order_date", "week").alias("week"))
        .agg(
            F.count(F.lit(1)).alias("orders"),
            filled.alias("filled"),
            count_if(F.col("status") == "O").alias("open"),
            round_to(filled.cast("double") / F.count(F.lit(1)), 6).alias("fill_rate"),
        )
    )


def order_pipeline_detail(orders: DataFrame, assignments: DataFrame) -> DataFrame:
    """(branch, week): pipeline with cancellations, requested posts and mean days to the first start.

    Start dates are reduced to one row per order first, so an order counts once.
    """
    starts = assignments.filter(F.col("order_id").isNotNull()).select("order_id", "start_date")
    joined = join_preaggregated(
        orders.filter(F.col("order_date").isNotNull()), starts, ["order_id"], [F.min("start_date").alias("first_start")]
    )
    delay = days_between("order_date", "first_start")
    total, filled = F.count(F.lit(1)), count_if(F.col("status").isin("P", "C"))
    return joined.groupBy("branch_id", grain("order_date", "week").alias("week")).agg(
        total.alias("orders"),
        count_if(F.col("status") == "O").alias("open"),
        filled.alias("filled"),
        count_if(F.col("status") == "A").alias("cancelled"),
        round_to(filled.cast("double") / total, 4).alias("fill_rate"),
        round_to(F.sum(delay).cast("double") / F.nullif(F.count(delay), F.lit(0)), 1).alias("mean_delay_days"),
        F.sum("headcount").cast("long").alias("requested_posts"),
    )


#: Keys and sums of the counted delays that the mart is built from; counts are additive over assignments.
DELAY_KEYS, DELAY_SUMS = ("branch_id", "week", "placement_delay_hours"), ("n",)


def delay_counts(assignments: DataFrame) -> DataFrame:
    """(branch, week of end, hours from order to start): assignments."""
    return (
        assignments.dropna(subset=["branch_id", "end_date", "placement_delay_hours"])
        .groupBy("branch_id", grain("end_date", "week").alias("week"), "placement_delay_hours")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def placement_delay(assignments: DataFrame) -> DataFrame:
    """(branch, week of end): mean and median hours from order to start, shares within 4 h, 24 h, over 72 h."""
    return placement_delay_from(delay_counts(assignments))


def placement_delay_from(counted: DataFrame) -> DataFrame:
    """The placement delays from counted values."""
    delay, keys = F.col("placement_delay_hours"), ["branch_id", "week"]
    total = F.sum("n")

    def percent(condition: Column) -> Column:
        return round_to(F.sum(F.when(condition, F.col("n")).otherwise(F.lit(0))).cast("double") / total * 100, 1)

    return (
        with_positions(counted, keys, "placement_delay_hours", "n")
        .groupBy(*keys)
        .agg(
            total.alias("assignments"),
            round_to(F.sum(delay * F.col("n")).cast("double") / total, 2).alias("mean_delay_hours"),
            round_to(median("placement_delay_hours"), 2).alias("median_delay_hours"),
            percent(delay <= 4).alias("pct_within_4h"),
            percent(delay <= 24).alias("pct_within_24h"),
            percent(delay > 72).alias("pct_over_72h"),
        )
    )


def declaration_compliance(assignments: DataFrame) -> DataFrame:
    """(branch, month of end): pre-hire declarations sent, in time, late, missing."""
    sent, gap = F.col("declared_at").isNotNull(), F.col("declaration_gap_hours")
    in_time, late = sent & (gap <= 0), sent & (gap > 0)
    late_gap = F.when(gap > 0, gap)
    return (
        assignments.dropna(subset=["branch_id", "end_date"])
        .groupBy("branch_id", grain("end_date", "month").alias("month"))
        .agg(
            F.count(F.lit(1)).alias("assignments"),
            count_if(sent).alias("declared"),
            count_if(in_time).alias("in_time"),
            count_if(late).alias("late"),
            count_if(~sent).alias("missing"),
            round_to(count_if(in_time).cast("double") / F.count(F.lit(1)), 4).alias("compliance_rate"),
            round_to(F.sum(late_gap).cast("double") / F.nullif(F.count(late_gap), F.lit(0)), 2).alias("mean_late_hours"),
        )
    )
