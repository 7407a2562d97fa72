"""Assignment marts: detail, duration, end reasons, renewals, billing coefficient."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import concat_skip_null, count_if, days_between, grain, money, ratio, round_to
from tallyhouse.operators.dedup import latest_loaded
from tallyhouse.operators.distribution import median, with_positions
from tallyhouse.operators.joins import join_preaggregated, spine_join
from tallyhouse.operators.windows import previous_in_chain

KEY = ["worker_id", "contract_id"]
# Longest gap in days between two assignments that still counts as a renewal.
RENEWAL_GAP_DAYS = 7
GOOD_COEFFICIENT, FAIR_COEFFICIENT = 1.35, 1.25


def contract_heads(contracts: DataFrame) -> DataFrame:
    """One row per (worker, contract): the newest load of its amendments."""
    return latest_loaded(contracts, KEY)


def hours_per_contract(timesheets: DataFrame, timesheet_lines: DataFrame) -> DataFrame:
    """(worker, contract): paid and billed hours and the billed rate.

    Lines are summed per sheet before they meet the sheets, so weekly sheets never multiply rows.
    """
    sheets = timesheets.dropna(subset=KEY).select("sheet_id", *KEY)
    sums = [
        F.sum("hours_paid").alias("paid"),
        F.sum("hours_billed").alias("billed"),
        F.max("bill_rate").alias("rate"),
    ]
    return (
        join_preaggregated(sheets, timesheet_lines, ["sheet_id"], sums)
        .groupBy(*KEY)
        .agg(
            F.sum("paid").cast("decimal(12,2)").alias("hours_paid"),
            F.sum("billed").cast("decimal(12,2)").alias("hours_billed"),
            F.max("rate").alias("line_bill_rate"),
        )
    )


def sheet_hours(timesheets: DataFrame, timesheet_lines: DataFrame) -> DataFrame:
    """(sheet): worker, contract and the sums of its lines; the fact that is stored by (worker, contract)."""
    sheets = timesheets.dropna(subset=KEY).select("sheet_id", *KEY)
    sums = [
        F.sum("hours_paid").alias("paid"),
        F.sum("hours_billed").alias("billed"),
        F.max("bill_rate").alias("rate"),
    ]
    return join_preaggregated(sheets, timesheet_lines, ["sheet_id"], sums)


def contract_facts(assignments: DataFrame, contracts: DataFrame, sheets: DataFrame) -> DataFrame:
    """(worker, contract): assignment, newest contract and hours.

    Tables stored in the same buckets of (worker, contract) are aggregated and joined where they lie, without a shuffle.
    """
    hours = sheets.groupBy(*KEY).agg(
        F.sum("paid").cast("decimal(12,2)").alias("hours_paid"),
        F.sum("billed").cast("decimal(12,2)").alias("hours_billed"),
        F.max("rate").alias("line_bill_rate"),
    )
    heads = contracts.select(*KEY, "pay_rate", "bill_rate", "trade_id")
    placed = assignments.select(*KEY, "client_id", "branch_id", "start_date")
    return placed.join(heads, KEY, "left").join(hours, KEY, "left")


def assignments_distinct(assignments: DataFrame) -> DataFrame:
    """Distinct (worker, contract, client, branch)."""
    return assignments.dropna(subset=KEY).select(*KEY, "client_id", "branch_id").distinct()


def assignment_detail(assignments: DataFrame, contracts: DataFrame, contract_hours: DataFrame) -> DataFrame:
    """(worker, contract): duration, hourly margin, revenue, cost, margin rate."""
    spine = assignments.dropna(subset=KEY).select(*KEY, "client_id", "branch_id")
    joined = spine_join(spine, contracts.select(*KEY, "trade_id", "start_date", "end_date", "pay_rate", "bill_rate"),
                        contract_hours.select(*KEY, "hours_paid"), on=KEY)
    hours = F.coalesce("hours_paid", F.lit(0).cast("decimal(12,2)"))
    pay, bill = (F.coalesce(c, F.lit(0).cast("decimal(10,4)")) for c in ("pay_rate", "bill_rate"))
    spread = (bill - pay).cast("decimal(12,4)")
    return joined.select(
        F.md5(
            F.concat(concat_skip_null("worker_id"), F.lit("|"), concat_skip_null("contract_id"), F.lit("|"),
                     concat_skip_null("client_id"))
        ).alias("assignment_sk"),
        *KEY,
        "client_id",
        "branch_id",
        "trade_id",
        "start_date",
        "end_date",
        days_between("start_date", "end_date").alias("duration_days"),
        "pay_rate",
        "bill_rate",
        (F.col("bill_rate") - F.col("pay_rate")).cast("decimal(12,4)").alias("hourly_margin"),
        hours.alias("hours"),
        money(hours * bill, 24, 6).alias("revenue"),
        money(hours * pay, 24, 6).alias("cost"),
        money(hours * spread, 24, 6).alias("margin"),
        F.when(hours * bill > 0, ratio(hours * spread, hours * bill, 4)).otherwise(F.lit(0.0)).alias("margin_rate"),
    )


def assignment_margin(assignments: DataFrame, contracts: DataFrame, contract_hours: DataFrame) -> DataFrame:
    """(worker, contract): gross margin on billed against paid hours."""
    spine = assignments.dropna(subset=KEY).select(*KEY, "client_id", "branch_id")
    joined = spine_join(spine, contracts.select(*KEY, "trade_id", "pay_rate", "bill_rate"), contract_hours, on=KEY)
    zero = money(F.lit(0), 24, 6)
    return (
        joined.withColumn("revenue", F.coalesce(money(F.col("hours_billed") * F.col("bill_rate"), 24, 6), zero))
        .withColumn("cost", F.coalesce(money(F.col("hours_paid") * F.col("pay_rate"), 24, 6), zero))
        .select(
            *KEY,
            "client_id",
            "branch_id",
            "trade_id",
            "revenue",
            "cost",
            money(F.col("revenue") - F.col("cost"), 24, 6).alias("gross_margin"),
            F.when(F.col("revenue") > 0, ratio(F.col("revenue") - F.col("cost"), "revenue", 4))
            .otherwise(F.lit(0.0))
            .alias("margin_rate"),
            money(
                F.coalesce("hours_paid", F.lit(0)) + F.coalesce("hours_billed", F.lit(0)), 14
            ).alias("total_hours"),
        )
    )


def termination_rate(end_status: DataFrame, assignments: DataFrame) -> DataFrame:
    """(branch, client, month): terminations, cancellations, normal ends; running assignments excluded."""
    ended = end_status.filter(F.col("end_status") != "EN_COURS").select(*KEY, "end_status", "actual_days")
    started = assignments.filter(F.col("start_date").isNotNull()).select(*KEY, "branch_id", "client_id", "start_date")
    status = F.col("end_status")
    total = F.count(F.lit(1))

    def percent(*labels: str) -> Column:
        return round_to(count_if(status.isin(*labels)).cast("double") / total * 100, 1)

    terminated = status == "RUPTURE"
    mean_days = F.sum(F.when(terminated, F.col("actual_days"))).cast("double") / F.nullif(
        count_if(terminated), F.lit(0)
    )
    return (
        ended.join(started, KEY)
        .groupBy("branch_id", "client_id", grain("start_date", "month").alias("month"))
        .agg(
            total.alias("assignments"),
            count_if(terminated).alias("terminations"),
            count_if(status == "ANNULEE").alias("cancellations"),
            count_if(status == "TERME_NORMAL").alias("normal_ends"),
            percent("RUPTURE").alias("termination_pct"),
            percent("RUPTURE", "ANNULEE").alias("early_end_pct"),
            round_to(mean_days, 1).alias("mean_days_before_termination"),
        )
    )


def assignment_duration(assignments: DataFrame, contracts: DataFrame) -> DataFrame:
    """(branch, client, trade, month): mean and median duration, cumulative buckets, profile."""
    dated = contracts.select(*KEY, "trade_id", "start_date", "end_date").dropna(subset=["start_date", "end_date"])
    keys = ["branch_id", "client_id", "trade_id", "month"]
    days, total = F.col("days"), F.sum("n")
    mean = F.sum(days * F.col("n")).cast("double") / total

    def rows_if(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(F.lit(0)))

    counted = (
        assignments.dropna(subset=KEY)
        .select(*KEY, "branch_id", "client_id")
        .join(dated, KEY)
        .withColumn("days", days_between("start_date", "end_date"))
        .filter(days > 0)
        .groupBy("branch_id", "client_id", "trade_id", grain("start_date", "month").alias("month"), "days")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        with_positions(counted, keys, "days", "n")
        .groupBy(*keys)
        .agg(
            total.alias("assignments"),
            round_to(mean, 1).alias("mean_days"),
            round_to(mean / 7.0, 1).alias("mean_weeks"),
            round_to(median("days"), 1).alias("median_days"),
            rows_if(days <= 1).alias("up_to_1_day"),
            rows_if(days <= 7).alias("up_to_1_week"),
            rows_if(days <= 30).alias("up_to_1_month"),
            rows_if(days > 30).alias("over_1_month"),
            F.when(mean <= 1, "MICRO").when(mean <= 7, "COURTE").when(mean <= 30, "MOYENNE").otherwise("LONGUE").alias(
                "duration_profile"
            ),
        )
    )


def billing_coefficient(assignments: DataFrame, contracts: DataFrame, contract_hours: DataFrame) -> DataFrame:
    """(branch, client, trade, month): billed over paid rate, weighted by hours and plain."""
    rated = contracts.filter((F.col("pay_rate") > 0) & (F.col("bill_rate") > 0) & F.col("start_date").isNotNull())
    rated = rated.select(*KEY, "trade_id", "start_date", "pay_rate", "bill_rate")
    joined = (
        assignments.dropna(subset=KEY)
        .select(*KEY, "branch_id", "client_id")
        .join(rated, KEY)
        .join(contract_hours.select(*KEY, "hours_paid"), KEY, "left")
        .withColumn("weight", F.coalesce("hours_paid", F.lit(0).cast("decimal(12,2)")))
    )
    weighted = F.try_divide(
        F.sum(F.col("bill_rate") * F.col("weight")).cast("double"),
        F.sum(F.col("pay_rate") * F.col("weight")).cast("double"),
    )
    simple = F.avg(F.col("bill_rate").cast("double") / F.col("pay_rate").cast("double"))
    rows = F.count(F.lit(1))
    return joined.groupBy("branch_id", "client_id", "trade_id", grain("start_date", "month").alias("month")).agg(
        rows.alias("assignments"),
        round_to(weighted, 3).alias("weighted_coefficient"),
        round_to(simple, 3).alias("mean_coefficient"),
        round_to(F.sum("bill_rate").cast("double") / rows, 2).alias("mean_bill_rate"),
        round_to(F.sum("pay_rate").cast("double") / rows, 2).alias("mean_pay_rate"),
        round_to((weighted - 1) * 100, 1).alias("coefficient_margin_pct"),
        F.when(simple >= GOOD_COEFFICIENT, "BON").when(simple >= FAIR_COEFFICIENT, "MOYEN").otherwise("A_REVOIR").alias(
            "coefficient_level"
        ),
    )


def renewal_rate(assignments: DataFrame, contracts: DataFrame) -> DataFrame:
    """(branch, client, month): restarts of a worker at the same client within a week of the last end."""
    dated = contracts.select(*KEY, "start_date", "end_date").dropna(subset=["start_date", "end_date"])
    base = assignments.select(*KEY, "branch_id", "client_id").join(dated, KEY)
    chained = previous_in_chain(
        base, ["worker_id", "client_id", "branch_id"], "start_date", "end_date", ["contract_id"], "previous_end"
    )
    gap = days_between("previous_end", "start_date")
    renewed = F.coalesce(gap.between(0, RENEWAL_GAP_DAYS), F.lit(False))
    renewals = count_if(renewed)
    mean_gap = F.sum(F.when(renewed, gap)).cast("double") / F.nullif(renewals, F.lit(0))
    return chained.groupBy("branch_id", "client_id", grain("start_date", "month").alias("month")).agg(
        F.count(F.lit(1)).alias("assignments"),
        renewals.alias("renewals"),
        round_to(renewals.cast("double") / F.count(F.lit(1)) * 100, 1).alias("renewal_pct"),
        round_to(mean_gap, 0).alias("mean_gap_days"),
    )


def status_by_month(end_status: DataFrame, assignments: DataFrame, since) -> DataFrame:
    """(branch, month, end status): assignments started since a date."""
    started = assignments.filter(F.col("start_date") >= F.lit(since)).select(*KEY, "branch_id", "start_date")
    return (
        end_status.select(*KEY, "end_status")
        .join(started, KEY)
        .groupBy("branch_id", grain("start_date", "month").alias("month"), "end_status")
        .agg(F.count(F.lit(1)).alias("assignments"))
    )
