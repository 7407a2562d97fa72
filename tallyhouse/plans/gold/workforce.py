"""Workforce marts: activity, loyalty, pool dynamics, skills, staffing, turnover."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import count_if, grain, key_hash, money, ratio, round_to
from tallyhouse.operators.distribution import distinct_count, first_of_value
from tallyhouse.operators.joins import periods_per_member, resolve_key, spine_join
from tallyhouse.plans.silver.loyalty import ACTIVE_RECENT, INACTIVE_LABELS

KEY = ["worker_id", "contract_id"]
# 22 working days of 7 hours.
MONTHLY_HOURS = 154.0


def worker_activity(
    assignments: DataFrame, contracts: DataFrame, contract_hours: DataFrame, workers: DataFrame
) -> DataFrame:
    """(worker, month): assignments, branches, clients, hours, occupancy, revenue.

    The billed rate comes from the timesheet lines, else from the contract.  What a worker does in a month is little, so its
    rows are gathered once and summed and counted where they lie.
    """
    started = assignments.filter(F.col("worker_id").isNotNull() & F.col("start_date").isNotNull())
    rates = contracts.select(*KEY, F.col("bill_rate").alias("contract_rate"))
    started = started.withColumn("month", grain("start_date", "month"))
    joined = spine_join(started, contract_hours, rates, on=KEY)
    revenue = F.col("hours_billed") * F.coalesce("line_bill_rate", "contract_rate")
    keys = ["worker_id", "month"]
    columns = ["contract_id", "branch_id", "client_id", "hours_paid", revenue.alias("revenue")]
    gathered = joined.select(*keys, *columns).repartition(*keys)
    monthly = (
        gathered.withColumns({"branch": first_of_value(keys, "branch_id"), "client": first_of_value(keys, "client_id")})
        .groupBy(*keys)
        .agg(
            F.count("contract_id").alias("assignments"),
            money(F.coalesce(F.sum("hours_paid"), F.lit(0)), 12).alias("hours"),
            money(F.coalesce(F.sum("revenue"), F.lit(0)), 24, 6).alias("revenue"),
            F.count("branch").alias("branches"),
            F.count("client").alias("clients"),
        )
    )
    return monthly.join(workers.select("worker_id", "worker_sk"), "worker_id", "left").withColumns(
        {
            "available_hours": F.lit(MONTHLY_HOURS),
            "occupancy": round_to(F.col("hours").cast("double") / MONTHLY_HOURS, 4),
        }
    )


def loyalty_summary(loyalty: DataFrame, portfolio: DataFrame, home: DataFrame) -> DataFrame:
    """(branch, loyalty category): members, mean tenure, inactivity and loyalty rate."""
    placed = resolve_key(loyalty, "worker_id", portfolio, home, "branch_id")

    def mean(c: str, digits: int):
        total = F.sum(F.col(c).cast("decimal(18,4)")).cast("double")
        return round_to(total / F.nullif(F.count(c), F.lit(0)), digits)

    return placed.groupBy("branch_id", "loyalty_category").agg(
        F.count_distinct("worker_id").alias("workers"),
        mean("tenure_days", 1).alias("mean_tenure_days"),
        mean("idle_days", 1).alias("mean_idle_days"),
        mean("loyalty_rate", 4).alias("mean_loyalty_rate"),
    )


def one_branch_per_member(portfolio: DataFrame) -> DataFrame:
    """Members followed by several branches count for the smallest branch id."""
    return portfolio.groupBy("worker_id").agg(F.min("branch_id").alias("branch_id"))


def pool_dynamics(loyalty: DataFrame, portfolio: DataFrame, home: DataFrame) -> DataFrame:
    """(branch, month): joiners, leavers, net growth, pool size, renewal of the pool."""
    members = resolve_key(loyalty, "worker_id", one_branch_per_member(portfolio), home, "branch_id")
    keys = ["branch_id", "month"]
    joiners = (
        members.filter(F.col("first_sale").isNotNull())
        .groupBy("branch_id", grain("first_sale", "month").alias("month"))
        .agg(F.count_distinct("worker_id").alias("joiners"))
    )
    lost = F.when(F.col("loyalty_category").isin(*INACTIVE_LABELS), F.col("worker_id"))
    leavers = (
        members.filter(F.col("last_sale").isNotNull())
        .groupBy("branch_id", grain("last_sale", "month").alias("month"))
        .agg(F.count_distinct(lost).alias("leavers"))
    )
    active = F.when(F.col("loyalty_category") == ACTIVE_RECENT, F.col("worker_id"))
    pool = members.groupBy("branch_id").agg(
        F.count_distinct(active).alias("active_pool"), F.count_distinct("worker_id").alias("total_pool")
    )
    joined = spine_join(joiners, leavers, on=keys).join(pool, "branch_id", "left").fillna(
        0, ["leavers", "active_pool", "total_pool"]
    )
    return joined.withColumn("net_growth", F.col("joiners") - F.col("leavers")).withColumn(
        "pool_renewal_pct", round_to(ratio("joiners", "total_pool") * 100, 1)
    )


def key_resolution_coverage(loyalty: DataFrame, portfolio: DataFrame, home: DataFrame) -> DataFrame:
    """(one row): members in all, resolved through the portfolio, the home branch, not at all."""
    placed = resolve_key(
        loyalty.select("worker_id").distinct(),
        "worker_id",
        one_branch_per_member(portfolio),
        home,
        "branch_id",
        keep_unresolved=True,
    )
    return placed.agg(
        F.count(F.lit(1)).alias("members"),
        count_if(F.col("via") == "primary").alias("via_portfolio"),
        count_if(F.col("via") == "fallback").alias("via_home_branch"),
        count_if(F.col("via") == "none").alias("unresolved"),
    )


def skill_availability(
    skills: DataFrame, workers: DataFrame, assignments: DataFrame, branches: DataFrame, as_of: date
) -> DataFrame:
    """(trade, branch): qualified, available and placed workers; coverage both ways."""
    qualified = (
        skills.filter((F.col("skill_type") == "METIER") & F.col("is_active") & (F.col("code") != ""))
        .select("worker_id", F.col("code").try_cast("long").alias("trade_id"))
        .filter(F.col("trade_id").isNotNull())
        .distinct()
    )
    staff = workers.filter(F.col("is_active") & F.col("home_branch").isNotNull()).select(
        "worker_id", F.col("home_branch").alias("branch_id")
    )
    busy = (
        assignments.filter((F.col("end_date") >= F.lit(as_of)) | F.col("end_date").isNull())
        .select("worker_id")
        .distinct()
        .withColumn("busy", F.lit(True))
    )
    # One row per (trade, worker), so plain counts are distinct counts.
    counted = (
        qualified.join(staff, "worker_id")
        .join(busy, "worker_id", "left")
        .groupBy("trade_id", "branch_id")
        .agg(F.count(F.lit(1)).alias("qualified"), F.count("busy").alias("on_assignment"))
        .withColumn("available", F.col("qualified") - F.col("on_assignment"))
    )
    sk = branches.filter("is_active").select("branch_id", "branch_sk")
    return counted.join(sk, "branch_id", "left").select(
        key_hash("trade_id").alias("trade_sk"),
        F.coalesce("branch_sk", key_hash(F.coalesce("branch_id", F.lit(0)))).alias("branch_sk"),
        "trade_id",
        "branch_id",
        "qualified",
        "available",
        "on_assignment",
        ratio("on_assignment", "qualified", 4).alias("coverage_rate"),
        ratio("available", "qualified", 4).alias("availability_rate"),
    )


def branch_pool(workers: DataFrame) -> DataFrame:
    """(branch): workers whose home branch it is."""
    return (
        workers.filter(F.col("home_branch").isNotNull())
        .groupBy(F.col("home_branch").alias("branch_id"))
        .agg(F.count_distinct("worker_id").alias("pool"))
    )


def branch_pool_weeks(workers: DataFrame, assignments: DataFrame) -> DataFrame:
    """(branch, week): the pool of every branch in every week that has an assignment start."""
    started = assignments.filter(F.col("start_date").isNotNull()).select(grain("start_date", "week").alias("week"))
    return periods_per_member(branch_pool(workers), started, "week")


def branch_staffing(assignments: DataFrame, workers: DataFrame, orders: DataFrame) -> DataFrame:
    """(branch, week): workers on assignment, available, placement and conversion rate.

    The pool does not depend on the week, so it is counted once and joined by branch.
    """
    keys = ["branch_id", "week"]
    started = assignments.filter(F.col("start_date").isNotNull())
    placed = started.groupBy("branch_id", grain("start_date", "week").alias("week")).agg(
        F.count_distinct("worker_id").alias("on_assignment")
    )
    ordered = (
        orders.filter(F.col("order_date").isNotNull())
        .groupBy("branch_id", grain("order_date", "week").alias("week"))
        .agg(F.count(F.lit(1)).alias("orders"), count_if(F.col("status").isin("P", "C")).alias("filled"))
    )
    joined = spine_join(placed, ordered, on=keys).join(branch_pool(workers), "branch_id", "left")
    idle = F.coalesce("pool", F.lit(0)) - F.col("on_assignment")
    return joined.select(
        *keys,
        "on_assignment",
        F.greatest(idle, F.lit(0)).alias("available"),
        ratio("on_assignment", "pool", 4).alias("placement_rate"),
        F.coalesce("orders", F.lit(0)).alias("orders"),
        ratio("filled", "orders", 4).alias("conversion_rate"),
    )


def worker_turnover(assignments: DataFrame, as_of: date) -> DataFrame:
    """(branch, month): entries, exits, headcount and turnover (months of either side)."""
    keys = ["branch_id", "month"]
    dated = assignments.filter(F.col("start_date").isNotNull())
    present = (F.col("start_date") <= F.lit(as_of)) & (
        F.col("end_date").isNull() | (F.col("end_date") >= F.col("start_date"))
    )
    # Per worker first, so that the distinct counts side by side need no row copies (Expand).
    entries = (
        dated.groupBy("branch_id", grain("start_date", "month").alias("month"), "worker_id")
        .agg(F.max(present).alias("present"))
        .groupBy(*keys)
        .agg(F.count("worker_id").alias("entries"), F.count(F.when(F.col("present"), F.col("worker_id"))).alias("headcount"))
    )
    ended = dated.filter(F.col("end_date").isNotNull()).withColumn("month", grain("end_date", "month"))
    exits = distinct_count(ended, keys, "worker_id", "exits")
    joined = entries.join(exits, keys, "full_outer")
    headcount = F.nullif(F.coalesce("headcount", F.lit(0)), F.lit(0))
    return joined.select(
        *keys,
        F.coalesce("entries", F.lit(0)).alias("entries"),
        F.coalesce("exits", F.lit(0)).alias("exits"),
        F.coalesce(headcount, F.lit(1)).alias("mean_headcount"),
        ratio(F.coalesce("exits", F.lit(0)), headcount, 4, 0.0).alias("turnover_rate"),
    )
