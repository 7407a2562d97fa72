"""Dashboard queries over the gold marts.

Each is a small report (top-n, latest period, share, pivot) on one or two marts.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import round_to
from tallyhouse.operators.joins import keep_top
from tallyhouse.operators.windows import latest_period, latest_value

ALERT_DSO_DAYS, ALERT_OLD_AMOUNT, ALERT_TERMINATION_PCT, ALERT_COEFFICIENT = 45, 50_000, 10, 1.25
BUCKETS = {"0-30j": "overdue_0_30", "31-60j": "overdue_31_60", "61-90j": "overdue_61_90", ">90j": "overdue_over_90"}


def largest(c: str) -> Column:
    return F.col(c).desc_nulls_last()


def mean(c: str, digits: int) -> Column:
    """Average of a rounded measure, exact in the summation order."""
    total = F.sum(F.col(c).cast("decimal(30,6)")).cast("double")
    return round_to(total / F.nullif(F.count(c), F.lit(0)), digits)


def since_months(df: DataFrame, as_of: date, months: int, period: str = "month") -> DataFrame:
    return df.filter(F.col(period) >= F.add_months(F.lit(as_of), -months))


def named(df: DataFrame, branches: DataFrame, *columns: str) -> DataFrame:
    """With the branch's name (and further columns); branches without a row are dropped."""
    return df.join(branches.select("branch_id", "branch_name", *columns), "branch_id")


# -- branch performance ------------------------------------------------------


def kpi_cards(scorecard: DataFrame) -> DataFrame:
    """Key figures of the latest month next to the month before."""
    monthly = scorecard.groupBy("month").agg(
        F.count_distinct("branch_id").alias("branches"),
        F.sum("net_revenue").cast("decimal(18,2)").alias("net_revenue"),
        mean("margin_rate", 4).alias("mean_margin_rate"),
        mean("conversion_rate", 4).alias("mean_conversion_rate"),
    )
    before = monthly.select(
        F.add_months("month", 1).alias("month"), *[F.col(c).alias(f"{c}_before") for c in monthly.columns[1:]]
    )
    return latest_period(monthly, "month").join(before, "month", "left")


def top_branches(scorecard: DataFrame, branches: DataFrame, n: int) -> DataFrame:
    latest = named(latest_period(scorecard, "month"), branches)
    return (
        latest.select(
            "branch_name", "month", "net_revenue", "margin_rate", "active_clients", "active_workers", "conversion_rate"
        )
        .orderBy(largest("net_revenue"), "branch_name")
        .limit(n)
    )


def ranking_flags(ranking: DataFrame, branches: DataFrame) -> DataFrame:
    """Latest ranking with a four-level flag and a display rank (one row per branch of one month)."""
    score = F.col("global_score")
    latest = named(latest_period(ranking, "month"), branches, "brand", "sector")
    flagged = latest.withColumn(
        "performance",
        F.when(score >= 0.75, "🟢").when(score >= 0.50, "🟡").when(score >= 0.25, "🟠").otherwise("🔴"),
    )
    display = F.row_number().over(Window.partitionBy("month").orderBy(largest("global_score"), "branch_name"))
    return flagged.withColumn("display_rank", display).select(
        "branch_name",
        "brand",
        "sector",
        "rank_revenue",
        "rank_margin",
        "rank_placement",
        "rank_conversion",
        "global_score",
        "performance",
        "display_rank",
    )


def top10_trend(trends: DataFrame, scorecard: DataFrame, branches: DataFrame, as_of: date) -> DataFrame:
    """Twelve months of the branches that lead the latest month."""
    leaders = latest_period(scorecard, "month")
    recent = keep_top(
        since_months(trends, as_of, 12), "branch_id", leaders, [largest("net_revenue"), F.col("branch_id")], 10
    )
    return named(recent, branches).select("branch_name", "month", "net_revenue", "trend").orderBy("month", "branch_name")


def delta_top20(trends: DataFrame, branches: DataFrame) -> DataFrame:
    latest = named(latest_period(trends, "month"), branches)
    return (
        latest.orderBy(largest("net_revenue"), "branch_name")
        .limit(20)
        .select("branch_name", "delta_revenue_mom", "delta_revenue_yoy", "trend")
    )


def trend_distribution(trends: DataFrame) -> DataFrame:
    return latest_period(trends, "month").groupBy("trend").agg(F.count(F.lit(1)).alias("branches"))


# -- assignment quality ------------------------------------------------------


def duration_heatmap(duration: DataFrame, branches: DataFrame, trades: DataFrame, as_of: date) -> DataFrame:
    recent = named(since_months(duration, as_of, 3), branches).join(trades.select("trade_id", "trade_name"), "trade_id")
    return (
        recent.groupBy("branch_name", "trade_name")
        .agg(mean("mean_days", 1).alias("mean_days"), F.sum("assignments").alias("assignments"))
        .orderBy(largest("assignments"), "branch_name", "trade_name")
    )


def termination_levels(termination: DataFrame, branches: DataFrame) -> DataFrame:
    pct = F.col("termination_pct")
    level = F.when(pct <= 5, "BON").when(pct <= 10, "MOYEN").otherwise("ELEVE")
    return (
        named(latest_period(termination, "month"), branches)
        .select("branch_name", "client_id", "termination_pct", "assignments", "terminations", level.alias("risk_level"))
        .orderBy(largest("termination_pct"), "branch_name", "client_id")
    )


def duration_mix(duration: DataFrame) -> DataFrame:
    """Share of the duration profiles in the latest month (at most four rows meet in the window)."""
    profiles = latest_period(duration, "month").groupBy("duration_profile").agg(F.sum("assignments").alias("assignments"))
    total = F.sum("assignments").over(Window.partitionBy())
    return profiles.withColumn("pct", round_to(F.col("assignments").cast("double") / total * 100, 1))


def termination_vs_renewal(termination: DataFrame, renewal: DataFrame, as_of: date) -> DataFrame:
    """Twelve months of termination next to renewal, at branch and month grain on both sides.

    Each mart is reduced to (branch, month) sums first, so clients never multiply.
    """

    def reduced(df: DataFrame, c: str) -> DataFrame:
        return since_months(df, as_of, 12).groupBy("branch_id", "month").agg(
            F.sum(F.col(c).cast("decimal(30,6)")).alias(f"{c}_sum"), F.count(c).alias(f"{c}_n")
        )

    left, right = reduced(termination, "termination_pct"), reduced(renewal, "renewal_pct")
    joined = left.join(right, ["branch_id", "month"], "left")

    def overall(c: str) -> Column:
        return round_to(F.sum(f"{c}_sum").cast("double") / F.nullif(F.sum(f"{c}_n"), F.lit(0)), 1)

    return (
        joined.groupBy("month")
        .agg(overall("termination_pct").alias("termination_pct"), overall("renewal_pct").alias("renewal_pct"))
        .orderBy("month")
    )


def coefficient_scatter(coefficient: DataFrame, trades: DataFrame, as_of: date) -> DataFrame:
    recent = since_months(coefficient, as_of, 3).join(trades.select("trade_id", "trade_name"), "trade_id")
    return (
        recent.groupBy("trade_name", "coefficient_level")
        .agg(
            mean("weighted_coefficient", 3).alias("mean_coefficient"),
            F.sum("assignments").alias("assignments"),
            mean("mean_bill_rate", 2).alias("mean_bill_rate"),
            mean("coefficient_margin_pct", 1).alias("margin_pct"),
        )
        .orderBy(largest("assignments"), "trade_name", "coefficient_level")
    )


def coefficient_detail(coefficient: DataFrame, branches: DataFrame, trades: DataFrame) -> DataFrame:
    latest = named(latest_period(coefficient, "month"), branches)
    return latest.join(trades.select("trade_id", "trade_name"), "trade_id").select(
        "branch_name",
        "client_id",
        "trade_name",
        "weighted_coefficient",
        "mean_bill_rate",
        "mean_pay_rate",
        "coefficient_margin_pct",
        "assignments",
        "coefficient_level",
    )


# -- receivables -------------------------------------------------------------


def aged_balance_pivot(aged: DataFrame, branches: DataFrame) -> DataFrame:
    """Overdue amounts of the latest month, one column per age bucket."""
    latest = named(latest_period(aged, "month"), branches)
    pivoted = latest.groupBy("branch_name").pivot("bucket", list(BUCKETS)).agg(F.sum("overdue").cast("decimal(18,2)"))
    columns = [F.col(f"`{b}`").alias(name) for b, name in BUCKETS.items()]
    total = sum((F.coalesce(F.col(n), F.lit(0)) for n in BUCKETS.values()), F.lit(0))
    return (
        pivoted.select("branch_name", *columns)
        .withColumn("overdue_total", total.cast("decimal(18,2)"))
        .orderBy(largest("overdue_total"), "branch_name")
    )


def bucket_split(aged: DataFrame) -> DataFrame:
    """Overdue amount per age bucket of the latest month, youngest first."""
    order = F.array_position(F.array(*[F.lit(b) for b in BUCKETS]), F.col("bucket"))
    return (
        latest_period(aged, "month")
        .groupBy("bucket")
        .agg(F.sum("overdue").cast("decimal(18,2)").alias("overdue"))
        .orderBy(order)
    )


def receivables_report(
    dso: DataFrame, clients: DataFrame, branches: DataFrame, sort_by: str, n: int | None = None
) -> DataFrame:
    """Clients of the latest month with a positive amount, largest first; all of them, or the top ``n``."""
    latest = named(latest_period(dso, "month"), branches).join(clients.select("client_id", "client_name"), "client_id")
    report = (
        latest.filter(F.col(sort_by) > 0)
        .select("client_name", "branch_name", "outstanding", "overdue", "dso_days", "open_invoices")
        .orderBy(largest(sort_by), "client_name", "branch_name")
    )
    return report if n is None else report.limit(n)


def dso_top10_trend(dso: DataFrame, branches: DataFrame, as_of: date) -> DataFrame:
    """Mean DSO over twelve months of the ten slowest branches of the latest month."""
    slowest = latest_period(dso, "month").groupBy("branch_id").agg(mean("dso_days", 6).alias("dso"))
    recent = keep_top(since_months(dso, as_of, 12), "branch_id", slowest, [largest("dso"), F.col("branch_id")], 10)
    return (
        named(recent, branches)
        .groupBy("branch_name", "month")
        .agg(mean("dso_days", 1).alias("dso_days"))
        .orderBy("month", "branch_name")
    )


# -- clients, pool, sectors --------------------------------------------------


def renewal_top_clients(renewal: DataFrame, clients: DataFrame, as_of: date) -> DataFrame:
    recent = since_months(renewal, as_of, 3).join(clients.select("client_id", "client_name"), "client_id")
    return (
        recent.select("client_name", "renewal_pct", "assignments", "renewals")
        .distinct()
        .orderBy(largest("renewal_pct"), largest("assignments"), "client_name", "renewals")
        .limit(20)
    )


def pool_by_month(pool: DataFrame, as_of: date) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ("joiners", "leavers", "net_growth", "active_pool")]
    return since_months(pool, as_of, 12).groupBy("month").agg(*sums).orderBy("month")


def pool_growth_latest(pool: DataFrame) -> DataFrame:
    return latest_period(pool, "month").agg(F.sum("net_growth").alias("net_growth"))


def sector_treemap(sectors: DataFrame) -> DataFrame:
    return (
        latest_period(sectors, "month")
        .groupBy("sector_label")
        .agg(
            F.sum("net_revenue").cast("decimal(18,2)").alias("net_revenue"),
            F.sum("clients").alias("clients"),
            F.sum("documents").alias("documents"),
        )
        .orderBy(largest("net_revenue"))
    )


def sector_heatmap(sectors: DataFrame, branches: DataFrame, as_of: date) -> DataFrame:
    return (
        named(since_months(sectors, as_of, 3), branches)
        .groupBy("branch_name", "sector_label")
        .agg(
            F.sum("net_revenue").cast("decimal(18,2)").alias("net_revenue"),
            mean("branch_share_pct", 1).alias("share_pct"),
        )
        .orderBy(largest("net_revenue"), "branch_name", "sector_label")
    )


def sector_top8_trend(sectors: DataFrame, as_of: date) -> DataFrame:
    """Twelve months of the eight largest sectors."""
    totals = sectors.groupBy("sector_label").agg(F.sum("net_revenue").alias("total"))
    recent = keep_top(
        since_months(sectors, as_of, 12), "sector_label", totals, [largest("total"), F.col("sector_label")], 8
    )
    return (
        recent.groupBy("month", "sector_label")
        .agg(F.sum("net_revenue").cast("decimal(18,2)").alias("net_revenue"))
        .orderBy("month", "sector_label")
    )


def client_risk(profile: DataFrame) -> DataFrame:
    """Every client with the worse of its credit and churn risk."""

    def either(level: str) -> Column:
        return (F.col("credit_risk") == level) | (F.col("churn_risk") == level)

    status = F.when(either("HIGH"), "🔴 Critique").when(either("MEDIUM"), "🟠 Attention").otherwise("🟢 OK")
    return profile.select(
        "client_id",
        "client_name",
        "city",
        "revenue_ytd",
        "revenue_growth_pct",
        "active_assignments",
        "churn_risk",
        "credit_risk",
        status.alias("global_risk"),
    )


def client_kpis(profile: DataFrame) -> DataFrame:
    return profile.agg(
        F.count(F.lit(1)).alias("clients"),
        F.sum("revenue_ytd").cast("decimal(18,2)").alias("revenue_ytd"),
        F.sum("active_assignments").alias("active_assignments"),
        F.sum("active_workers").alias("active_workers"),
        mean("mean_margin_rate", 4).alias("mean_margin_rate"),
    )


def top_clients(profile: DataFrame, n: int = 20) -> DataFrame:
    return (
        profile.select("client_name", "revenue_12m", "mean_margin_rate", "assignments", "credit_risk", "city")
        .orderBy(largest("revenue_12m"), "client_name")
        .limit(n)
    )


def churn_split(profile: DataFrame) -> DataFrame:
    return profile.groupBy("churn_risk").agg(F.count(F.lit(1)).alias("clients"))


# -- workers -----------------------------------------------------------------


def skills_view(availability: DataFrame, trades: DataFrame, branches: DataFrame) -> DataFrame:
    """Skill availability with trade and branch labels."""
    trade = trades.select("trade_sk", "trade_name", "qualification")
    branch = branches.select("branch_sk", "branch_name", "brand", "sector")
    return availability.join(trade, "trade_sk", "left").join(branch, "branch_sk", "left")


def worker_activity_view(workers: DataFrame, activity: DataFrame, branches: DataFrame) -> DataFrame:
    """Active workers with their activity over all months."""
    totals = activity.groupBy("worker_id").agg(
        F.sum("assignments").alias("assignments"),
        mean("occupancy", 4).alias("occupancy"),
        F.sum("revenue").cast("decimal(24,6)").alias("revenue"),
    )
    branch = branches.select(F.col("branch_id").alias("home_branch"), "branch_name")
    joined = workers.filter("is_active").join(totals, "worker_id", "left").join(branch, "home_branch", "left")
    return joined.select(
        "worker_sk",
        "worker_id",
        "worker_name",
        "is_active",
        "home_branch",
        F.coalesce("assignments", F.lit(0)).alias("assignments"),
        F.coalesce("occupancy", F.lit(0.0)).alias("occupancy"),
        F.coalesce("revenue", F.lit(0)).cast("decimal(24,6)").alias("revenue"),
        "branch_name",
    )


def anonymous(view: DataFrame, hidden: Sequence[str] = ("worker_name",)) -> DataFrame:
    return view.drop(*hidden)


# -- alerts and dashboard load -------------------------------------------------


def threshold_alerts(dso: DataFrame, aged: DataFrame, termination: DataFrame, coefficient: DataFrame) -> DataFrame:
    """One row per alert rule with the observed value of the latest month and whether it fires.  Each mart is read once."""

    def alert(name: str, df: DataFrame, value: Column, threshold: float, above: bool) -> DataFrame:
        observed = latest_value(df, "month", value.cast("double"), "observed")
        fired = F.col("observed") > threshold if above else F.col("observed") < threshold
        return observed.select(
            F.lit(name).alias("alert"), "observed", F.lit(float(threshold)).alias("threshold"),
            F.coalesce(fired, F.lit(False)).alias("fired"),
        )

    old = F.sum(F.when(F.col("bucket") == ">90j", F.col("overdue")))
    return (
        alert("dso", dso, mean("dso_days", 4), ALERT_DSO_DAYS, True)
        .unionByName(alert("overdue_over_90", aged, old, ALERT_OLD_AMOUNT, True))
        .unionByName(alert("termination", termination, mean("termination_pct", 4), ALERT_TERMINATION_PCT, True))
        .unionByName(alert("coefficient", coefficient, mean("weighted_coefficient", 4), ALERT_COEFFICIENT, False))
    )


def load_weekly_revenue(weekly: DataFrame, as_of: date) -> DataFrame:
    """Net revenue per branch over the last twelve weeks, largest first."""
    return (
        weekly.filter(F.col("week") >= F.date_sub(F.lit(as_of), 84))
        .groupBy("branch_id", "week")
        .agg(F.sum("net_revenue").cast("decimal(18,2)").alias("net_revenue"))
        .orderBy(largest("net_revenue"), "branch_id", "week")
    )


def load_scorecard(ranking: DataFrame, as_of: date) -> DataFrame:
    """Scores of the last month, best first."""
    return (
        since_months(ranking, as_of, 1)
        .select("branch_id", "month", "net_revenue", "margin_rate", "global_score")
        .orderBy(largest("global_score"), "branch_id", "month")
    )


def load_client_360(profile: DataFrame) -> DataFrame:
    """Clients at risk, largest revenue first."""
    return (
        profile.filter(F.col("churn_risk") != "LOW")
        .select("client_name", "revenue_ytd", "active_assignments", "churn_risk")
        .orderBy(largest("revenue_ytd"), "client_name")
    )
