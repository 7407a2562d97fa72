"""Client marts: 360° views, retention, profitability."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyhouse.functions import clamp01, count_if, days_between, grain, money, ratio, round_to
from tallyhouse.operators.dedup import latest_loaded, top_per_group
from tallyhouse.operators.distribution import distinct_count
from tallyhouse.operators.joins import spine_join
from tallyhouse.operators.windows import active_periods, with_previous
from tallyhouse.plans.gold.revenue import assignment_count, invoices_with_amounts, net

WIDE = (24, 6)


def revenue_windows(monthly_revenue: DataFrame, measure: str, as_of: date) -> DataFrame:
    """(client): year to date, previous year and rolling twelve months."""
    year = F.year("month")
    value, zero = F.col(measure), F.lit(0)
    since = F.add_months(F.lit(as_of), -12)
    return monthly_revenue.groupBy("client_id").agg(
        money(F.sum(F.when(year == as_of.year, value).otherwise(zero))).alias("revenue_ytd"),
        money(F.sum(F.when(year == as_of.year - 1, value).otherwise(zero))).alias("revenue_previous_year"),
        money(F.sum(F.when(F.col("month") >= since, value).otherwise(zero))).alias("revenue_12m"),
    )


def _growth(scale: int, factor: int = 1) -> Column:
    base = F.col("revenue_previous_year")
    growth = ratio(F.col("revenue_ytd") - base, base) * factor
    return round_to(growth, scale)


def client_360_light(monthly_revenue: DataFrame, clients: DataFrame, exposures: DataFrame, as_of: date) -> DataFrame:
    """(client): revenue this and last year, credit position (alarm at 90 % / 70 % of the limit)."""
    credit = latest_loaded(exposures, ["siren"]).select("siren", "credit_used", "credit_limit")
    revenue = revenue_windows(monthly_revenue, "revenue", as_of)
    used, limit = F.col("credit_used").cast("double"), F.col("credit_limit").cast("double")
    joined = clients.join(revenue, "client_id", "left").join(credit, "siren", "left")
    zero = F.lit(0)
    return joined.select(
        "client_id",
        F.trim("client_name").alias("client_name"),
        F.trim("siren").alias("siren"),
        F.trim("city").alias("city"),
        F.trim("naf_code").alias("naf_code"),
        money(F.coalesce("revenue_ytd", zero)).alias("revenue_ytd"),
        money(F.coalesce("revenue_previous_year", zero)).alias("revenue_previous_year"),
        F.when(F.coalesce("revenue_previous_year", zero) != 0, _growth(4)).alias("revenue_growth"),
        money(F.coalesce("credit_used", zero)).alias("credit_used"),
        money(F.coalesce("credit_limit", zero)).alias("credit_limit"),
        F.when(used > limit * 0.9, "CRITIQUE").when(used > limit * 0.7, "ELEVE").otherwise("NORMAL").alias("credit_risk"),
    )


def assignment_profile(detail: DataFrame, as_of: date, open_end_is_active: bool = True) -> DataFrame:
    """(client): assignments and workers, active and ever, branches, first start, mean margin."""
    active = F.col("end_date") >= F.lit(as_of)
    if open_end_is_active:
        active = active | F.col("end_date").isNull()
    # Per worker first, so that distinct workers need no row copies (Expand).
    per_worker = detail.groupBy("client_id", "worker_id").agg(
        count_if(active).alias("active"),
        F.count(F.lit(1)).alias("rows"),
        F.min("start_date").alias("first_start"),
        F.sum(F.col("margin_rate").cast("decimal(18,4)")).alias("margin_rates"),
        F.count("margin_rate").alias("margins"),
    )
    profile = per_worker.groupBy("client_id").agg(
        F.sum("active").alias("active_assignments"),
        F.sum("rows").alias("assignments"),
        F.count(F.when(F.col("active") > 0, F.col("worker_id"))).alias("active_workers"),
        F.count("worker_id").alias("workers"),
        F.min("first_start").alias("first_start"),
        round_to(F.sum("margin_rates").cast("double") / F.nullif(F.sum("margins"), F.lit(0)), 4).alias("mean_margin_rate"),
    )
    # A client without an id joins nothing below.
    return profile.join(distinct_count(detail, ["client_id"], "branch_id", "branches"), "client_id", "left")


def top_trades(detail: DataFrame, k: int = 3) -> DataFrame:
    """(client): the k most frequent trades, most frequent first."""
    counted = (
        detail.filter(F.col("trade_id").isNotNull()).groupBy("client_id", "trade_id").agg(F.count(F.lit(1)).alias("n"))
    )
    leaders = top_per_group(counted, ["client_id"], [F.col("n").desc(), F.col("trade_id").asc()], k)
    ordered = F.array_sort(F.collect_list(F.struct("position", "trade_id")))
    ids = F.transform(ordered, lambda x: x["trade_id"].cast("string"))
    return leaders.groupBy("client_id").agg(F.concat(F.lit("["), F.array_join(ids, ", "), F.lit("]")).alias("top_trades"))


def client_360(
    clients: DataFrame,
    monthly_revenue: DataFrame,
    detail: DataFrame,
    exposures: DataFrame,
    invoices: DataFrame,
    as_of: date,
) -> DataFrame:
    """(client): the full profile."""
    credit = exposures.groupBy("siren").agg(
        F.max_by("credit_used", "_loaded_at").alias("credit_used"),
        F.max_by("credit_limit", "_loaded_at").alias("credit_limit"),
    )
    last = invoices.groupBy("client_id").agg(F.max("invoice_date").alias("last_invoice"))
    joined = spine_join(
        clients,
        revenue_windows(monthly_revenue, "net_revenue", as_of),
        assignment_profile(detail, as_of),
        top_trades(detail),
        last,
        on=["client_id"],
    ).join(credit, "siren", "left")
    zero, today = F.lit(0), F.lit(as_of)
    used, limit = F.col("credit_used").cast("double"), F.col("credit_limit").cast("double")
    idle = days_between("last_invoice", today)
    counts = ["active_assignments", "assignments", "active_workers", "workers", "branches"]
    return joined.select(
        "client_sk",
        "client_id",
        "client_name",
        "siren",
        "city",
        F.col("client_status"),
        money(F.coalesce("revenue_ytd", zero)).alias("revenue_ytd"),
        money(F.coalesce("revenue_previous_year", zero)).alias("revenue_previous_year"),
        F.when(F.col("revenue_previous_year") > 0, _growth(2, 100)).alias("revenue_growth_pct"),
        money(F.coalesce("revenue_12m", zero)).alias("revenue_12m"),
        *[F.coalesce(c, zero).cast("long").alias(c) for c in counts],
        F.coalesce("top_trades", F.lit("[]")).alias("top_trades"),
        F.coalesce(days_between("first_start", today), zero).alias("seniority_days"),
        F.coalesce("mean_margin_rate", F.lit(0.0)).alias("mean_margin_rate"),
        money(F.coalesce("credit_used", zero)).alias("credit_used"),
        money(F.coalesce("credit_limit", zero)).alias("credit_limit"),
        F.when((limit > 0) & (used > limit * 0.8), "HIGH")
        .when((limit > 0) & (used > limit * 0.5), "MEDIUM")
        .otherwise("LOW")
        .alias("credit_risk"),
        "last_invoice",
        F.coalesce(idle, F.lit(9999)).alias("days_since_invoice"),
        F.when(F.col("last_invoice").isNull() | (idle > 90), "HIGH").when(idle > 45, "MEDIUM").otherwise("LOW").alias(
            "churn_risk"
        ),
    )


def client_360_fallback(clients: DataFrame, monthly_revenue: DataFrame, detail: DataFrame, as_of: date) -> DataFrame:
    """(client): the profile when only the upstream marts are readable; the rest is constant."""
    joined = spine_join(
        clients,
        revenue_windows(monthly_revenue, "net_revenue", as_of),
        assignment_profile(detail, as_of, open_end_is_active=False),
        on=["client_id"],
    )
    zero = F.lit(0)
    counts = ["active_assignments", "assignments", "active_workers", "workers", "branches"]
    return joined.select(
        "client_sk",
        "client_id",
        "client_name",
        money(F.coalesce("revenue_ytd", zero)).alias("revenue_ytd"),
        money(F.coalesce("revenue_previous_year", zero)).alias("revenue_previous_year"),
        F.when(F.col("revenue_previous_year") > 0, _growth(2, 100)).alias("revenue_growth_pct"),
        money(F.coalesce("revenue_12m", zero)).alias("revenue_12m"),
        *[F.coalesce(c, zero).cast("long").alias(c) for c in counts],
        F.lit("[]").alias("top_trades"),
        F.coalesce(days_between("first_start", F.lit(as_of)), zero).alias("seniority_days"),
        F.coalesce("mean_margin_rate", F.lit(0.0)).alias("mean_margin_rate"),
        money(zero).alias("credit_used"),
        money(zero).alias("credit_limit"),
        F.lit("LOW").alias("credit_risk"),
        F.lit(None).cast("date").alias("last_invoice"),
        F.lit(9999).alias("days_since_invoice"),
        F.lit("HIGH").alias("churn_risk"),
    )


def client_retention_light(monthly_revenue: DataFrame) -> DataFrame:
    """(client, quarter): revenue change on the quarter before (0 before the first) and a coarse risk."""
    quarterly = monthly_revenue.groupBy("client_id", grain("month", "quarter").alias("quarter")).agg(
        money(F.sum("revenue")).alias("revenue"), F.sum("assignments").alias("assignments")
    )
    previous = F.lag("revenue", 1, 0).over(W.partitionBy("client_id").orderBy("quarter"))
    return (
        quarterly.withColumn("previous", previous.cast("decimal(18,2)"))
        .withColumn("delta_qoq", money(F.col("revenue") - F.col("previous")))
        .withColumn(
            "churn_risk",
            F.when(F.col("revenue").cast("double") < F.col("previous").cast("double") * 0.7, "RISQUE_FORT")
            .when(F.col("revenue") == 0, "INACTIF")
            .otherwise("STABLE"),
        )
        .drop("previous")
    )


def churn_label(days: Column, qoq_pct: Column, active_quarters: Column) -> Column:
    return (
        F.when(days > 180, "PERDU")
        .when(days > 90, "HIGH")
        .when(days > 45, "MEDIUM")
        .when(qoq_pct < -0.3, "MEDIUM")
        .when(active_quarters <= 1, "MEDIUM")
        .otherwise("LOW")
    )


def churn_score(days: Column, qoq_pct: Column, active_quarters: Column, yoy_pct: Column) -> Column:
    """Weighted score in [0, 1]: inactivity, frequency, quarterly and yearly loss."""

    def loss(pct: Column) -> Column:
        return F.when(F.coalesce(pct, F.lit(0.0)) < 0, F.least(F.abs(pct), F.lit(1.0))).otherwise(F.lit(0.0))

    idle = F.least(days.cast("double") / 180.0, F.lit(1.0))
    rare = 1.0 - F.least(active_quarters.cast("double") / 4.0, F.lit(1.0))
    total = F.lit(0.30) * idle + F.lit(0.25) * rare + F.lit(0.25) * loss(qoq_pct) + F.lit(0.20) * loss(yoy_pct)
    return round_to(clamp01(total), 4)


def client_retention(
    invoices: DataFrame, invoice_lines: DataFrame, assignments: DataFrame, clients: DataFrame, as_of: date
) -> DataFrame:
    """(client, quarter): deltas, activity, churn risk and score."""
    keys = ["client_id", "branch_id", "quarter"]
    per_branch = (
        invoices_with_amounts(invoices, invoice_lines)
        .groupBy("client_id", "branch_id", grain("invoice_date", "quarter").alias("quarter"))
        .agg(net().alias("net"), F.count(F.lit(1)).alias("invoices"), F.max("invoice_date").alias("last_invoice"))
    )
    started = (
        assignments.filter(F.col("start_date").isNotNull() & F.col("client_id").isNotNull())
        .groupBy("client_id", "branch_id", grain("start_date", "quarter").alias("quarter"))
        .agg(assignment_count().alias("assignments"))
    )
    quarterly = (
        spine_join(per_branch, started, on=keys)
        .groupBy("client_id", "quarter")
        .agg(
            money(F.sum("net")).alias("net_revenue"),
            F.coalesce(F.sum("assignments"), F.lit(0)).alias("assignments"),
            F.sum("invoices").alias("invoices"),
            F.max("last_invoice").alias("last_invoice"),
        )
    )
    lagged = with_previous(quarterly, ["client_id"], "quarter", ["net_revenue"], 1, "_q1")
    lagged = with_previous(lagged, ["client_id"], "quarter", ["net_revenue"], 4, "_y1")
    lagged = lagged.withColumn("active_quarters_4", active_periods(["client_id"], "quarter", 4))

    def delta(before: str) -> Column:
        return money(F.coalesce(F.col("net_revenue") - F.col(before), F.lit(0)))

    def delta_pct(before: str) -> Column:
        return F.when(F.col(before) > 0, ratio(F.col("net_revenue") - F.col(before), before, 4))

    measured = lagged.withColumns(
        {
            "delta_qoq": delta("net_revenue_q1"),
            "delta_qoq_pct": delta_pct("net_revenue_q1"),
            "delta_yoy": delta("net_revenue_y1"),
            "delta_yoy_pct": delta_pct("net_revenue_y1"),
            "days_inactive": days_between("last_invoice", F.lit(as_of)),
        }
    )
    days, qoq, yoy, freq = (
        F.col(c) for c in ("days_inactive", "delta_qoq_pct", "delta_yoy_pct", "active_quarters_4")
    )
    return (
        measured.withColumns(
            {"churn_risk": churn_label(days, qoq, freq), "churn_score": churn_score(days, qoq, freq, yoy)}
        )
        .drop("net_revenue_q1", "net_revenue_y1")
        .join(clients.select("client_id", "client_sk"), "client_id", "left")
    )


def client_profitability(
    invoices: DataFrame,
    invoice_lines: DataFrame,
    assignments: DataFrame,
    contracts: DataFrame,
    contract_hours: DataFrame,
    clients: DataFrame,
    overhead: float = 0.05,
) -> DataFrame:
    """(client, year): revenue against assignment cost, each aggregated on its own, and the overhead."""
    gross = money(F.sum(F.when(F.col("doc_type") == "F", F.col("amount")).otherwise(F.lit(0))))
    revenue = (
        invoices_with_amounts(invoices, invoice_lines)
        .groupBy("client_id", F.year("invoice_date").alias("year"))
        .agg(net().alias("net_revenue"), gross.alias("gross_revenue"))
    )
    rates = contracts.select("worker_id", "contract_id", "pay_rate", "bill_rate")
    dated = assignments.filter(F.col("client_id").isNotNull() & F.col("start_date").isNotNull())
    costs = (
        spine_join(dated, rates, contract_hours, on=["worker_id", "contract_id"])
        .groupBy("client_id", F.year("start_date").alias("year"))
        .agg(
            money(F.coalesce(F.sum(F.col("hours_billed") * F.col("bill_rate")), F.lit(0)), *WIDE).alias(
                "assignment_revenue"
            ),
            money(F.coalesce(F.sum(F.col("hours_paid") * F.col("pay_rate")), F.lit(0)), *WIDE).alias("payroll_cost"),
            F.count_distinct("worker_id").alias("workers"),
        )
    )
    zero = money(F.lit(0), *WIDE)
    filled = spine_join(revenue, costs, on=["client_id", "year"]).withColumns(
        {
            "assignment_revenue": F.coalesce("assignment_revenue", zero),
            "payroll_cost": F.coalesce("payroll_cost", zero),
            "workers": F.coalesce("workers", F.lit(0)),
            "overhead_cost": money(F.col("gross_revenue") * F.lit(overhead).cast("decimal(4,2)"), 20, 4),
        }
    )
    margin = F.col("assignment_revenue") - F.col("payroll_cost")
    positive = F.col("assignment_revenue") > 0
    return (
        filled.withColumn("gross_margin", money(margin, *WIDE))
        .withColumn("net_profit", money(F.col("gross_margin") - F.col("overhead_cost"), *WIDE))
        .withColumn(
            "margin_rate", F.when(positive, ratio("gross_margin", "assignment_revenue", 4)).otherwise(F.lit(0.0))
        )
        .withColumn(
            "net_profit_rate", F.when(positive, ratio("net_profit", "assignment_revenue", 4)).otherwise(F.lit(0.0))
        )
        .drop("gross_revenue")
        .join(clients.select("client_id", "client_sk"), "client_id", "left")
    )
