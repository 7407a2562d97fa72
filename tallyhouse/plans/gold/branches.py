"""Branch marts: scorecard, ranking, trends."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import count_if, credit, grain, invoiced, money, ratio, round_to
from tallyhouse.operators.distribution import distinct_count
from tallyhouse.operators.joins import spine_join
from tallyhouse.operators.windows import same_period_last_year, with_previous
from tallyhouse.plans.gold.clients import WIDE
from tallyhouse.plans.gold.revenue import assignment_count, invoices_with_amounts


def branch_scorecard(
    invoices: DataFrame,
    invoice_lines: DataFrame,
    assignments: DataFrame,
    contracts: DataFrame,
    contract_hours: DataFrame,
    orders: DataFrame,
) -> DataFrame:
    """(branch, month) on the invoice spine: revenue, margin, staffing, order conversion."""
    grain_keys = ["branch_id", "month"]
    revenue = (
        invoices_with_amounts(invoices, invoice_lines)
        .groupBy("branch_id", grain("invoice_date", "month").alias("month"))
        .agg((invoiced("amount") - credit("amount")).cast("decimal(18,2)").alias("net_revenue"))
    )
    rates = contracts.select("worker_id", "contract_id", "pay_rate", "bill_rate")
    started = assignments.filter(F.col("start_date").isNotNull()).withColumn("month", grain("start_date", "month"))
    people = distinct_count(started, grain_keys, "worker_id", "active_workers")
    served = distinct_count(started, grain_keys, "client_id", "active_clients")
    staffing = (
        spine_join(started, rates, contract_hours, on=["worker_id", "contract_id"])
        .groupBy(*grain_keys)
        .agg(
            assignment_count().alias("assignments"),
            money(F.coalesce(F.sum(F.col("hours_paid") * F.col("pay_rate")), F.lit(0)), *WIDE).alias("cost"),
            money(F.coalesce(F.sum(F.col("hours_billed") * F.col("bill_rate")), F.lit(0)), *WIDE).alias("billed"),
        )
    )
    conversion = (
        orders.filter(F.col("order_date").isNotNull())
        .groupBy("branch_id", grain("order_date", "month").alias("month"))
        .agg(F.count(F.lit(1)).alias("orders"), count_if(F.col("status").isin("P", "C")).alias("filled_orders"))
    )
    joined = spine_join(revenue, staffing, people, served, conversion, on=grain_keys)
    zero, wide_zero = F.lit(0), money(F.lit(0), *WIDE)
    margin = money(F.coalesce("billed", wide_zero) - F.coalesce("cost", wide_zero), *WIDE)
    return joined.select(
        *grain_keys,
        "net_revenue",
        F.when(F.col("billed") > 0, ratio(F.col("billed") - F.col("cost"), "billed", 4)).otherwise(F.lit(0.0)).alias(
            "margin_rate"
        ),
        margin.alias("gross_margin"),
        *[
            F.coalesce(c, zero).cast("long").alias(c)
            for c in ("active_clients", "active_workers", "assignments", "orders", "filled_orders")
        ],
        ratio("filled_orders", "orders", 4).alias("conversion_rate"),
    )


def branch_ranking(scorecard: DataFrame) -> DataFrame:
    """(branch, month): four ranks and the weighted percent-rank score.

    A month's window holds one row per branch; all windows share one exchange by month.
    """
    month = Window.partitionBy("month")

    def rank(c: str):
        return F.rank().over(month.orderBy(F.col(c).desc_nulls_last()))

    def standing(c: str):
        return F.percent_rank().over(month.orderBy(F.col(c).asc_nulls_first()))

    score = (
        F.lit(0.35) * standing("net_revenue")
        + F.lit(0.25) * standing("margin_rate")
        + F.lit(0.25) * standing("active_workers")
        + F.lit(0.15) * standing("conversion_rate")
    )
    return scorecard.select(
        "branch_id",
        "month",
        "net_revenue",
        "margin_rate",
        "active_workers",
        "conversion_rate",
        rank("net_revenue").alias("rank_revenue"),
        rank("margin_rate").alias("rank_margin"),
        rank("active_workers").alias("rank_placement"),
        rank("conversion_rate").alias("rank_conversion"),
        round_to(score, 4).alias("global_score"),
    )


def branch_trends(scorecard: DataFrame) -> DataFrame:
    """(branch, month): change on the month before and on the same month last year, trend label."""
    measures = ["net_revenue", "margin_rate", "active_workers"]
    base = scorecard.select("branch_id", "month", *measures)
    joined = with_previous(base, ["branch_id"], "month", measures)
    joined = same_period_last_year(joined, ["branch_id"], "month", ["net_revenue", "margin_rate"])

    def change(c: str, before: str):
        return F.col(c) - F.coalesce(F.col(before), F.lit(0))

    deltas = joined.select(
        "branch_id",
        "month",
        *measures,
        money(change("net_revenue", "net_revenue_prev")).alias("delta_revenue_mom"),
        round_to(change("margin_rate", "margin_rate_prev"), 4).alias("delta_margin_mom"),
        change("active_workers", "active_workers_prev").alias("delta_workers_mom"),
        money(change("net_revenue", "net_revenue_last_year")).alias("delta_revenue_yoy"),
        round_to(change("margin_rate", "margin_rate_last_year"), 4).alias("delta_margin_yoy"),
    )
    mom, yoy = F.col("delta_revenue_mom"), F.col("delta_revenue_yoy")
    return deltas.withColumn(
        "trend",
        F.when((mom > 0) & (yoy > 0), "HAUSSE").when((mom < 0) & (yoy < 0), "BAISSE").otherwise("STABLE"),
    )
