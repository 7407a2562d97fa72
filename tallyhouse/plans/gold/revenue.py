"""Revenue marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import count_if, credit, grain, invoiced, money, ratio, round_to, signed
from tallyhouse.operators.dedup import top_per_group
from tallyhouse.operators.distribution import with_mode
from tallyhouse.operators.joins import spine_join
from tallyhouse.operators.windows import percent_rank_of, ranked_values, share_of
from tallyhouse.plans.gold.reference import sector_lookup


def invoice_amounts(invoice_lines: DataFrame) -> DataFrame:
    """Amount and hours per invoice, rebuilt from its lines."""
    return (
        invoice_lines.filter(F.col("invoice_id").isNotNull())
        .groupBy("invoice_id")
        .agg(
            money(F.coalesce(F.sum("amount"), F.lit(0))).alias("amount"),
            money(F.coalesce(F.sum("qty"), F.lit(0)), 12).alias("hours"),
        )
    )


def invoices_with_amounts(invoices: DataFrame, invoice_lines: DataFrame, how: str = "left") -> DataFrame:
    """Dated invoices with amount and hours (0 without lines)."""
    amounts = invoice_amounts(invoice_lines)
    joined = invoices.filter(F.col("invoice_date").isNotNull()).join(amounts, "invoice_id", how)
    return joined.withColumns(
        {
            "amount": money(F.coalesce("amount", F.lit(0))),
            "hours": money(F.coalesce("hours", F.lit(0)), 12),
        }
    )


def net(amount: str = "amount") -> Column:
    return money(F.sum(signed(amount)))


def assignment_count() -> Column:
    """Number of (worker, contract) pairs: assignments hold one row per pair."""
    return F.count(F.lit(1))


#: Keys and sums of the state that the monthly revenue is built from; all sums are additive over invoices.
REVENUE_KEYS = ("client_id", "month", "branch_id")
REVENUE_SUMS = ("revenue", "credited", "invoices", "billed_hours", "documents")


def revenue_by_branch(invoices: DataFrame, invoice_lines: DataFrame) -> DataFrame:
    """(client, month, branch): the additive state of the monthly revenue, and the documents counted for its mode."""
    return (
        invoices_with_amounts(invoices, invoice_lines)
        .groupBy("client_id", grain("invoice_date", "month").alias("month"), "branch_id")
        .agg(
            invoiced("amount").alias("revenue"),
            credit("amount").alias("credited"),
            count_if(F.col("doc_type") == "F").alias("invoices"),
            invoiced("hours").alias("billed_hours"),
            F.count(F.lit(1)).alias("documents"),
        )
    )


def started_by_month(assignments: DataFrame) -> DataFrame:
    """(client, month): assignments that start."""
    return (
        assignments.filter(F.col("start_date").isNotNull())
        .groupBy("client_id", grain("start_date", "month").alias("month"))
        .agg(assignment_count().alias("assignments"))
    )


def monthly_revenue_client(
    invoices: DataFrame, invoice_lines: DataFrame, assignments: DataFrame, clients: DataFrame
) -> DataFrame:
    """(client, month): invoiced, credited, net, documents, hours, mean rate, main branch."""
    return monthly_revenue_from(revenue_by_branch(invoices, invoice_lines), started_by_month(assignments), clients)


def monthly_revenue_from(by_branch: DataFrame, started: DataFrame, clients: DataFrame) -> DataFrame:
    """The monthly revenue from its additive states."""
    keys = ["client_id", "month"]
    monthly = (
        with_mode(by_branch, keys, "branch_id", "documents", "main_branch")
        .groupBy(*keys)
        .agg(
            money(F.sum("revenue")).alias("revenue"),
            money(F.sum("credited")).alias("credited"),
            F.sum("invoices").alias("invoices"),
            money(F.sum("billed_hours"), 12).alias("billed_hours"),
            F.max("main_branch").alias("main_branch"),
        )
    )
    joined = spine_join(monthly, started, on=["client_id", "month"]).join(
        clients.select("client_id", "client_sk"), "client_id", "left"
    )
    return joined.select(
        "client_sk",
        "client_id",
        "month",
        "revenue",
        "credited",
        money(F.col("revenue") - F.col("credited")).alias("net_revenue"),
        "invoices",
        F.coalesce("assignments", F.lit(0)).alias("assignments"),
        "billed_hours",
        ratio("revenue", "billed_hours", 4).alias("mean_rate"),
        "main_branch",
    )


def client_month_net(invoices: DataFrame, invoice_lines: DataFrame) -> DataFrame:
    """(branch, month, client): net revenue."""
    return (
        invoices_with_amounts(invoices.filter(F.col("branch_id").isNotNull()), invoice_lines)
        .groupBy("branch_id", grain("invoice_date", "month").alias("month"), "client_id")
        .agg(net().alias("net_revenue"))
    )


def client_concentration(invoices: DataFrame, invoice_lines: DataFrame) -> DataFrame:
    """(branch, month): share of the top 20 % and of the top 5 clients.

    Works on ranked distinct values with their multiplicity, so no branch is ranked in one task.
    """
    ranked = ranked_values(client_month_net(invoices, invoice_lines), ["branch_id", "month"], "net_revenue")
    in_top20 = percent_rank_of() <= 0.2
    value = F.col("net_revenue") * F.col("members")
    return (
        ranked.groupBy("branch_id", "month")
        .agg(
            F.sum("members").alias("clients"),
            F.sum(F.when(in_top20, F.col("members")).otherwise(0)).alias("clients_top20"),
            money(F.sum(value)).alias("net_total"),
            money(F.sum(F.when(in_top20, value).otherwise(0))).alias("net_top20"),
            money(F.sum(F.when(F.col("dense_rank") <= 5, value).otherwise(0))).alias("net_top5"),
        )
        .withColumn("concentration_top20", ratio("net_top20", "net_total", 4))
        .withColumn("concentration_top5", ratio("net_top5", "net_total", 4))
    )


def client_concentration_topn(monthly_revenue: DataFrame) -> DataFrame:
    """(main branch, month): share of the top 1, 3, 5 and 10 clients and the risk level."""
    group = ["branch_id", "month"]
    per_client = monthly_revenue.groupBy(
        F.col("main_branch").alias("branch_id"), "month", "client_id"
    ).agg(money(F.sum("net_revenue")).alias("net"))
    totals = per_client.groupBy(*group).agg(
        money(F.sum("net")).alias("net_total"), F.count(F.lit(1)).alias("active_clients")
    )
    leaders = top_per_group(per_client, group, [F.col("net").desc_nulls_last(), F.col("client_id").asc()], 10)
    sums = leaders.groupBy(*group).agg(
        *[money(F.sum(F.when(F.col("position") <= n, F.col("net")))).alias(f"net_top{n}") for n in (1, 3, 5, 10)]
    )
    share3 = ratio("net_top3", "net_total")
    same = F.col("a.branch_id").eqNullSafe(F.col("b.branch_id")) & (F.col("a.month") == F.col("b.month"))
    joined = totals.alias("a").join(sums.alias("b"), same).drop(F.col("b.branch_id"), F.col("b.month"))
    return joined.select(
        *group,
        "net_total",
        *[round_to(ratio(f"net_top{n}", "net_total") * 100, 2).alias(f"pct_top{n}") for n in (1, 3, 5, 10)],
        "active_clients",
        F.when(share3 >= 0.70, "CRITIQUE").when(share3 >= 0.50, "ELEVE").otherwise("NORMAL").alias("concentration_risk"),
    )


def sector_revenue(invoices: DataFrame, invoice_lines: DataFrame, clients: DataFrame) -> DataFrame:
    """(branch, month, activity code): revenue split by sector and its share of the branch."""
    group = ["branch_id", "month", "naf_code", "naf_division", "naf_section", "sector_label"]
    dated = invoices.filter(F.col("branch_id").isNotNull() & F.col("client_id").isNotNull())
    per_client = (
        invoices_with_amounts(dated, invoice_lines)
        .groupBy("branch_id", grain("invoice_date", "month").alias("month"), "client_id")
        .agg(net().alias("net_revenue"), count_if(F.col("doc_type") == "F").alias("documents"))
    )
    codes = clients.select("client_id", F.coalesce("naf_code", F.lit("")).alias("naf_code"))
    labelled = per_client.join(codes, "client_id", "left").withColumn("naf_division", F.left("naf_code", F.lit(2)))
    labelled = sector_lookup(labelled, "naf_division")
    sectors = (
        labelled.groupBy(*group)
        .agg(
            F.count(F.lit(1)).alias("clients"),
            money(F.sum("net_revenue")).alias("net_revenue"),
            F.sum("documents").alias("documents"),
        )
        .filter(F.col("net_revenue") > 0)
    )
    return sectors.withColumn("branch_share_pct", round_to(share_of("net_revenue", ["branch_id", "month"]) * 100, 1))


def weekly_revenue_branch(
    invoices: DataFrame, invoice_lines: DataFrame, assignments: DataFrame, branches: DataFrame
) -> DataFrame:
    """(branch, week): revenue, documents, hours and active workers."""
    kind = F.col("doc_type")
    weekly = (
        invoices_with_amounts(invoices, invoice_lines)
        .groupBy("branch_id", grain("invoice_date", "week").alias("week"))
        .agg(
            money(invoiced("amount")).alias("revenue"),
            money(credit("amount")).alias("credited"),
            net().alias("net_revenue"),
            count_if(kind == "F").alias("invoices"),
            count_if(kind == "A").alias("credit_notes"),
            money(F.sum("hours"), 12).alias("billed_hours"),
        )
    )
    active = (
        assignments.filter(F.col("start_date").isNotNull())
        .groupBy("branch_id", grain("start_date", "week").alias("week"))
        .agg(F.count_distinct("worker_id").alias("active_workers"))
    )
    named = spine_join(weekly, active, on=["branch_id", "week"]).join(
        branches.select("branch_id", "branch_name"), "branch_id", "left"
    )
    return named.withColumn("active_workers", F.coalesce("active_workers", F.lit(0)))


def daily_revenue_branch_client(invoices: DataFrame, invoice_lines: DataFrame, assignments: DataFrame) -> DataFrame:
    """(branch, client, day): net revenue, hours and active workers."""
    keys = ["branch_id", "client_id", "day"]
    daily = (
        invoices_with_amounts(invoices, invoice_lines)
        .groupBy("branch_id", "client_id", F.col("invoice_date").alias("day"))
        .agg(net().alias("net_revenue"), money(F.sum("hours"), 12).alias("hours"))
    )
    active = (
        assignments.filter(F.col("start_date").isNotNull())
        .groupBy("branch_id", "client_id", F.col("start_date").alias("day"))
        .agg(F.count_distinct("worker_id").alias("active_workers"))
    )
    return spine_join(daily, active, on=keys).withColumn("active_workers", F.coalesce("active_workers", F.lit(0)))
