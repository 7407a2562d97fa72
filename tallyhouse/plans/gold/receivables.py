"""Receivables marts: due amounts, DSO, aged balances, settlement statistics."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import (
    bucketize,
    count_if,
    credit,
    days_between,
    grain,
    invoiced,
    money,
    month_days,
    ratio,
    round_to,
    signed,
)
from tallyhouse.operators.distribution import median, with_positions
from tallyhouse.operators.joins import spine_join
from tallyhouse.plans.gold.revenue import invoices_with_amounts, net

AGE_STEPS = ((30, "0-30j"), (60, "31-60j"), (90, "61-90j"))
OLDEST = ">90j"
OPEN_STEPS = ((30, "1_0_30J"), (60, "2_30_60J"), (90, "3_60_90J"))
OLDEST_OPEN = "4_PLUS_90J"


def month_start(as_of: date) -> Column:
    return F.lit(as_of.replace(day=1))


def due_weekly(invoices: DataFrame, invoice_lines: DataFrame) -> DataFrame:
    """(client, branch, due week): invoiced, credited and net amount due; invoices with lines only."""
    due = invoices.dropna(subset=["due_date", "client_id", "branch_id"])
    return (
        invoices_with_amounts(due, invoice_lines, "inner")
        .groupBy("client_id", "branch_id", grain("due_date", "week").alias("week"))
        .agg(
            money(invoiced("amount")).alias("invoiced"),
            money(credit("amount")).alias("credited"),
            net().alias("net_due"),
            count_if(F.col("doc_type") == "F").alias("invoices"),
        )
    )


def dso_client(invoices: DataFrame, invoice_lines: DataFrame, payments: DataFrame, as_of: date) -> DataFrame:
    """(branch, client, month): outstanding, DSO in days, overdue at the start of the current month.

    Revenue and overdue come from one pass over the invoices.
    """
    keys = ["branch_id", "client_id", "month"]
    known = invoices.dropna(subset=["branch_id", "client_id"])
    overdue = F.when(F.col("due_date") < month_start(as_of), signed("amount")).otherwise(F.lit(0))
    monthly = (
        invoices_with_amounts(known, invoice_lines, "inner")
        .groupBy("branch_id", "client_id", grain("invoice_date", "month").alias("month"))
        .agg(
            net().alias("net"),
            count_if(F.col("doc_type") == "F").alias("open_invoices"),
            money(F.sum(overdue)).alias("overdue"),
        )
    )
    paid = (
        payments.dropna(subset=["paid_date", "branch_id", "client_id"])
        .groupBy("branch_id", "client_id", grain("paid_date", "month").alias("month"))
        .agg(money(F.sum(F.coalesce("amount_paid", F.lit(0)))).alias("paid"))
    )
    per_day = ratio("net", month_days("month"))
    outstanding = money(F.col("net") - F.coalesce("paid", F.lit(0)))
    return (
        spine_join(monthly, paid, on=keys)
        .withColumn("outstanding", outstanding)
        .select(
            *keys,
            "outstanding",
            round_to(ratio("outstanding", per_day), 1).alias("dso_days"),
            "open_invoices",
            "overdue",
        )
    )


def aged_balance(invoices: DataFrame, invoice_lines: DataFrame, as_of: date) -> DataFrame:
    """(branch, month, bucket): overdue amounts by age at the start of the current month."""
    snapshot = month_start(as_of)
    overdue = invoices.filter((F.col("due_date") < snapshot) & F.col("branch_id").isNotNull())
    age = days_between("due_date", snapshot)
    return (
        invoices_with_amounts(overdue, invoice_lines, "inner")
        .groupBy(
            "branch_id",
            grain("invoice_date", "month").alias("month"),
            bucketize(age, AGE_STEPS, OLDEST).alias("bucket"),
        )
        .agg(net().alias("overdue"), F.count(F.lit(1)).alias("documents"))
    )


def settlement_facts(invoices: DataFrame, payments: DataFrame, as_of: date) -> DataFrame:
    """Invoices (no credit notes) with settlement status, days to pay and age bucket."""
    today = F.lit(as_of)
    paid, due = F.col("paid_date"), F.col("due_date")
    late = F.coalesce(days_between("due_date", "paid_date"), days_between("due_date", today))
    dated = invoices.filter((F.col("doc_type") == "F") & F.col("invoice_date").isNotNull())
    return dated.join(payments.select("invoice_id", "paid_date"), "invoice_id", "left").select(
        "invoice_id",
        "branch_id",
        "client_id",
        "invoice_date",
        days_between("invoice_date", "paid_date").alias("days_to_pay"),
        late.alias("late_days"),
        F.when(paid <= due, "REGLE_A_TEMPS")
        .when(paid > due, "REGLE_EN_RETARD")
        .when(today <= due, "EN_COURS")
        .when(today > due, "EN_RETARD")
        .otherwise("INCONNU")
        .alias("settlement"),
        F.when(paid.isNotNull(), "REGLE")
        .when(today <= due, "0_NON_ECHU")
        .otherwise(
            bucketize(days_between("due_date", today), OPEN_STEPS, OLDEST_OPEN, OLDEST_OPEN)
        )
        .alias("age_bucket"),
    )


def settlement_stats(facts: DataFrame) -> DataFrame:
    """(branch, client, month): settled, late, mean and median days to pay, level."""
    keys = ["branch_id", "client_id", "month"]
    days, late = F.col("days_to_pay"), F.col("late_days")
    late_only = F.when(late > 0, late)
    counted = facts.groupBy(
        "branch_id", "client_id", grain("invoice_date", "month").alias("month"), "days_to_pay"
    ).agg(
        F.count(F.lit(1)).alias("n"),
        count_if(F.col("settlement").like("REGLE%")).alias("settled"),
        count_if(F.col("settlement").isin("EN_RETARD", "REGLE_EN_RETARD")).alias("late"),
        F.sum(late_only).alias("late_sum"),
        F.count(late_only).alias("late_n"),
    )
    dated = F.sum(F.when(days.isNotNull(), F.col("n")).otherwise(F.lit(0)))
    mean_days = F.sum(days * F.col("n")).cast("double") / F.nullif(dated, F.lit(0))
    return with_positions(counted, keys, "days_to_pay", "n").groupBy(*keys).agg(
        F.sum("n").alias("invoices"),
        F.sum("settled").alias("settled"),
        F.sum("late").alias("late"),
        round_to(mean_days, 0).alias("mean_days_to_pay"),
        round_to(median("days_to_pay"), 0).alias("median_days_to_pay"),
        round_to(F.sum("late_sum").cast("double") / F.nullif(F.sum("late_n"), F.lit(0)), 0).alias("mean_late_days"),
        F.when(mean_days <= 30, "BON").when(mean_days <= 45, "MOYEN").otherwise("CRITIQUE").alias("payment_level"),
    )


def aged_balance_wide(facts: DataFrame, amounts: DataFrame) -> DataFrame:
    """(branch, client): open amounts by age in columns, share over 60 days, risk level."""
    open_items = facts.filter(F.col("settlement").isin("EN_COURS", "EN_RETARD"))
    items = open_items.join(amounts.select("invoice_id", "amount"), "invoice_id")
    bucket = F.col("age_bucket")

    def total(*labels: str) -> Column:
        return money(F.sum(F.when(bucket.isin(*labels), F.col("amount")).otherwise(F.lit(0))))

    wide = items.groupBy("branch_id", "client_id").agg(
        total("0_NON_ECHU").alias("not_due"),
        total("1_0_30J").alias("due_0_30"),
        total("2_30_60J").alias("due_31_60"),
        total("3_60_90J").alias("due_61_90"),
        total("4_PLUS_90J").alias("due_over_90"),
        money(F.sum("amount")).alias("open_total"),
    )
    old = ratio(F.col("due_61_90") + F.col("due_over_90"), "open_total")
    return wide.withColumn("old_share_pct", round_to(old * 100, 1)).withColumn(
        "risk_level",
        F.when(ratio("due_over_90", "open_total") > 0.20, "LITIGIEUX").when(old > 0.30, "A_RISQUE").otherwise("NORMAL"),
    )
