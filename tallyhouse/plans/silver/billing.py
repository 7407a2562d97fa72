"""Timesheets, invoices, invoice lines and payments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import days_between
from tallyhouse.operators.joins import horizon_join
from tallyhouse.plans.silver.common import (
    as_date,
    as_decimal,
    as_int,
    as_long,
    as_timestamp,
    missing,
    newest,
    text,
)


def timesheets(raw: DataFrame) -> DataFrame:
    """Timesheet heads; the branch is not delivered and is resolved through the assignment."""
    return newest(
        raw,
        ["sheet_id"],
        [
            as_long("PRH_BTS").alias("sheet_id"),
            as_long("PER_ID").alias("worker_id"),
            as_long("CNT_ID").alias("contract_id"),
            as_long("TIE_ID").alias("client_id"),
            missing("long").alias("branch_id"),
            as_timestamp("PRH_MODIFDATE").alias("modified_at"),
            F.col("PRH_FLAG_RH").try_cast("boolean").alias("valid"),
        ],
    )


def timesheet_lines(raw: DataFrame) -> DataFrame:
    """Timesheet lines; they carry no worker id on purpose."""
    return newest(
        raw,
        ["sheet_id", "line_no"],
        [
            as_long("PRH_BTS").alias("sheet_id"),
            as_int("RHD_LIGNE").alias("line_no"),
            text("RHD_ORIRUB").alias("rubric"),
            as_decimal("RHD_BASEP", 10, 2).alias("hours_paid"),
            as_decimal("RHD_TAUXP", 10, 4).alias("pay_rate"),
            as_decimal("RHD_BASEF", 10, 2).alias("hours_billed"),
            as_decimal("RHD_TAUXF", 10, 4).alias("bill_rate"),
            text("RHD_LIBRUB").alias("label"),
        ],
    )


def invoices(raw: DataFrame) -> DataFrame:
    """Invoice heads; amounts are rebuilt from the lines downstream."""
    return newest(
        raw,
        ["invoice_id"],
        [
            text("EFAC_NUM").alias("invoice_id"),
            as_long("RGPCNT_ID").alias("branch_id"),
            as_long("TIE_ID").alias("client_id"),
            as_long("TIES_SERV").alias("site_id"),
            text("EFAC_TYPF").alias("doc_type"),
            as_date("EFAC_DTEEDI").alias("invoice_date"),
            as_date("EFAC_DTEECH").alias("due_date"),
            missing("decimal(18,2)").alias("amount_net"),
            missing("decimal(18,2)").alias("amount_gross"),
            as_decimal("EFAC_TAUXTVA", 6, 4).alias("vat_rate"),
        ],
    )


def invoice_lines(raw: DataFrame) -> DataFrame:
    return newest(
        raw,
        ["invoice_id", "line_no"],
        [
            text("FAC_NUM").alias("invoice_id"),
            as_int("LFAC_ORD").alias("line_no"),
            text("LFAC_LIB").alias("label"),
            as_decimal("LFAC_BASE", 10, 2).alias("qty"),
            as_decimal("LFAC_TAUX", 10, 4).alias("rate"),
            as_decimal("LFAC_MNT", 18, 2).alias("amount"),
        ],
    )


def invoice_lines_since(lines: DataFrame, invoice_heads: DataFrame, since) -> DataFrame:
    """Lines of the invoices dated on or after the horizon."""
    return horizon_join(lines, invoice_heads, {"invoice_id": "invoice_id"}, "invoice_date", since)


def payments(raw: DataFrame, invoice_heads: DataFrame) -> DataFrame:
    """Settlement date per invoice and its delay on the due date."""
    paid = newest(
        raw,
        ["invoice_id"],
        [
            text("EFAC_NUM").alias("invoice_id"),
            as_long("TIE_ID").alias("client_id"),
            as_long("RGPCNT_ID").alias("branch_id"),
            as_date("EFAC_DTEREGLF").alias("paid_date"),
        ],
    )
    due = invoice_heads.select("invoice_id", "due_date")
    return paid.join(due, "invoice_id", "left").select(
        "invoice_id",
        "client_id",
        "branch_id",
        "paid_date",
        missing("decimal(18,2)").alias("amount_paid"),
        missing("string").alias("payment_type"),
        days_between("due_date", "paid_date").alias("delay_days"),
        "_loaded_at",
    )
