"""Assignments, contracts, orders, placements, ends of assignment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import bucketize, days_between, empty_if_null, hours_between
from tallyhouse.plans.silver.common import (
    as_date,
    as_decimal,
    as_int,
    as_long,
    as_timestamp,
    missing,
    newest,
    text,
    with_columns_present,
)

KEY = ["worker_id", "contract_id"]
# Upper bounds in hours of the placement-delay classes.
DELAY_STEPS = ((24, "urgent"), (72, "court"), (168, "standard"))


def contract_spans(raw: DataFrame) -> DataFrame:
    """(worker, contract): first start and last end over all amendments delivered, with their times of day."""
    rows = raw.select(
        *_keys(), as_timestamp("CNTI_DATEFFET").alias("starts_at"), as_timestamp("CNTI_DATEFINCNTI").alias("ends_at")
    )
    return merged_spans(rows)


def merged_spans(spans: DataFrame) -> DataFrame:
    """One span per contract from those of several loads."""
    return spans.groupBy(*KEY).agg(F.min("starts_at").alias("starts_at"), F.max("ends_at").alias("ends_at"))


def _keys():
    return [as_long("PER_ID").alias("worker_id"), as_long("CNT_ID").alias("contract_id")]


def delivered_keys(raw: DataFrame) -> DataFrame:
    """The (worker, contract) of every row delivered, with repeats."""
    return raw.select(*_keys())


def assignment_heads(raw: DataFrame) -> DataFrame:
    """The newest row of every assignment, as `assignments_from` needs it."""
    return newest(
        raw,
        KEY,
        [
            *_keys(),
            as_long("TIE_ID").alias("client_id"),
            as_long("TIES_SERV").alias("site_id"),
            as_long("RGPCNT_ID").alias("branch_id"),
            as_date("MISS_SAISIE_DTFIN").alias("end_date"),
            text("FINMISS_CODE").alias("end_code"),
            as_timestamp("MISS_FLAGDPAE").alias("declared_at"),
            as_long("CMD_ID").alias("order_id"),
        ],
    )


def assignment_end_heads(raw: DataFrame) -> DataFrame:
    """The newest row of every assignment, as `assignment_ends_from` needs it."""
    return newest(
        with_columns_present(raw, {"MISS_ANNULE": "int"}),
        KEY,
        [
            *_keys(),
            as_long("RGPCNT_ID").alias("branch_id"),
            as_long("TIE_ID").alias("client_id"),
            as_date("MISS_SAISIE_DTFIN").alias("entered_end"),
            text("FINMISS_CODE").alias("end_code"),
            as_int("MISS_ANNULE").alias("cancelled"),
        ],
    )


def order_times(raw: DataFrame) -> DataFrame:
    """When every order came in, with its time of day."""
    return newest(raw, ["order_id"], [as_long("CMD_ID").alias("order_id"), as_timestamp("CMD_DTE").alias("ordered_at")])


def assignments_from(heads: DataFrame, spans: DataFrame, times: DataFrame) -> DataFrame:
    """Assignments with first contract start, declaration gap and placement delay."""
    starts = spans.select(*KEY, "starts_at")
    joined = heads.join(starts, KEY, "left").join(times.select("order_id", "ordered_at"), "order_id", "left")
    delay = hours_between("ordered_at", "starts_at")
    return joined.select(
        *KEY,
        "client_id",
        "site_id",
        "branch_id",
        "order_id",
        F.to_date("starts_at").alias("start_date"),
        "end_date",
        "end_code",
        "declared_at",
        hours_between("starts_at", "declared_at").alias("declaration_gap_hours"),
        delay.alias("placement_delay_hours"),
        bucketize(delay, DELAY_STEPS, "long", "inconnu").alias("delay_class"),
        "_batch_id",
        "_loaded_at",
    )


def assignments(raw: DataFrame, raw_contracts: DataFrame, raw_orders: DataFrame) -> DataFrame:
    """Assignments from whole raw tables."""
    return assignments_from(assignment_heads(raw), contract_spans(raw_contracts), order_times(raw_orders))


def contracts(raw: DataFrame) -> DataFrame:
    """Contract amendments."""
    return newest(
        raw,
        [*KEY, "amendment"],
        [
            *_keys(),
            as_int("CNTI_ORDRE").alias("amendment"),
            as_long("MET_ID").alias("trade_id"),
            F.col("PCS_CODE_2003").cast("string").alias("pcs_code"),
            as_date("CNTI_DATEFFET").alias("start_date"),
            as_date("CNTI_DATEFINCNTI").alias("end_date"),
            as_decimal("CNTI_THPAYE", 10, 4).alias("pay_rate"),
            as_decimal("CNTI_THFACT", 10, 4).alias("bill_rate"),
            as_decimal("CNTI_DURHEBDO", 10, 2).alias("weekly_hours"),
            text("CNTI_POSTE").alias("position_label"),
        ],
    )


def orders(raw: DataFrame) -> DataFrame:
    """Client orders; the status is never NULL."""
    return newest(
        raw,
        ["order_id"],
        [
            as_long("CMD_ID").alias("order_id"),
            as_long("RGPCNT_ID").alias("branch_id"),
            as_date("CMD_DTE").alias("order_date"),
            as_int("CMD_NBSALS").alias("headcount"),
            empty_if_null("STAT_CODE").alias("status"),
            empty_if_null("STAT_TYPE").alias("status_type"),
        ],
    )


def placements(raw: DataFrame) -> DataFrame:
    return newest(
        raw,
        ["placement_id"],
        [
            as_long("PLAC_ID").alias("placement_id"),
            as_long("RGPCNT_ID").alias("branch_id"),
            as_long("TIE_ID").alias("client_id"),
            as_long("MET_ID").alias("trade_id"),
            missing("string").alias("status"),
            as_date("PLAC_DTEEDI").alias("placement_date"),
        ],
    )


def end_status_label(cancelled, end_code, reason_closes, reason_label, code_label):
    """Ordered classification: cancelled, still running, normal end, termination; text as fallback."""
    closes = F.lower(reason_label)
    label = F.lower(code_label)
    return (
        F.when(cancelled == 1, "ANNULEE")
        .when(end_code.isNull(), "EN_COURS")
        .when(reason_closes == 0, "EN_COURS")
        .when(closes.like("%fin de mission%"), "TERME_NORMAL")
        .when(reason_closes == 1, "RUPTURE")
        .when(label.like("%terme%") | label.like("%normal%") | label.like("%échéance%"), "TERME_NORMAL")
        .otherwise("RUPTURE")
    )


def assignment_ends(
    raw: DataFrame, raw_contracts: DataFrame, raw_end_codes: DataFrame, raw_reasons: DataFrame
) -> DataFrame:
    """How every assignment ended, from whole raw tables."""
    return assignment_ends_from(assignment_end_heads(raw), contract_spans(raw_contracts), raw_end_codes, raw_reasons)


def assignment_ends_from(
    heads: DataFrame, spans: DataFrame, raw_end_codes: DataFrame, raw_reasons: DataFrame
) -> DataFrame:
    """How every assignment ended, with its real duration."""
    codes = newest(
        raw_end_codes,
        ["end_code"],
        [
            text("FINMISS_CODE").alias("end_code"),
            text("FINMISS_LIBELLE").alias("end_label"),
            as_int("MTFCNT_ID").alias("reason_id"),
        ],
    ).select("end_code", "end_label", "reason_id")
    reasons = newest(
        raw_reasons,
        ["reason_id"],
        [
            as_int("MTFCNT_ID").alias("reason_id"),
            text("MTFCNT_CODE").alias("reason_code"),
            text("MTFCNT_LIBELLE").alias("reason_label"),
            as_int("MTFCNT_FINCNT").alias("reason_closes"),
        ],
    ).select("reason_id", "reason_code", "reason_label", "reason_closes")
    # A few codes name the end of all assignments: they go to the rows, not the rows of one code to one task.
    explained = codes.join(reasons, "reason_id", "left")
    joined = (
        heads.join(spans, KEY, "left")
        .join(F.broadcast(explained), "end_code", "left")
        .withColumns({"start_date": F.to_date("starts_at"), "actual_end": F.to_date("ends_at")})
    )
    return joined.select(
        *KEY,
        "branch_id",
        "client_id",
        "start_date",
        "actual_end",
        "entered_end",
        "end_code",
        "end_label",
        "reason_code",
        "reason_label",
        "reason_closes",
        "cancelled",
        days_between("start_date", "actual_end").alias("actual_days"),
        end_status_label(
            F.col("cancelled"), F.col("end_code"), F.col("reason_closes"), F.col("reason_label"), F.col("end_label")
        ).alias("end_status"),
        "_batch_id",
        "_loaded_at",
    )


def payroll_contracts(raw: DataFrame) -> DataFrame:
    return newest(
        raw,
        KEY,
        [
            *_keys(),
            as_long("ETA_ID").alias("site_id"),
            as_long("RGPCNT_ID").alias("branch_id"),
            as_date("CNT_DATEDEB").alias("start_date"),
            as_date("CNT_DATEFIN").alias("end_date"),
            as_date("CNT_FINPREVU").alias("planned_end"),
            text("LOTPAYE_CODE").alias("payroll_batch"),
            text("TYPCOT_CODE").alias("contribution_type"),
            as_int("CNT_AVT_ORDRE").alias("amendment"),
            as_int("CNT_INI_ORDRE").alias("initial_order"),
        ],
    )


def invoice_links(raw: DataFrame) -> DataFrame:
    """Bridge between invoices and contracts."""
    return newest(
        raw,
        ["contract_id", "invoice_id"],
        [
            as_long("CNT_ID").alias("contract_id"),
            text("FAC_NUM").alias("invoice_id"),
            as_long("PER_ID").alias("worker_id"),
            as_long("TIE_ID").alias("client_id"),
        ],
    )


__all__ = [
    "assignment_end_heads", "assignment_ends", "assignment_ends_from", "assignment_heads", "assignments", "assignments_from", "contract_spans",
    "contracts", "delivered_keys", "end_status_label", "invoice_links", "merged_spans", "order_times", "orders", "payroll_contracts", "placements",
]
