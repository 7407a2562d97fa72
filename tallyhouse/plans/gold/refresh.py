"""Marts kept up to date from what a load changed: the monthly revenue, and the placement delays with their medians.

Before a load the contributions of the invoices and assignments that it will touch are noted, after it they are computed again;
the difference is added to the stored states of the months concerned.  Neither unchanged rows nor other months are read.
A median needs the counts of all its values, and these are a state like any other.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tallyhouse.operators.additive import signed_change
from tallyhouse.plans.gold import operations as ops
from tallyhouse.plans.gold import revenue as rev
from tallyhouse.sources.partitioned import Layout, by_key, by_month, rows_of
from tallyhouse.sources.states import MonthlyState

INVOICES, INVOICE_LINES = by_month("invoice_date"), by_key(["invoice_id"])
STARTED_KEYS, STARTED_SUMS = ("client_id", "month"), ("assignments",)


@dataclass(frozen=True)
class Billed:
    """The stored invoices and lines, of which only those of some invoices are read."""

    spark: SparkSession
    invoices_path: str
    lines_path: str
    invoices: StructType
    lines: StructType
    heads_layout: Layout = INVOICES
    lines_layout: Layout = INVOICE_LINES

    def contributions(self, ids: DataFrame) -> DataFrame:
        """What the invoices of some ids add to the state of the monthly revenue."""
        heads = rows_of(self.spark, self.invoices_path, ids, ["invoice_id"], self.heads_layout, self.invoices)
        lines = rows_of(self.spark, self.lines_path, ids, ["invoice_id"], self.lines_layout, self.lines)
        return rev.revenue_by_branch(heads, lines)


def revenue_state(root: str) -> MonthlyState:
    return MonthlyState(f"{root}/state_revenue_by_branch", rev.REVENUE_KEYS, rev.REVENUE_SUMS)


def started_state(root: str) -> MonthlyState:
    return MonthlyState(f"{root}/state_started_by_month", STARTED_KEYS, STARTED_SUMS)


def delay_state(root: str) -> MonthlyState:
    return MonthlyState(f"{root}/state_placement_delays", ops.DELAY_KEYS, ops.DELAY_SUMS, month="week")


def refresh(state: MonthlyState, before: DataFrame, after: DataFrame, load: int) -> list[str]:
    """Add the difference of two states of the same rows; returns the months rewritten."""
    return state.apply(signed_change(before, after, state.keys, state.sums), load)


def monthly_revenue(spark: SparkSession, root: str, by_branch: StructType, started: StructType, clients: DataFrame) -> DataFrame:
    """The mart from the stored states."""
    revenue, starts = revenue_state(root).read(spark, by_branch), started_state(root).read(spark, started)
    return rev.monthly_revenue_from(revenue, starts, clients)


def placement_delays(spark: SparkSession, root: str, counted: StructType) -> DataFrame:
    """The mart from the stored counts."""
    return ops.placement_delay_from(delay_state(root).read(spark, counted))
