"""Query catalogue over the staffing views: gold marts and shared intermediates."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from tallyhouse.plans.gold import (
    assignments as asg,
)
from tallyhouse.plans.gold import (
    branches as brn,
)
from tallyhouse.plans.gold import (
    clients as cli,
)
from tallyhouse.plans.gold import (
    operations as ops,
)
from tallyhouse.plans.gold import (
    receivables as rec,
)
from tallyhouse.plans.gold import (
    reference as ref,
)
from tallyhouse.plans.gold import (
    revenue as rev,
)
from tallyhouse.plans.gold import (
    workforce as wrk,
)
from tallyhouse.plans.silver.loyalty import loyalty
from tallyhouse.plans.staffing import AS_OF, StaffingViews
from tallyhouse.sources.scratch import known_shared


class Marts(StaffingViews):
    """Every mart as a lazy DataFrame; a mart read by another one is planned once."""

    def stored(self, name: str) -> DataFrame:
        """A mart as a stored table of this load."""
        return self.shared(f"mart-{name}", lambda: getattr(self, name))

    def at_hand(self, name: str) -> DataFrame:
        """For a report that reads a mart once: the stored mart if the load has written it, else the lazy one.

        The report's filter then reaches the mart's files or, without them, the tables that the mart is built from.
        """
        known = known_shared(self.spark, self.load, f"mart-{name}")
        return getattr(self, name) if known is None else known

    @cached_property
    def contract_hours(self) -> DataFrame:
        return self.stored("hours_per_contract")

    @cached_property
    def hours_per_contract(self) -> DataFrame:
        return asg.hours_per_contract(self.timesheets, self.timesheet_lines)

    @cached_property
    def monthly_revenue_client(self) -> DataFrame:
        return rev.monthly_revenue_client(self.invoices, self.invoice_lines, self.assignments, self.clients)

    @cached_property
    def branch_scorecard(self) -> DataFrame:
        return brn.branch_scorecard(
            self.invoices,
            self.invoice_lines,
            self.assignments,
            self.contracts,
            self.contract_hours,
            self.placement_orders,
        )

    @cached_property
    def branch_ranking(self) -> DataFrame:
        return brn.branch_ranking(self.branch_scorecard)

    @cached_property
    def branch_trends(self) -> DataFrame:
        return brn.branch_trends(self.branch_scorecard)

    @cached_property
    def assignment_detail(self) -> DataFrame:
        return asg.assignment_detail(self.assignments, self.contracts, self.contract_hours)

    @cached_property
    def profiled_detail(self) -> DataFrame:
        """What the client profiles read of the assignment detail, several times: stored once per load."""
        columns = ["client_id", "worker_id", "branch_id", "trade_id", "start_date", "end_date", "margin_rate"]
        return self.shared("profiled-detail", lambda: self.assignment_detail.select(*columns))

    @cached_property
    def client_360(self) -> DataFrame:
        return cli.client_360(
            self.clients, self.monthly_revenue_client, self.profiled_detail, self.credit_exposures, self.invoices, AS_OF
        )

    @cached_property
    def weekly_revenue_branch(self) -> DataFrame:
        return rev.weekly_revenue_branch(self.invoices, self.invoice_lines, self.assignments, self.branches)

    @cached_property
    def sector_revenue(self) -> DataFrame:
        return rev.sector_revenue(self.invoices, self.invoice_lines, self.clients)

    @cached_property
    def termination_rate(self) -> DataFrame:
        return asg.termination_rate(self.end_status, self.assignments)

    @cached_property
    def assignment_duration(self) -> DataFrame:
        return asg.assignment_duration(self.assignments, self.contracts)

    @cached_property
    def billing_coefficient(self) -> DataFrame:
        return asg.billing_coefficient(self.assignments, self.contracts, self.contract_hours)

    @cached_property
    def renewal_rate(self) -> DataFrame:
        return asg.renewal_rate(self.assignments, self.contracts)

    @cached_property
    def dso_client(self) -> DataFrame:
        return rec.dso_client(self.invoices, self.invoice_lines, self.payments, AS_OF)

    @cached_property
    def aged_balance(self) -> DataFrame:
        return rec.aged_balance(self.invoices, self.invoice_lines, AS_OF)

    @cached_property
    def settlement_facts(self) -> DataFrame:
        return rec.settlement_facts(self.invoices, self.payments, AS_OF)

    @cached_property
    def worker_activity(self) -> DataFrame:
        return wrk.worker_activity(self.assignments, self.contracts, self.contract_hours, self.workers)

    @cached_property
    def pool_loyalty(self) -> DataFrame:
        return loyalty(self.pool_raw, self.pool_assignments, AS_OF).drop("_loaded_at")

    @cached_property
    def pool_dynamics(self) -> DataFrame:
        return wrk.pool_dynamics(self.pool_loyalty, self.pool_portfolio, self.pool_home)

    @cached_property
    def trade_skills(self) -> DataFrame:
        """Trades a worker was billed for, read as active skills."""
        return self.table("lineitem").select(
            F.col("l_suppkey").alias("worker_id"),
            F.lit("METIER").alias("skill_type"),
            F.col("l_partkey").cast("string").alias("code"),
            F.lit(True).alias("is_active"),
        )

    @cached_property
    def skill_availability(self) -> DataFrame:
        return wrk.skill_availability(self.trade_skills, self.workers, self.assignments, self.branches, AS_OF)

    @cached_property
    def event_sheets(self) -> DataFrame:
        """Events read as timesheets of the worker with the same id."""
        home = self.workers.select(F.col("worker_id").alias("user_id"), F.col("home_branch").alias("branch_id"))
        known = self.table("events").join(home, "user_id", "left")
        return known.select(
            F.col("event_id").alias("sheet_id"),
            F.coalesce("branch_id", F.lit(UNKNOWN_BRANCH)).alias("branch_id"),
            F.col("ts").alias("modified_at"),
        )

    @cached_property
    def event_lines(self) -> DataFrame:
        return self.table("events").select(
            F.col("event_id").alias("sheet_id"),
            F.col("event_type").alias("rubric"),
            F.col("value").cast("decimal(10,2)").alias("hours_paid"),
        )


# Branch of the sheets of users without a known home branch.
UNKNOWN_BRANCH = -1
# Event types read as hour rubrics.
EVENT_RUBRICS = {
    "normal_hours": "click,view",
    "overtime_hours": "pur%",
    "night_hours": "s%",
    "sunday_hours": "e%r",
}

Query = Callable[[Marts], DataFrame]

GOLD: dict[str, Query] = {
    "latest_invoice_lines": lambda m: m.invoice_lines,
    "invoice_amounts": lambda m: rev.invoice_amounts(m.invoice_lines),
    "hours_per_contract": lambda m: m.hours_per_contract,
    "assignments_distinct": lambda m: asg.assignments_distinct(m.assignments),
    "monthly_revenue_client": lambda m: m.monthly_revenue_client,
    "weekly_revenue_branch": lambda m: m.weekly_revenue_branch,
    "daily_revenue_branch_client": lambda m: rev.daily_revenue_branch_client(m.invoices, m.invoice_lines, m.assignments),
    "client_concentration": lambda m: rev.client_concentration(m.invoices, m.invoice_lines),
    "client_concentration_topn": lambda m: rev.client_concentration_topn(m.monthly_revenue_client),
    "sector_revenue": lambda m: m.sector_revenue,
    "client_360": lambda m: m.client_360,
    "client_360_light": lambda m: cli.client_360_light(m.monthly_revenue_client, m.clients, m.credit_exposures, AS_OF),
    "client_360_fallback": lambda m: cli.client_360_fallback(
        m.clients, m.monthly_revenue_client, m.profiled_detail, AS_OF
    ),
    "client_retention_light": lambda m: cli.client_retention_light(m.monthly_revenue_client),
    "client_retention": lambda m: cli.client_retention(m.invoices, m.invoice_lines, m.assignments, m.clients, AS_OF),
    "client_profitability": lambda m: cli.client_profitability(
        m.invoices, m.invoice_lines, m.assignments, m.contracts, m.contract_hours, m.clients
    ),
    "branch_scorecard": lambda m: m.branch_scorecard,
    "branch_ranking": lambda m: m.branch_ranking,
    "branch_trends": lambda m: m.branch_trends,
    "fte_weekly": lambda m: ops.fte_weekly(m.timesheets, m.timesheet_lines, m.assignments),
    "weekly_hours": lambda m: ops.weekly_hours(m.timesheets, m.timesheet_lines, m.assignments),
    "weekly_hours_by_rubric": lambda m: ops.weekly_hours_by_rubric(
        m.event_sheets, m.event_lines, ["branch_id"], EVENT_RUBRICS
    ),
    "order_pipeline": lambda m: ops.order_pipeline(m.placement_orders),
    "order_pipeline_detail": lambda m: ops.order_pipeline_detail(m.placement_orders, m.assignments),
    "placement_delay": lambda m: ops.placement_delay(m.assignments),
    "declaration_compliance": lambda m: ops.declaration_compliance(m.assignments),
    "due_weekly": lambda m: rec.due_weekly(m.invoices, m.invoice_lines),
    "dso_client": lambda m: m.dso_client,
    "aged_balance": lambda m: m.aged_balance,
    "aged_balance_wide": lambda m: rec.aged_balance_wide(m.settlement_facts, rev.invoice_amounts(m.invoice_lines)),
    "settlement_stats": lambda m: rec.settlement_stats(m.settlement_facts),
    "termination_rate": lambda m: m.termination_rate,
    "assignment_duration": lambda m: m.assignment_duration,
    "billing_coefficient": lambda m: m.billing_coefficient,
    "renewal_rate": lambda m: m.renewal_rate,
    "worker_activity": lambda m: m.worker_activity,
    "assignment_detail": lambda m: m.assignment_detail,
    "assignment_margin": lambda m: asg.assignment_margin(m.assignments, m.contracts, m.contract_hours),
    "loyalty": lambda m: m.pool_loyalty,
    "loyalty_summary": lambda m: wrk.loyalty_summary(m.pool_loyalty, m.pool_portfolio, m.pool_home),
    "pool_dynamics": lambda m: m.pool_dynamics,
    "key_resolution_coverage": lambda m: wrk.key_resolution_coverage(m.pool_loyalty, m.pool_portfolio, m.pool_home),
    "skill_availability": lambda m: m.skill_availability,
    "branch_staffing": lambda m: wrk.branch_staffing(m.assignments, m.workers, m.placement_orders),
    "branch_pool_weeks": lambda m: wrk.branch_pool_weeks(m.workers, m.assignments),
    "worker_turnover": lambda m: wrk.worker_turnover(m.assignments, AS_OF),
    "calendar_dim": lambda m: ref.calendar_dim(ref.spanned_days(m.table("orders"), "o_orderdate")),
    "sector_ref": lambda m: ref.sector_usage(m.spark, m.clients),
}


def naive_times(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the tables deliver them."""
    zoned = [f.name for f in df.schema.fields if f.dataType == TimestampType()]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


def runner(build: Query, source: type[Marts] = Marts) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: naive_times(build(source(spark, folder)))
