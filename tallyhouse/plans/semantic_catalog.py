"""Query catalogue of the dashboard reports."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.plans import semantic as sem
from tallyhouse.plans.catalog import Marts
from tallyhouse.plans.gold.assignments import status_by_month
from tallyhouse.plans.gold.branches import branch_trends
from tallyhouse.plans.staffing import AS_OF

STATUS_SINCE = date(2000, 1, 1)


def closed(mart: DataFrame) -> DataFrame:
    """Complete months only: the reference day opens a new month."""
    return mart.filter(F.col("month") < F.lit(AS_OF))


def _receivables(m: Marts, sort_by: str, n: int | None = None) -> DataFrame:
    return sem.receivables_report(closed(m.stored("dso_client")), m.clients, m.branches, sort_by, n)


SEMANTIC: dict[str, Callable[[Marts], DataFrame]] = {
    "kpi_cards": lambda m: sem.kpi_cards(closed(m.stored("branch_scorecard"))),
    "top_branches": lambda m: sem.top_branches(closed(m.stored("branch_scorecard")), m.branches, 20),
    "top_branches_heatmap": lambda m: sem.top_branches(closed(m.stored("branch_scorecard")), m.branches, 30),
    "ranking_flags": lambda m: sem.ranking_flags(closed(m.stored("branch_ranking")), m.branches),
    "top10_trend": lambda m: sem.top10_trend(
        branch_trends(m.stored("branch_scorecard")), closed(m.stored("branch_scorecard")), m.branches, AS_OF
    ),
    "delta_top20": lambda m: sem.delta_top20(closed(m.stored("branch_trends")), m.branches),
    "trend_distribution": lambda m: sem.trend_distribution(closed(m.stored("branch_trends"))),
    "duration_heatmap": lambda m: sem.duration_heatmap(m.stored("assignment_duration"), m.branches, m.trades, AS_OF),
    "termination_levels": lambda m: sem.termination_levels(closed(m.stored("termination_rate")), m.branches),
    "duration_mix": lambda m: sem.duration_mix(closed(m.stored("assignment_duration"))),
    "termination_vs_renewal": lambda m: sem.termination_vs_renewal(m.stored("termination_rate"), m.stored("renewal_rate"), AS_OF),
    "coefficient_scatter": lambda m: sem.coefficient_scatter(m.stored("billing_coefficient"), m.trades, AS_OF),
    "coefficient_detail": lambda m: sem.coefficient_detail(
        closed(m.stored("billing_coefficient")), m.branches, m.trades
    ),
    "aged_balance_pivot": lambda m: sem.aged_balance_pivot(closed(m.stored("aged_balance")), m.branches),
    "bucket_split": lambda m: sem.bucket_split(closed(m.stored("aged_balance"))),
    "receivables_detail": lambda m: _receivables(m, "outstanding"),
    "top_overdue_clients": lambda m: _receivables(m, "overdue", 15),
    "receivables_matrix": lambda m: _receivables(m, "outstanding"),
    "dso_top10_trend": lambda m: sem.dso_top10_trend(closed(m.stored("dso_client")), m.branches, AS_OF),
    "renewal_top_clients": lambda m: sem.renewal_top_clients(m.stored("renewal_rate"), m.clients, AS_OF),
    "pool_by_month": lambda m: sem.pool_by_month(m.stored("pool_dynamics"), AS_OF),
    "pool_growth_latest": lambda m: sem.pool_growth_latest(closed(m.stored("pool_dynamics"))),
    "sector_treemap": lambda m: sem.sector_treemap(closed(m.stored("sector_revenue"))),
    "sector_heatmap": lambda m: sem.sector_heatmap(m.stored("sector_revenue"), m.branches, AS_OF),
    "sector_top8_trend": lambda m: sem.sector_top8_trend(m.stored("sector_revenue"), AS_OF),
    "client_risk": lambda m: sem.client_risk(m.stored("client_360")),
    "client_kpis": lambda m: sem.client_kpis(m.stored("client_360")),
    "top_clients": lambda m: sem.top_clients(m.stored("client_360")),
    "churn_split": lambda m: sem.churn_split(m.stored("client_360")),
    "skills_view": lambda m: sem.skills_view(m.stored("skill_availability"), m.trades, m.branches),
    "worker_activity_view": lambda m: sem.worker_activity_view(m.workers, m.stored("worker_activity"), m.branches),
    "worker_activity_anonymous": lambda m: sem.anonymous(
        sem.worker_activity_view(m.workers, m.stored("worker_activity"), m.branches)
    ),
    "threshold_alerts": lambda m: sem.threshold_alerts(
        closed(m.at_hand("dso_client")),
        closed(m.at_hand("aged_balance")),
        closed(m.at_hand("termination_rate")),
        closed(m.at_hand("billing_coefficient")),
    ),
    "load_weekly_revenue": lambda m: sem.load_weekly_revenue(m.at_hand("weekly_revenue_branch"), AS_OF),
    "load_scorecard": lambda m: sem.load_scorecard(m.at_hand("branch_ranking"), AS_OF),
    "load_client_360": lambda m: sem.load_client_360(m.at_hand("client_360")),
    "status_by_month": lambda m: status_by_month(m.end_status, m.assignments, STATUS_SINCE),
}

#: Marts that the load stores for the reports which must answer at once.
LOADED_MARTS = ("weekly_revenue_branch", "branch_ranking", "client_360")


def load_marts(marts: Marts) -> None:
    """The load's part of those reports."""
    for name in LOADED_MARTS:
        marts.stored(name)
