"""SQL of the dashboard reports."""

from __future__ import annotations

from oracle.gold import AS_OF


def latest(view: str) -> str:
    """The newest complete month."""
    return f"month = (SELECT MAX(month) FROM {view} WHERE month < {AS_OF})"


def mean(c: str, digits: int) -> str:
    return f"ROUND(SUM(({c})::DECIMAL(30,6))::DOUBLE / NULLIF(COUNT({c}), 0), {digits})"


def recent(months: int) -> str:
    return f"month >= ({AS_OF} - INTERVAL {months} MONTH)"


MONTHLY = f"""SELECT month, COUNT(DISTINCT branch_id) AS branches, SUM(net_revenue)::DECIMAL(18,2) AS net_revenue,
  {mean('margin_rate', 4)} AS mean_margin_rate, {mean('conversion_rate', 4)} AS mean_conversion_rate FROM m_scorecard GROUP BY 1"""
RECEIVABLES = """
SELECT c.client_name, b.branch_name, outstanding, overdue, dso_days, open_invoices
FROM m_dso d JOIN v_branches b ON b.branch_id = d.branch_id JOIN v_clients c ON c.client_id = d.client_id
WHERE month = (SELECT MAX(month) FROM m_dso WHERE month < DATE '2001-08-01') AND {by} > 0
ORDER BY {by} DESC, c.client_name, b.branch_name"""
TOP_BRANCHES = f"""
SELECT branch_name, month, net_revenue, margin_rate, active_clients, active_workers, conversion_rate
FROM m_scorecard s JOIN v_branches b ON b.branch_id = s.branch_id WHERE {latest('m_scorecard')}
ORDER BY net_revenue DESC, branch_name LIMIT {{n}}"""
ACTIVITY = f"""
SELECT w.worker_sk, w.worker_id, w.worker_name, w.is_active, w.home_branch, COALESCE(a.assignments, 0)::BIGINT AS assignments,
  COALESCE(a.occupancy, 0)::DOUBLE AS occupancy, COALESCE(a.revenue, 0)::DECIMAL(24,6) AS revenue, b.branch_name
FROM v_workers w LEFT JOIN (SELECT worker_id, SUM(assignments)::BIGINT AS assignments, {mean('occupancy', 4)} AS occupancy,
  SUM(revenue) AS revenue FROM m_activity GROUP BY 1) a ON a.worker_id = w.worker_id
LEFT JOIN v_branches b ON b.branch_id = w.home_branch WHERE w.is_active"""


def alert(name: str, value: str, view: str, test: str, extra: str = "") -> str:
    threshold = test.split()[1]
    return f"""SELECT '{name}' AS alert, observed, {threshold}::DOUBLE AS threshold, COALESCE(observed {test}, FALSE) AS fired
FROM (SELECT ({value})::DOUBLE AS observed FROM {view} WHERE {latest(view)}{extra})"""


QUERIES = {
    "kpi_cards": f"""
SELECT c.*, p.branches AS branches_before, p.net_revenue AS net_revenue_before, p.mean_margin_rate AS mean_margin_rate_before,
  p.mean_conversion_rate AS mean_conversion_rate_before
FROM ({MONTHLY}) c LEFT JOIN ({MONTHLY}) p ON p.month = (c.month - INTERVAL 1 MONTH)
WHERE c.{latest('m_scorecard')}""",
    "top_branches": TOP_BRANCHES.format(n=20),
    "top_branches_heatmap": TOP_BRANCHES.format(n=30),
    "ranking_flags": f"""
SELECT branch_name, brand, sector, rank_revenue, rank_margin, rank_placement, rank_conversion, global_score,
  CASE WHEN global_score >= 0.75 THEN '🟢' WHEN global_score >= 0.50 THEN '🟡' WHEN global_score >= 0.25 THEN '🟠' ELSE '🔴' END AS performance,
  ROW_NUMBER() OVER (ORDER BY global_score DESC, branch_name) AS display_rank
FROM m_ranking r JOIN v_branches b ON b.branch_id = r.branch_id WHERE {latest('m_ranking')}""",
    "top10_trend": f"""
SELECT branch_name, month, net_revenue, trend FROM m_trends t JOIN v_branches b ON b.branch_id = t.branch_id
WHERE {recent(12)} AND t.branch_id IN (SELECT branch_id FROM m_scorecard WHERE {latest('m_scorecard')}
  ORDER BY net_revenue DESC, branch_id LIMIT 10)""",
    "delta_top20": f"""
SELECT branch_name, delta_revenue_mom, delta_revenue_yoy, trend FROM m_trends t JOIN v_branches b ON b.branch_id = t.branch_id
WHERE {latest('m_trends')} ORDER BY net_revenue DESC, branch_name LIMIT 20""",
    "trend_distribution": f"SELECT trend, COUNT(*) AS branches FROM m_trends WHERE {latest('m_trends')} GROUP BY 1",
    "duration_heatmap": f"""
SELECT branch_name, p_type AS trade_name, {mean('mean_days', 1)} AS mean_days, SUM(assignments)::BIGINT AS assignments
FROM m_duration d JOIN v_branches b ON b.branch_id = d.branch_id JOIN part ON p_partkey = d.trade_id WHERE {recent(3)}
GROUP BY 1, 2 ORDER BY SUM(assignments) DESC, branch_name, trade_name""",
    "termination_levels": f"""
SELECT branch_name, client_id, termination_pct, assignments, terminations,
  CASE WHEN termination_pct <= 5 THEN 'BON' WHEN termination_pct <= 10 THEN 'MOYEN' ELSE 'ELEVE' END AS risk_level
FROM m_termination t JOIN v_branches b ON b.branch_id = t.branch_id WHERE {latest('m_termination')}
ORDER BY termination_pct DESC, branch_name, client_id""",
    "duration_mix": f"""
SELECT duration_profile, SUM(assignments)::BIGINT AS assignments,
  ROUND(SUM(assignments)::DOUBLE / SUM(SUM(assignments)) OVER () * 100, 1) AS pct
FROM m_duration WHERE {latest('m_duration')} GROUP BY 1""",
    "termination_vs_renewal": f"""
SELECT t.month, ROUND(SUM(t.s)::DOUBLE / SUM(t.n), 1) AS termination_pct, ROUND(SUM(r.s)::DOUBLE / NULLIF(SUM(r.n), 0), 1) AS renewal_pct
FROM (SELECT branch_id, month, SUM(termination_pct::DECIMAL(30,6)) AS s, COUNT(termination_pct) AS n FROM m_termination GROUP BY 1, 2) t
LEFT JOIN (SELECT branch_id, month, SUM(renewal_pct::DECIMAL(30,6)) AS s, COUNT(renewal_pct) AS n FROM m_renewal GROUP BY 1, 2) r
  ON r.branch_id = t.branch_id AND r.month = t.month
WHERE t.{recent(12)} GROUP BY 1""",
    "coefficient_scatter": f"""
SELECT p_type AS trade_name, coefficient_level, {mean('weighted_coefficient', 3)} AS mean_coefficient, SUM(assignments)::BIGINT AS assignments,
  {mean('mean_bill_rate', 2)} AS mean_bill_rate, {mean('coefficient_margin_pct', 1)} AS margin_pct
FROM m_coefficient JOIN part ON p_partkey = trade_id WHERE {recent(3)} GROUP BY 1, 2
ORDER BY SUM(assignments) DESC, trade_name, coefficient_level""",
    "coefficient_detail": f"""
SELECT branch_name, client_id, p_type AS trade_name, weighted_coefficient, mean_bill_rate, mean_pay_rate, coefficient_margin_pct,
  assignments, coefficient_level
FROM m_coefficient c JOIN v_branches b ON b.branch_id = c.branch_id JOIN part ON p_partkey = trade_id WHERE {latest('m_coefficient')}""",
    "aged_balance_pivot": f"""
SELECT branch_name, (SUM(overdue) FILTER (WHERE bucket = '0-30j'))::DECIMAL(18,2) AS overdue_0_30,
  (SUM(overdue) FILTER (WHERE bucket = '31-60j'))::DECIMAL(18,2) AS overdue_31_60,
  (SUM(overdue) FILTER (WHERE bucket = '61-90j'))::DECIMAL(18,2) AS overdue_61_90,
  (SUM(overdue) FILTER (WHERE bucket = '>90j'))::DECIMAL(18,2) AS overdue_over_90, SUM(overdue)::DECIMAL(18,2) AS overdue_total
FROM m_aged a JOIN v_branches b ON b.branch_id = a.branch_id WHERE {latest('m_aged')}
GROUP BY 1 ORDER BY SUM(overdue) DESC, branch_name""",
    "bucket_split": f"SELECT bucket, SUM(overdue)::DECIMAL(18,2) AS overdue FROM m_aged WHERE {latest('m_aged')} GROUP BY 1",
    "receivables_detail": RECEIVABLES.format(by="outstanding"),
    "top_overdue_clients": RECEIVABLES.format(by="overdue") + " LIMIT 15",
    "receivables_matrix": RECEIVABLES.format(by="outstanding"),
    "dso_top10_trend": f"""
SELECT branch_name, month, {mean('dso_days', 1)} AS dso_days FROM m_dso d JOIN v_branches b ON b.branch_id = d.branch_id
WHERE {recent(12)} AND month < {AS_OF} AND d.branch_id IN (SELECT branch_id FROM m_dso WHERE {latest('m_dso')} GROUP BY 1
  ORDER BY {mean('dso_days', 6)} DESC, branch_id LIMIT 10) GROUP BY 1, 2""",
    "renewal_top_clients": f"""
SELECT DISTINCT client_name, renewal_pct, assignments, renewals FROM m_renewal r JOIN v_clients c ON c.client_id = r.client_id
WHERE {recent(3)} ORDER BY renewal_pct DESC, assignments DESC, client_name, renewals LIMIT 20""",
    "pool_by_month": f"""
SELECT month, SUM(joiners)::BIGINT AS joiners, SUM(leavers)::BIGINT AS leavers, SUM(net_growth)::BIGINT AS net_growth,
  SUM(active_pool)::BIGINT AS active_pool FROM m_pool WHERE {recent(12)} GROUP BY 1""",
    "pool_growth_latest": f"SELECT SUM(net_growth)::BIGINT AS net_growth FROM m_pool WHERE {latest('m_pool')}",
    "sector_treemap": f"""
SELECT sector_label, SUM(net_revenue)::DECIMAL(18,2) AS net_revenue, SUM(clients)::BIGINT AS clients, SUM(documents)::BIGINT AS documents
FROM m_sector WHERE {latest('m_sector')} GROUP BY 1""",
    "sector_heatmap": f"""
SELECT branch_name, sector_label, SUM(net_revenue)::DECIMAL(18,2) AS net_revenue, {mean('branch_share_pct', 1)} AS share_pct
FROM m_sector s JOIN v_branches b ON b.branch_id = s.branch_id WHERE {recent(3)} GROUP BY 1, 2""",
    "sector_top8_trend": f"""
SELECT month, sector_label, SUM(net_revenue)::DECIMAL(18,2) AS net_revenue FROM m_sector WHERE {recent(12)}
  AND sector_label IN (SELECT sector_label FROM m_sector GROUP BY 1 ORDER BY SUM(net_revenue) DESC, sector_label LIMIT 8)
GROUP BY 1, 2""",
    "client_risk": """
SELECT client_id, client_name, city, revenue_ytd, revenue_growth_pct, active_assignments, churn_risk, credit_risk,
  CASE WHEN credit_risk = 'HIGH' OR churn_risk = 'HIGH' THEN '🔴 Critique'
       WHEN credit_risk = 'MEDIUM' OR churn_risk = 'MEDIUM' THEN '🟠 Attention' ELSE '🟢 OK' END AS global_risk FROM m_client_360""",
    "client_kpis": f"""
SELECT COUNT(*) AS clients, SUM(revenue_ytd)::DECIMAL(18,2) AS revenue_ytd, SUM(active_assignments)::BIGINT AS active_assignments,
  SUM(active_workers)::BIGINT AS active_workers, {mean('mean_margin_rate', 4)} AS mean_margin_rate FROM m_client_360""",
    "top_clients": """
SELECT client_name, revenue_12m, mean_margin_rate, assignments, credit_risk, city FROM m_client_360
ORDER BY revenue_12m DESC, client_name LIMIT 20""",
    "churn_split": "SELECT churn_risk, COUNT(*) AS clients FROM m_client_360 GROUP BY 1",
    "skills_view": """
SELECT a.*, p.p_type AS trade_name, p.p_brand AS qualification, b.branch_name, b.brand, b.sector
FROM m_skills_available a LEFT JOIN part p ON MD5(p.p_partkey::VARCHAR) = a.trade_sk
LEFT JOIN v_branches b ON b.branch_sk = a.branch_sk""",
    "worker_activity_view": ACTIVITY,
    "worker_activity_anonymous": ACTIVITY.replace("w.worker_name, ", ""),
    "threshold_alerts": " UNION ALL ".join(
        [
            alert("dso", mean("dso_days", 4), "m_dso", "> 45"),
            alert("overdue_over_90", "SUM(overdue)", "m_aged", "> 50000", " AND bucket = '>90j'"),
            alert("termination", mean("termination_pct", 4), "m_termination", "> 10"),
            alert("coefficient", mean("weighted_coefficient", 4), "m_coefficient", "< 1.25"),
        ]
    ),
    "load_weekly_revenue": f"""
SELECT branch_id, week, SUM(net_revenue)::DECIMAL(18,2) AS net_revenue FROM m_weekly_revenue
WHERE week >= ({AS_OF} - 84) GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2""",
    "load_scorecard": f"""
SELECT branch_id, month, net_revenue, margin_rate, global_score FROM m_ranking WHERE {recent(1)}
ORDER BY global_score DESC, branch_id, month""",
    "load_client_360": """
SELECT client_name, revenue_ytd, active_assignments, churn_risk FROM m_client_360 WHERE churn_risk <> 'LOW'
ORDER BY revenue_ytd DESC, client_name""",
    "status_by_month": """
SELECT a.branch_id, DATE_TRUNC('month', a.start_date)::DATE AS month, e.end_status, COUNT(*) AS assignments
FROM v_end_status e JOIN v_assignments a ON a.worker_id = e.worker_id AND a.contract_id = e.contract_id
WHERE a.start_date >= DATE '2000-01-01' GROUP BY 1, 2, 3""",
}
