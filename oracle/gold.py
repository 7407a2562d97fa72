"""SQL of the gold marts."""

AS_OF = "DATE '2001-08-01'"


def div(num: str, den: str) -> str:
    return f"(({num})::DOUBLE / NULLIF(({den})::DOUBLE, 0))"


def ratio(num: str, den: str, digits: int) -> str:
    return f"ROUND({div(num, den)}, {digits})"


def month(c: str) -> str:
    return f"DATE_TRUNC('month', {c})::DATE"


def week(c: str) -> str:
    return f"DATE_TRUNC('week', {c})::DATE"


VIEWS = {
    "m_monthly_revenue": f"""
SELECT c.client_sk, r.client_id, r.month, revenue, credited, (revenue - credited)::DECIMAL(18,2) AS net_revenue, invoices,
  COALESCE(a.assignments, 0) AS assignments, billed_hours, {ratio('revenue', 'billed_hours', 4)} AS mean_rate, b.main_branch
FROM (SELECT client_id, {month('invoice_date')} AS month,
        SUM(CASE WHEN doc_type = 'F' THEN amount ELSE 0 END)::DECIMAL(18,2) AS revenue,
        SUM(CASE WHEN doc_type = 'A' THEN amount ELSE 0 END)::DECIMAL(18,2) AS credited,
        COUNT(DISTINCT CASE WHEN doc_type = 'F' THEN invoice_id END) AS invoices,
        SUM(CASE WHEN doc_type = 'F' THEN hours ELSE 0 END)::DECIMAL(12,2) AS billed_hours
      FROM v_billed GROUP BY 1, 2) r
LEFT JOIN (SELECT client_id, month, branch_id AS main_branch FROM (
        SELECT client_id, month, branch_id, ROW_NUMBER() OVER (PARTITION BY client_id, month ORDER BY n DESC, branch_id) AS rn
        FROM (SELECT client_id, {month('invoice_date')} AS month, branch_id, COUNT(*) AS n FROM v_billed GROUP BY 1, 2, 3))
      WHERE rn = 1) b ON b.client_id = r.client_id AND b.month = r.month
LEFT JOIN (SELECT client_id, {month('start_date')} AS month, COUNT(DISTINCT worker_id || '|' || contract_id) AS assignments
      FROM v_assignments GROUP BY 1, 2) a ON a.client_id = r.client_id AND a.month = r.month
LEFT JOIN v_clients c ON c.client_id = r.client_id""",
    "m_client_month": f"""
SELECT branch_id, {month('invoice_date')} AS month, client_id, SUM(signed_amount)::DECIMAL(18,2) AS net_revenue,
  COUNT(*) FILTER (WHERE doc_type = 'F') AS documents
FROM v_billed GROUP BY 1, 2, 3""",
    "m_scorecard": f"""
SELECT ca.branch_id, ca.month, ca.net_revenue,
  CASE WHEN billed > 0 THEN {ratio('billed - cost', 'billed', 4)} ELSE 0 END::DOUBLE AS margin_rate,
  (COALESCE(billed, 0) - COALESCE(cost, 0))::DECIMAL(24,6) AS gross_margin,
  COALESCE(active_clients, 0) AS active_clients, COALESCE(active_workers, 0) AS active_workers,
  COALESCE(s.assignments, 0) AS assignments, COALESCE(t.orders, 0) AS orders,
  COALESCE(t.filled_orders, 0) AS filled_orders, {ratio('t.filled_orders', 't.orders', 4)} AS conversion_rate
FROM (SELECT branch_id, {month('invoice_date')} AS month, SUM(signed_amount)::DECIMAL(18,2) AS net_revenue
      FROM v_billed GROUP BY 1, 2) ca
LEFT JOIN (SELECT branch_id, {month('start_date')} AS month, COUNT(DISTINCT worker_id) AS active_workers,
      COUNT(DISTINCT client_id) AS active_clients, COUNT(DISTINCT worker_id || '|' || contract_id) AS assignments
      FROM v_assignments GROUP BY 1, 2) s ON s.branch_id = ca.branch_id AND s.month = ca.month
LEFT JOIN (SELECT a.branch_id, {month('a.start_date')} AS month,
      COALESCE(SUM(h.hours_paid * c.pay_rate), 0)::DECIMAL(24,6) AS cost,
      COALESCE(SUM(h.hours_billed * c.bill_rate), 0)::DECIMAL(24,6) AS billed
      FROM v_assignments a
      LEFT JOIN v_contracts c ON c.worker_id = a.worker_id AND c.contract_id = a.contract_id
      LEFT JOIN v_hours h ON h.worker_id = a.worker_id AND h.contract_id = a.contract_id
      GROUP BY 1, 2) m ON m.branch_id = ca.branch_id AND m.month = ca.month
LEFT JOIN (SELECT branch_id, {month('order_date')} AS month, COUNT(*) AS orders,
      COUNT(CASE WHEN status IN ('P', 'C') THEN 1 END) AS filled_orders
      FROM v_orders GROUP BY 1, 2) t ON t.branch_id = ca.branch_id AND t.month = ca.month""",
    "m_ranking": """
SELECT branch_id, month, net_revenue, margin_rate, active_workers, conversion_rate,
  RANK() OVER (PARTITION BY month ORDER BY net_revenue DESC) AS rank_revenue,
  RANK() OVER (PARTITION BY month ORDER BY margin_rate DESC) AS rank_margin,
  RANK() OVER (PARTITION BY month ORDER BY active_workers DESC) AS rank_placement,
  RANK() OVER (PARTITION BY month ORDER BY conversion_rate DESC NULLS LAST) AS rank_conversion,
  ROUND(0.35::DOUBLE * PERCENT_RANK() OVER (PARTITION BY month ORDER BY net_revenue)
    + 0.25::DOUBLE * PERCENT_RANK() OVER (PARTITION BY month ORDER BY margin_rate)
    + 0.25::DOUBLE * PERCENT_RANK() OVER (PARTITION BY month ORDER BY active_workers)
    + 0.15::DOUBLE * PERCENT_RANK() OVER (PARTITION BY month ORDER BY conversion_rate NULLS FIRST), 4) AS global_score
FROM m_scorecard""",
    "m_trends": """
SELECT *, CASE WHEN delta_revenue_mom > 0 AND delta_revenue_yoy > 0 THEN 'HAUSSE'
    WHEN delta_revenue_mom < 0 AND delta_revenue_yoy < 0 THEN 'BAISSE' ELSE 'STABLE' END AS trend
FROM (SELECT c.branch_id, c.month, c.net_revenue, c.margin_rate, c.active_workers,
    (c.net_revenue - COALESCE(c.r1, 0))::DECIMAL(18,2) AS delta_revenue_mom,
    ROUND(c.margin_rate - COALESCE(c.m1, 0), 4) AS delta_margin_mom,
    c.active_workers - COALESCE(c.w1, 0) AS delta_workers_mom,
    (c.net_revenue - COALESCE(p.net_revenue, 0))::DECIMAL(18,2) AS delta_revenue_yoy,
    ROUND(c.margin_rate - COALESCE(p.margin_rate, 0), 4) AS delta_margin_yoy
  FROM (SELECT *, LAG(net_revenue) OVER w AS r1, LAG(margin_rate) OVER w AS m1, LAG(active_workers) OVER w AS w1
        FROM m_scorecard WINDOW w AS (PARTITION BY branch_id ORDER BY month)) c
  LEFT JOIN m_scorecard p ON p.branch_id = c.branch_id AND p.month = (c.month - INTERVAL 12 MONTH)::DATE)""",
    "m_detail": f"""
SELECT MD5(a.worker_id || '|' || a.contract_id || '|' || a.client_id) AS assignment_sk, a.worker_id, a.contract_id,
  a.client_id, a.branch_id, c.trade_id, c.start_date, c.end_date, DATEDIFF('day', c.start_date, c.end_date) AS duration_days,
  c.pay_rate, c.bill_rate, (c.bill_rate - c.pay_rate)::DECIMAL(12,4) AS hourly_margin,
  COALESCE(h.hours_paid, 0)::DECIMAL(12,2) AS hours,
  (COALESCE(h.hours_paid, 0)::DECIMAL(12,2) * COALESCE(c.bill_rate, 0)::DECIMAL(10,4))::DECIMAL(24,6) AS revenue,
  (COALESCE(h.hours_paid, 0)::DECIMAL(12,2) * COALESCE(c.pay_rate, 0)::DECIMAL(10,4))::DECIMAL(24,6) AS cost,
  (COALESCE(h.hours_paid, 0)::DECIMAL(12,2) * (COALESCE(c.bill_rate, 0) - COALESCE(c.pay_rate, 0))::DECIMAL(12,4))::DECIMAL(24,6) AS margin,
  CASE WHEN h.hours_paid * c.bill_rate > 0
    THEN {ratio('h.hours_paid * (c.bill_rate - c.pay_rate)::DECIMAL(12,4)', 'h.hours_paid * c.bill_rate', 4)} ELSE 0 END::DOUBLE AS margin_rate
FROM v_assignments a
LEFT JOIN v_contracts c ON c.worker_id = a.worker_id AND c.contract_id = a.contract_id
LEFT JOIN v_hours h ON h.worker_id = a.worker_id AND h.contract_id = a.contract_id""",
    "m_revenue_windows": f"""
SELECT client_id,
  SUM(CASE WHEN YEAR(month) = 2001 THEN net_revenue ELSE 0 END)::DECIMAL(18,2) AS net_ytd,
  SUM(CASE WHEN YEAR(month) = 2000 THEN net_revenue ELSE 0 END)::DECIMAL(18,2) AS net_n1,
  SUM(CASE WHEN month >= {AS_OF} - INTERVAL 12 MONTH THEN net_revenue ELSE 0 END)::DECIMAL(18,2) AS net_12m,
  SUM(CASE WHEN YEAR(month) = 2001 THEN revenue ELSE 0 END)::DECIMAL(18,2) AS gross_ytd,
  SUM(CASE WHEN YEAR(month) = 2000 THEN revenue ELSE 0 END)::DECIMAL(18,2) AS gross_n1
FROM m_monthly_revenue GROUP BY 1""",
    "m_profile": f"""
SELECT client_id, COUNT(*) FILTER (WHERE end_date >= {AS_OF}) AS active_assignments, COUNT(*) AS assignments,
  COUNT(DISTINCT CASE WHEN end_date >= {AS_OF} THEN worker_id END) AS active_workers,
  COUNT(DISTINCT worker_id) AS workers, COUNT(DISTINCT branch_id) AS branches, MIN(start_date) AS first_start,
  ROUND(SUM(margin_rate::DECIMAL(18,4))::DOUBLE / COUNT(margin_rate), 4) AS mean_margin_rate
FROM m_detail GROUP BY 1""",
    "m_client_360": f"""
SELECT c.client_sk, c.client_id, c.client_name, c.siren, c.city, c.client_status,
  COALESCE(w.net_ytd, 0)::DECIMAL(18,2) AS revenue_ytd, COALESCE(w.net_n1, 0)::DECIMAL(18,2) AS revenue_previous_year,
  CASE WHEN w.net_n1 > 0 THEN ROUND({div('w.net_ytd - w.net_n1', 'w.net_n1')} * 100, 2) END AS revenue_growth_pct,
  COALESCE(w.net_12m, 0)::DECIMAL(18,2) AS revenue_12m,
  COALESCE(p.active_assignments, 0) AS active_assignments, COALESCE(p.assignments, 0) AS assignments,
  COALESCE(p.active_workers, 0) AS active_workers, COALESCE(p.workers, 0) AS workers, COALESCE(p.branches, 0) AS branches,
  COALESCE(t.top_trades, '[]') AS top_trades,
  COALESCE(DATEDIFF('day', p.first_start, {AS_OF}), 0) AS seniority_days,
  COALESCE(p.mean_margin_rate, 0)::DOUBLE AS mean_margin_rate, c.credit_used, c.credit_limit,
  CASE WHEN c.credit_used::DOUBLE > 0.8::DOUBLE * c.credit_limit THEN 'HIGH'
       WHEN c.credit_used::DOUBLE > 0.5::DOUBLE * c.credit_limit THEN 'MEDIUM' ELSE 'LOW' END AS credit_risk,
  l.last_invoice, COALESCE(DATEDIFF('day', l.last_invoice, {AS_OF}), 9999) AS days_since_invoice,
  CASE WHEN l.last_invoice IS NULL OR DATEDIFF('day', l.last_invoice, {AS_OF}) > 90 THEN 'HIGH'
       WHEN DATEDIFF('day', l.last_invoice, {AS_OF}) > 45 THEN 'MEDIUM' ELSE 'LOW' END AS churn_risk
FROM v_clients c
LEFT JOIN m_revenue_windows w ON w.client_id = c.client_id
LEFT JOIN m_profile p ON p.client_id = c.client_id
LEFT JOIN (SELECT client_id, '[' || STRING_AGG(trade_id::VARCHAR, ', ' ORDER BY rn) || ']' AS top_trades FROM (
    SELECT client_id, trade_id, ROW_NUMBER() OVER (PARTITION BY client_id ORDER BY COUNT(*) DESC, trade_id) AS rn
    FROM m_detail WHERE trade_id IS NOT NULL GROUP BY 1, 2) WHERE rn <= 3 GROUP BY 1) t ON t.client_id = c.client_id
LEFT JOIN (SELECT client_id, MAX(invoice_date) AS last_invoice FROM v_invoices GROUP BY 1) l ON l.client_id = c.client_id""",
    "m_weekly_revenue": f"""
SELECT r.*, COALESCE(a.active_workers, 0) AS active_workers, b.branch_name
FROM (SELECT branch_id, {week('invoice_date')} AS week,
    SUM(CASE WHEN doc_type = 'F' THEN amount ELSE 0 END)::DECIMAL(18,2) AS revenue,
    SUM(CASE WHEN doc_type = 'A' THEN amount ELSE 0 END)::DECIMAL(18,2) AS credited,
    SUM(signed_amount)::DECIMAL(18,2) AS net_revenue,
    COUNT(*) FILTER (WHERE doc_type = 'F') AS invoices, COUNT(*) FILTER (WHERE doc_type = 'A') AS credit_notes,
    SUM(hours)::DECIMAL(12,2) AS billed_hours FROM v_billed GROUP BY 1, 2) r
LEFT JOIN (SELECT branch_id, {week('start_date')} AS week, COUNT(DISTINCT worker_id) AS active_workers
    FROM v_assignments GROUP BY 1, 2) a ON a.branch_id = r.branch_id AND a.week = r.week
LEFT JOIN v_branches b ON b.branch_id = r.branch_id""",
    "v_sections": """
SELECT * FROM (VALUES
 ('A','Agriculture, sylviculture et pêche','01','03'), ('B','Industries extractives','05','09'),
 ('C','Industrie manufacturière','10','33'), ('D','Production et distribution énergie','35','35'),
 ('E','Eau, assainissement, déchets','36','39'), ('F','Construction','41','43'),
 ('G','Commerce, réparation automobiles','45','47'), ('H','Transports et entreposage','49','53'),
 ('I','Hébergement et restauration','55','56'), ('J','Information et communication','58','63'),
 ('K','Activités financières et assurance','64','66'), ('L','Activités immobilières','68','68'),
 ('M','Activités spécialisées et techniques','69','75'), ('N','Services administratifs et de soutien','77','82'),
 ('O','Administration publique','84','84'), ('P','Enseignement','85','85'),
 ('Q','Santé humaine et action sociale','86','88'), ('R','Arts, spectacles et loisirs','90','93'),
 ('S','Autres activités de services','94','96'), ('T','Ménages employeurs','97','98'),
 ('U','Activités extra-territoriales','99','99')) AS t(section_code, sector_label, division_min, division_max)""",
    "m_sector": f"""
SELECT s.*, ROUND({div('net_revenue', 'SUM(net_revenue) OVER (PARTITION BY branch_id, month)')} * 100, 1) AS branch_share_pct
FROM (SELECT m.branch_id, m.month, c.naf_code, LEFT(c.naf_code, 2) AS naf_division,
    COALESCE(n.section_code, 'XX') AS naf_section, COALESCE(n.sector_label, 'Non classifié') AS sector_label,
    COUNT(DISTINCT m.client_id) AS clients, SUM(m.net_revenue)::DECIMAL(18,2) AS net_revenue, SUM(m.documents)::BIGINT AS documents
  FROM m_client_month m LEFT JOIN v_clients c ON c.client_id = m.client_id
  LEFT JOIN v_sections n ON LEFT(c.naf_code, 2) BETWEEN n.division_min AND n.division_max
  GROUP BY 1, 2, 3, 4, 5, 6) s
WHERE net_revenue > 0""",
    "m_termination": f"""
SELECT m.branch_id, m.client_id, {month('m.start_date')} AS month, COUNT(*) AS assignments,
  COUNT(*) FILTER (WHERE end_status = 'RUPTURE') AS terminations,
  COUNT(*) FILTER (WHERE end_status = 'ANNULEE') AS cancellations,
  COUNT(*) FILTER (WHERE end_status = 'TERME_NORMAL') AS normal_ends,
  ROUND(COUNT(*) FILTER (WHERE end_status = 'RUPTURE')::DOUBLE / COUNT(*) * 100, 1) AS termination_pct,
  ROUND(COUNT(*) FILTER (WHERE end_status IN ('RUPTURE', 'ANNULEE'))::DOUBLE / COUNT(*) * 100, 1) AS early_end_pct,
  ROUND(AVG(CASE WHEN end_status = 'RUPTURE' THEN actual_days END), 1) AS mean_days_before_termination
FROM v_end_status e JOIN v_assignments m ON m.worker_id = e.worker_id AND m.contract_id = e.contract_id
WHERE end_status <> 'EN_COURS' GROUP BY 1, 2, 3""",
    "m_duration": f"""
SELECT branch_id, client_id, trade_id, {month('start_date')} AS month, COUNT(*) AS assignments,
  ROUND(AVG(days), 1) AS mean_days, ROUND(AVG(days) / 7.0::DOUBLE, 1) AS mean_weeks,
  ROUND(PERCENTILE_CONT(0.5) WITHIN GROUP (ORDER BY days), 1) AS median_days,
  COUNT(*) FILTER (WHERE days <= 1) AS up_to_1_day, COUNT(*) FILTER (WHERE days <= 7) AS up_to_1_week,
  COUNT(*) FILTER (WHERE days <= 30) AS up_to_1_month, COUNT(*) FILTER (WHERE days > 30) AS over_1_month,
  CASE WHEN AVG(days) <= 1 THEN 'MICRO' WHEN AVG(days) <= 7 THEN 'COURTE' WHEN AVG(days) <= 30 THEN 'MOYENNE' ELSE 'LONGUE' END AS duration_profile
FROM (SELECT a.branch_id, a.client_id, c.trade_id, c.start_date, DATEDIFF('day', c.start_date, c.end_date) AS days
  FROM v_assignments a JOIN v_contracts c ON c.worker_id = a.worker_id AND c.contract_id = a.contract_id)
WHERE days > 0 GROUP BY 1, 2, 3, 4""",
    "m_coefficient": f"""
SELECT branch_id, client_id, trade_id, month, n AS assignments, ROUND(weighted, 3) AS weighted_coefficient,
  ROUND(simple, 3) AS mean_coefficient, mean_bill_rate, mean_pay_rate, ROUND((weighted - 1) * 100, 1) AS coefficient_margin_pct,
  CASE WHEN simple >= 1.35 THEN 'BON' WHEN simple >= 1.25 THEN 'MOYEN' ELSE 'A_REVOIR' END AS coefficient_level
FROM (SELECT a.branch_id, a.client_id, c.trade_id, {month('c.start_date')} AS month, COUNT(*) AS n,
    {div('SUM(c.bill_rate * COALESCE(h.hours_paid, 0)::DECIMAL(12,2))', 'SUM(c.pay_rate * COALESCE(h.hours_paid, 0)::DECIMAL(12,2))')} AS weighted,
    AVG(c.bill_rate::DOUBLE / c.pay_rate::DOUBLE) AS simple,
    ROUND(SUM(c.bill_rate)::DOUBLE / COUNT(*), 2) AS mean_bill_rate, ROUND(SUM(c.pay_rate)::DOUBLE / COUNT(*), 2) AS mean_pay_rate
  FROM v_assignments a JOIN v_contracts c ON c.worker_id = a.worker_id AND c.contract_id = a.contract_id
  LEFT JOIN v_hours h ON h.worker_id = a.worker_id AND h.contract_id = a.contract_id
  WHERE c.pay_rate > 0 AND c.bill_rate > 0 GROUP BY 1, 2, 3, 4)""",
    "m_renewal": f"""
SELECT branch_id, client_id, {month('start_date')} AS month, COUNT(*) AS assignments,
  COUNT(*) FILTER (WHERE gap BETWEEN 0 AND 7) AS renewals,
  ROUND(COUNT(*) FILTER (WHERE gap BETWEEN 0 AND 7)::DOUBLE / COUNT(*) * 100, 1) AS renewal_pct,
  ROUND(AVG(CASE WHEN gap BETWEEN 0 AND 7 THEN gap END), 0) AS mean_gap_days
FROM (SELECT *, DATEDIFF('day', LAG(end_date) OVER (PARTITION BY worker_id, client_id, branch_id ORDER BY start_date, contract_id), start_date) AS gap
  FROM v_assignments)
GROUP BY 1, 2, 3""",
    "m_dso": f"""
SELECT f.branch_id, f.client_id, f.month, (f.net - COALESCE(p.paid, 0))::DECIMAL(18,2) AS outstanding,
  ROUND({div('f.net - COALESCE(p.paid, 0)', "f.net::DOUBLE / DATEDIFF('day', f.month, (f.month + INTERVAL 1 MONTH)::DATE)")}, 1) AS dso_days,
  f.open_invoices, f.overdue
FROM (SELECT branch_id, client_id, {month('invoice_date')} AS month, SUM(signed_amount)::DECIMAL(18,2) AS net,
    COUNT(*) FILTER (WHERE doc_type = 'F') AS open_invoices,
    SUM(CASE WHEN due_date < DATE_TRUNC('month', {AS_OF}) THEN signed_amount ELSE 0 END)::DECIMAL(18,2) AS overdue
  FROM v_billed WHERE has_lines GROUP BY 1, 2, 3) f
LEFT JOIN (SELECT branch_id, client_id, {month('paid_date')} AS month, SUM(COALESCE(amount_paid, 0))::DECIMAL(18,2) AS paid
  FROM v_payments WHERE paid_date IS NOT NULL GROUP BY 1, 2, 3) p
  ON p.branch_id = f.branch_id AND p.client_id = f.client_id AND p.month = f.month""",
    "m_aged": f"""
SELECT branch_id, {month('invoice_date')} AS month,
  CASE WHEN age BETWEEN 0 AND 30 THEN '0-30j' WHEN age BETWEEN 31 AND 60 THEN '31-60j'
       WHEN age BETWEEN 61 AND 90 THEN '61-90j' ELSE '>90j' END AS bucket,
  SUM(signed_amount)::DECIMAL(18,2) AS overdue, COUNT(*) AS documents
FROM (SELECT *, DATEDIFF('day', due_date, {AS_OF}) AS age FROM v_billed WHERE has_lines AND due_date < {AS_OF})
GROUP BY 1, 2, 3""",
    "m_settlement": f"""
SELECT i.invoice_id, i.branch_id, i.client_id, i.invoice_date, DATEDIFF('day', i.invoice_date, p.paid_date) AS days_to_pay,
  DATEDIFF('day', i.due_date, COALESCE(p.paid_date, {AS_OF})) AS late_days,
  CASE WHEN p.paid_date <= i.due_date THEN 'REGLE_A_TEMPS' WHEN p.paid_date > i.due_date THEN 'REGLE_EN_RETARD'
       WHEN {AS_OF} <= i.due_date THEN 'EN_COURS' ELSE 'EN_RETARD' END AS settlement,
  CASE WHEN p.paid_date IS NOT NULL THEN 'REGLE' WHEN {AS_OF} <= i.due_date THEN '0_NON_ECHU'
       WHEN DATEDIFF('day', i.due_date, {AS_OF}) <= 30 THEN '1_0_30J' WHEN DATEDIFF('day', i.due_date, {AS_OF}) <= 60 THEN '2_30_60J'
       WHEN DATEDIFF('day', i.due_date, {AS_OF}) <= 90 THEN '3_60_90J' ELSE '4_PLUS_90J' END AS age_bucket
FROM v_invoices i LEFT JOIN v_payments p ON p.invoice_id = i.invoice_id WHERE i.doc_type = 'F'""",
    "m_activity": f"""
SELECT a.worker_id, {month('a.start_date')} AS month, COUNT(DISTINCT a.contract_id) AS assignments,
  COUNT(DISTINCT a.branch_id) AS branches, COUNT(DISTINCT a.client_id) AS clients,
  COALESCE(SUM(h.hours_paid), 0)::DECIMAL(12,2) AS hours,
  COALESCE(SUM(h.hours_billed * COALESCE(h.line_bill_rate, c.bill_rate)), 0)::DECIMAL(24,6) AS revenue,
  MAX(w.worker_sk) AS worker_sk, 154.0::DOUBLE AS available_hours,
  ROUND(COALESCE(SUM(h.hours_paid), 0)::DECIMAL(12,2)::DOUBLE / 154.0::DOUBLE, 4) AS occupancy
FROM v_assignments a
LEFT JOIN v_hours h ON h.worker_id = a.worker_id AND h.contract_id = a.contract_id
LEFT JOIN v_contracts c ON c.worker_id = a.worker_id AND c.contract_id = a.contract_id
LEFT JOIN v_workers w ON w.worker_id = a.worker_id
GROUP BY 1, 2""",
    "m_loyalty": f"""
SELECT worker_id, first_sale, previous_sale, last_sale, recent::INT AS assignments_12m,
  DATEDIFF('day', first_sale, last_sale) AS tenure_days, DATEDIFF('day', last_sale, {AS_OF}) AS idle_days,
  CASE WHEN last_sale IS NULL THEN 'inactif' WHEN DATEDIFF('day', last_sale, {AS_OF}) <= 90 THEN 'actif_recent'
       WHEN DATEDIFF('day', last_sale, {AS_OF}) <= 365 THEN 'actif_annee' ELSE 'inactif_long' END AS loyalty_category,
  ROUND(recent::DOUBLE / NULLIF(DATEDIFF('day', first_sale, last_sale) / 30.0::DOUBLE, 0), 4) AS loyalty_rate
FROM v_pool_raw""",
    "m_placed": """
SELECT l.*, COALESCE(p.branch_id, h.branch_id) AS branch_id,
  CASE WHEN p.branch_id IS NOT NULL THEN 'primary' WHEN h.branch_id IS NOT NULL THEN 'fallback' ELSE 'none' END AS via
FROM m_loyalty l LEFT JOIN (SELECT worker_id, MIN(branch_id) AS branch_id FROM v_pool_portfolio GROUP BY 1) p ON p.worker_id = l.worker_id
LEFT JOIN v_pool_home h ON h.worker_id = l.worker_id""",
    "m_pool": f"""
SELECT e.branch_id, e.month, e.joiners, COALESCE(s.leavers, 0) AS leavers, p.active_pool, p.total_pool,
  e.joiners - COALESCE(s.leavers, 0) AS net_growth, ROUND({div('e.joiners', 'p.total_pool')} * 100, 1) AS pool_renewal_pct
FROM (SELECT branch_id, {month('first_sale')} AS month, COUNT(DISTINCT worker_id) AS joiners
  FROM m_placed WHERE branch_id IS NOT NULL AND first_sale IS NOT NULL GROUP BY 1, 2) e
LEFT JOIN (SELECT branch_id, {month('last_sale')} AS month,
  COUNT(DISTINCT worker_id) FILTER (WHERE loyalty_category IN ('inactif_long', 'inactif')) AS leavers
  FROM m_placed WHERE last_sale IS NOT NULL GROUP BY 1, 2) s ON s.branch_id = e.branch_id AND s.month = e.month
LEFT JOIN (SELECT branch_id, COUNT(DISTINCT worker_id) FILTER (WHERE loyalty_category = 'actif_recent') AS active_pool,
  COUNT(DISTINCT worker_id) AS total_pool FROM m_placed GROUP BY 1) p ON p.branch_id = e.branch_id""",
    "m_skills_available": f"""
SELECT MD5(trade_id::VARCHAR) AS trade_sk, MD5(home_branch::VARCHAR) AS branch_sk, trade_id, home_branch AS branch_id,
  COUNT(DISTINCT worker_id) AS qualified, COUNT(DISTINCT CASE WHEN NOT busy THEN worker_id END) AS available,
  COUNT(DISTINCT CASE WHEN busy THEN worker_id END) AS on_assignment,
  ROUND(COUNT(DISTINCT CASE WHEN busy THEN worker_id END)::DOUBLE / COUNT(DISTINCT worker_id), 4) AS coverage_rate,
  ROUND(COUNT(DISTINCT CASE WHEN NOT busy THEN worker_id END)::DOUBLE / COUNT(DISTINCT worker_id), 4) AS availability_rate
FROM (SELECT l.l_partkey AS trade_id, w.home_branch, w.worker_id, b.worker_id IS NOT NULL AS busy
  FROM lineitem l JOIN v_workers w ON w.worker_id = l.l_suppkey AND w.is_active
  LEFT JOIN (SELECT DISTINCT worker_id FROM v_assignments WHERE end_date >= {AS_OF}) b ON b.worker_id = w.worker_id)
GROUP BY trade_id, home_branch""",
}


def _top(n: int) -> str:
    return f"SUM(net) FILTER (WHERE rn <= {n})"


def _rubric(pred: str) -> str:
    return f"SUM(CASE WHEN {pred} THEN e.value::DECIMAL(10,2) ELSE 0 END)::DECIMAL(14,2)"


QUERIES = {
    "latest_invoice_lines": "SELECT * FROM v_invoice_lines",
    "invoice_amounts": "SELECT * FROM v_amounts",
    "hours_per_contract": "SELECT * FROM v_hours",
    "assignments_distinct": "SELECT DISTINCT worker_id, contract_id, client_id, branch_id FROM v_assignments",
    "monthly_revenue_client": "SELECT * FROM m_monthly_revenue",
    "weekly_revenue_branch": "SELECT * FROM m_weekly_revenue",
    "daily_revenue_branch_client": """
SELECT r.branch_id, r.client_id, r.day, r.net_revenue, r.hours, COALESCE(a.active_workers, 0) AS active_workers
FROM (SELECT branch_id, client_id, invoice_date AS day, SUM(signed_amount)::DECIMAL(18,2) AS net_revenue,
    SUM(hours)::DECIMAL(12,2) AS hours FROM v_billed GROUP BY 1, 2, 3) r
LEFT JOIN (SELECT branch_id, client_id, start_date AS day, COUNT(DISTINCT worker_id) AS active_workers
    FROM v_assignments GROUP BY 1, 2, 3) a ON a.branch_id = r.branch_id AND a.client_id = r.client_id AND a.day = r.day""",
    "client_concentration": f"""
SELECT branch_id, month, COUNT(DISTINCT client_id)::BIGINT AS clients,
  COUNT(DISTINCT client_id) FILTER (WHERE pr <= 0.2) AS clients_top20, SUM(net_revenue)::DECIMAL(18,2) AS net_total,
  COALESCE(SUM(net_revenue) FILTER (WHERE pr <= 0.2), 0)::DECIMAL(18,2) AS net_top20,
  COALESCE(SUM(net_revenue) FILTER (WHERE dr <= 5), 0)::DECIMAL(18,2) AS net_top5,
  {ratio('COALESCE(SUM(net_revenue) FILTER (WHERE pr <= 0.2), 0)', 'SUM(net_revenue)', 4)} AS concentration_top20,
  {ratio('COALESCE(SUM(net_revenue) FILTER (WHERE dr <= 5), 0)', 'SUM(net_revenue)', 4)} AS concentration_top5
FROM (SELECT *, PERCENT_RANK() OVER (PARTITION BY branch_id, month ORDER BY net_revenue DESC) AS pr,
        DENSE_RANK() OVER (PARTITION BY branch_id, month ORDER BY net_revenue DESC) AS dr FROM m_client_month)
GROUP BY 1, 2""",
    "client_concentration_topn": f"""
SELECT branch_id, month, SUM(net)::DECIMAL(18,2) AS net_total,
  ROUND({div(_top(1), 'SUM(net)')} * 100, 2) AS pct_top1, ROUND({div(_top(3), 'SUM(net)')} * 100, 2) AS pct_top3,
  ROUND({div(_top(5), 'SUM(net)')} * 100, 2) AS pct_top5, ROUND({div(_top(10), 'SUM(net)')} * 100, 2) AS pct_top10,
  COUNT(*) AS active_clients,
  CASE WHEN {div(_top(3), 'SUM(net)')} >= 0.70 THEN 'CRITIQUE' WHEN {div(_top(3), 'SUM(net)')} >= 0.50 THEN 'ELEVE' ELSE 'NORMAL' END AS concentration_risk
FROM (SELECT main_branch AS branch_id, month, client_id, SUM(net_revenue) AS net,
  ROW_NUMBER() OVER (PARTITION BY main_branch, month ORDER BY SUM(net_revenue) DESC, client_id) AS rn
  FROM m_monthly_revenue GROUP BY 1, 2, 3)
GROUP BY 1, 2""",
    "sector_revenue": "SELECT * FROM m_sector",
    "client_360": "SELECT * FROM m_client_360",
    "client_360_light": f"""
SELECT c.client_id, TRIM(c.client_name) AS client_name, c.siren, c.city, c.naf_code,
  COALESCE(w.gross_ytd, 0)::DECIMAL(18,2) AS revenue_ytd, COALESCE(w.gross_n1, 0)::DECIMAL(18,2) AS revenue_previous_year,
  CASE WHEN COALESCE(w.gross_n1, 0) <> 0 THEN {ratio('w.gross_ytd - w.gross_n1', 'w.gross_n1', 4)} END AS revenue_growth,
  c.credit_used, c.credit_limit,
  CASE WHEN c.credit_used::DOUBLE > c.credit_limit::DOUBLE * 0.9 THEN 'CRITIQUE'
       WHEN c.credit_used::DOUBLE > c.credit_limit::DOUBLE * 0.7 THEN 'ELEVE' ELSE 'NORMAL' END AS credit_risk
FROM v_clients c LEFT JOIN m_revenue_windows w ON w.client_id = c.client_id""",
    "client_360_fallback": """
SELECT client_sk, client_id, client_name, revenue_ytd, revenue_previous_year, revenue_growth_pct, revenue_12m,
  active_assignments, assignments, active_workers, workers, branches, '[]' AS top_trades, seniority_days,
  mean_margin_rate, 0::DECIMAL(18,2) AS credit_used, 0::DECIMAL(18,2) AS credit_limit, 'LOW' AS credit_risk,
  NULL::DATE AS last_invoice, 9999 AS days_since_invoice, 'HIGH' AS churn_risk
FROM m_client_360""",
    "client_retention_light": """
SELECT client_id, quarter, revenue, assignments, (revenue - COALESCE(prev, 0))::DECIMAL(18,2) AS delta_qoq,
  CASE WHEN revenue::DOUBLE < COALESCE(prev, 0)::DOUBLE * 0.7 THEN 'RISQUE_FORT' WHEN revenue = 0 THEN 'INACTIF' ELSE 'STABLE' END AS churn_risk
FROM (SELECT *, LAG(revenue) OVER (PARTITION BY client_id ORDER BY quarter) AS prev
  FROM (SELECT client_id, DATE_TRUNC('quarter', month)::DATE AS quarter, SUM(revenue)::DECIMAL(18,2) AS revenue,
    SUM(assignments)::BIGINT AS assignments FROM m_monthly_revenue GROUP BY 1, 2))""",
    "client_retention": f"""
WITH_VIEWS q AS (
  SELECT client_id, quarter, SUM(net)::DECIMAL(18,2) AS net_revenue, COALESCE(SUM(assignments), 0)::BIGINT AS assignments,
    SUM(invoices)::BIGINT AS invoices, MAX(last_invoice) AS last_invoice
  FROM (SELECT client_id, branch_id, DATE_TRUNC('quarter', invoice_date)::DATE AS quarter, SUM(signed_amount) AS net,
          COUNT(*) AS invoices, MAX(invoice_date) AS last_invoice FROM v_billed GROUP BY 1, 2, 3)
  LEFT JOIN (SELECT client_id, branch_id, DATE_TRUNC('quarter', start_date)::DATE AS quarter,
          COUNT(DISTINCT worker_id || '|' || contract_id) AS assignments FROM v_assignments GROUP BY 1, 2, 3) USING (client_id, branch_id, quarter)
  GROUP BY 1, 2),
lagged AS (SELECT *, LAG(net_revenue) OVER w AS q1, LAG(net_revenue, 4) OVER w AS y1,
    COUNT(*) OVER (PARTITION BY client_id ORDER BY quarter ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS active_quarters_4,
    DATEDIFF('day', last_invoice, {AS_OF}) AS days_inactive
  FROM q WINDOW w AS (PARTITION BY client_id ORDER BY quarter)),
deltas AS (SELECT *, CASE WHEN q1 > 0 THEN {ratio('net_revenue - q1', 'q1', 4)} END AS delta_qoq_pct,
    CASE WHEN y1 > 0 THEN {ratio('net_revenue - y1', 'y1', 4)} END AS delta_yoy_pct FROM lagged)
SELECT c.client_sk, d.client_id, quarter, net_revenue, assignments, invoices, last_invoice, active_quarters_4,
  COALESCE(net_revenue - q1, 0)::DECIMAL(18,2) AS delta_qoq, delta_qoq_pct,
  COALESCE(net_revenue - y1, 0)::DECIMAL(18,2) AS delta_yoy, delta_yoy_pct, days_inactive,
  CASE WHEN days_inactive > 180 THEN 'PERDU' WHEN days_inactive > 90 THEN 'HIGH' WHEN days_inactive > 45 THEN 'MEDIUM'
       WHEN delta_qoq_pct < -0.3 THEN 'MEDIUM' WHEN active_quarters_4 <= 1 THEN 'MEDIUM' ELSE 'LOW' END AS churn_risk,
  ROUND(LEAST(1.0::DOUBLE, GREATEST(0.0::DOUBLE,
    0.30::DOUBLE * LEAST(days_inactive::DOUBLE / 180.0::DOUBLE, 1.0::DOUBLE)
    + 0.25::DOUBLE * (1.0::DOUBLE - LEAST(active_quarters_4::DOUBLE / 4.0::DOUBLE, 1.0::DOUBLE))
    + 0.25::DOUBLE * CASE WHEN COALESCE(delta_qoq_pct, 0) < 0 THEN LEAST(ABS(delta_qoq_pct), 1.0::DOUBLE) ELSE 0.0::DOUBLE END
    + 0.20::DOUBLE * CASE WHEN COALESCE(delta_yoy_pct, 0) < 0 THEN LEAST(ABS(delta_yoy_pct), 1.0::DOUBLE) ELSE 0.0::DOUBLE END)), 4) AS churn_score
FROM deltas d LEFT JOIN v_clients c ON c.client_id = d.client_id""",
    "client_profitability": f"""
SELECT c.client_sk, r.client_id, r.year, r.net_revenue, COALESCE(m.billed, 0)::DECIMAL(24,6) AS assignment_revenue,
  COALESCE(m.cost, 0)::DECIMAL(24,6) AS payroll_cost, (COALESCE(m.billed, 0) - COALESCE(m.cost, 0))::DECIMAL(24,6) AS gross_margin,
  CASE WHEN m.billed > 0 THEN {ratio('m.billed - m.cost', 'm.billed', 4)} ELSE 0 END::DOUBLE AS margin_rate,
  (r.gross * 0.05::DECIMAL(4,2))::DECIMAL(20,4) AS overhead_cost,
  (COALESCE(m.billed, 0) - COALESCE(m.cost, 0) - r.gross * 0.05::DECIMAL(4,2))::DECIMAL(24,6) AS net_profit,
  CASE WHEN m.billed > 0 THEN {ratio('m.billed - m.cost - r.gross * 0.05::DECIMAL(4,2)', 'm.billed', 4)} ELSE 0 END::DOUBLE AS net_profit_rate,
  COALESCE(m.workers, 0) AS workers
FROM (SELECT client_id, YEAR(invoice_date) AS year, SUM(signed_amount)::DECIMAL(18,2) AS net_revenue,
    SUM(CASE WHEN doc_type = 'F' THEN amount ELSE 0 END)::DECIMAL(18,2) AS gross FROM v_billed GROUP BY 1, 2) r
LEFT JOIN (SELECT a.client_id, YEAR(a.start_date) AS year, COALESCE(SUM(h.hours_billed * c.bill_rate), 0)::DECIMAL(24,6) AS billed,
    COALESCE(SUM(h.hours_paid * c.pay_rate), 0)::DECIMAL(24,6) AS cost, COUNT(DISTINCT a.worker_id) AS workers
  FROM v_assignments a LEFT JOIN v_contracts c ON c.worker_id = a.worker_id AND c.contract_id = a.contract_id
  LEFT JOIN v_hours h ON h.worker_id = a.worker_id AND h.contract_id = a.contract_id GROUP BY 1, 2) m
  ON m.client_id = r.client_id AND m.year = r.year
LEFT JOIN v_clients c ON c.client_id = r.client_id""",
    "branch_scorecard": "SELECT * FROM m_scorecard",
    "branch_ranking": "SELECT * FROM m_ranking",
    "branch_trends": "SELECT * FROM m_trends",
    "fte_weekly": f"""
SELECT a.branch_id, {week('l.l_shipdate')} AS week, COUNT(*) AS sheets, COUNT(DISTINCT l.l_suppkey) AS workers,
  SUM(l.l_quantity::DECIMAL(10,2))::DECIMAL(12,2) AS hours,
  ROUND(SUM(l.l_quantity::DECIMAL(10,2))::DOUBLE / 35.0::DOUBLE, 4) AS fte
FROM v_lines l JOIN v_assignments a ON a.worker_id = l.l_suppkey AND a.contract_id = l.l_orderkey
WHERE l.l_returnflag <> 'R' GROUP BY 1, 2""",
    "weekly_hours": f"""
SELECT a.branch_id, a.client_id, {week('l.l_shipdate')} AS week, SUM(l.l_quantity::DECIMAL(10,2))::DECIMAL(12,2) AS hours_paid,
  SUM(l.l_quantity::DECIMAL(10,2))::DECIMAL(12,2) AS hours_billed, COUNT(*) AS sheets
FROM v_lines l JOIN v_assignments a ON a.worker_id = l.l_suppkey AND a.contract_id = l.l_orderkey
WHERE l.l_returnflag <> 'R' GROUP BY 1, 2, 3""",
    "weekly_hours_by_rubric": f"""
SELECT COALESCE(s_nationkey, -1) AS branch_id, {week('e.ts')} AS week, {_rubric("e.event_type IN ('click', 'view')")} AS normal_hours,
  {_rubric("e.event_type LIKE 'pur%'")} AS overtime_hours, {_rubric("e.event_type LIKE 's%'")} AS night_hours,
  {_rubric("e.event_type LIKE 'e%r'")} AS sunday_hours, COUNT(*) AS sheets,
  {_rubric("e.event_type IN ('click', 'view') OR e.event_type LIKE 'pur%' OR e.event_type LIKE 's%' OR e.event_type LIKE 'e%r'")} AS total_hours
FROM events e LEFT JOIN supplier ON s_suppkey = e.user_id GROUP BY 1, 2""",
    "order_pipeline": f"""
SELECT branch_id, {week('order_date')} AS week, COUNT(*) AS orders, COUNT(*) FILTER (WHERE status = 'P') AS filled,
  COUNT(*) FILTER (WHERE status = 'O') AS open, ROUND(COUNT(*) FILTER (WHERE status = 'P')::DOUBLE / COUNT(*), 6) AS fill_rate
FROM v_orders GROUP BY 1, 2""",
    "order_pipeline_detail": f"""
SELECT o.branch_id, {week('o.order_date')} AS week, COUNT(*) AS orders, COUNT(*) FILTER (WHERE status = 'O') AS open,
  COUNT(*) FILTER (WHERE status IN ('P', 'C')) AS filled, COUNT(*) FILTER (WHERE status = 'A') AS cancelled,
  ROUND(COUNT(*) FILTER (WHERE status IN ('P', 'C'))::DOUBLE / COUNT(*), 4) AS fill_rate,
  ROUND(AVG(DATEDIFF('day', o.order_date, s.first_start)), 1) AS mean_delay_days, SUM(headcount)::BIGINT AS requested_posts
FROM v_orders o LEFT JOIN (SELECT order_id, MIN(start_date) AS first_start FROM v_assignments GROUP BY 1) s ON s.order_id = o.order_id
GROUP BY 1, 2""",
    "placement_delay": f"""
SELECT branch_id, {week('end_date')} AS week, COUNT(*) AS assignments, ROUND(AVG(delay_hours), 2) AS mean_delay_hours,
  ROUND(PERCENTILE_CONT(0.5) WITHIN GROUP (ORDER BY delay_hours), 2) AS median_delay_hours,
  ROUND(COUNT(*) FILTER (WHERE delay_hours <= 4)::DOUBLE / COUNT(*) * 100, 1) AS pct_within_4h,
  ROUND(COUNT(*) FILTER (WHERE delay_hours <= 24)::DOUBLE / COUNT(*) * 100, 1) AS pct_within_24h,
  ROUND(COUNT(*) FILTER (WHERE delay_hours > 72)::DOUBLE / COUNT(*) * 100, 1) AS pct_over_72h
FROM v_assignments GROUP BY 1, 2""",
    "declaration_compliance": f"""
SELECT branch_id, {month('end_date')} AS month, COUNT(*) AS assignments, COUNT(gap_hours) AS declared,
  COUNT(*) FILTER (WHERE gap_hours <= 0) AS in_time, COUNT(*) FILTER (WHERE gap_hours > 0) AS late,
  COUNT(*) FILTER (WHERE gap_hours IS NULL) AS missing,
  ROUND(COUNT(*) FILTER (WHERE gap_hours <= 0)::DOUBLE / COUNT(*), 4) AS compliance_rate,
  ROUND(AVG(gap_hours) FILTER (WHERE gap_hours > 0), 2) AS mean_late_hours
FROM v_assignments GROUP BY 1, 2""",
    "due_weekly": f"""
SELECT client_id, branch_id, {week('due_date')} AS week, SUM(CASE WHEN doc_type = 'F' THEN amount ELSE 0 END)::DECIMAL(18,2) AS invoiced,
  SUM(CASE WHEN doc_type = 'A' THEN amount ELSE 0 END)::DECIMAL(18,2) AS credited, SUM(signed_amount)::DECIMAL(18,2) AS net_due,
  COUNT(DISTINCT CASE WHEN doc_type = 'F' THEN invoice_id END) AS invoices
FROM v_billed WHERE has_lines GROUP BY 1, 2, 3""",
    "dso_client": "SELECT * FROM m_dso",
    "aged_balance": "SELECT * FROM m_aged",
    "aged_balance_wide": f"""
SELECT branch_id, client_id, not_due, due_0_30, due_31_60, due_61_90, due_over_90, open_total,
  ROUND({div('due_61_90 + due_over_90', 'open_total')} * 100, 1) AS old_share_pct,
  CASE WHEN {div('due_over_90', 'open_total')} > 0.20 THEN 'LITIGIEUX'
       WHEN {div('due_61_90 + due_over_90', 'open_total')} > 0.30 THEN 'A_RISQUE' ELSE 'NORMAL' END AS risk_level
FROM (SELECT s.branch_id, s.client_id,
    COALESCE(SUM(a.amount) FILTER (WHERE age_bucket = '0_NON_ECHU'), 0)::DECIMAL(18,2) AS not_due,
    COALESCE(SUM(a.amount) FILTER (WHERE age_bucket = '1_0_30J'), 0)::DECIMAL(18,2) AS due_0_30,
    COALESCE(SUM(a.amount) FILTER (WHERE age_bucket = '2_30_60J'), 0)::DECIMAL(18,2) AS due_31_60,
    COALESCE(SUM(a.amount) FILTER (WHERE age_bucket = '3_60_90J'), 0)::DECIMAL(18,2) AS due_61_90,
    COALESCE(SUM(a.amount) FILTER (WHERE age_bucket = '4_PLUS_90J'), 0)::DECIMAL(18,2) AS due_over_90,
    SUM(a.amount)::DECIMAL(18,2) AS open_total
  FROM m_settlement s JOIN v_amounts a ON a.invoice_id = s.invoice_id
  WHERE settlement IN ('EN_COURS', 'EN_RETARD') GROUP BY 1, 2)""",
    "settlement_stats": f"""
SELECT branch_id, client_id, {month('invoice_date')} AS month, COUNT(*) AS invoices,
  COUNT(*) FILTER (WHERE settlement LIKE 'REGLE%') AS settled,
  COUNT(*) FILTER (WHERE settlement IN ('EN_RETARD', 'REGLE_EN_RETARD')) AS late,
  ROUND(AVG(days_to_pay), 0) AS mean_days_to_pay,
  ROUND(PERCENTILE_CONT(0.5) WITHIN GROUP (ORDER BY days_to_pay) FILTER (WHERE days_to_pay IS NOT NULL), 0) AS median_days_to_pay,
  ROUND(AVG(late_days) FILTER (WHERE late_days > 0), 0) AS mean_late_days,
  CASE WHEN AVG(days_to_pay) <= 30 THEN 'BON' WHEN AVG(days_to_pay) <= 45 THEN 'MOYEN' ELSE 'CRITIQUE' END AS payment_level
FROM m_settlement GROUP BY 1, 2, 3""",
    "termination_rate": "SELECT * FROM m_termination",
    "assignment_duration": "SELECT * FROM m_duration",
    "billing_coefficient": "SELECT * FROM m_coefficient",
    "renewal_rate": "SELECT * FROM m_renewal",
    "worker_activity": "SELECT * FROM m_activity",
    "assignment_detail": "SELECT * FROM m_detail",
    "assignment_margin": f"""
SELECT a.worker_id, a.contract_id, a.client_id, a.branch_id, c.trade_id,
  COALESCE(h.hours_billed * c.bill_rate, 0)::DECIMAL(24,6) AS revenue, COALESCE(h.hours_paid * c.pay_rate, 0)::DECIMAL(24,6) AS cost,
  (COALESCE(h.hours_billed * c.bill_rate, 0) - COALESCE(h.hours_paid * c.pay_rate, 0))::DECIMAL(24,6) AS gross_margin,
  CASE WHEN h.hours_billed * c.bill_rate > 0 THEN {ratio('h.hours_billed * c.bill_rate - h.hours_paid * c.pay_rate', 'h.hours_billed * c.bill_rate', 4)} ELSE 0 END::DOUBLE AS margin_rate,
  (COALESCE(h.hours_paid, 0) + COALESCE(h.hours_billed, 0))::DECIMAL(14,2) AS total_hours
FROM v_assignments a LEFT JOIN v_contracts c ON c.worker_id = a.worker_id AND c.contract_id = a.contract_id
LEFT JOIN v_hours h ON h.worker_id = a.worker_id AND h.contract_id = a.contract_id""",
    "loyalty": "SELECT * FROM m_loyalty",
    "loyalty_summary": """
SELECT COALESCE(p.branch_id, h.branch_id) AS branch_id, loyalty_category, COUNT(DISTINCT l.worker_id) AS workers,
  ROUND(AVG(tenure_days), 1) AS mean_tenure_days, ROUND(AVG(idle_days), 1) AS mean_idle_days,
  ROUND(SUM(loyalty_rate::DECIMAL(18,4))::DOUBLE / NULLIF(COUNT(loyalty_rate), 0), 4) AS mean_loyalty_rate
FROM m_loyalty l LEFT JOIN v_pool_portfolio p ON p.worker_id = l.worker_id LEFT JOIN v_pool_home h ON h.worker_id = l.worker_id
WHERE COALESCE(p.branch_id, h.branch_id) IS NOT NULL GROUP BY 1, 2""",
    "pool_dynamics": "SELECT * FROM m_pool",
    "key_resolution_coverage": """
SELECT COUNT(*) AS members, COUNT(*) FILTER (WHERE via = 'primary') AS via_portfolio,
  COUNT(*) FILTER (WHERE via = 'fallback') AS via_home_branch, COUNT(*) FILTER (WHERE via = 'none') AS unresolved FROM m_placed""",
    "skill_availability": "SELECT * FROM m_skills_available",
    "branch_staffing": f"""
SELECT e.branch_id, e.week, e.on_assignment, GREATEST(COALESCE(d.pool, 0) - e.on_assignment, 0) AS available,
  {ratio('e.on_assignment', 'd.pool', 4)} AS placement_rate, COALESCE(c.orders, 0) AS orders, {ratio('c.filled', 'c.orders', 4)} AS conversion_rate
FROM (SELECT branch_id, {week('start_date')} AS week, COUNT(DISTINCT worker_id) AS on_assignment FROM v_assignments GROUP BY 1, 2) e
LEFT JOIN (SELECT home_branch AS branch_id, week, COUNT(DISTINCT worker_id) AS pool
  FROM v_workers CROSS JOIN (SELECT DISTINCT {week('start_date')} AS week FROM v_assignments) GROUP BY 1, 2) d
  ON d.branch_id = e.branch_id AND d.week = e.week
LEFT JOIN (SELECT branch_id, {week('order_date')} AS week, COUNT(*) AS orders,
  COUNT(*) FILTER (WHERE status IN ('P', 'C')) AS filled FROM v_orders GROUP BY 1, 2) c ON c.branch_id = e.branch_id AND c.week = e.week""",
    "branch_pool_weeks": f"""
SELECT home_branch AS branch_id, week, COUNT(DISTINCT worker_id) AS pool
FROM v_workers CROSS JOIN (SELECT DISTINCT {week('start_date')} AS week FROM v_assignments) GROUP BY 1, 2""",
    "worker_turnover": f"""
SELECT COALESCE(e.branch_id, s.branch_id) AS branch_id, COALESCE(e.month, s.month) AS month, COALESCE(e.entries, 0) AS entries,
  COALESCE(s.exits, 0) AS exits, COALESCE(f.headcount, 1) AS mean_headcount,
  COALESCE({ratio('COALESCE(s.exits, 0)', 'f.headcount', 4)}, 0)::DOUBLE AS turnover_rate
FROM (SELECT branch_id, {month('start_date')} AS month, COUNT(DISTINCT worker_id) AS entries FROM v_assignments GROUP BY 1, 2) e
FULL OUTER JOIN (SELECT branch_id, {month('end_date')} AS month, COUNT(DISTINCT worker_id) AS exits FROM v_assignments GROUP BY 1, 2) s
  ON s.branch_id = e.branch_id AND s.month = e.month
LEFT JOIN (SELECT branch_id, {month('start_date')} AS month, COUNT(DISTINCT worker_id) AS headcount FROM v_assignments
  WHERE start_date <= {AS_OF} AND (end_date IS NULL OR end_date >= start_date) GROUP BY 1, 2) f
  ON f.branch_id = COALESCE(e.branch_id, s.branch_id) AND f.month = COALESCE(e.month, s.month)""",
    "calendar_dim": """
SELECT d AS date_id, ISODOW(d) - 1 AS weekday,
  ['lundi', 'mardi', 'mercredi', 'jeudi', 'vendredi', 'samedi', 'dimanche'][ISODOW(d)] AS weekday_name,
  WEEKOFYEAR(d) AS iso_week, MONTH(d) AS month,
  ['janvier', 'février', 'mars', 'avril', 'mai', 'juin', 'juillet', 'août', 'septembre', 'octobre', 'novembre', 'décembre'][MONTH(d)] AS month_name,
  QUARTER(d) AS quarter, YEAR(d) AS year,
  ISODOW(d) < 6 AND STRFTIME(d, '%m-%d') NOT IN ('01-01', '05-01', '05-08', '07-14', '08-15', '11-01', '11-11', '12-25') AS is_working_day,
  STRFTIME(d, '%m-%d') IN ('01-01', '05-01', '05-08', '07-14', '08-15', '11-01', '11-11', '12-25') AS is_holiday
FROM (SELECT UNNEST(GENERATE_SERIES(MIN(o_orderdate)::DATE, MAX(o_orderdate)::DATE, INTERVAL 1 DAY))::DATE AS d FROM orders)""",
    "sector_ref": """
SELECT s.section_code, s.sector_label, s.division_min, s.division_max, COUNT(c.client_id) AS clients
FROM v_sections s LEFT JOIN v_clients c ON LEFT(c.naf_code, 2) BETWEEN s.division_min AND s.division_max GROUP BY 1, 2, 3, 4""",
}
