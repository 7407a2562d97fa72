"""SQL twin of the staffing views."""

NEWEST = (
    "l_shipdate DESC, l_extendedprice DESC, l_quantity DESC, l_partkey, l_suppkey, l_discount, l_tax, "
    "l_returnflag, l_linestatus"
)

VIEWS = {
    "v_lines": f"""
SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {NEWEST}) AS rn
FROM lineitem) WHERE rn = 1""",
    "v_assigned": f"""
SELECT a.*, o.o_custkey, c.c_nationkey, o.o_orderdate::DATE AS started, a.l_shipdate::DATE AS ended
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_suppkey, l_orderkey ORDER BY {NEWEST}, l_linenumber) AS rn
      FROM lineitem) a
JOIN orders o ON o.o_orderkey = a.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey WHERE a.rn = 1""",
    "v_invoices": """
SELECT o_orderkey AS invoice_id, o_custkey AS client_id, c_nationkey AS branch_id,
  CASE WHEN o_orderstatus = 'P' THEN 'A' ELSE 'F' END AS doc_type, o_orderdate::DATE AS invoice_date,
  (o_orderdate::DATE + 30)::DATE AS due_date, o_orderstatus
FROM orders JOIN customer ON c_custkey = o_custkey""",
    "v_invoice_lines": """
SELECT l_orderkey AS invoice_id, l_linenumber AS line_no, l_quantity::DECIMAL(12,2) AS qty,
  l_extendedprice::DECIMAL(18,2) AS amount, l_linestatus = 'F' AS settled, l_shipdate::DATE AS line_date
FROM v_lines""",
    "v_amounts": """
SELECT invoice_id, SUM(amount)::DECIMAL(18,2) AS amount, SUM(qty)::DECIMAL(12,2) AS hours
FROM v_invoice_lines GROUP BY invoice_id""",
    "v_billed": """
SELECT i.*, COALESCE(a.amount, 0)::DECIMAL(18,2) AS amount, COALESCE(a.hours, 0)::DECIMAL(12,2) AS hours,
  a.invoice_id IS NOT NULL AS has_lines,
  CASE WHEN doc_type = 'F' THEN COALESCE(a.amount, 0) WHEN doc_type = 'A' THEN -COALESCE(a.amount, 0) ELSE 0 END
    ::DECIMAL(18,2) AS signed_amount
FROM v_invoices i LEFT JOIN v_amounts a ON a.invoice_id = i.invoice_id""",
    "v_payments": """
SELECT i.invoice_id, i.client_id, i.branch_id, CASE WHEN i.o_orderstatus = 'F' THEN l.last_line END AS paid_date,
  CASE WHEN i.o_orderstatus = 'F' THEN l.settled_amount END AS amount_paid
FROM v_invoices i LEFT JOIN (
  SELECT invoice_id, MAX(line_date) AS last_line, (SUM(amount) FILTER (WHERE settled))::DECIMAL(18,2) AS settled_amount
  FROM v_invoice_lines GROUP BY 1) l ON l.invoice_id = i.invoice_id""",
    "v_assignments": """
SELECT l_suppkey AS worker_id, l_orderkey AS contract_id, o_custkey AS client_id, c_nationkey AS branch_id,
  l_orderkey AS order_id, started AS start_date, ended AS end_date,
  CASE WHEN l_returnflag <> 'N' THEN (l_linenumber - 4) * 6 END AS gap_hours,
  l_quantity::INT * 4 AS delay_hours
FROM v_assigned""",
    "v_contracts": """
SELECT l_suppkey AS worker_id, l_orderkey AS contract_id, l_partkey AS trade_id, started AS start_date,
  ended AS end_date, p_retailprice::DECIMAL(10,4) AS pay_rate,
  ROUND(l_extendedprice / l_quantity, 4)::DECIMAL(10,4) AS bill_rate
FROM v_assigned JOIN part ON p_partkey = l_partkey""",
    "v_end_status": """
SELECT l_suppkey AS worker_id, l_orderkey AS contract_id,
  CASE WHEN l_returnflag = 'A' THEN 'ANNULEE' WHEN l_linestatus = 'O' THEN 'EN_COURS'
       WHEN l_returnflag = 'R' THEN 'RUPTURE' ELSE 'TERME_NORMAL' END AS end_status,
  DATEDIFF('day', started, ended) AS actual_days
FROM v_assigned""",
    "v_hours": """
SELECT l_suppkey AS worker_id, l_orderkey AS contract_id,
  SUM(l_quantity::DECIMAL(10,2))::DECIMAL(12,2) AS hours_paid, SUM(l_quantity::DECIMAL(10,2))::DECIMAL(12,2) AS hours_billed,
  MAX(CASE WHEN l_linestatus = 'F' THEN ROUND(l_extendedprice / l_quantity, 4)::DECIMAL(10,4) END) AS line_bill_rate
FROM v_lines GROUP BY 1, 2""",
    "v_orders": """
SELECT o_orderkey AS order_id, c_nationkey AS branch_id, o_orderdate::DATE AS order_date,
  LEFT(o_orderpriority, 1)::INT AS headcount,
  CASE o_orderstatus WHEN 'F' THEN 'P' WHEN 'O' THEN 'O' ELSE 'A' END AS status
FROM orders JOIN customer ON c_custkey = o_custkey""",
    "v_branches": """
SELECT MD5(n_nationkey::VARCHAR) AS branch_sk, n_nationkey AS branch_id, n_name AS branch_name,
  LEFT(r_name, 3) AS brand, r_name AS sector
FROM nation JOIN region ON r_regionkey = n_regionkey""",
    "v_clients": """
SELECT MD5(c_custkey::VARCHAR) AS client_sk, c_custkey AS client_id, c_name AS client_name,
  LPAD(c_custkey::VARCHAR, 9, '0') AS siren, LPAD((c_custkey % 100)::VARCHAR, 2, '0') || '10Z' AS naf_code,
  c_mktsegment AS client_status, c_nationkey::VARCHAR AS city, c_acctbal::DECIMAL(18,2) AS credit_used,
  10000::DECIMAL(18,2) AS credit_limit
FROM customer""",
    "v_workers": """
SELECT MD5(s_suppkey::VARCHAR) AS worker_sk, s_suppkey AS worker_id, s_name AS worker_name,
  s_nationkey AS home_branch, s_acctbal > 0 AS is_active
FROM supplier""",
    "v_pool_raw": """
SELECT c_custkey AS worker_id, MIN(day) AS first_sale, MAX(day) FILTER (WHERE rk = 2) AS previous_sale,
  MAX(day) AS last_sale, COUNT(*) FILTER (WHERE o_orderdate >= DATE '2001-08-01' - INTERVAL 12 MONTH) AS recent
FROM customer LEFT JOIN (
  SELECT o_custkey, o_orderdate, o_orderdate::DATE AS day,
    DENSE_RANK() OVER (PARTITION BY o_custkey ORDER BY o_orderdate::DATE DESC) AS rk FROM orders) o ON o_custkey = c_custkey
GROUP BY 1""",
    "v_pool_portfolio": """
SELECT c_custkey AS worker_id, s.n_nationkey AS branch_id
FROM customer JOIN nation n ON n.n_nationkey = c_nationkey JOIN nation s ON s.n_regionkey = n.n_regionkey
WHERE c_acctbal > 5000""",
    "v_pool_home": "SELECT c_custkey AS worker_id, c_nationkey AS branch_id FROM customer WHERE c_acctbal >= 0",
}
