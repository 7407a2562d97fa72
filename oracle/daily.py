"""SQL of the loads over several days: always over the whole history at once."""

from oracle import gold, silver

DAY = "DATE '2002-01-0{}'"

QUERIES = {
    "daily_assignments": silver.QUERIES["silver_assignments"],
    "daily_assignment_ends": silver.QUERIES["silver_assignment_ends"],
    "daily_clients": f"""
SELECT client_id, city, client_id % 3 <> 0 AS is_current, {DAY.format(1)} AS valid_from FROM s_clients
UNION ALL SELECT client_id, 'Elsewhere', TRUE, {DAY.format(3)} FROM s_clients WHERE client_id % 3 = 0""",
    "daily_portfolio": silver.QUERIES["silver_portfolio"] + " WHERE l_linenumber % 4 <> 0",
    "ingest_marks": """
SELECT o_custkey AS worker_id, o_orderkey AS contract_id, o_orderdate::DATE AS start_date,
  CASE WHEN o_orderkey % 50 = 1 THEN DATE '2050-12-31' ELSE (o_orderdate::DATE + 30)::DATE END AS end_date FROM orders""",
    "mart_refresh_placement_delay": gold.QUERIES["placement_delay"],
    "mart_refresh_monthly_revenue": "SELECT * FROM m_monthly_revenue",
    "distinct_rollup": " UNION ALL ".join(
        f"SELECT branch_id, '{grain}' AS grain, DATE_TRUNC('{grain}', start_date)::DATE AS period, "
        "COUNT(DISTINCT worker_id) AS workers FROM v_assignments WHERE start_date IS NOT NULL GROUP BY 1, 3"
        for grain in ("day", "week", "month", "quarter", "year")
    ),
    "erase_subjects": """
SELECT o_custkey AS client_id, o_orderkey AS order_id, o_orderstatus, n.lines FROM orders
LEFT JOIN (SELECT l_orderkey, COUNT(DISTINCT l_linenumber) AS lines FROM lineitem GROUP BY 1) n ON n.l_orderkey = o_orderkey
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
    "merge_touched_partitions": """
SELECT order_id, client_id, order_date, status, STRFTIME(order_date, 'm%Y-%m') AS part FROM (
  SELECT o_orderkey AS order_id, o_custkey AS client_id,
    (o_orderdate::DATE + CASE WHEN o_orderkey % 50 = 1 THEN 40 ELSE 0 END)::DATE AS order_date,
    CASE WHEN o_orderkey % 50 = 1 THEN 'M' ELSE o_orderstatus END AS status FROM orders WHERE o_orderkey % 100 <> 7)""",
    "raw_rejects": """
SELECT 'delivered' AS outcome, COUNT(*) AS count FROM lineitem
UNION ALL SELECT CASE WHEN l_linenumber = 3 THEN 'rejected' ELSE 'good' END, COUNT(*) FROM lineitem GROUP BY 1""",
}
