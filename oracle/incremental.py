"""SQL of the incremental, quality, privacy and streaming queries."""

from __future__ import annotations

SINCE = "TIMESTAMP '2024-01-15 00:00:00'"
T1, T2, T3 = (f"TIMESTAMP '{t} 00:00:00'" for t in ("1996-07-01", "1998-07-01", "2001-08-02"))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def state(until: str, since: str = "") -> str:
    recent = f" AND o_orderdate >= {since}" if since else ""
    return f"""SELECT o_custkey AS client_id, o_orderpriority AS last_priority, o_orderstatus AS last_status,
  o_orderdate::DATE AS last_order, MD5(LENGTH(o_orderpriority) || ':' || o_orderpriority || LENGTH(o_orderstatus) || ':' || o_orderstatus) AS change_hash
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders WHERE o_orderdate < {until}) WHERE rn = 1{recent}"""


COLUMNS = "client_sk, change_hash, client_id, last_priority, last_status, last_order, is_current, valid_from, valid_to"


def opened(view: str, at: str) -> str:
    stamp = at.split("'")[1]
    return f"""SELECT MD5(client_id || '|{stamp}') AS client_sk, change_hash, client_id, last_priority, last_status, last_order,
  TRUE AS is_current, {at} AS valid_from, NULL::TIMESTAMP AS valid_to FROM {view}"""


def merge(staging: str, existing: str, at: str) -> str:
    return f"""
SELECT n.*, CASE WHEN e.client_id IS NULL THEN 'new' ELSE 'changed' END AS change FROM ({opened(staging, at)}) n
LEFT JOIN (SELECT client_id, change_hash FROM {existing} WHERE is_current) e ON e.client_id = n.client_id
WHERE e.client_id IS NULL OR e.change_hash <> n.change_hash
UNION ALL SELECT {COLUMNS}, 'historical' AS change FROM {existing} WHERE NOT is_current
UNION ALL
SELECT e.client_sk, e.change_hash, e.client_id, e.last_priority, e.last_status, e.last_order,
  s.client_id IS NULL OR s.change_hash = e.change_hash AS is_current, e.valid_from,
  CASE WHEN s.change_hash <> e.change_hash THEN {at} ELSE e.valid_to END AS valid_to,
  CASE WHEN s.change_hash <> e.change_hash THEN 'closed' ELSE 'unchanged' END AS change
FROM (SELECT * FROM {existing} WHERE is_current) e LEFT JOIN {staging} s ON s.client_id = e.client_id"""


VIEWS = {
    "i_state1": state(T1),
    "i_state2": state(T2, "TIMESTAMP '1996-07-01 00:00:00'"),
    "i_state3": state(T3, "TIMESTAMP '1999-08-02 00:00:00'"),
    "i_state3_all": state(T3),
    "i_load1": opened("i_state1", T1),
    "i_load2": merge("i_state2", "i_load1", T2),
    "i_load3": merge("i_state3", "i_load2", T3),
    "i_runs": """
SELECT event_type || '_' || (user_id % 10) AS pipeline, ts AS started_at,
  ts + TO_MICROSECONDS(CAST(ROUND(value * 1000000) AS BIGINT)) AS ended_at, user_id % 3 AS tables_processed,
  CAST(props->>'$.k' AS BIGINT) % 2 AS error_count, event_type AS layer FROM events""",
    "i_drift": """
SELECT 'events' AS domain, d.table_name, COUNT(*) AS expected_columns, COUNT(k.column_name) + MAX(e.extra_columns) AS actual_columns,
  COALESCE(STRING_AGG(d.column_name, ',' ORDER BY d.column_name) FILTER (WHERE k.column_name IS NULL AND NOT d.uncertain), '') AS missing,
  COALESCE(STRING_AGG(d.column_name, ',' ORDER BY d.column_name) FILTER (WHERE k.column_name IS NULL AND d.uncertain), '') AS missing_uncertain,
  MAX(e.extra) AS extra,
  CASE WHEN COUNT(k.column_name) + MAX(e.extra_columns) = 0 THEN 'NOT_FOUND' WHEN COUNT(k.column_name) = COUNT(*) THEN 'PASS'
       WHEN COUNT(*) FILTER (WHERE k.column_name IS NULL AND NOT d.uncertain) = 0 THEN 'WARN' ELSE 'FAIL' END AS status
FROM i_declared d LEFT JOIN i_keys k ON k.table_name = d.table_name AND k.column_name = d.column_name
JOIN (SELECT d.table_name, COUNT(k.column_name) AS extra_columns, COALESCE(STRING_AGG(k.column_name, ',' ORDER BY k.column_name), '') AS extra
  FROM (SELECT DISTINCT table_name FROM i_declared) d LEFT JOIN i_keys k ON k.table_name = d.table_name
    AND NOT EXISTS (SELECT 1 FROM i_declared x WHERE x.table_name = k.table_name AND x.column_name = k.column_name)
  GROUP BY 1) e ON e.table_name = d.table_name
GROUP BY d.table_name""",
    "i_declared": """
SELECT * FROM (VALUES ('click', 'k', FALSE), ('view', 'k', FALSE), ('view', 'source', TRUE), ('purchase', 'k', FALSE),
  ('purchase', 'amount', FALSE), ('signup', 'plan', FALSE), ('refund', 'k', FALSE)) AS t(table_name, column_name, uncertain)""",
    "i_keys": "SELECT DISTINCT event_type AS table_name, UNNEST(JSON_KEYS(props)) AS column_name FROM events",
    "i_changes": """
SELECT user_id AS worker_id, CAST(props->>'$.k' AS BIGINT) AS contract_id,
  CASE event_type WHEN 'error' THEN 'd' WHEN 'purchase' THEN 'c' WHEN 'view' THEN 'x' ELSE 'u' END AS op,
  EPOCH_US(ts) // 1000 AS ts_ms, event_id, value FROM events""",
    "i_monthly_net": "SELECT STRFTIME(month, '%Y-%m') AS period, SUM(net_revenue)::DECIMAL(18,2)::DOUBLE AS net FROM m_monthly_revenue GROUP BY 1",
    "i_expected": """
SELECT period, net, net * (CASE LEFT(period, 4) WHEN '1996' THEN 1.004::DOUBLE WHEN '1997' THEN 1.01::DOUBLE WHEN '2001' THEN 0.0::DOUBLE
  ELSE 1.0::DOUBLE END) AS expected FROM i_monthly_net""",
}


def rule(suite: str, name: str, view: str, good: str, base: str, mostly: float) -> str:
    observed = f"COALESCE((COUNT(*) FILTER (WHERE {good}))::DOUBLE / NULLIF({base}, 0), 1)::DOUBLE"
    return (
        f"SELECT '{suite}' AS suite, '{name}' AS rule, ROUND({observed}, 6) AS observed, {mostly}::DOUBLE AS threshold, "
        f"{observed} >= {mostly} AS passed FROM {view}"
    )


def unique(suite: str, column: str, view: str) -> str:
    observed = "COALESCE((SUM(n) FILTER (WHERE n = 1))::DOUBLE / SUM(n), 0)::DOUBLE"
    return (
        f"SELECT '{suite}' AS suite, 'unique:{column}' AS rule, ROUND({observed}, 6) AS observed, 1.0::DOUBLE AS threshold, "
        f"{observed} >= 1 AS passed FROM (SELECT {column}, COUNT(*) AS n FROM {view} WHERE {column} IS NOT NULL GROUP BY 1)"
    )


def between(suite: str, column: str, view: str, low: str | None, high: str | None, mostly: float) -> str:
    tests = [f"{column} >= {low}" if low else "", f"{column} <= {high}" if high else ""]
    return rule(suite, f"between:{column}", view, " AND ".join(t for t in tests if t), f"COUNT({column})", mostly)


EXPECTATIONS = " UNION ALL ".join(
    [
        "SELECT 'workers' AS suite, 'exists:worker_id' AS rule, 1.0::DOUBLE AS observed, 1.0::DOUBLE AS threshold, TRUE AS passed",
        rule("workers", "not_null:worker_id", "s_workers", "worker_id IS NOT NULL", "COUNT(*)", 1.0),
        unique("workers", "worker_id", "s_workers").replace("unique:worker_id", "unique:worker_sk"),
        rule("workers", "length:nir_hash", "s_workers", "LENGTH(nir_hash) = 64", "COUNT(nir_hash)", 0.0),
        between("workers", "birth_date", "s_workers", "DATE '1940-01-01'", "DATE '2010-01-01'", 0.95),
        rule("skills", "not_null:worker_id", "s_skills", "worker_id IS NOT NULL", "COUNT(*)", 1.0),
        rule("skills", "in_set:skill_type", "s_skills", "skill_type IN ('METIER', 'HABILITATION', 'DIPLOME', 'EXPERIENCE')",
             "COUNT(skill_type)", 1.0),
        unique("skills", "skill_id", "s_skills"),
        "SELECT 'skills' AS suite, 'row_count' AS rule, COUNT(*)::DOUBLE AS observed, 1000.0::DOUBLE AS threshold, COUNT(*) >= 1000 AS passed FROM s_skills",
        rule("worker_activity", "not_null:worker_id", "m_activity", "worker_id IS NOT NULL", "COUNT(*)", 1.0),
        between("worker_activity", "occupancy", "m_activity", "0", "2", 0.99),
        between("worker_activity", "revenue", "m_activity", "0", None, 0.95),
        between("assignment_detail", "margin_rate", "m_detail", "-0.5::DOUBLE", "0.8::DOUBLE", 0.95),
        between("assignment_detail", "duration_days", "m_detail", "0", None, 0.98),
        rule("assignment_detail", "not_null:assignment_sk", "m_detail", "assignment_sk IS NOT NULL", "COUNT(*)", 1.0),
    ]
)
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "phone": r"\+?\d[\d .()-]{7,}\d",
    "iban": r"\b[A-Z]{2}\d{2}[A-Z0-9]{11,30}\b",
    "ip_address": r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b",
}


def pii(table: str, column: str) -> str:
    tests = {k: f"REGEXP_MATCHES({column}, '{p}')" for k, p in PATTERNS.items()}
    hits = ", ".join(f"COUNT(*) FILTER (WHERE {t}) AS {k}_hits" for k, t in tests.items())
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, COUNT({column}) AS filled, {hits}, "
        f"ROUND((COUNT(*) FILTER (WHERE {' OR '.join(tests.values())}))::DOUBLE / COUNT({column}), 4) AS pii_share FROM {table}"
    )


def attribute(a: str) -> str:
    return f"ARG_MIN({a}, (rk, {a})) FILTER (WHERE {a} IS NOT NULL) AS {a}, ARG_MIN(src, (rk, {a})) FILTER (WHERE {a} IS NOT NULL) AS {a}_source"


def copied(name: str, source: str, target: str) -> str:
    return f"""SELECT '{name}' AS table_name, s AS source_rows, t AS target_rows, ROUND(t::DOUBLE / s, 6) AS integrity, t::DOUBLE / s >= 0.99 AS passed
FROM (SELECT COUNT(*) AS s FROM {source}), (SELECT COUNT(*) AS t FROM {target})"""


COLUMN_COUNTS = {
    "region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11, "events": 6,
    "documents": 5, "embeddings": 3, "pages": 3, "benchmark": 2, "labels": 3, "conversations": 4,
}

QUERIES = {
    "scd2_first_load": "SELECT * FROM i_load1",
    "scd2_merge": "SELECT * FROM i_load3",
    "current_versions": f"SELECT {COLUMNS} FROM i_load3 WHERE is_current",
    "as_of_versions": f"""SELECT {COLUMNS} FROM i_load3 WHERE valid_from <= TIMESTAMP '1999-01-01 00:00:00'
  AND (valid_to IS NULL OR valid_to > TIMESTAMP '1999-01-01 00:00:00')""",
    "changed_rows": """
SELECT COALESCE(o.client_id, n.client_id) AS client_id, o.change_hash AS old_hash, n.change_hash AS new_hash,
  CASE WHEN o.client_id IS NULL THEN 'added' WHEN n.client_id IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM i_state1 o FULL OUTER JOIN i_state3_all n ON n.client_id = o.client_id
WHERE o.change_hash IS DISTINCT FROM n.change_hash""",
    "golden_record": f"""
SELECT client_id, {attribute('name')}, {attribute('city')}, {attribute('status')} FROM (
  SELECT c_custkey AS client_id, UPPER(c_name) AS name, NULL AS city, NULL AS status, 1 AS rk, 'manual' AS src FROM customer WHERE c_acctbal > 8000
  UNION ALL SELECT c_custkey, c_name, NULL, CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_mktsegment END, 2, 'erp' FROM customer
  UNION ALL SELECT c_custkey, NULL, n_name, NULL, 3, 'address_register' FROM customer JOIN nation ON n_nationkey = c_nationkey
  UNION ALL SELECT o_custkey, NULL, '?', o_orderstatus, 4, 'inferred' FROM orders) GROUP BY 1""",
    "enrich_current": """
SELECT c_custkey AS client_id, c_name, c_mktsegment <> 'BUILDING' AS is_current,
  CASE WHEN c_mktsegment <> 'BUILDING' AND c_acctbal / 10000.0::DOUBLE >= 0.5 THEN c_nationkey / 2.0::DOUBLE END AS latitude,
  CASE WHEN c_mktsegment <> 'BUILDING' AND c_acctbal / 10000.0::DOUBLE >= 0.5 THEN c_nationkey / 4.0::DOUBLE END AS longitude FROM customer""",
    "delta_extract": f"SELECT * FROM events WHERE ts >= {SINCE} OR ts IS NULL",
    "watermark_upsert": f"""
SELECT COALESCE(s.t, u.t) AS table_name, 'events' AS pipeline,
  CASE WHEN u.ok THEN u.high_mark WHEN s.t IS NOT NULL THEN s.last_success ELSE TIMESTAMP '1970-01-01 00:00:00' END AS last_success,
  CASE WHEN u.t IS NULL OR u.ok THEN 'success' ELSE 'failed' END AS last_status,
  CASE WHEN NOT u.ok THEN REPEAT('lost ', 300) END AS last_error,
  (CASE WHEN s.t IS NULL THEN 0 ELSE 1 END + CASE WHEN u.ok THEN 1 ELSE 0 END)::BIGINT AS run_count,
  (COALESCE(s.n, 0) + CASE WHEN u.ok THEN u.n ELSE 0 END)::BIGINT AS rows_ingested
FROM (SELECT event_type AS t, MAX(ts) AS last_success, COUNT(*) AS n FROM events WHERE ts < {SINCE} AND event_type <> 'view' GROUP BY 1) s
FULL OUTER JOIN (SELECT event_type AS t, MAX(ts) AS high_mark, COUNT(*) AS n, event_type NOT IN ('error', 'view') AS ok
  FROM events WHERE ts >= {SINCE} GROUP BY 1) u ON u.t = s.t""",
    "last_run_per_pipeline": """
SELECT pipeline, started_at, ended_at, tables_processed, error_count, layer,
  CASE WHEN error_count = 0 THEN 'success' WHEN tables_processed > 0 THEN 'partial' ELSE 'failed' END AS status,
  ((EPOCH_US(ended_at) - EPOCH_US(started_at)) / 1000000.0)::DECIMAL(10,3) AS duration_s
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY pipeline ORDER BY started_at DESC, ended_at, tables_processed, error_count) AS rn FROM i_runs)
WHERE rn = 1""",
    "horizon_lines": "SELECT l.* FROM lineitem l JOIN orders ON o_orderkey = l_orderkey WHERE o_orderdate >= DATE '1998-01-01'",
    "expectations_report": EXPECTATIONS,
    "reconcile_revenue": """
SELECT period, net AS actual, expected, ROUND(ABS(net - expected) / ABS(NULLIF(expected, 0)) * 100, 3) AS delta_pct,
  CASE WHEN expected = 0 THEN 'UNCALIBRATED' WHEN ABS(net - expected) / ABS(NULLIF(expected, 0)) * 100 < 0.5 THEN 'PASS' ELSE 'FAIL' END AS status
FROM i_expected""",
    "schema_drift": "SELECT * FROM i_drift",
    "schema_drift_by_domain": "SELECT domain, status, COUNT(*) AS tables FROM i_drift GROUP BY 1, 2",
    "table_probe": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS row_count, {COLUMN_COUNTS[t]} AS column_count FROM {t}" for t in TABLES
    ),
    "copy_integrity": " UNION ALL ".join(
        [copied("invoices", "orders", "v_invoices"), copied("invoice_lines", "lineitem", "v_invoice_lines"),
         copied("clients", "customer", "v_clients")]
    ),
    "pseudonymize": "SELECT c_custkey, c_nationkey, SHA256(c_name || 'sample-tables-only-salt') AS name_hash FROM customer",
    "pii_profile": " UNION ALL ".join([pii("documents", "text"), pii("pages", "html"), pii("conversations", "text")]),
    "forget_subjects": """SELECT o_custkey AS client_id, o_orderkey, o_orderstatus FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
    "secure_view": """SELECT c_custkey, c_nationkey, c_mktsegment FROM customer
WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2)""",
    "reject_split": """SELECT CASE WHEN event_type = 'error' THEN 'reject' ELSE 'good' END AS outcome, event_id,
  CASE WHEN event_type <> 'error' THEN event_type END AS event_type FROM events""",
    "stream_ingest": "SELECT *, ts::DATE AS load_date FROM events",
    "load_partitions": "SELECT STRFTIME(ts, '%Y-%m-%d') AS load_date, COUNT(*) AS row_count FROM events GROUP BY 1",
    "cdc_upsert": """
SELECT worker_id, contract_id, op, ts_ms, event_id, value FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY worker_id, contract_id ORDER BY ts_ms DESC, op = 'd' DESC, op, event_id, value) AS rn
  FROM i_changes WHERE op <> 'x') WHERE rn = 1 AND op <> 'd'""",
    "missing_declaration_alert": """
SELECT s.user_id AS worker_id, s.ts AS started_at, s.event_id FROM events s WHERE s.event_type = 'purchase'
  AND NOT EXISTS (SELECT 1 FROM events d WHERE d.event_type = 'view' AND d.user_id = s.user_id
    AND d.ts <= s.ts AND d.ts >= s.ts - INTERVAL 8 HOUR)""",
    "weekly_hours_stream": """
SELECT user_id, DATE_TRUNC('week', ts)::DATE AS week, SUM(value::DECIMAL(10,2))::DECIMAL(18,2) AS hours, COUNT(*) AS sheets
FROM events GROUP BY 1, 2""",
}
QUERIES |= {
    "expectations_incremental": QUERIES["expectations_report"],
    "reconcile_file": QUERIES["reconcile_revenue"],
    "declaration_alert_live": QUERIES["missing_declaration_alert"],
    "append_checked": """
SELECT YEAR(o_orderdate)::INT AS order_year, COUNT(*) AS source_rows, COUNT(*) AS added_rows, COUNT(*) AS stored_rows FROM orders GROUP BY 1""",
    "empty_source_guard": """
SELECT step, step IN (0, 2) AS replaced, rows_left, key_sum FROM (SELECT UNNEST([0, 1, 2, 3])::INT AS step),
  (SELECT COUNT(*) AS rows_left, SUM(c_custkey)::BIGINT AS key_sum FROM customer WHERE c_custkey % 2 = 0)""",
    "run_counters": """
SELECT event_type, COUNT(*) AS processed, COUNT(*) FILTER (WHERE value < 10 OR value IS NULL) AS rejected,
  NULLIF(COUNT(*) FILTER (WHERE value >= 10), 0) AS written FROM events GROUP BY 1""",
    "hours_per_contract_bucketed": """
SELECT a.worker_id, a.contract_id, a.client_id, a.branch_id, a.start_date, c.pay_rate, c.bill_rate, c.trade_id,
  h.hours_paid, h.hours_billed, h.line_bill_rate
FROM v_assignments a LEFT JOIN v_contracts c ON c.worker_id = a.worker_id AND c.contract_id = a.contract_id
LEFT JOIN v_hours h ON h.worker_id = a.worker_id AND h.contract_id = a.contract_id""",
    "scd2_out_of_order": """
SELECT client_id, last_priority, last_status, change_hash, valid_from,
  LEAD(valid_from) OVER (PARTITION BY client_id ORDER BY valid_from) AS valid_to
FROM (SELECT *, LAG(change_hash) OVER (PARTITION BY client_id ORDER BY valid_from) AS before FROM (
  SELECT o_custkey AS client_id, o_orderdate::TIMESTAMP AS valid_from, o_orderpriority AS last_priority, o_orderstatus AS last_status,
    MD5(LENGTH(o_orderpriority) || ':' || o_orderpriority || LENGTH(o_orderstatus) || ':' || o_orderstatus) AS change_hash
  FROM orders QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) = 1))
WHERE before IS DISTINCT FROM change_hash""",
    "cdc_merge_on_read": QUERIES["cdc_upsert"],
    "weekly_hours_compacted": QUERIES["weekly_hours_stream"],
}
