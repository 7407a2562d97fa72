"""SQL of the silver builders on the raw-shaped views."""

from __future__ import annotations

AS_OF = "DATE '2001-08-01'"
ORDERS = "orders JOIN customer ON c_custkey = o_custkey"


def newest(source: str, keys: str, loaded: str, **columns: str) -> str:
    """Project, then keep the newest load per key; the other columns break ties in their order."""
    key_list = [k.strip() for k in keys.split(",")]
    ties = ", ".join(f"{c} ASC NULLS LAST" for c in columns if c not in key_list)
    projected = ", ".join(f"{e} AS {c}" for c, e in columns.items())
    present = " AND ".join(f"{k} IS NOT NULL" for k in key_list)
    order = f"loaded DESC{', ' + ties if ties else ''}"
    return f"""SELECT {', '.join(columns)} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn
  FROM (SELECT {projected}, {loaded} AS loaded FROM {source})) WHERE rn = 1 AND {present}"""



KEY = {"worker_id": "l_suppkey", "contract_id": "l_orderkey"}
DIGIT = "LEFT(o_orderpriority, 1)"
NIC = "CASE WHEN o_orderstatus <> 'P' THEN '00012' END"
ADDRESS = "o_orderpriority || ' ' || c_nationkey || ' ' || c_mktsegment || ' '"
HOURS = "(EPOCH(DATE_TRUNC('hour', {b})) - EPOCH(DATE_TRUNC('hour', {a})))::BIGINT // 3600"


def line(keys: str, **columns: str) -> str:
    return newest("lineitem", keys, "l_shipdate", **columns)


def order(keys: str, **columns: str) -> str:
    return newest(ORDERS, keys, "o_orderdate", **columns)


VIEWS = {
    "s_span": """
SELECT l_suppkey AS worker_id, l_orderkey AS contract_id, MIN(l_shipdate::DATE - l_quantity::INT) AS starts,
  MAX(l_shipdate)::DATE AS ends FROM lineitem GROUP BY 1, 2""",
    "s_missions": line(
        "worker_id, contract_id",
        **KEY,
        client_id="l_partkey",
        site_id="l_linenumber",
        branch_id="l_linenumber",
        end_date="l_shipdate::DATE",
        end_code="CASE WHEN l_linestatus = 'F' THEN l_returnflag END",
        declared_at="CASE WHEN l_returnflag <> 'N' THEN l_shipdate + (l_linenumber - 4) * INTERVAL 6 HOUR END",
        order_id="l_orderkey",
    ),
    "s_ends": line(
        "worker_id, contract_id",
        **KEY,
        branch_id="l_linenumber",
        client_id="l_partkey",
        entered_end="l_shipdate::DATE",
        end_code="CASE WHEN l_linestatus = 'F' THEN l_returnflag END",
        cancelled="CASE WHEN l_discount = 0 THEN 1 ELSE 0 END",
    ),
    "s_end_codes": """
SELECT DISTINCT l_returnflag AS end_code,
  CASE l_returnflag WHEN 'A' THEN 'Fin normale' WHEN 'N' THEN 'Terme prévu' ELSE 'Autre' END AS end_label,
  CASE l_returnflag WHEN 'N' THEN 1 WHEN 'R' THEN 2 END AS reason_id FROM lineitem""",
    "s_reasons": """
SELECT DISTINCT CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS reason_id, o_orderstatus AS reason_code,
  CASE o_orderstatus WHEN 'F' THEN 'Fin de mission TT' WHEN 'O' THEN 'Démission' ELSE 'Changement' END AS reason_label,
  CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS reason_closes FROM orders""",
    "s_invoices": order(
        "invoice_id",
        invoice_id="o_orderkey::VARCHAR",
        branch_id="c_nationkey",
        client_id="o_custkey",
        site_id=f"{DIGIT}::BIGINT",
        doc_type="CASE WHEN o_orderstatus = 'P' THEN 'A' ELSE 'F' END",
        invoice_date="o_orderdate::DATE",
        due_date="(o_orderdate::DATE + 30)::DATE",
        amount_net="NULL::DECIMAL(18,2)",
        amount_gross="NULL::DECIMAL(18,2)",
        vat_rate="CASE WHEN o_orderstatus <> 'O' THEN 0.2::DECIMAL(6,4) END",
    ),
    "s_sites": order(
        "client_id, site_id",
        client_id="o_custkey",
        site_id=f"{DIGIT}::BIGINT",
        client_name="c_name",
        siren="LPAD(o_custkey::VARCHAR, 9, '0')",
        nic=NIC,
        naf_code="CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus ELSE '7820Z' END",
        address=ADDRESS,
        city="c_mktsegment",
        postcode="c_nationkey::VARCHAR",
        loaded_at="o_orderdate",
    ),
    "s_clients": """
SELECT s.client_id, client_name, siren, nic, naf_code,
  COALESCE(CASE WHEN c.c_acctbal > 0 THEN 'Secteur ' || c.c_mktsegment END, '') AS naf_label, address, city, postcode,
  COALESCE(CASE WHEN c.c_mktsegment NOT IN ('HOUSEHOLD', 'BUILDING') THEN c.c_mktsegment END,
    CASE WHEN c.c_acctbal > 0 THEN 'Client actif' END, 'INCONNU') AS client_status,
  c.c_acctbal::DECIMAL(18,2) AS potential_revenue, NULL::DATE AS created_on, '10-19' AS headcount_range
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY client_id ORDER BY loaded_at DESC, site_id) AS newest_site FROM s_sites) s
JOIN customer c ON c.c_custkey = s.client_id WHERE newest_site = 1""",
    "s_payroll": line("worker_id", worker_id="l_suppkey", matricule="'M' || l_suppkey", hired_on="l_shipdate::DATE",
                      is_active="l_linestatus = 'F'"),
    "s_profiles": line("worker_id", worker_id="l_suppkey", is_candidate="l_returnflag = 'A'", is_permanent="l_returnflag = 'R'"),
    "s_home": line("worker_id", worker_id="l_suppkey", home_branch="l_linenumber::BIGINT"),
    "s_workers": """
SELECT s.s_suppkey AS worker_id, s.s_name AS last_name, 'Alex' AS first_name, DATE '1980-05-17' AS birth_date,
  'FR' AS nationality, '' AS country, 'Rue ' || s_nationkey || '  Lyon ' AS address, 'Lyon' AS city,
  s_nationkey::VARCHAR AS postcode, p.matricule, p.hired_on, COALESCE(p.is_active, FALSE) AS is_active,
  COALESCE(i.is_candidate, FALSE) AS is_candidate, COALESCE(i.is_permanent, FALSE) AS is_permanent, h.home_branch,
  NULL::DATE AS left_on,
  CASE WHEN s_acctbal > 0 THEN SHA256(LPAD(s_suppkey::VARCHAR, 13, '1') || 'sample-tables-only-salt') END AS nir_hash
FROM supplier s LEFT JOIN s_payroll p ON p.worker_id = s.s_suppkey LEFT JOIN s_profiles i ON i.worker_id = s.s_suppkey
LEFT JOIN s_home h ON h.worker_id = s.s_suppkey""",
    "s_trade_skills": """
SELECT MD5(l_suppkey || '|METIER|' || l_partkey) AS skill_id, l_suppkey AS worker_id, 'METIER' AS skill_type,
  l_partkey::VARCHAR AS code, COALESCE(p_type, 'Métier inconnu') AS label, NULL::VARCHAR AS level, NULL::DATE AS obtained_on,
  NULL::DATE AS expires_on, COALESCE(p_size, 0) <= 45 AS is_active, CASE WHEN p_size > 10 THEN p_type END AS pcs_code,
  'WTPMET' AS source_table, l_shipdate AS loaded
FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""",
    "s_cert_ref": """
SELECT p_size AS id, p_brand AS label, p_size * 3 AS months FROM (
  SELECT p_size, p_brand, ROW_NUMBER() OVER (PARTITION BY p_size ORDER BY p_brand) AS rn FROM part WHERE p_size > 2) WHERE rn = 1""",
    "s_cert_skills": f"""
SELECT MD5(l_suppkey || '|HABILITATION|' || l_linenumber) AS skill_id, l_suppkey AS worker_id, 'HABILITATION' AS skill_type,
  l_linenumber::VARCHAR AS code, COALESCE(r.label, 'Habilitation inconnue') AS label, '' AS level, l_shipdate::DATE AS obtained_on,
  expires AS expires_on, expires IS NULL OR expires > {AS_OF} AS is_active, NULL::VARCHAR AS pcs_code, 'WTPHAB' AS source_table,
  l_shipdate AS loaded
FROM (SELECT l.*, r.label, CASE WHEN l_returnflag = 'R' THEN l_shipdate::DATE + 90
        ELSE (l_shipdate::DATE + r.months * INTERVAL 1 MONTH)::DATE END AS expires
      FROM lineitem l LEFT JOIN s_cert_ref r ON r.id = l_linenumber) r""",
    "s_degree_skills": """
SELECT MD5(l_suppkey || '|DIPLOME|' || l_returnflag) AS skill_id, l_suppkey AS worker_id, 'DIPLOME' AS skill_type,
  l_returnflag AS code, CASE WHEN l_returnflag = 'A' THEN 'Diplôme inconnu' ELSE 'Diplôme ' || l_returnflag END AS label,
  CASE WHEN l_returnflag = 'R' THEN 'III' END AS level, l_shipdate::DATE AS obtained_on, NULL::DATE AS expires_on, TRUE AS is_active,
  NULL::VARCHAR AS pcs_code, 'WTPDIP' AS source_table, l_shipdate AS loaded FROM lineitem""",
    "s_experience_skills": """
SELECT MD5(l_suppkey || '|EXPERIENCE|' || l_orderkey) AS skill_id, l_suppkey AS worker_id, 'EXPERIENCE' AS skill_type,
  l_orderkey::VARCHAR AS code, CASE WHEN l_linestatus = 'F' THEN l_returnflag ELSE 'Expérience inconnue' END AS label,
  NULL::VARCHAR AS level, l_shipdate::DATE AS obtained_on, NULL::DATE AS expires_on, TRUE AS is_active, NULL::VARCHAR AS pcs_code,
  'WTEXP' AS source_table, l_shipdate AS loaded FROM lineitem""",
    "s_skills": """
SELECT * EXCLUDE (loaded, rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY skill_id ORDER BY loaded DESC, worker_id, skill_type, code, label, level NULLS LAST,
    obtained_on NULLS LAST, expires_on NULLS LAST, is_active, pcs_code NULLS LAST, source_table) AS rn
  FROM (SELECT * FROM s_trade_skills UNION ALL SELECT * FROM s_cert_skills UNION ALL SELECT * FROM s_degree_skills
        UNION ALL SELECT * FROM s_experience_skills)) WHERE rn = 1""",
    "s_management": """
SELECT * FROM (SELECT c_nationkey AS branch_id, LOWER(n_name) AS name, c_mktsegment AS brand,
    CASE WHEN c_mktsegment <> 'BUILDING' THEN 'BTP' END AS line, n_name AS commercial_name, n_regionkey::VARCHAR AS commercial_code,
    ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_mktsegment,
      CASE WHEN c_mktsegment = 'BUILDING' THEN ' ' ELSE 'BTP' END) AS rn
  FROM customer JOIN nation ON n_nationkey = c_nationkey) WHERE rn = 1""",
    "s_branches": """
SELECT MD5(n_nationkey::VARCHAR) AS branch_sk, n_nationkey AS branch_id, n_name AS branch_name, 'N' || n_nationkey AS branch_code,
  n_regionkey = 4 AS is_closed, n_regionkey <> 4 AS is_active, CASE WHEN n_regionkey = 4 THEN DATE '2000-06-30' END AS closed_on,
  m.brand, m.line, m.commercial_name, m.commercial_code, NULL::VARCHAR AS city, NULL::VARCHAR AS email
FROM nation LEFT JOIN s_management m ON m.branch_id = n_nationkey""",
    "s_territory": """
SELECT DISTINCT m.branch_id, r_name AS sector, LEFT(r_name, 2) AS perimeter, r_name AS zone
FROM s_management m JOIN nation n ON LOWER(n.n_name) = m.name JOIN supplier ON s_nationkey = n.n_nationkey
JOIN region ON r_regionkey = n.n_regionkey""",
    "s_trades": """
SELECT MD5(p_partkey::VARCHAR) AS trade_sk, p_partkey AS trade_id, p_brand AS trade_code, p_type AS trade_name,
  COALESCE(q.label, '') AS qualification, p_size::VARCHAR AS speciality, '' AS level,
  CASE WHEN p_size > 10 THEN p_type END AS pcs_code
FROM part LEFT JOIN (SELECT p_size AS id, p_brand AS label, ROW_NUMBER() OVER (PARTITION BY p_size ORDER BY LENGTH(p_type) DESC, p_brand) AS rn
  FROM part WHERE p_size > 5) q ON q.id = p_size AND q.rn = 1
WHERE p_size <= 45""",
}

QUERIES = {
    "silver_assignments": f"""
SELECT m.*, s.starts AS start_date, {HOURS.format(a='s.starts::TIMESTAMP', b='m.declared_at')} AS declaration_gap_hours,
  {HOURS.format(a='o.o_orderdate', b='s.starts::TIMESTAMP')} AS placement_delay_hours,
  CASE WHEN o.o_orderdate IS NULL THEN 'inconnu' WHEN {HOURS.format(a='o.o_orderdate', b='s.starts::TIMESTAMP')} <= 24 THEN 'urgent'
       WHEN {HOURS.format(a='o.o_orderdate', b='s.starts::TIMESTAMP')} <= 72 THEN 'court'
       WHEN {HOURS.format(a='o.o_orderdate', b='s.starts::TIMESTAMP')} <= 168 THEN 'standard' ELSE 'long' END AS delay_class
FROM s_missions m LEFT JOIN s_span s ON s.worker_id = m.worker_id AND s.contract_id = m.contract_id
LEFT JOIN orders o ON o.o_orderkey = m.order_id""",
    "silver_contracts": line(
        "worker_id, contract_id, amendment",
        **KEY,
        amendment="l_linenumber",
        trade_id="l_partkey",
        pcs_code="l_returnflag",
        start_date="(l_shipdate::DATE - l_quantity::INT)::DATE",
        end_date="l_shipdate::DATE",
        pay_rate="l_extendedprice::DECIMAL(10,4)",
        bill_rate="l_quantity::DECIMAL(10,4)",
        weekly_hours="l_quantity::DECIMAL(10,2)",
        position_label="l_linestatus",
    ),
    "silver_orders": order(
        "order_id",
        order_id="o_orderkey",
        branch_id="c_nationkey",
        order_date="o_orderdate::DATE",
        headcount=f"{DIGIT}::INT",
        status="o_orderstatus",
        status_type="''",
    ),
    "silver_placements": order(
        "placement_id",
        placement_id="o_orderkey",
        branch_id="c_nationkey",
        client_id="o_custkey",
        trade_id="LENGTH(o_orderpriority)",
        status="NULL::VARCHAR",
        placement_date="o_orderdate::DATE",
    ),
    "silver_assignment_ends": """
SELECT e.*, s.starts AS start_date, s.ends AS actual_end, c.end_label, r.reason_code, r.reason_label, r.reason_closes,
  DATEDIFF('day', s.starts, s.ends) AS actual_days,
  CASE WHEN e.cancelled = 1 THEN 'ANNULEE' WHEN e.end_code IS NULL THEN 'EN_COURS' WHEN r.reason_closes = 0 THEN 'EN_COURS'
       WHEN LOWER(r.reason_label) LIKE '%fin de mission%' THEN 'TERME_NORMAL' WHEN r.reason_closes = 1 THEN 'RUPTURE'
       WHEN LOWER(c.end_label) LIKE '%terme%' OR LOWER(c.end_label) LIKE '%normal%' OR LOWER(c.end_label) LIKE '%échéance%' THEN 'TERME_NORMAL'
       ELSE 'RUPTURE' END AS end_status
FROM s_ends e LEFT JOIN s_span s ON s.worker_id = e.worker_id AND s.contract_id = e.contract_id
LEFT JOIN s_end_codes c ON c.end_code = e.end_code LEFT JOIN s_reasons r ON r.reason_id = c.reason_id""",
    "silver_payroll_contracts": order(
        "worker_id, contract_id",
        worker_id="o_custkey",
        contract_id="o_orderkey",
        site_id="c_nationkey",
        branch_id="c_nationkey",
        start_date="o_orderdate::DATE",
        end_date="(o_orderdate::DATE + 30)::DATE",
        planned_end="(o_orderdate::DATE + INTERVAL 2 MONTH)::DATE",
        payroll_batch="o_orderstatus",
        contribution_type="c_mktsegment",
        amendment=f"{DIGIT}::INT",
        initial_order="0",
    ),
    "silver_invoice_links": line(
        "contract_id, invoice_id", contract_id="l_orderkey", invoice_id="'F' || l_partkey", worker_id="l_suppkey",
        client_id="l_linenumber",
    ),
    "silver_timesheets": line(
        "sheet_id",
        sheet_id="l_orderkey",
        worker_id="l_suppkey",
        contract_id="l_orderkey",
        client_id="l_partkey",
        branch_id="NULL::BIGINT",
        modified_at="l_shipdate",
        valid="l_returnflag <> 'R'",
    ),
    "silver_timesheet_lines": line(
        "sheet_id, line_no",
        sheet_id="l_orderkey",
        line_no="l_linenumber",
        rubric="'H' || l_returnflag",
        hours_paid="l_quantity::DECIMAL(10,2)",
        pay_rate="l_discount::DECIMAL(10,4)",
        hours_billed="l_quantity::DECIMAL(10,2)",
        bill_rate="l_tax::DECIMAL(10,4)",
        label="l_linestatus",
    ),
    "silver_invoices": "SELECT * FROM s_invoices",
    "silver_invoice_lines": line(
        "invoice_id, line_no",
        invoice_id="l_orderkey::VARCHAR",
        line_no="l_linenumber",
        label="l_returnflag",
        qty="l_quantity::DECIMAL(10,2)",
        rate="l_tax::DECIMAL(10,4)",
        amount="l_extendedprice::DECIMAL(18,2)",
    ),
    "silver_payments": """
SELECT i.invoice_id, i.client_id, i.branch_id, p.paid_date, NULL::DECIMAL(18,2) AS amount_paid, NULL::VARCHAR AS payment_type,
  DATEDIFF('day', i.due_date, p.paid_date) AS delay_days
FROM s_invoices i JOIN (SELECT o_orderkey::VARCHAR AS invoice_id,
  CASE WHEN o_orderstatus = 'F' THEN (o_orderdate::DATE + c_nationkey * 4)::DATE END AS paid_date
  FROM orders JOIN customer ON c_custkey = o_custkey) p ON p.invoice_id = i.invoice_id""",
    "silver_clients": "SELECT * FROM s_clients",
    "silver_sites": order(
        "client_id, site_id",
        site_id=f"{DIGIT}::BIGINT",
        client_id="o_custkey",
        site_name="c_name",
        siren="LPAD(o_custkey::VARCHAR, 9, '0')",
        nic=NIC,
        address=ADDRESS,
        city="c_mktsegment",
        postcode="c_nationkey::VARCHAR",
        country="CASE WHEN o_orderstatus = 'O' THEN 'BE' ELSE 'FR' END",
        email="LOWER('Contact@' || c_mktsegment || '.FR')",
        branch_id="c_nationkey",
        is_active="o_orderstatus <> 'P'",
        closed_on="CASE WHEN o_orderstatus = 'P' THEN o_orderdate::DATE END",
        row_hash="MD5("
        + " || ".join(
            f"LENGTH({part}) || ':' || {part}"
            for part in (
                "LPAD(o_custkey::VARCHAR, 9, '0')",
                f"COALESCE({NIC}, '')",
                "o_orderpriority",
                "c_nationkey::VARCHAR",
                "c_mktsegment",
                "LOWER('Contact@' || c_mktsegment || '.FR')",
            )
        )
        + ")",
    ),
    "silver_contacts": order(
        "client_id, contact_no",
        contact_id=f"MD5(o_custkey || '|' || {DIGIT})",
        client_id="o_custkey",
        contact_no=f"{DIGIT}::INT",
        last_name="c_name",
        first_name="o_orderstatus",
        email="o_orderkey || '@mail.fr'",
        phone="'+33 ' || o_orderkey",
        function_code="'DRH'",
    ),
    "silver_credit_exposures": order(
        "exposure_id",
        exposure_id="o_custkey",
        siren="LPAD(o_custkey::VARCHAR, 9, '0')",
        credit_used="NULL::DECIMAL(18,2)",
        credit_limit="NULL::DECIMAL(18,2)",
        decided_on="NULL::DATE",
        decision="CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority ELSE '' END",
    ),
    "silver_workers": "SELECT * FROM s_workers",
    "silver_evaluations": line(
        "worker_id, eval_id",
        eval_id="MD5(l_suppkey || '|' || STRFTIME(l_shipdate, '%Y-%m-%d'))",
        worker_id="l_suppkey",
        evaluated_on="l_shipdate::DATE",
        grade="l_quantity::DECIMAL(5,2)",
        comment="NULL::VARCHAR",
        evaluator_id="l_partkey",
    ),
    "silver_contact_points": line(
        "worker_id, contact_id",
        contact_id="MD5(l_suppkey || '|' || l_returnflag)",
        worker_id="l_suppkey",
        contact_type="l_returnflag",
        contact_value="'06' || LPAD(l_partkey::VARCHAR, 8, '0')",
        extension="''",
        is_main="FALSE",
    ),
    "silver_portfolio": "SELECT DISTINCT l_suppkey AS worker_id, l_linenumber AS branch_id FROM lineitem",
    "skills_union": "SELECT * FROM s_skills",
    "silver_branches": "SELECT * FROM s_branches",
    "text_bridge": "SELECT * FROM s_territory",
    "branch_dim": """
SELECT b.* EXCLUDE (city), '' AS city, COALESCE(t.sector, '') AS sector, COALESCE(t.perimeter, '') AS perimeter, COALESCE(t.zone, '') AS zone
FROM s_branches b LEFT JOIN s_territory t ON t.branch_id = b.branch_id""",
    "client_dim": """
SELECT MD5(client_id || '|2001-01-01 00:00:00') AS client_sk, client_id, client_name, siren, nic, siren || nic AS siret, naf_code,
  NULLIF(naf_label, '') AS naf_label, city, postcode, client_status, headcount_range FROM s_clients""",
    "worker_dim": """
SELECT MD5(worker_id || '|2001-01-01 00:00:00') AS worker_sk, worker_id, matricule, last_name, first_name, city, postcode, hired_on,
  is_active, is_candidate, is_permanent, home_branch FROM s_workers""",
    "trade_dim": "SELECT * FROM s_trades",
    "certification_dim": """
SELECT code, MD5(code) AS certification_sk, MAX(label) AS label, BOOL_OR(is_active) AS is_active
FROM s_skills WHERE skill_type = 'HABILITATION' AND code <> '' GROUP BY code""",
    "degree_dim": """
SELECT code, MD5(code) AS degree_sk, MAX(label) AS label, MAX(level) AS level, BOOL_OR(is_active) AS is_active
FROM s_skills WHERE skill_type = 'DIPLOME' AND code <> '' GROUP BY code""",
}
