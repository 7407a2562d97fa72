from datetime import date, datetime
from decimal import Decimal

import pytest

from tallyhouse.plans.gold import assignments as asg
from tallyhouse.plans.gold import branches as brn
from tallyhouse.plans.gold import clients as cli
from tallyhouse.plans.gold import operations as ops
from tallyhouse.plans.gold import receivables as rec
from tallyhouse.plans.gold import reference as ref
from tallyhouse.plans.gold import revenue as rev
from tallyhouse.plans.gold import workforce as wrk

D = Decimal
INVOICE = "invoice_id string, client_id long, branch_id long, doc_type string, invoice_date date, due_date date"
LINE = "invoice_id string, line_no int, qty decimal(12,2), amount decimal(18,2)"
ASSIGNMENT = (
    "worker_id long, contract_id long, client_id long, branch_id long, order_id long, start_date date, end_date date, "
    "declared_at timestamp, declaration_gap_hours long, placement_delay_hours long"
)
CONTRACT = "worker_id long, contract_id long, trade_id long, start_date date, end_date date, pay_rate decimal(10,4), bill_rate decimal(10,4)"
SHEET = "sheet_id string, worker_id long, contract_id long, modified_at timestamp, valid boolean"
SHEET_LINE = "sheet_id string, hours_paid decimal(10,2), hours_billed decimal(10,2), bill_rate decimal(10,4)"


@pytest.fixture(scope="module")
def invoices(frame):
    jan, feb = date(2026, 1, 15), date(2026, 2, 15)
    return frame(
        [
            ("F1", 1, 10, "F", jan, date(2026, 2, 14)),
            ("F2", 1, 10, "F", jan, date(2026, 2, 14)),
            ("A1", 1, 10, "A", jan, date(2026, 2, 14)),
            ("F3", 2, 10, "F", jan, date(2026, 2, 14)),
            ("F4", 1, 10, "F", feb, date(2026, 3, 17)),
            ("F5", 2, 20, "F", feb, date(2026, 3, 17)),
            ("F6", 2, 20, "F", None, None),
        ],
        INVOICE,
    )


@pytest.fixture(scope="module")
def lines(frame):
    return frame(
        [
            ("F1", 1, D("10"), D("500")), ("F1", 2, D("5"), D("750")), ("F1", 3, D("1"), D("100")),
            ("F2", 1, D("4"), D("1000")), ("A1", 1, D("1"), D("350")), ("F3", 1, D("2"), D("2500")),
            ("F4", 1, D("1"), D("800")), (None, 1, D("1"), D("1")),
        ],
        LINE,
    )


@pytest.fixture(scope="module")
def assignments(frame):
    return frame(
        [
            (1, 1, 1, 10, 5, date(2026, 1, 5), date(2026, 1, 12), datetime(2026, 1, 4), -24, 4),
            (1, 2, 1, 10, 5, date(2026, 1, 15), date(2026, 2, 1), datetime(2026, 1, 16), 24, 24),
            (1, 3, 1, 10, 6, date(2026, 3, 1), None, None, None, 73),
            (2, 1, 2, 10, 7, date(2026, 1, 20), date(2026, 1, 25), None, None, None),
        ],
        ASSIGNMENT,
    )


@pytest.fixture(scope="module")
def contracts(frame):
    return frame(
        [
            (1, 1, 7, date(2026, 1, 5), date(2026, 1, 12), D("12"), D("15.5")),
            (1, 2, 7, date(2026, 1, 15), date(2026, 2, 1), D("12"), D("15.5")),
            (2, 1, 8, date(2026, 1, 20), date(2026, 1, 25), D("10"), D("14")),
        ],
        CONTRACT,
    )


@pytest.fixture(scope="module")
def sheets(frame):
    return frame(
        [
            ("s1", 1, 1, datetime(2026, 1, 7), True), ("s2", 1, 1, datetime(2026, 1, 14), True),
            ("s3", 2, 1, datetime(2026, 1, 21), True), ("s4", 2, 1, datetime(2026, 1, 22), False),
            ("s5", 9, 9, datetime(2026, 1, 22), True), ("s6", 1, 2, datetime(2026, 1, 21), True),
        ],
        SHEET,
    )


@pytest.fixture(scope="module")
def sheet_lines(frame):
    return frame(
        [
            ("s1", D("20"), D("20"), None), ("s1", D("15"), D("15"), D("16")), ("s2", D("28"), D("28"), None),
            ("s3", D("35"), D("35"), None), ("s4", D("7"), D("7"), None),
        ],
        SHEET_LINE,
    )


def test_amounts_come_from_lines(lines, rows):
    assert rows(rev.invoice_amounts(lines), "invoice_id", "amount") == [
        ("A1", D("350.00")), ("F1", D("1350.00")), ("F2", D("1000.00")), ("F3", D("2500.00")), ("F4", D("800.00"))
    ]


def test_monthly_revenue(invoices, lines, assignments, frame, rows):
    clients = frame([(1, "sk1"), (2, "sk2")], "client_id long, client_sk string")
    mart = rev.monthly_revenue_client(invoices, lines, assignments, clients)
    got = {(r["client_id"], r["month"]): r for r in mart.collect()}
    assert len(got) == 4
    january = got[1, date(2026, 1, 1)]
    assert (january["revenue"], january["credited"], january["net_revenue"]) == (D("2350.00"), D("350.00"), D("2000.00"))
    assert (january["invoices"], january["assignments"], january["billed_hours"]) == (2, 2, D("20.00"))
    assert january["mean_rate"] == round(2350 / 20, 4)
    empty = got[2, date(2026, 2, 1)]
    assert (empty["revenue"], empty["mean_rate"], empty["main_branch"]) == (D("0.00"), None, 20)


def test_concentration(frame, rows):
    dated = [(f"F{i}", i, 10, "F", date(2026, 1, 1), None) for i in range(1, 12)]
    amounts = [(f"F{i}", 1, D("1"), D(100 * i)) for i in range(1, 12)]
    mart = rev.client_concentration(frame(dated, INVOICE), frame(amounts, LINE)).first()
    assert (mart["clients"], mart["clients_top20"], mart["net_total"]) == (11, 3, D("6600.00"))
    assert mart["net_top20"] == D("3000.00") and mart["net_top5"] == D("4500.00")
    monthly = frame([(10, date(2026, 1, 1), i, D(100 * i)) for i in range(1, 12)], "main_branch long, month date, client_id long, net_revenue decimal(18,2)")
    top = rev.client_concentration_topn(monthly).first()
    assert (top["pct_top1"], top["pct_top10"], top["concentration_risk"]) == (16.67, 98.48, "NORMAL")


def test_sectors_share_sums_to_100(invoices, lines, frame):
    clients = frame([(1, "7820Z"), (2, None)], "client_id long, naf_code string")
    got = {(r["month"], r["naf_section"]): r for r in rev.sector_revenue(invoices, lines, clients).collect()}
    january = date(2026, 1, 1)
    assert got[january, "N"]["sector_label"] == "Services administratifs et de soutien"
    assert got[january, "XX"]["sector_label"] == "Non classifié"
    assert got[january, "N"]["branch_share_pct"] + got[january, "XX"]["branch_share_pct"] == pytest.approx(100, abs=0.1)
    assert (date(2026, 2, 1), "XX") not in got  # no revenue


@pytest.mark.parametrize(("code", "section"), [("01", "A"), ("04", "XX"), ("33", "C"), ("34", "XX"), ("99", "U"), ("", "XX")])
def test_sector_ranges(frame, code, section):
    assert ref.sector_lookup(frame([(code,)], "d string"), "d").first()["naf_section"] == section


def test_hours_are_not_multiplied(sheets, sheet_lines, rows):
    hours = asg.hours_per_contract(sheets, sheet_lines)
    assert rows(hours, "worker_id", "contract_id", "hours_paid", "line_bill_rate") == [
        (1, 1, D("63.00"), D("16.0000")), (1, 2, None, None), (2, 1, D("42.00"), None), (9, 9, None, None)
    ]


def test_detail_and_margin(assignments, contracts, sheets, sheet_lines):
    hours = asg.hours_per_contract(sheets, sheet_lines)
    detail = {(r["worker_id"], r["contract_id"]): r for r in asg.assignment_detail(assignments, contracts, hours).collect()}
    assert len(detail) == 4
    assert detail[1, 1]["margin"] == D("220.500000") and detail[1, 1]["margin_rate"] == round(3.5 / 15.5, 4)
    assert (detail[1, 2]["hours"], detail[1, 2]["margin_rate"]) == (D("0.00"), 0.0)
    assert detail[1, 3]["trade_id"] is None
    margin = {(r["worker_id"], r["contract_id"]): r for r in asg.assignment_margin(assignments, contracts, hours).collect()}
    assert margin[1, 1]["total_hours"] == D("126.00") and margin[1, 3]["margin_rate"] == 0.0


def test_fte(sheets, sheet_lines, assignments):
    got = {r["week"]: r for r in ops.fte_weekly(sheets, sheet_lines, assignments).collect()}
    assert got[date(2026, 1, 5)]["fte"] == 1.0
    assert got[date(2026, 1, 12)]["fte"] == 0.8
    last = got[date(2026, 1, 19)]
    assert (last["sheets"], last["workers"], last["hours"]) == (2, 2, D("35.00"))
    hours = ops.weekly_hours(sheets, sheet_lines, assignments)
    assert hours.count() == 3


def test_rubrics(frame):
    sheets = frame([("s", 1, datetime(2026, 1, 7)), ("t", 1, datetime(2026, 1, 8))], "sheet_id string, branch_id long, modified_at timestamp")
    detail = [("s", "HN", D("30")), ("s", "HS25", D("5")), ("s", "HNUIT", D("2")), ("s", "HD", D("1")), ("s", "ZZ", D("9"))]
    got = ops.weekly_hours_by_rubric(sheets, frame(detail, "sheet_id string, rubric string, hours_paid decimal(10,2)"), ["branch_id"]).collect()
    assert len(got) == 1
    row = got[0]
    kinds = ("normal_hours", "overtime_hours", "night_hours", "sunday_hours", "total_hours", "sheets")
    assert [row[k] for k in kinds] == [D("30.00"), D("5.00"), D("2.00"), D("1.00"), D("38.00"), 2]


def test_pipeline_delay_and_compliance(assignments, frame):
    orders = frame(
        [(5, 10, date(2026, 1, 1), 2, "P"), (6, 10, date(2026, 1, 2), 1, "O"), (8, 10, date(2026, 1, 3), 1, "A")],
        "order_id long, branch_id long, order_date date, headcount int, status string",
    )
    simple = {r["week"]: r for r in ops.order_pipeline(orders).collect()}[date(2025, 12, 29)]
    assert (simple["orders"], simple["filled"], simple["open"], simple["fill_rate"]) == (3, 1, 1, 0.333333)
    detail = ops.order_pipeline_detail(orders, assignments).first()
    assert (detail["orders"], detail["cancelled"], detail["requested_posts"], detail["mean_delay_days"]) == (3, 1, 4, 31.0)
    delay = {r["week"]: r for r in ops.placement_delay(assignments).collect()}
    assert delay[date(2026, 1, 12)]["pct_within_4h"] == 100.0 and len(delay) == 2
    january = {r["month"]: r for r in ops.declaration_compliance(assignments).collect()}[date(2026, 1, 1)]
    assert (january["declared"], january["in_time"], january["late"], january["missing"], january["compliance_rate"]) == (1, 1, 0, 1, 0.5)


def test_ends_durations_renewals(assignments, contracts, sheets, sheet_lines, frame):
    ends = frame([(1, 1, "RUPTURE", 7), (1, 2, "TERME_NORMAL", 17), (2, 1, "EN_COURS", 5)], "worker_id long, contract_id long, end_status string, actual_days int")
    row = asg.termination_rate(ends, assignments).collect()
    assert len(row) == 1
    assert (row[0]["assignments"], row[0]["terminations"], row[0]["termination_pct"], row[0]["mean_days_before_termination"]) == (2, 1, 50.0, 7.0)
    durations = {r["trade_id"]: r for r in asg.assignment_duration(assignments, contracts).collect()}
    assert (durations[7]["mean_days"], durations[7]["median_days"], durations[7]["duration_profile"]) == (12.0, 12.0, "MOYENNE")
    assert (durations[7]["up_to_1_week"], durations[8]["duration_profile"]) == (1, "COURTE")
    coefficient = asg.billing_coefficient(assignments, contracts, asg.hours_per_contract(sheets, sheet_lines))
    got = {r["trade_id"]: r for r in coefficient.collect()}
    assert (got[7]["weighted_coefficient"], got[7]["coefficient_level"], got[8]["coefficient_level"]) == (1.292, "MOYEN", "BON")
    renewals = {r["client_id"]: r for r in asg.renewal_rate(assignments, contracts).collect()}
    assert (renewals[1]["assignments"], renewals[1]["renewals"], renewals[1]["mean_gap_days"]) == (2, 1, 3.0)


def test_receivables(invoices, lines, frame):
    as_of = date(2026, 4, 20)
    payments = frame([("F1", 1, 10, date(2026, 1, 31), D("1350")), ("F2", 1, 10, date(2026, 3, 20), None)], "invoice_id string, client_id long, branch_id long, paid_date date, amount_paid decimal(18,2)")
    dso = {(r["client_id"], r["month"]): r for r in rec.dso_client(invoices, lines, payments, as_of).collect()}
    row = dso[1, date(2026, 1, 1)]
    assert (row["outstanding"], row["dso_days"], row["overdue"]) == (D("650.00"), round(650 / (2000 / 31), 1), D("2000.00"))
    aged = {(r["month"], r["bucket"]): r for r in rec.aged_balance(invoices, lines, as_of).collect()}
    assert aged[date(2026, 1, 1), "31-60j"]["overdue"] == D("4500.00")
    assert aged[date(2026, 2, 1), "0-30j"]["documents"] == 1
    facts = rec.settlement_facts(invoices, payments, as_of)
    status = {r["invoice_id"]: (r["settlement"], r["age_bucket"]) for r in facts.collect()}
    assert status == {
        "F1": ("REGLE_A_TEMPS", "REGLE"), "F2": ("REGLE_EN_RETARD", "REGLE"), "F3": ("EN_RETARD", "3_60_90J"),
        "F4": ("EN_RETARD", "2_30_60J"), "F5": ("EN_RETARD", "2_30_60J"),
    }
    stats = {(r["client_id"], r["month"]): r for r in rec.settlement_stats(facts).collect()}[1, date(2026, 1, 1)]
    assert (stats["settled"], stats["late"], stats["mean_days_to_pay"], stats["payment_level"]) == (2, 1, 40.0, "MOYEN")
    wide = {r["client_id"]: r for r in rec.aged_balance_wide(facts, rev.invoice_amounts(lines)).collect()}
    assert (wide[2]["due_61_90"], wide[2]["old_share_pct"], wide[2]["risk_level"]) == (D("2500.00"), 100.0, "A_RISQUE")
    due = {(r["client_id"], r["week"]): r for r in rec.due_weekly(invoices, lines).collect()}
    assert due[1, date(2026, 2, 9)]["net_due"] == D("2000.00")


def test_scorecard_ranking_trends(invoices, lines, assignments, contracts, sheets, sheet_lines, frame):
    orders = frame([(5, 10, date(2026, 1, 1), 2, "P"), (6, 10, date(2026, 1, 2), 1, "O")], "order_id long, branch_id long, order_date date, headcount int, status string")
    hours = asg.hours_per_contract(sheets, sheet_lines)
    card = brn.branch_scorecard(invoices, lines, assignments, contracts, hours, orders)
    got = {(r["branch_id"], r["month"]): r for r in card.collect()}
    row = got[10, date(2026, 1, 1)]
    assert (row["net_revenue"], row["active_workers"], row["assignments"], row["conversion_rate"]) == (D("4500.00"), 2, 3, 0.5)
    assert got[20, date(2026, 2, 1)]["conversion_rate"] is None
    ranking = {(r["branch_id"], r["month"]): r for r in brn.branch_ranking(card).collect()}
    assert ranking[10, date(2026, 2, 1)]["rank_revenue"] == 1 and ranking[20, date(2026, 2, 1)]["rank_revenue"] == 2
    trends = {(r["branch_id"], r["month"]): r for r in brn.branch_trends(card).collect()}
    assert trends[10, date(2026, 1, 1)]["trend"] == "HAUSSE"
    assert trends[10, date(2026, 2, 1)]["trend"] == "STABLE"


def test_retention_and_profit(invoices, lines, assignments, contracts, sheets, sheet_lines, frame):
    clients = frame([(1, "sk1"), (2, "sk2")], "client_id long, client_sk string")
    as_of = date(2026, 4, 1)
    row = {r["client_id"]: r for r in cli.client_retention(invoices, lines, assignments, clients, as_of).collect()}[1]
    assert (row["net_revenue"], row["assignments"], row["delta_qoq"], row["delta_qoq_pct"]) == (D("2800.00"), 3, D("0.00"), None)
    assert (row["days_inactive"], row["churn_risk"], row["active_quarters_4"]) == (45, "MEDIUM", 1)
    hours = asg.hours_per_contract(sheets, sheet_lines)
    profit = {r["client_id"]: r for r in cli.client_profitability(invoices, lines, assignments, contracts, hours, clients).collect()}
    assert (profit[1]["assignment_revenue"], profit[1]["payroll_cost"]) == (D("976.500000"), D("756.000000"))
    assert profit[1]["overhead_cost"] == D("157.5000") and profit[1]["net_profit"] == D("63.000000")


def test_client_360(frame):
    as_of = date(2026, 3, 31)
    clients = frame([(1, "sk1", "A", "s1", "n", "c", "x"), (2, "sk2", "B", "s2", "n", "c", "x")], "client_id long, client_sk string, client_name string, siren string, naf_code string, city string, client_status string")
    monthly = frame(
        [(1, date(2026, 1, 1), D("120"), D("100"), 1), (1, date(2025, 2, 1), D("60"), D("50"), 1), (1, date(2025, 3, 31), D("9"), D("9"), 1)],
        "client_id long, month date, revenue decimal(18,2), net_revenue decimal(18,2), assignments long",
    )
    detail = frame(
        [(1, 1, 5, 7, date(2026, 1, 1), None, 0.2), (1, 2, 5, 7, date(2025, 1, 1), date(2025, 2, 1), 0.4), (1, 2, 6, 8, date(2026, 1, 1), date(2026, 4, 1), 0.0)],
        "client_id long, worker_id long, branch_id long, trade_id long, start_date date, end_date date, margin_rate double",
    )
    exposures = frame([("s1", D("70"), D("100"), datetime(2026, 1, 2)), ("s1", D("99"), D("100"), datetime(2026, 1, 1))], "siren string, credit_used decimal(18,2), credit_limit decimal(18,2), _loaded_at timestamp")
    invoices = frame([(1, date(2026, 2, 14))], "client_id long, invoice_date date")
    full = {r["client_id"]: r for r in cli.client_360(clients, monthly, detail, exposures, invoices, as_of).collect()}
    one, two = full[1], full[2]
    assert (one["revenue_ytd"], one["revenue_previous_year"], one["revenue_growth_pct"], one["revenue_12m"]) == (D("100.00"), D("59.00"), 69.49, D("109.00"))
    assert (one["active_assignments"], one["active_workers"], one["workers"], one["branches"]) == (2, 2, 2, 2)
    assert (one["top_trades"], one["credit_risk"], one["churn_risk"], one["mean_margin_rate"]) == ("[7, 8]", "MEDIUM", "LOW", 0.2)
    assert (two["top_trades"], two["days_since_invoice"], two["churn_risk"]) == ("[]", 9999, "HIGH")
    light = {r["client_id"]: r for r in cli.client_360_light(monthly, clients, exposures, as_of).collect()}
    assert (light[1]["revenue_ytd"], light[1]["credit_risk"], light[2]["revenue_growth"]) == (D("120.00"), "NORMAL", None)
    fallback = {r["client_id"]: r for r in cli.client_360_fallback(clients, monthly, detail, as_of).collect()}
    assert (fallback[1]["active_assignments"], fallback[1]["churn_risk"]) == (1, "HIGH")
    quarters = {r["quarter"]: r for r in cli.client_retention_light(monthly).collect()}
    assert quarters[date(2025, 1, 1)]["delta_qoq"] == D("69.00") and quarters[date(2026, 1, 1)]["churn_risk"] == "STABLE"


def test_workforce(assignments, contracts, sheets, sheet_lines, frame, rows):
    workers = frame([(1, "w1", 10, True), (2, "w2", 10, True), (3, "w3", 10, True), (4, "w4", None, True)], "worker_id long, worker_sk string, home_branch long, is_active boolean")
    activity = {(r["worker_id"], r["month"]): r for r in wrk.worker_activity(assignments, contracts, asg.hours_per_contract(sheets, sheet_lines), workers).collect()}
    assert activity[1, date(2026, 1, 1)]["revenue"] == D("1008.000000")  # 63 h at the line rate of 16
    assert activity[1, date(2026, 1, 1)]["occupancy"] == round(63 / 154, 4)
    orders = frame([(5, 10, date(2026, 1, 6), 2, "P")], "order_id long, branch_id long, order_date date, headcount int, status string")
    staffing = {r["week"]: r for r in wrk.branch_staffing(assignments, workers, orders).collect()}
    first = staffing[date(2026, 1, 5)]
    assert (first["on_assignment"], first["available"], first["placement_rate"], first["conversion_rate"]) == (1, 2, 0.3333, 1.0)
    turnover = {r["month"]: r for r in wrk.worker_turnover(assignments, date(2026, 4, 1)).collect()}
    assert (turnover[date(2026, 2, 1)]["entries"], turnover[date(2026, 2, 1)]["exits"], turnover[date(2026, 2, 1)]["turnover_rate"]) == (0, 1, 0.0)
    assert turnover[date(2026, 1, 1)]["turnover_rate"] == 1.0

    skills = frame([(1, "METIER", "7", True), (2, "METIER", "7", True), (2, "METIER", "7", True), (1, "DIPLOME", "7", True), (2, "METIER", "x", True)], "worker_id long, skill_type string, code string, is_active boolean")
    branch = frame([(10, "b10", True)], "branch_id long, branch_sk string, is_active boolean")
    got = wrk.skill_availability(skills, workers, assignments, branch, date(2026, 3, 31)).collect()
    assert [(r["trade_id"], r["qualified"], r["available"], r["on_assignment"], r["coverage_rate"]) for r in got] == [(7, 2, 1, 1, 0.5)]


def test_pool(frame, rows):
    loyal = frame(
        [
            (1, date(2025, 1, 1), date(2026, 1, 1), 365, 10, "actif_recent", 0.5),
            (2, date(2025, 1, 5), date(2025, 1, 9), 4, 400, "inactif_long", 0.1),
            (3, None, None, None, None, "inactif", None),
        ],
        "worker_id long, first_sale date, last_sale date, tenure_days int, idle_days int, loyalty_category string, loyalty_rate double",
    )
    portfolio = frame([(1, 30), (1, 20)], "worker_id long, branch_id long")
    home = frame([(2, 20)], "worker_id long, branch_id long")
    pool = wrk.pool_dynamics(loyal, portfolio, home).first()
    assert (pool["branch_id"], pool["joiners"], pool["leavers"], pool["active_pool"], pool["total_pool"], pool["pool_renewal_pct"]) == (20, 2, 1, 1, 2, 100.0)
    assert rows(wrk.key_resolution_coverage(loyal, portfolio, home)) == [(3, 1, 1, 1)]
    summary = rows(wrk.loyalty_summary(loyal, portfolio, home), "branch_id", "loyalty_category", "workers")
    assert summary == [(20, "actif_recent", 1), (20, "inactif_long", 1), (30, "actif_recent", 1)]


def test_calendar(spark):
    days = ref.calendar_dim(ref.day_series(spark, date(2020, 1, 1), date(2035, 12, 31)))
    assert days.count() == 5844
    got = {r["date_id"]: r for r in days.filter("year = 2026 and month in (3, 5)").collect()}
    sunday, friday, may_day = got[date(2026, 3, 15)], got[date(2026, 3, 13)], got[date(2026, 5, 1)]
    assert (sunday["weekday_name"], sunday["is_working_day"]) == ("dimanche", False)
    assert (friday["weekday_name"], friday["is_working_day"], friday["month_name"]) == ("vendredi", True, "mars")
    assert (may_day["is_holiday"], may_day["is_working_day"]) == (True, False)
