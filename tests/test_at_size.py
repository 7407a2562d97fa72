"""What keeps the plans small on large tables: nothing is computed twice, multiplied or gathered in one task without need."""

import time
import uuid
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallyhouse.plans import semantic as sem
from tallyhouse.plans.daily_catalog import DAILY, Daily
from tallyhouse.plans.gold import assignments as asg
from tallyhouse.plans.gold import clients as cli
from tallyhouse.plans.gold import revenue as rev
from tallyhouse.plans.gold import workforce as wrk
from tallyhouse.plans.incremental_catalog import SUITES, Incremental
from tallyhouse.plans.silver import missions, skills
from tallyhouse.plans.staffing import TABLE_SCHEMAS, StaffingViews
from tallyhouse.sources import scratch
from tallyhouse.sources.writers import write_bucketed, write_raw
from tallyhouse.streaming import spans

DAY = datetime(1996, 3, 5)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def folder(frame, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    tables = {
        "customer": [(1, "A", 3, 5.0, "BUILDING")],
        "orders": [(k, 1, "F", 9.0, DAY, "1-URGENT") for k in (7, 8, 9)],
        "lineitem": [
            (k, 2, 4, line, 5.0, 10.0, 0.0, 0.1, "A", "F", datetime(1996, 4, line)) for k in (7, 8, 9) for line in (1, 2)
        ],
    }
    for name, data in tables.items():
        frame(data, TABLE_SCHEMAS[name]).write.parquet(f"{root}/{name}.parquet")
    return root


def test_assignments_of_every_order_know_its_time(spark, folder):
    got = {r["contract_id"]: r["placement_delay_hours"] for r in DAILY["daily_assignments"](Daily(spark, folder)).collect()}
    assert set(got) == {7, 8, 9} and None not in got.values()


def test_touched_keys_are_not_parsed_again(spark, folder, monkeypatch):
    def parsed(raw):
        raise AssertionError("a raw batch is read for its keys")

    monkeypatch.setattr(missions, "delivered_keys", parsed)
    days = Daily(spark, folder)
    load = days.assignment_days
    assert {tuple(r) for r in load.stored_once["touched"].collect()} == {(4, 7), (4, 8), (4, 9)}
    assert {r["contract_id"] for r in load.silver("assignments").collect()} == {7, 8, 9} and not load.brought
    # the query reads the tables of the load where they lie
    found = Daily(spark, folder).daily_assignments("assignment_ends")
    assert all("/silver/assignment_ends/" in file for file in found.inputFiles()) and not {"part", "_loaded_at"} & {*found.columns}


def test_raw_batches_are_compressed(frame, tmp_path):
    write_raw(frame([(1, "x")], "id int, v string"), str(tmp_path), "wtx", date(2026, 3, 1), "b1", "2026-03-01 05:00:00")
    assert [p.name for p in tmp_path.rglob("part-*")][0].endswith(".json.gz")


def test_suites_read_their_columns_from_stored_tables(spark, folder, frame):
    class Sample(Incremental):
        worker_staging = frame([(1, "x" * 64, date(1980, 1, 1))], "worker_id long, nir_hash string, birth_date date")
        skill_table = frame([(1, "METIER", "a"), (None, "y", "a")], "worker_id long, skill_type string, skill_id string")
        worker_activity = frame([(1, 0.5, 3.0, 1), (2, 9.0, -1.0, 1)], "worker_id long, occupancy double, revenue double, other int")
        assignment_detail = frame([(0.1, 4, "k", 1)], "margin_rate double, duration_days int, assignment_sk string, other int")

    sample = Sample(spark, folder)
    tables = sample._expected_tables()
    assert set(tables) == set(SUITES) and all(t.inputFiles() for t in tables.values())
    assert tables["worker_activity"].columns == ["worker_id", "occupancy", "revenue"]
    columns = ["suite", "rule", "observed", "threshold", "passed"]
    assert sorted(sample.expectations_by_day.select(columns).collect()) == sorted(sample.expectations.select(columns).collect())


def test_lines_of_an_order_are_gathered_once(spark, folder):
    views = StaffingViews(spark, folder)
    heads = views.order_heads.select(views.order_heads["o_orderkey"].alias("l_orderkey"), "o_custkey")
    text = plan(views.assigned_lines.join(heads.hint("merge"), "l_orderkey"))
    keys = [line.split("hashpartitioning(")[1] for line in text.splitlines() if "hashpartitioning(l_orderkey" in line]
    assert len(keys) == 2 and not any("l_suppkey" in k for k in keys)
    assert {(r["contract_id"], r["worker_id"]) for r in views.assignments.collect()} == {(7, 4), (8, 4), (9, 4)}


def test_codes_go_to_the_rows(spark, frame):
    heads = frame([(1, 2, 3, 4, None, "A", 0, "b", DAY)], "worker_id long, contract_id long, branch_id long, client_id long, entered_end date, "
                  "end_code string, cancelled int, _batch_id string, _loaded_at timestamp")  # fmt: skip
    spans = frame([(1, 2, DAY, DAY)], "worker_id long, contract_id long, starts_at timestamp, ends_at timestamp")
    codes = frame([(" A", "Fin", 1, "2026-01-01")], "FINMISS_CODE string, FINMISS_LIBELLE string, MTFCNT_ID int, _loaded_at string")
    reasons = frame([(1, "R", "Fin de mission", 1, "2026-01-01")], "MTFCNT_ID int, MTFCNT_CODE string, MTFCNT_LIBELLE string, MTFCNT_FINCNT int, _loaded_at string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ends = missions.assignment_ends_from(heads, spans, codes, reasons)
        text = plan(ends)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin [end_code" in text and text.count("SortMergeJoin") == 2
    assert [(r["end_label"], r["reason_code"], r["end_status"]) for r in ends.collect()] == [("Fin", "R", "TERME_NORMAL")]


def test_distinct_counts_side_by_side_copy_no_rows(frame):
    detail = frame(
        [(1, 1, 5, date(2026, 1, 1), None, 0.2), (1, 1, 6, date(2025, 1, 1), date(2025, 2, 1), 0.4), (1, None, 5, None, None, 0.0)],
        "client_id long, worker_id long, branch_id long, start_date date, end_date date, margin_rate double",
    )
    profile = cli.assignment_profile(detail, date(2026, 3, 1))
    row = profile.first()
    assert (row["active_assignments"], row["assignments"], row["active_workers"], row["workers"], row["branches"]) == (2, 3, 1, 1, 2)
    placed = frame(
        [(1, 10, date(2026, 1, 1), date(2026, 1, 2)), (1, 10, date(2026, 1, 5), date(2025, 1, 2)), (None, 10, date(2026, 1, 5), None),
         (2, 10, date(2026, 1, 7), date(2026, 1, 1))],
        "worker_id long, branch_id long, start_date date, end_date date",
    )
    turnover = wrk.worker_turnover(placed, date(2026, 4, 1))
    january = {r["month"]: r for r in turnover.collect()}[date(2026, 1, 1)]
    assert (january["entries"], january["exits"], january["mean_headcount"]) == (2, 2, 1)
    assert "Expand" not in plan(profile) + plan(turnover)


def test_a_bucket_is_one_file(spark):
    name = f"b_{uuid.uuid4().hex}"
    write_bucketed(spark.range(200).repartition(5), name, ["id"], 4)
    assert len(spark.table(name).inputFiles()) == 4


def test_raw_lines_are_shuffled_once_for_lines_and_assignments(spark, frame, tmp_path):
    lineitem = [  # order, worker, line, amount: a line in two versions, a worker with two lines, incomplete keys
        (7, 4, 1, 10.0), (7, 5, 1, 20.0), (7, 5, 2, 30.0), (7, None, 3, 40.0), (7, 6, None, 50.0), (None, 6, 1, 60.0), (8, 4, 1, 70.0), (8, 4, 1, 70.0),
    ]
    tables = {
        "customer": [(1, "A", 3, 5.0, "BUILDING")],
        "orders": [(k, 1, "F", 9.0, DAY, "1-URGENT") for k in (7, 8)],
        "lineitem": [(k, 2, w, n, 5.0, amount, 0.0, 0.1, "A", "F", DAY) for k, w, n, amount in lineitem],
    }
    for name, data in tables.items():
        frame(data, TABLE_SCHEMAS[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    views = StaffingViews(spark, str(tmp_path))
    amounts = rev.invoice_amounts(views.invoice_lines)
    assert "Exchange" not in plan(amounts)  # the stored lines lie in buckets of orders
    assert "hashpartitioning(l_orderkey" not in plan(views.assigned_lines)  # read from the stored lines
    assert sorted((r["line_no"], float(r["amount"])) for r in views.invoice_lines.filter("invoice_id = 7").collect()) == [(1, 20), (2, 30), (3, 40)]
    assert {r["invoice_id"]: float(r["amount"]) for r in amounts.collect()} == {7: 90, 8: 70}
    assigned = [(r["l_orderkey"], r["l_suppkey"], r["l_extendedprice"]) for r in views.assigned_lines.collect()]
    assert sorted(assigned) == [(7, 4, 10.0), (7, 5, 30.0), (7, 6, 50.0), (8, 4, 70.0)]
    assert sorted((r["contract_id"], r["worker_id"]) for r in views.assignments.collect()) == [(7, 4), (7, 5), (7, 6), (8, 4)]


def test_buckets_follow_the_lines(spark, folder):
    class Sized(StaffingViews):
        rows = 0

        def table(self, name):
            return spark.range(self.rows)

    views = [Sized(spark, folder) for _ in range(4)]
    for view, rows in zip(views, (0, 60_000, 600_000, 3_000_001), strict=True):
        view.rows = rows
    assert [v.buckets for v in views] == [1, 2, 8, 16]


def test_shared_buckets_are_forgotten(spark, tmp_path):
    rows = scratch.shared(spark, str(tmp_path), "in-buckets", lambda: spark.range(20).repartition(3, "id"), 3, "id")
    path, _, table = scratch._shared[(spark.sparkContext.applicationId, str(tmp_path), "in-buckets")]
    assert len(rows.inputFiles()) == 3 and spark.catalog.tableExists(table) and rows.count() == 20
    others = {k: scratch._shared.pop(k) for k in list(scratch._shared) if k[2] != "in-buckets"}
    try:
        scratch.forget_shared(spark)
    finally:
        scratch._shared.update(others)
    assert not spark.catalog.tableExists(table)
    assert scratch.known_shared(spark, str(tmp_path), "in-buckets") is None


def test_a_worker_and_month_is_gathered_once(frame):
    placed = [(1, 1, 5, 8, 3), (1, 2, 5, 9, 4), (1, 3, 6, None, 5), (1, 4, 5, 8, None), (2, 5, None, None, 6), (None, 6, 5, 5, 7)]
    assignments = frame(
        [(w, c, b, k, day and date(2026, 1, day)) for w, c, b, k, day in placed],
        "worker_id long, contract_id long, branch_id long, client_id long, start_date date",
    )
    contracts = frame([(1, 1, 2), (1, 1, 2), (1, 2, 3)], "worker_id long, contract_id long, rate int")  # one comes twice
    contracts = contracts.selectExpr("worker_id", "contract_id", "cast(rate as decimal(10,4)) bill_rate")
    sheets = frame([(1, 1, 1), (2, 1, 2)], "sheet_id long, worker_id long, contract_id long")
    lines = frame([(1, 7), (2, 5)], "sheet_id long, h int")
    lines = lines.selectExpr("sheet_id", "cast(h as decimal(10,2)) hours_paid", "cast(h as decimal(10,2)) hours_billed",
                             "cast(null as decimal(10,4)) bill_rate")
    workers = frame([(1, "x")], "worker_id long, worker_sk string")
    activity = wrk.worker_activity(assignments, contracts, asg.hours_per_contract(sheets, lines), workers)
    shuffles = [line for line in plan(activity).splitlines() if "hashpartitioning(worker_id" in line and ", month#" in line]
    assert len(shuffles) == 1
    got = {r["worker_id"]: r for r in activity.collect()}
    assert [(w, got[w]["assignments"], got[w]["branches"], got[w]["clients"], got[w]["hours"], got[w]["revenue"]) for w in sorted(got)] == [
        (1, 4, 2, 2, 19, 43), (2, 1, 0, 0, 0, 0),
    ]


def test_alerts_read_each_mart_once(frame):
    def mart(rows, columns):
        return frame([(m and date(2026, m, 1), *rest) for m, *rest in rows], f"month date, {columns}")

    alerts = sem.threshold_alerts(
        mart([(1, 10.0), (2, 40.0), (2, 60.0), (2, None), (None, 99.0)], "dso_days double"),
        mart([(1, ">90j", 90000), (2, ">90j", 60000), (2, "0-30j", 5)], "bucket string, overdue int"),
        mart([], "termination_pct double"),
        mart([(1, 1.0), (3, None)], "weighted_coefficient double"),
    )
    assert "ubquery" not in plan(alerts)
    got = {r["alert"]: (r["observed"], r["fired"]) for r in alerts.collect()}
    assert got == {"dso": (50.0, True), "overdue_over_90": (60000.0, True), "termination": (None, False), "coefficient": (None, False)}


def shuffle_files(spark):
    """Shuffle files on disk."""
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (found.apply(i).getName() for i in range(found.size())) if name.startswith("shuffle_")}


def test_shuffles_of_a_shared_table_leave_the_disk(spark, tmp_path):
    def counted(name):
        build = lambda: spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
        return scratch.shared(spark, str(tmp_path), name, build)

    before = shuffle_files(spark)
    counted("first")
    first = shuffle_files(spark) - before
    rows, until = counted("second"), time.time() + 20  # files are deleted beside the running jobs
    while first & shuffle_files(spark) and time.time() < until:
        time.sleep(0.2)
    assert first and not first & shuffle_files(spark) and rows.count() == 7


def test_suites_are_stored_in_turn(spark, folder):
    class Sample(Incremental):
        worker_staging = spark.sql("SELECT 1L worker_id, 'x' nir_hash, DATE'1980-01-01' birth_date")
        skill_table = spark.sql("SELECT 1L worker_id, 'METIER' skill_type, 'a' skill_id")
        assignment_detail = spark.sql("SELECT 0.1D margin_rate, 4 duration_days, 'k' assignment_sk")

        @property
        def worker_activity(self):
            assert scratch.known_shared(self.spark, self.load, "expected-skills") is not None
            return spark.sql("SELECT 1L worker_id, 0.5D occupancy, 3.0D revenue")

    sample = Sample(spark, folder)
    sample.load = f"{folder} in turn"
    assert list(sample._expected_tables()) == list(SUITES)


def test_gathered_batches_are_written_where_they_lie(spark, tmp_path):
    rows = spark.range(0, 100, 1, 3).withColumn("n", F.lit(1))
    for _ in range(2):  # a batch that comes again replaces itself
        spans.write_batch(rows, str(tmp_path / "batches"), 4, gathered=True)
    found = spans.read_batches(spark, str(tmp_path / "batches"), rows.schema)
    assert len(found.inputFiles()) == 3 and found.count() == 100


def test_skill_codes_go_to_the_rows_and_ids_are_packed(spark, frame):
    held = frame([(1, 2, "2026-01-01", None, "2026-01-01"), (1, 2, "2025-01-01", None, "2026-01-02"), (None, 2, None, None, "2026-01-01"),
                  (3, None, None, None, None)], "PER_ID long, THAB_ID int, PHAB_DELIVR string, PHAB_EXPIR string, _loaded_at string")
    kinds = frame([(2, " B", "12", "2026-01-01"), (9, "Z", None, "2026-01-01")], "THAB_ID int, THAB_LIBELLE string, THAB_NBMOIS string, _loaded_at string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parts = skills.certifications(held, kinds, date(2026, 6, 1))
        text = plan(parts)
        table = skills.skills(parts)
        shuffled = plan(table)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "unhex(" in shuffled
    want = spark.sql("SELECT md5('1|HABILITATION|2') a, md5('3|HABILITATION|') b").first()
    got = {r["skill_id"]: (r["worker_id"], r["label"], r["obtained_on"], r["is_active"]) for r in table.collect()}
    assert got == {want[0]: (1, "B", date(2025, 1, 1), False), want[1]: (3, "Habilitation inconnue", None, True)}
