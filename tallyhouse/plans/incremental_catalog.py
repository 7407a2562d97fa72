"""Query catalogue of the incremental, quality, privacy and streaming operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime
from functools import cached_property, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import change_hash, key_hash
from tallyhouse.operators import delta, history, privacy, quality
from tallyhouse.operators import versions as ver
from tallyhouse.operators.dedup import current_versions, latest_by
from tallyhouse.operators.joins import horizon_join
from tallyhouse.operators.quality import Rule
from tallyhouse.plans.gold import assignments as asg
from tallyhouse.plans.silver.skills import CERTIFICATION, DEGREE, EXPERIENCE, TRADE
from tallyhouse.plans.silver_catalog import SAMPLE_SALT, Silver
from tallyhouse.sources.readers import load_partitions, read_delimited, read_optional_table, read_tolerant
from tallyhouse.sources.scratch import fresh_path, release, stored
from tallyhouse.sources.writers import append_checked, overwrite_unless_empty, write_bucketed
from tallyhouse.streaming import alerts, change_log, changes, ingest, live_alerts, spans, weekly

# Instants of the three sample loads of the client state.
LOADS = (datetime(1996, 7, 1), datetime(1998, 7, 1), datetime(2001, 8, 2))
STATE_TRACKED = ("last_priority", "last_status")
EVENTS_SINCE = datetime(2024, 1, 15)
MIN_SCORE = 0.5
# Lines of one bucket of the bucketed facts, and the least number of buckets.
LINES_PER_BUCKET, BUCKETS = 250_000, 16
HORIZON = date(1998, 1, 1)

# The expectation suites.
SUITES: dict[str, list[Rule]] = {
    "workers": [
        Rule("exists", "worker_id"),
        Rule("not_null", "worker_id"),
        Rule("unique", "worker_sk"),
        Rule("length", "nir_hash", 0.0, {"value": 64}),
        Rule("between", "birth_date", 0.95, {"min": date(1940, 1, 1), "max": date(2010, 1, 1)}),
    ],
    "skills": [
        Rule("not_null", "worker_id"),
        Rule("in_set", "skill_type", 1.0, {"values": (TRADE, CERTIFICATION, DEGREE, EXPERIENCE)}),
        Rule("unique", "skill_id"),
        Rule("row_count", args={"min": 1000}),
    ],
    "worker_activity": [
        Rule("not_null", "worker_id"),
        Rule("between", "occupancy", 0.99, {"min": 0.0, "max": 2.0}),
        Rule("between", "revenue", 0.95, {"min": 0}),
    ],
    "assignment_detail": [
        Rule("between", "margin_rate", 0.95, {"min": -0.5, "max": 0.8}),
        Rule("between", "duration_days", 0.98, {"min": 0}),
        Rule("not_null", "assignment_sk"),
    ],
}
# Declared keys of the event payloads: (table, column, uncertain).
DECLARED_KEYS = (
    ("click", "k", False),
    ("view", "k", False),
    ("view", "source", True),
    ("purchase", "k", False),
    ("purchase", "amount", False),
    ("signup", "plan", False),
    ("refund", "k", False),
)


class Incremental(Silver):
    def client_state(self, until: datetime, since: datetime | None = None) -> DataFrame:
        """What is known of a client at an instant: its newest order; only clients seen after ``since``."""
        orders = self.table("orders").filter(F.col("o_orderdate") < F.lit(until))
        newest = latest_by(orders, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])
        if since is not None:
            newest = newest.filter(F.col("o_orderdate") >= F.lit(since))
        return newest.select(
            F.col("o_custkey").alias("client_id"),
            F.col("o_orderpriority").alias("last_priority"),
            F.col("o_orderstatus").alias("last_status"),
            F.to_date("o_orderdate").alias("last_order"),
        )

    @cached_property
    def first_load(self) -> DataFrame:
        return ver.scd2_first_load(self.client_state(LOADS[0]), "client_id", STATE_TRACKED, LOADS[0], "client_sk")

    @cached_property
    def second_load(self) -> DataFrame:
        return self._merge(LOADS[1], stored(self.first_load, "clients-1"))

    def _merge(self, at: datetime, existing: DataFrame) -> DataFrame:
        staging = self.client_state(at, since=at.replace(year=at.year - 2))
        return ver.scd2_merge(staging, existing, "client_id", STATE_TRACKED, at, "client_sk")

    @cached_property
    def third_load(self) -> DataFrame:
        return self._merge(LOADS[2], stored(self.second_load.drop("change"), "clients-2"))

    @cached_property
    def late_history(self) -> DataFrame:
        """The history of clients from their orders, which come in three loads in no order of time."""
        seen = self.table("orders").select(
            F.col("o_custkey").alias("client_id"),
            F.col("o_orderdate").cast("timestamp").alias("seen_at"),
            F.col("o_orderpriority").alias("last_priority"),
            F.col("o_orderstatus").alias("last_status"),
            F.col("o_orderkey").alias("order_id"),
        )
        known, recorded = None, None
        for number, turn in enumerate((2, 0, 1)):
            fresh = seen.filter(F.pmod(F.xxhash64("order_id"), F.lit(3)) == turn)
            known = history.merge_observations(known, fresh, "client_id", "seen_at", [F.col("order_id").desc()])
            known = stored(known, "observations")
            concerned = known.join(fresh.select("client_id").distinct(), "client_id", "left_semi")
            # Recording compares these versions with the known ones several times.
            believed = stored(history.versions(concerned, "client_id", "seen_at", STATE_TRACKED), "believed")
            recorded = stored(history.record(recorded, believed, "client_id", LOADS[number]), "recorded")
        return recorded.filter(F.col("recorded_to").isNull()).drop("recorded_from", "recorded_to")

    def fingerprints(self, until: datetime) -> DataFrame:
        return self.client_state(until).select("client_id", change_hash(STATE_TRACKED).alias("change_hash"))

    @cached_property
    def golden_sources(self) -> dict[str, DataFrame]:
        """Four descriptions of a client: corrected by hand, from the ERP, from the register, inferred."""
        customer, orders = self.table("customer"), self.table("orders")
        missing = F.lit(None).cast("string")
        nation = self.table("nation").withColumnRenamed("n_nationkey", "c_nationkey")
        return {
            "manual": customer.filter(F.col("c_acctbal") > 8000).select(
                F.col("c_custkey").alias("client_id"), F.upper("c_name").alias("name"), missing.alias("city"),
                missing.alias("status"),
            ),
            "erp": customer.select(
                F.col("c_custkey").alias("client_id"), F.col("c_name").alias("name"), missing.alias("city"),
                F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_mktsegment")).alias("status"),
            ),
            "address_register": customer.join(nation, "c_nationkey").select(
                F.col("c_custkey").alias("client_id"), missing.alias("name"), F.col("n_name").alias("city"),
                missing.alias("status"),
            ),
            "inferred": orders.select(
                F.col("o_custkey").alias("client_id"), missing.alias("name"), F.lit("?").alias("city"),
                F.col("o_orderstatus").alias("status"),
            ),
        }

    # -- load bookkeeping --------------------------------------------------

    @cached_property
    def watermark_state(self) -> DataFrame:
        """State before the sample load: one mark per event type seen until then."""
        before = self.table("events").filter(F.col("ts") < F.lit(EVENTS_SINCE))
        return before.filter(F.col("event_type") != "view").groupBy(F.col("event_type").alias("table_name")).agg(
            F.lit("events").alias("pipeline"),
            F.max("ts").cast("timestamp").alias("last_success"),
            F.lit("success").alias("last_status"),
            F.lit(None).cast("string").alias("last_error"),
            F.lit(1).cast("long").alias("run_count"),
            F.count(F.lit(1)).alias("rows_ingested"),
        )

    @cached_property
    def watermark_updates(self) -> DataFrame:
        """Outcome of the sample load: 'error' and 'view' fail, the others move their mark."""
        after = self.table("events").filter(F.col("ts") >= F.lit(EVENTS_SINCE))
        ok = ~F.col("table_name").isin("error", "view")
        return after.groupBy(F.col("event_type").alias("table_name")).agg(
            F.lit("events").alias("pipeline"), F.max("ts").cast("timestamp").alias("high_mark"), F.count(F.lit(1)).alias("rows")
        ).withColumns({"ok": ok, "error": F.when(~ok, F.repeat(F.lit("lost "), 300))})

    @cached_property
    def raw_runs(self) -> DataFrame:
        """Events read as pipeline runs."""
        seconds = F.make_dt_interval(secs=F.col("value").cast("decimal(18,6)"))
        return self.table("events").select(
            F.concat("event_type", F.lit("_"), (F.col("user_id") % 10).cast("string")).alias("pipeline"),
            F.col("ts").cast("timestamp").alias("started_at"),
            (F.col("ts").cast("timestamp") + seconds).alias("ended_at"),
            (F.col("user_id") % 3).alias("tables_processed"),
            (F.get_json_object("props", "$.k").cast("long") % 2).alias("error_count"),
        )

    # -- quality -----------------------------------------------------------

    def _expected_tables(self) -> dict[str, DataFrame]:
        """What the suites read of their tables, stored once per load: every rule and day reads it again."""
        # Each is built when its turn comes, so what the later ones store doesn't lie beside the skills' shuffles.
        tables: dict[str, Callable[[], DataFrame]] = {
            "workers": lambda: self.worker_staging.withColumn("worker_sk", key_hash("worker_id")),
            "skills": lambda: self.skill_table,
            "worker_activity": lambda: self.worker_activity,
            "assignment_detail": lambda: self.assignment_detail,
        }

        def asked(suite: str) -> DataFrame:
            table = tables[suite]()
            return table.select(*dict.fromkeys(rule.column for rule in SUITES[suite] if rule.column in table.columns))

        return {suite: self.shared(f"expected-{suite}", lambda suite=suite: asked(suite)) for suite in tables}

    @cached_property
    def expectations(self) -> DataFrame:
        reports = [
            quality.run_expectations(table, SUITES[suite]).withColumn("suite", F.lit(suite))
            for suite, table in self._expected_tables().items()
        ]
        return reduce(DataFrame.unionByName, reports)

    @cached_property
    def expectations_by_day(self) -> DataFrame:
        """The expectations from the stored states of three days, each of which was read once; the second one twice."""
        reports = []
        for suite, table in self._expected_tables().items():
            root, rules = fresh_path(self.spark, f"states-{suite}"), SUITES[suite]
            key = next(rule.column for rule in rules if rule.column)
            for day in (0, 1, 2, 1):
                rows = table.filter(F.pmod(F.xxhash64(key), F.lit(3)) == day)
                states, values = quality.expectation_states(rows, rules), quality.value_counts(rows, rules)
                spans.write_batch(states, f"{root}/states", day)
                spans.write_batch(values, f"{root}/values", day, gathered=True)  # many values, counted in many tasks
                release(self.spark)
            states = spans.read_batches(self.spark, f"{root}/states", states.schema)
            values = spans.read_batches(self.spark, f"{root}/values", values.schema)
            reports.append(quality.report_from_states(states, values, rules).withColumn("suite", F.lit(suite)))
        return reduce(DataFrame.unionByName, reports)

    @cached_property
    def reconciliation(self) -> DataFrame:
        return self._reconciled(lambda expected: expected)

    @cached_property
    def reconciliation_with_file(self) -> DataFrame:
        """The same with the reference in a delimited file, whose headers are written in another case and padded."""

        def through_file(expected: DataFrame) -> DataFrame:
            path = fresh_path(self.spark, "reference")
            named = expected.select(F.col("net").alias(" Net "), F.col("period").alias("PERIOD"), F.lit("x").alias("note"))
            named.write.option("sep", ";").option("header", True).csv(path)
            return read_delimited(self.spark, path, expected.select("period", "net").schema)

        return self._reconciled(through_file)

    def _reconciled(self, reference: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Monthly revenue against a reference that drifts per year (0.4 %, 1 %, none)."""
        actual = self.monthly_revenue_client.groupBy(F.date_format("month", "yyyy-MM").alias("period")).agg(
            F.sum("net_revenue").cast("decimal(18,2)").alias("net")
        )
        year = F.left("period", F.lit(4))
        factor = F.when(year == "1996", 1.004).when(year == "1997", 1.01).when(year == "2001", 0.0).otherwise(1.0)
        expected = actual.withColumn("net", F.col("net").cast("double") * factor)
        return quality.reconcile(actual, reference(expected), "period", "net")

    @cached_property
    def drift(self) -> DataFrame:
        """Declared against delivered keys of the event payloads, a table per event type."""
        actual = self.table("events").select(
            F.col("event_type").alias("table_name"),
            F.explode(F.json_object_keys("props")).alias("column_name"),
        )
        declared = self.spark.createDataFrame(
            [("events", *key) for key in DECLARED_KEYS],
            "domain string, table_name string, column_name string, uncertain boolean",
        )
        return quality.schema_drift(declared, actual)

    def all_tables(self) -> dict[str, DataFrame]:
        names = (
            "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
            "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
        )
        return {n: self.table(n) for n in names}

    @cached_property
    def bucketed_facts(self) -> DataFrame:
        """Assignments, contracts and hours from tables in the same buckets of (worker, contract)."""
        keys, names = list(asg.KEY), {}
        buckets = max(BUCKETS, -(-self.table("lineitem").count() // LINES_PER_BUCKET))
        facts = {
            "assignments": self.assignments.dropna(subset=keys),
            "contracts": asg.contract_heads(self.contracts.withColumn("_loaded_at", F.col("start_date").cast("timestamp"))),
            "sheet_hours": asg.sheet_hours(self.timesheets, self.timesheet_lines),
        }
        for name, rows in facts.items():
            names[name] = f"{name}_{uuid.uuid4().hex}"
            write_bucketed(rows, names[name], keys, buckets)
        return asg.contract_facts(*[self.spark.table(names[name]) for name in facts])

    # -- writers -----------------------------------------------------------

    @cached_property
    def appended(self) -> DataFrame:
        """Orders appended year by year through the integrity gate: what it counted, and what the table holds."""
        path, orders = fresh_path(self.spark, "appended"), self.table("orders")
        year = F.year("o_orderdate")
        years = [row[0] for row in orders.select(year.alias("y")).distinct().orderBy("y").collect()]  # one for each year
        counts = []
        for y in years:
            rows = orders.filter(year == y)
            counted = append_checked(rows, path, dry_run=y % 2 == 0)
            if y % 2 == 0:
                counted["added_rows"] = append_checked(rows, path)["added_rows"]
            counts.append((y, counted["source_rows"], counted["added_rows"]))
        report = self.spark.createDataFrame(counts, "order_year int, source_rows long, added_rows long")
        stored_rows = self.spark.read.parquet(path).groupBy(year.alias("order_year")).agg(F.count("*").alias("stored_rows"))
        return report.join(stored_rows, "order_year", "left")

    @cached_property
    def guarded(self) -> DataFrame:
        """Clients per segment: the target keeps its rows when a source delivers nothing, and is replaced when it does."""
        path = fresh_path(self.spark, "guarded")
        customers = self.table("customer").select("c_custkey", "c_mktsegment")
        wanted = [F.lit(True), F.col("c_custkey") < 0, F.col("c_custkey") % 2 == 0, F.col("c_custkey").isNull()]
        outcomes = [(i, overwrite_unless_empty(customers.filter(some), path)) for i, some in enumerate(wanted)]
        steps = self.spark.createDataFrame(outcomes, "step int, replaced boolean")
        left = self.spark.read.parquet(path).agg(F.count("*").alias("rows_left"), F.sum("c_custkey").alias("key_sum")).first()
        return steps.withColumns({name: F.lit(value).cast("long") for name, value in left.asDict().items()})

    @cached_property
    def counted_run(self) -> DataFrame:
        """Processed and rejected rows of each event type, counted by the pass that writes them."""
        path = fresh_path(self.spark, "counted")
        valid = F.col("value") >= 10
        counts = []
        for kind in [row[0] for row in self.table("events").select("event_type").distinct().collect()]:  # a handful
            rows, seen = quality.observe_rows(self.table("events").filter(F.col("event_type") == kind), valid, f"rows-{kind}")
            rows.filter(valid).write.mode("append").parquet(path)
            counts.append((kind, seen.get["processed"], seen.get["rejected"]))
        report = self.spark.createDataFrame(counts, "event_type string, processed long, rejected long")
        written = self.spark.read.parquet(path).groupBy("event_type").agg(F.count("*").alias("written"))
        return report.join(written, "event_type", "left")

    # -- streams -----------------------------------------------------------

    def _event_stream(self) -> DataFrame:
        """The events table as a stream; the glob fits a single file as well as a folder of files."""
        schema = self.table("events").schema
        stream = ingest.file_stream(self.spark, f"{self.folder}/{{events.parquet}}", schema)
        return stream.withColumn("ts", F.col("ts").cast("timestamp"))

    @cached_property
    def ingested(self) -> DataFrame:
        """All events through the streaming ingest."""
        target, mark = fresh_path(self.spark, "ingested"), fresh_path(self.spark, "ingest-mark")
        ingest.run_to_end(ingest.ingest_files(self._event_stream(), target, mark, "ts"))
        return self.spark.read.schema(self._ingested_schema()).parquet(target)

    def _ingested_schema(self):
        events = self.table("events").withColumn("ts", F.col("ts").cast("timestamp"))
        return events.schema.add("load_date", "date")

    @staticmethod
    def as_changes(events: DataFrame) -> DataFrame:
        """Events read as row changes: an error deletes the row of its (user, payload key)."""
        kind = F.col("event_type")
        op = F.when(kind == "error", "d").when(kind == "purchase", "c").when(kind == "view", "x").otherwise("u")
        return events.select(
            F.col("user_id").alias("worker_id"),
            F.get_json_object("props", "$.k").cast("long").alias("contract_id"),
            op.alias("op"),
            F.unix_millis("ts").alias("ts_ms"),
            F.col("event_id"),
            F.col("value"),
        )

    @cached_property
    def upserted(self) -> DataFrame:
        target, mark = fresh_path(self.spark, "upserted"), fresh_path(self.spark, "upsert-mark")
        stream = self.as_changes(self._event_stream())
        keys = ["worker_id", "contract_id"]
        ingest.run_to_end(changes.cdc_upsert(stream, target, mark, keys, buckets=16))
        schema = stream.schema.add("is_deleted", "boolean").add(changes.BUCKET, "integer")
        return changes.live_rows(read_optional_table(self.spark, target, schema))

    def _starts_and_declarations(self, events: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Purchases read as starts, views as declarations of the same user."""
        starts = events.filter(F.col("event_type") == "purchase").select(
            F.col("user_id").alias("worker_id"), F.col("ts").alias("started_at"), "event_id"
        )
        declared = events.filter(F.col("event_type") == "view").select(
            F.col("user_id").alias("worker_id"), F.col("ts").alias("declared_at")
        )
        return starts, declared

    @cached_property
    def alerts_stream(self) -> DataFrame:
        """Starts and declarations come in as a stream; alerts are read from what has arrived."""
        starts, declared = self._starts_and_declarations(self.ingested)
        return alerts.missing_declarations(starts, declared, "worker_id")

    def _weekly(self, sheets: DataFrame, fan: int) -> DataFrame:
        target, mark = fresh_path(self.spark, "weekly"), fresh_path(self.spark, "weekly-mark")
        sheets = sheets.withColumn("hours", F.col("value").cast("decimal(10,2)"))
        ingest.run_to_end(weekly.run_weekly_hours(sheets, target, mark, ["user_id"], "ts", "hours", fan))
        schema = weekly.weekly_sums(sheets, ["user_id"], "ts", "hours").schema
        return weekly.weekly_totals(weekly.stored_sums(self.spark, target, schema), ["user_id"])

    @cached_property
    def live_alerts(self) -> DataFrame:
        """The alerts that stand after the events came in files of no order of time."""
        target, mark = (fresh_path(self.spark, name) for name in ("live-log", "live-mark"))
        starts, declared = self._starts_and_declarations(self._event_batches(5))
        log = live_alerts.watch(live_alerts.events(starts, declared, "worker_id"), hold_ms=1)
        live_alerts.run_until_quiet(live_alerts.start_watch(log, target, mark), hold_ms=1)
        found = live_alerts.standing(read_optional_table(self.spark, target, log.schema))
        return found.withColumnRenamed("key", "worker_id")

    @cached_property
    def weekly_stream(self) -> DataFrame:
        """All events, through the stored sums of the micro-batches."""
        return self._weekly(self._event_stream(), fan=8)

    @cached_property
    def weekly_compacted(self) -> DataFrame:
        """All events in many micro-batches, whose sums are folded by level."""
        return self._weekly(self._event_batches(), fan=3)

    def _event_batches(self, batches: int = 14) -> DataFrame:
        """The events as a stream of so many micro-batches, in no order of time."""
        folder = fresh_path(self.spark, "event-files")
        events = self.table("events").withColumn("ts", F.col("ts").cast("timestamp"))
        events.repartition(batches, F.xxhash64("event_id")).write.parquet(folder)
        return ingest.file_stream(self.spark, folder, events.schema, files_per_batch=1)

    @cached_property
    def merged_on_read(self) -> DataFrame:
        """Row changes as a base and appended changes, some of them folded into the base."""
        path, mark = fresh_path(self.spark, "change-log"), fresh_path(self.spark, "change-mark")
        stream, keys = self.as_changes(self._event_batches()), ["worker_id", "contract_id"]
        ingest.run_to_end(change_log.cdc_merge_on_read(stream, path, mark, keys, buckets=8, fold_every=5))
        return change_log.current_rows(self.spark, path, stream.schema, keys)

    @cached_property
    def rejects(self) -> DataFrame:
        """Events written as JSON lines, those of type 'error' cut short, then read back tolerantly."""
        whole = F.to_json(F.struct("event_id", "event_type", "value"))
        cut = F.substring(whole, F.lit(1), F.length(whole) - 1)
        path = fresh_path(self.spark, "lines")
        line = F.when(F.col("event_type") == "error", cut).otherwise(whole)
        self.table("events").select(line.alias("value")).write.text(path)
        schema = self.table("events").select("event_id", "event_type", "value").schema
        good, bad = read_tolerant(self.spark, path, schema)
        ids = F.regexp_extract("raw_text", r'"event_id":(\d+)', 1).cast("long")
        return good.select(F.lit("good").alias("outcome"), "event_id", "event_type").unionByName(
            bad.select(
                F.lit("reject").alias("outcome"), ids.alias("event_id"), F.lit(None).cast("string").alias("event_type")
            )
        )


def _enriched(m: Incremental) -> DataFrame:
    """Clients with coordinates from scored updates; low scores leave them empty."""
    customer = m.table("customer")
    dim = customer.select(
        F.col("c_custkey").alias("client_id"), "c_name", (F.col("c_mktsegment") != "BUILDING").alias("is_current")
    )
    updates = customer.select(
        F.col("c_custkey").alias("client_id"),
        (F.col("c_nationkey") / 2.0).alias("latitude"),
        (F.col("c_nationkey") / 4.0).alias("longitude"),
        (F.col("c_acctbal") / 10000.0).alias("score"),
    )
    return ver.enrich_current(dim, updates, "client_id", ["latitude", "longitude"], "score", MIN_SCORE)


def _secured(m: Incremental) -> DataFrame:
    """Clients a regional user may see, without their balance."""
    grants = m.table("nation").select(
        F.concat(F.lit("user_"), F.col("n_regionkey").cast("string")).alias("username"),
        F.col("n_nationkey").alias("c_nationkey"),
    )
    hidden = {"viewer": ["c_acctbal", "c_name"]}
    return privacy.secure_view(m.table("customer"), grants, "user_2", "c_nationkey", hidden, "viewer")


def _profiled(m: Incremental) -> DataFrame:
    parts = [
        privacy.pii_profile(m.table(name), [column]).withColumn("table_name", F.lit(name))
        for name, column in (("documents", "text"), ("pages", "html"), ("conversations", "text"))
    ]
    return reduce(DataFrame.unionByName, parts)


def _forgotten(m: Incremental) -> DataFrame:
    """Orders without those of clients who asked to be forgotten (negative balance)."""
    subjects = m.table("customer").filter(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("client_id"))
    orders = m.table("orders").select(F.col("o_custkey").alias("client_id"), "o_orderkey", "o_orderstatus")
    return privacy.forget_subjects({"orders": orders}, subjects, "client_id")["orders"]


def _copied(m: Incremental) -> DataFrame:
    """Raw tables against their deduplicated form."""
    sources = {"invoices": m.table("orders"), "invoice_lines": m.table("lineitem"), "clients": m.table("customer")}
    targets = {"invoices": m.invoices, "invoice_lines": m.invoice_lines, "clients": m.clients}
    return quality.copy_integrity(sources, targets)


INCREMENTAL: dict[str, Callable[[Incremental], DataFrame]] = {
    "scd2_first_load": lambda m: m.first_load,
    "scd2_merge": lambda m: m.third_load,
    "current_versions": lambda m: current_versions(m.third_load.drop("change"), "client_id"),
    "as_of_versions": lambda m: ver.as_of_versions(m.third_load.drop("change"), datetime(1999, 1, 1)),
    "scd2_out_of_order": lambda m: m.late_history,
    "changed_rows": lambda m: ver.changed_rows(m.fingerprints(LOADS[0]), m.fingerprints(LOADS[2]), "client_id"),
    "golden_record": lambda m: ver.golden_record(
        m.golden_sources, ["manual", "erp", "address_register", "inferred"], "client_id", ["name", "city", "status"]
    ),
    "enrich_current": _enriched,
    "delta_extract": lambda m: delta.delta_extract(m.table("events"), "ts", EVENTS_SINCE, include_null=True),
    "watermark_upsert": lambda m: delta.apply_watermark_updates(m.watermark_state, m.watermark_updates),
    "last_run_per_pipeline": lambda m: delta.last_run_per_pipeline(delta.run_records(m.raw_runs)),
    "horizon_lines": lambda m: horizon_join(
        m.table("lineitem"), m.table("orders"), {"l_orderkey": "o_orderkey"}, "o_orderdate", HORIZON
    ),
    "expectations_report": lambda m: m.expectations,
    "expectations_incremental": lambda m: m.expectations_by_day,
    "reconcile_revenue": lambda m: m.reconciliation,
    "reconcile_file": lambda m: m.reconciliation_with_file,
    "append_checked": lambda m: m.appended,
    "empty_source_guard": lambda m: m.guarded,
    "run_counters": lambda m: m.counted_run,
    "hours_per_contract_bucketed": lambda m: m.bucketed_facts,
    "schema_drift": lambda m: m.drift,
    "schema_drift_by_domain": lambda m: quality.drift_by_domain(m.drift),
    "table_probe": lambda m: quality.table_probe(m.all_tables()),
    "copy_integrity": _copied,
    "pseudonymize": lambda m: privacy.pseudonymize(
        m.table("customer").select("c_custkey", "c_name", "c_nationkey"), {"c_name": "name_hash"}, SAMPLE_SALT
    ),
    "pii_profile": _profiled,
    "forget_subjects": _forgotten,
    "secure_view": _secured,
    "reject_split": lambda m: m.rejects,
    "stream_ingest": lambda m: m.ingested,
    "load_partitions": lambda m: load_partitions(m.ingested, r"load_date=(\d{4}-\d{2}-\d{2})/").drop("files"),
    "cdc_upsert": lambda m: m.upserted,
    "cdc_merge_on_read": lambda m: m.merged_on_read,
    "missing_declaration_alert": lambda m: m.alerts_stream,
    "declaration_alert_live": lambda m: m.live_alerts,
    "weekly_hours_stream": lambda m: m.weekly_stream,
    "weekly_hours_compacted": lambda m: m.weekly_compacted,
}
