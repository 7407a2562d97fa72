"""Loads over several days: the sample tables arrive in parts, and the stored tables must equal those of one whole load."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators import bitmaps
from tallyhouse.plans.gold import operations as ops
from tallyhouse.plans.gold import refresh
from tallyhouse.plans.gold import revenue as rev
from tallyhouse.plans.ingestion import RAW_TABLES, ingest
from tallyhouse.plans.platform import Load, load_silver
from tallyhouse.plans.silver import missions
from tallyhouse.plans.silver_catalog import SAMPLE_SALT, Silver
from tallyhouse.plans.staffing import AS_OF
from tallyhouse.sources import erasure
from tallyhouse.sources.partitioned import by_key, by_month, merge_partitions, read_partitioned
from tallyhouse.sources.readers import read_raw, read_tolerant
from tallyhouse.sources.schemas import raw_schema
from tallyhouse.sources.scratch import fresh_path, known_shared, share, stored
from tallyhouse.sources.writers import write_raw

DAYS = (date(2002, 1, 1), date(2002, 1, 2), date(2002, 1, 3))
STATE = (
    "pipeline string, table_name string, last_success timestamp, last_status string, last_error string, "
    "run_count long, rows_ingested long"
)


def conform(df: DataFrame, table: str) -> DataFrame:
    """The columns of a raw table; those that the sample lacks are NULL."""
    fields = [f for f in raw_schema(table).fields if not f.name.startswith("_")]
    found = [
        (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields
    ]
    return df.select(*found, "_loaded_at")


def part(*columns: str, of: int) -> Column:
    """A number below ``of`` that the values decide."""
    return F.pmod(F.xxhash64(*columns), F.lit(of))


class Daily(Silver):
    @cached_property
    def root(self) -> str:
        return fresh_path(self.spark, "daily")

    def deliver(self, day: date, **tables: DataFrame) -> None:
        for table, rows in tables.items():
            batch = conform(rows, table)
            write_raw(batch, self.root + "/raw", table, day, f"b{day.day}", F.col("_loaded_at"))

    def load_day(self, day: date, only: list[str]) -> Load:
        """One day's load; returns it for a look at its tables."""
        now = datetime(day.year, day.month, day.day, 5)
        load = Load(self.spark, f"{self.root}/raw", f"{self.root}/silver", f"{self.root}/gold", AS_OF, now, SAMPLE_SALT, day)
        load_silver(load, only)
        return load

    @cached_property
    def assignment_days(self) -> Load:
        """Each line's assignment, contract and order come on days of their own.

        Day 2 brings amendments without their assignment, assignments without their contract, and all orders: most as they
        were, some new, some with another time.  Orders of day 1 that never were are gone.
        """
        names = ["assignment_heads", "assignment_end_heads", "contract_spans", "order_times", "assignments", "assignment_ends"]
        own = part("PER_ID", "CNT_ID", "TIE_ID", "TIES_SERV", of=3) == 0
        amended = part("CNT_ID", "PER_ID", "CNTI_ORDRE", of=3) == 0
        known = part("CMD_ID", of=2) == 0
        moved = F.when(F.col("CMD_ID") % 20 == 3, F.lit("1991-01-01")).otherwise(F.col("CMD_DTE"))
        never = self.wtcmd.filter(F.col("CMD_ID") % 40 == 7).withColumn("CMD_ID", -F.col("CMD_ID"))
        day1, day2 = DAYS[:2]
        self.deliver(
            day1,
            wtmiss=self.wtmiss.filter(~own),
            wtcnti=self.wtcnti.filter(~amended),
            wtcmd=self.wtcmd.filter(known).withColumn("CMD_DTE", moved).unionByName(never),
            wtfinmiss=self.wtfinmiss,
            pymtfcnt=self.pymtfcnt,
        )
        self.load_day(day1, names)
        self.deliver(day2, wtmiss=self.wtmiss.filter(own), wtcnti=self.wtcnti.filter(amended), wtcmd=self.wtcmd)
        return self.load_day(day2, names)

    def daily_assignments(self, table: str) -> DataFrame:
        """A table of `assignment_days`; the days are run once for both, and their tables are read where they lie."""
        if known_shared(self.spark, self.load, f"daily-{table}") is None:
            load = self.assignment_days
            for name in ("assignments", "assignment_ends"):
                schema = _plain(load.silver(name)).schema
                share(self.spark, self.load, f"daily-{name}", f"{load.silver_root}/{name}", schema)
        return known_shared(self.spark, self.load, f"daily-{table}")

    @cached_property
    def client_days(self) -> Load:
        """Day 2 lacks the attributes of the clients; on day 3 every third client has moved."""
        day1, day2, day3 = DAYS
        self.deliver(day1, wttieserv=self.wttieserv, wtclpt=self.wtclpt)
        self.load_day(day1, ["client_versions"])
        self.deliver(day2, wttieserv=self.wttieserv)
        self.load_day(day2, ["client_versions"])
        moved = F.when(F.col("TIE_ID") % 3 == 0, F.lit("Elsewhere")).otherwise(F.col("TIES_VILLE"))
        self.deliver(day3, wttieserv=self.wttieserv.withColumn("TIES_VILLE", moved), wtclpt=self.wtclpt)
        return self.load_day(day3, ["client_versions"])

    @cached_property
    def portfolio_days(self) -> Load:
        """On day 2 the links to every fourth branch are gone, on day 3 nothing comes."""
        day1, day2, day3 = DAYS
        self.deliver(day1, wtugpint=self.wtugpint)
        self.load_day(day1, ["portfolio"])
        self.deliver(day2, wtugpint=self.wtugpint.filter(F.col("RGPCNT_ID") % 4 != 0))
        self.load_day(day2, ["portfolio"])
        return self.load_day(day3, ["portfolio"])

    @cached_property
    def placement_days(self) -> DataFrame:
        """Orders in a table cut by month, over three loads.

        Day 2 brings new orders, orders that moved to another month and stale copies; day 3 takes orders away and repeats
        a part of day 2.
        """
        orders = self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("client_id"),
            F.to_date("o_orderdate").alias("order_date"),
            F.col("o_orderstatus").alias("status"),
        )

        def of(day: int, rows: DataFrame) -> DataFrame:
            return rows.withColumn("_loaded_at", F.lit(datetime(2002, 1, day)))

        key, path = F.col("order_id"), f"{self.root}/placements"
        late, moved, stale = key % 10 == 3, key % 50 == 1, key % 50 == 2
        layout = by_month("order_date")
        merge_partitions(of(1, orders.filter(~late)), path, ["order_id"], layout)
        again = orders.filter(moved).withColumns({"order_date": F.date_add("order_date", 40), "status": F.lit("M")})
        old = orders.filter(stale).withColumn("status", F.lit("S"))
        second = of(2, orders.filter(late).union(again)).union(of(1, old).withColumn("_loaded_at", F.lit(datetime(2001, 1, 1))))
        merge_partitions(second, path, ["order_id"], layout)
        merge_partitions(of(2, again), path, ["order_id"], layout, gone=orders.filter(key % 100 == 7))
        return read_partitioned(self.spark, path)

    @cached_property
    def refreshed_revenue(self) -> DataFrame:
        """The monthly revenue from states that three loads have changed.

        Day 1 lacks some invoices and lines, has wrong months and amounts, and invoices that never were; day 2 brings heads,
        day 3 lines, takes the false invoices away and repeats heads of day 2.
        """
        root, key = f"{self.root}/refresh", F.col("invoice_id")
        heads = self.invoices.select(*self.invoices.columns)
        lines = self.invoice_lines.select(*self.invoice_lines.columns)
        late, moved, wrong, false = key % 10 == 3, key % 50 == 1, key % 7 == 0, key % 100 == 7

        def of(day: int, rows: DataFrame) -> DataFrame:
            return rows.withColumn("_loaded_at", F.lit(datetime(2002, 1, day)))

        def but(rows: DataFrame, **columns: Column) -> DataFrame:
            return rows.withColumns({name: c.cast(rows.schema[name].dataType) for name, c in columns.items()})

        bad = but(heads, invoice_date=F.when(moved, F.date_add("invoice_date", 40)).otherwise(F.col("invoice_date")),
                  branch_id=F.when(moved, F.col("branch_id") + 1).otherwise(F.col("branch_id")))
        bad_lines = but(lines, amount=F.when(wrong, F.col("amount") * 2).otherwise(F.col("amount")))
        never, never_lines = (but(rows.filter(false), invoice_id=-key) for rows in (heads, lines))
        days = [
            (bad.filter(~late).union(never), bad_lines.filter("line_no < 3").union(never_lines), None),
            (heads.filter(late | moved), lines.filter(late), None),
            (heads.filter(moved), lines.filter(wrong | (F.col("line_no") >= 3)), never.select("invoice_id")),
        ]
        starts = self.assignments
        states = refresh.revenue_state(root), refresh.started_state(root)
        billed = refresh.Billed(
            self.spark, f"{root}/invoices", f"{root}/lines", of(1, heads).schema, of(1, lines).schema
        )
        for number, (some_heads, some_lines, gone) in enumerate(days, 1):
            ids = some_heads.select("invoice_id").union(some_lines.select("invoice_id"))
            ids = stored((ids if gone is None else ids.union(gone)).distinct(), "ids")
            before = stored(billed.contributions(ids), "before")
            gone_lines = None if gone is None else never_lines
            merge_partitions(of(number, some_heads), billed.invoices_path, ["invoice_id"], billed.heads_layout, gone=gone)
            merge_partitions(
                of(number, some_lines), billed.lines_path, ["invoice_id", "line_no"], billed.lines_layout, gone=gone_lines
            )
            after = stored(billed.contributions(ids), "after")
            for _ in range(2):  # a load that is run again changes nothing more
                refresh.refresh(states[0], before, after, number)
            part = rev.started_by_month(starts.filter(F.col("contract_id") % len(days) == number - 1))
            refresh.refresh(states[1], part.limit(0), part, number)
        by_branch, started = rev.revenue_by_branch(heads, lines), rev.started_by_month(starts)
        return refresh.monthly_revenue(self.spark, root, by_branch.schema, started.schema, self.clients)

    @cached_property
    def refreshed_delays(self) -> DataFrame:
        """The placement delays from counted values that two loads have changed; the first had wrong delays and branches."""
        root, rows = f"{self.root}/delays", self.assignments
        state = refresh.delay_state(root)
        slow, astray, late = F.col("worker_id") % 7 == 0, F.col("worker_id") % 11 == 0, F.col("contract_id") % 3 == 2
        wrong = rows.filter(~late).withColumns(
            {
                "placement_delay_hours": F.when(slow, F.col("placement_delay_hours") + 100)
                .otherwise(F.col("placement_delay_hours"))
                .cast(rows.schema["placement_delay_hours"].dataType),
                "branch_id": F.when(astray, F.col("branch_id") + 1).otherwise(F.col("branch_id")),
            }
        )
        loads = [(wrong.limit(0), wrong), (wrong.filter(slow | astray), rows.filter(late | slow | astray))]
        for number, (before, after) in enumerate(loads, 1):
            for _ in range(2):  # a load that is run again changes nothing more
                refresh.refresh(state, ops.delay_counts(before), ops.delay_counts(after), number)
        return refresh.placement_delays(self.spark, root, ops.delay_counts(rows).schema)

    @cached_property
    def erased_orders(self) -> DataFrame:
        """Stored orders and their lines after clients who asked for it were erased: first some of them, then the others."""
        orders = self.table("orders").select(
            F.col("o_custkey").alias("client_id"), F.col("o_orderkey").alias("order_id"), "o_orderstatus",
            F.to_date("o_orderdate").alias("order_date"),
        )
        lines = self.table("lineitem").select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"))
        lines = lines.join(orders.select("order_id", "client_id"), "order_id")
        root = f"{self.root}/erasure"
        tables = [
            erasure.SubjectTable(f"{root}/orders", ["order_id"], by_month("order_date", bloom=["client_id"]), "client_id"),
            erasure.SubjectTable(f"{root}/lines", ["order_id", "line_no"], by_key(["order_id"], 8, bloom=["client_id"]), "client_id"),
        ]
        for table, rows in zip(tables, (orders, lines), strict=True):
            merge_partitions(rows.withColumn("_loaded_at", F.lit(datetime(2002, 1, 1))), table.path, table.keys, table.layout)
        asked = self.table("customer").filter(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("client_id"))
        first = F.col("client_id") % 20 == 3
        for some in (asked.filter(first), asked.filter(~first)):
            erasure.erase_subjects(self.spark, tables, some)
        counted = read_partitioned(self.spark, tables[1].path).groupBy("order_id").agg(F.count("*").alias("lines"))
        left = read_partitioned(self.spark, tables[0].path).drop("_loaded_at", "part", "order_date")
        return left.join(counted, "order_id", "left")

    @cached_property
    def started_workers(self) -> DataFrame:
        """Workers that start per branch, counted by day, week, month, quarter and year from bitmaps of two loads."""
        rows, keys = self.assignments.select("branch_id", "start_date", "worker_id"), ["branch_id"]
        early = part("worker_id", "start_date", of=3) > 0
        known, daily = None, None
        for some in (rows.filter(early), rows.filter(~early)):
            if known is None:
                known = stored(bitmaps.numbered(some, "worker_id"), "numbers")
            else:
                known = stored(known.unionByName(bitmaps.new_numbers(known, some, "worker_id")), "numbers")
            fresh = bitmaps.daily_bitmaps(some, known, keys, "start_date", "worker_id")
            daily = stored(fresh if daily is None else bitmaps.merge_days(daily, fresh, keys), "bitmaps")
        return bitmaps.rolled_up(daily, keys, "workers")

    @cached_property
    def ingested_contracts(self) -> DataFrame:
        """Payroll contracts over two ingestions; some of the first end decades later."""
        far = F.when(F.col("CNT_ID") % 50 == 1, F.lit("2050-12-31")).otherwise(F.col("CNT_DATEFIN"))
        every = conform(self.pycontrat.withColumn("CNT_DATEFIN", far), "pycontrat").drop("_loaded_at")
        early = every.filter(F.col("CNT_DATEDEB") < "1996-01-01")
        tables = [t for t in RAW_TABLES if t.name == "pycontrat"]
        tables = [replace(t, first_since=datetime(1990, 1, 1)) for t in tables]
        state = self.spark.createDataFrame([], STATE)
        for rows, now in ((early, datetime(1996, 1, 1)), (every, datetime(1999, 1, 1))):
            state = ingest(state, lambda _, rows=rows: rows, "bronze", self.root, now.date(), f"b{now.year}", now, tables)
            state = self.spark.createDataFrame(state.collect(), STATE)  # one row per table
        return missions.payroll_contracts(read_raw(self.spark, self.root, "pycontrat", raw_schema("pycontrat")))

    @cached_property
    def counted_lines(self) -> DataFrame:
        """Raw lines of which some are broken: what was kept and rejected."""
        path = fresh_path(self.spark, "broken")
        # A line without its last two characters is no record.
        line = F.to_json(F.struct(*[c for c in self.wtrhdon.columns if c != "_loaded_at"]))
        broken = F.col("RHD_LIGNE") == 3
        self.wtrhdon.select(F.when(broken, F.substring(line, F.lit(1), F.length(line) - 2)).otherwise(line)).write.text(path)
        good, rejects = read_tolerant(self.spark, path, raw_schema("wtrhdon"))
        outcomes = good.select(F.lit("good").alias("outcome")).union(rejects.select(F.lit("rejected")))
        return outcomes.union(self.wtrhdon.select(F.lit("delivered"))).groupBy("outcome").count()


def _plain(df: DataFrame) -> DataFrame:
    return df.drop("_batch_id", "_loaded_at")


DAILY: dict[str, Callable[[Daily], DataFrame]] = {
    "daily_assignments": lambda d: d.daily_assignments("assignments"),
    "daily_assignment_ends": lambda d: d.daily_assignments("assignment_ends"),
    "daily_clients": lambda d: d.client_days.silver("client_versions").select(
        "client_id", "city", "is_current", F.to_date("valid_from").alias("valid_from")
    ),
    "daily_portfolio": lambda d: _plain(d.portfolio_days.silver("portfolio")),
    "ingest_marks": lambda d: d.ingested_contracts.select("worker_id", "contract_id", "start_date", "end_date"),
    "mart_refresh_placement_delay": lambda d: d.refreshed_delays,
    "mart_refresh_monthly_revenue": lambda d: d.refreshed_revenue,
    "distinct_rollup": lambda d: d.started_workers,
    "erase_subjects": lambda d: d.erased_orders,
    "merge_touched_partitions": lambda d: d.placement_days.drop("_loaded_at"),
    "raw_rejects": lambda d: d.counted_lines,
}
