"""Staffing views over the star-schema tables.

Maps orders, lines, customers, suppliers and parts onto the platform's vocabulary
(invoices, assignments, contracts, timesheets …) so that the marts run on them.
One object wires the views of one data folder; every view is a lazy DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions import key_hash, round_to
from tallyhouse.operators.dedup import is_newest, latest_by, top_per_group
from tallyhouse.sources.scratch import fingerprint, known_shared, shared

# Reference day of the recency marts on these tables.
AS_OF = date(2001, 8, 1)
PAYMENT_TERM_DAYS = 30
# Lines in a bucket of orders; small tables are cut into up to MIN_BUCKETS of MIN_LINES.
LINES_PER_BUCKET, MIN_BUCKETS, MIN_LINES = 200_000, 8, 50_000
KEPT_LINES = "kept-lines"
# Schemas of the sample tables, so that reading one starts no inference job.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "pages": "page_id long, url string, html string",
    "benchmark": "item_id long, text string",
    "labels": "doc_id long, quality int, toxic int",
    "conversations": "conv_id long, turn long, role string, text string",
}


def newest_line(*last_ties: str) -> list[Column]:
    """Total order of line versions (the table has no load timestamp)."""
    return [
        F.col("l_shipdate").desc(),
        F.col("l_extendedprice").desc(),
        F.col("l_quantity").desc(),
        *[
            F.col(c).asc()
            for c in ("l_partkey", "l_suppkey", "l_discount", "l_tax", "l_returnflag", "l_linestatus", *last_ties)
        ],
    ]


class StaffingViews:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        """A sample table."""
        return self.spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def shared(self, name: str, build: Callable[[], DataFrame], by: str | None = None) -> DataFrame:
        return shared(self.spark, self.load, name, build, self.buckets if by else 0, by)

    @cached_property
    def buckets(self) -> int:
        """Buckets of the tables stored by order: as many as the lines need, whatever the session's settings."""
        lines = self.table("lineitem").count()
        return max(1, min(MIN_BUCKETS, -(-lines // MIN_LINES)), -(-lines // LINES_PER_BUCKET))

    @cached_property
    def load(self) -> str:
        """The input folder and the state of its files."""
        return f"{self.folder} {fingerprint(self.spark, self.folder)}"

    # -- line versions -----------------------------------------------------

    @cached_property
    def lines(self) -> DataFrame:
        """Newest version of every (order, line number)."""
        return self._kept_lines.filter("of_line").drop("of_line", "of_worker")

    @cached_property
    def assigned_lines(self) -> DataFrame:
        """Newest line of every (worker, contract), gathered by order for the join with the orders.

        From the stored lines if the load has written them.
        """
        known = known_shared(self.spark, self.load, KEPT_LINES)
        if known is not None:
            return known.filter("of_worker").drop("of_line", "of_worker")
        present = self._gathered.filter(F.col("l_suppkey").isNotNull())
        return latest_by(present, ["l_orderkey", "l_suppkey"], newest_line("l_linenumber"))

    @cached_property
    def _gathered(self) -> DataFrame:
        """Lines of orders, gathered by order in the buckets that they are stored in.

        Most keys have one line, so the rows are gathered before they are sorted: a sort of whole input splits would only spill.
        """
        return self.table("lineitem").filter(F.col("l_orderkey").isNotNull()).repartition(self.buckets, "l_orderkey")

    @cached_property
    def _kept_lines(self) -> DataFrame:
        """Lines that are the newest of their (order, line number) or (order, worker), and of which; others are dropped.

        One shuffle of the raw lines serves both.  Stored once per load in buckets of orders; keys must be complete.
        """
        of_line = F.col("l_linenumber").isNotNull() & is_newest(["l_orderkey", "l_linenumber"], newest_line())
        of_worker = F.col("l_suppkey").isNotNull() & is_newest(["l_orderkey", "l_suppkey"], newest_line("l_linenumber"))
        marked = self._gathered.withColumns({"of_line": of_line, "of_worker": of_worker})
        return self.shared(KEPT_LINES, lambda: marked.filter("of_line OR of_worker").drop("l_discount", "l_tax"), by="l_orderkey")

    @cached_property
    def order_heads(self) -> DataFrame:
        """Orders with their client's branch."""
        customer = self.table("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
        return (
            self.table("orders")
            .join(customer, "o_custkey")
            .withColumn("o_orderdate", F.to_date("o_orderdate"))
        )

    # -- invoicing ---------------------------------------------------------

    @cached_property
    def invoices(self) -> DataFrame:
        return self.order_heads.select(
            F.col("o_orderkey").alias("invoice_id"),
            F.col("o_custkey").alias("client_id"),
            F.col("c_nationkey").alias("branch_id"),
            F.when(F.col("o_orderstatus") == "P", "A").otherwise("F").alias("doc_type"),
            F.col("o_orderdate").alias("invoice_date"),
            F.date_add("o_orderdate", PAYMENT_TERM_DAYS).alias("due_date"),
        )

    @cached_property
    def invoice_lines(self) -> DataFrame:
        return self.lines.select(
            F.col("l_orderkey").alias("invoice_id"),
            F.col("l_linenumber").alias("line_no"),
            F.col("l_quantity").cast("decimal(12,2)").alias("qty"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
            (F.col("l_linestatus") == "F").alias("settled"),
            F.to_date("l_shipdate").alias("line_date"),
        )

    @cached_property
    def payments(self) -> DataFrame:
        """One row per invoice; paid_date is NULL while it is open."""
        per_invoice = self.invoice_lines.groupBy("invoice_id").agg(
            F.max("line_date").alias("last_line"),
            F.sum(F.when(F.col("settled"), F.col("amount"))).cast("decimal(18,2)").alias("settled_amount"),
        )
        paid = F.col("o_orderstatus") == "F"
        heads = self.order_heads.select(
            F.col("o_orderkey").alias("invoice_id"),
            F.col("o_custkey").alias("client_id"),
            F.col("c_nationkey").alias("branch_id"),
            "o_orderstatus",
            F.date_add("o_orderdate", PAYMENT_TERM_DAYS).alias("due_date"),
        )
        return heads.join(per_invoice, "invoice_id", "left").select(
            "invoice_id",
            "client_id",
            "branch_id",
            F.when(paid, F.col("last_line")).alias("paid_date"),
            F.when(paid, F.col("settled_amount")).alias("amount_paid"),
            F.when(paid, F.datediff("last_line", "due_date")).alias("delay_days"),
        )

    # -- assignments -------------------------------------------------------

    @cached_property
    def _assigned(self) -> DataFrame:
        """Assigned lines with their order, stored once per load."""
        heads = self.order_heads.select(
            F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "c_nationkey", "o_orderdate"
        )
        self._kept_lines  # noqa: B018  written before they are read
        return self.shared(
            "assigned", lambda: self.assigned_lines.join(heads, "l_orderkey").withColumn("l_shipdate", F.to_date("l_shipdate"))
        )

    @cached_property
    def assignments(self) -> DataFrame:
        gap = (F.col("l_linenumber") - 4) * 6
        start = F.col("o_orderdate").cast("timestamp")
        return self._assigned.select(
            F.col("l_suppkey").alias("worker_id"),
            F.col("l_orderkey").alias("contract_id"),
            F.col("o_custkey").alias("client_id"),
            F.col("c_nationkey").alias("branch_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("o_orderdate").alias("start_date"),
            F.col("l_shipdate").alias("end_date"),
            F.when(F.col("l_returnflag") != "N", start + F.make_dt_interval(hours=gap)).alias("declared_at"),
            F.when(F.col("l_returnflag") != "N", gap).alias("declaration_gap_hours"),
            (F.col("l_quantity").cast("int") * 4).alias("placement_delay_hours"),
        )

    @cached_property
    def contracts(self) -> DataFrame:
        part = self.table("part").select(
            F.col("p_partkey").alias("trade_id"), F.col("p_retailprice").cast("decimal(10,4)").alias("pay_rate")
        )
        rate = round_to(F.col("l_extendedprice") / F.col("l_quantity"), 4)
        billed = self._assigned.select(
            F.col("l_suppkey").alias("worker_id"),
            F.col("l_orderkey").alias("contract_id"),
            F.col("l_partkey").alias("trade_id"),
            F.col("o_orderdate").alias("start_date"),
            F.col("l_shipdate").alias("end_date"),
            rate.cast("decimal(10,4)").alias("bill_rate"),
        )
        return billed.join(part, "trade_id").select(
            "worker_id", "contract_id", "trade_id", "start_date", "end_date", "pay_rate", "bill_rate"
        )

    @cached_property
    def end_status(self) -> DataFrame:
        return self._assigned.select(
            F.col("l_suppkey").alias("worker_id"),
            F.col("l_orderkey").alias("contract_id"),
            F.when(F.col("l_returnflag") == "A", "ANNULEE")
            .when(F.col("l_linestatus") == "O", "EN_COURS")
            .when(F.col("l_returnflag") == "R", "RUPTURE")
            .otherwise("TERME_NORMAL")
            .alias("end_status"),
            F.datediff("l_shipdate", "o_orderdate").alias("actual_days"),
        )

    @cached_property
    def timesheets(self) -> DataFrame:
        return self.lines.select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("sheet_id"),
            F.col("l_suppkey").alias("worker_id"),
            F.col("l_orderkey").alias("contract_id"),
            F.col("l_shipdate").alias("modified_at"),
            (F.col("l_returnflag") != "R").alias("valid"),
        )

    @cached_property
    def timesheet_lines(self) -> DataFrame:
        rate = round_to(F.col("l_extendedprice") / F.col("l_quantity"), 4).cast("decimal(10,4)")
        hours = F.col("l_quantity").cast("decimal(10,2)")
        return self.lines.select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("sheet_id"),
            hours.alias("hours_paid"),
            hours.alias("hours_billed"),
            F.when(F.col("l_linestatus") == "F", rate).alias("bill_rate"),
        )

    @cached_property
    def placement_orders(self) -> DataFrame:
        status = F.when(F.col("o_orderstatus") == "F", "P").when(F.col("o_orderstatus") == "O", "O").otherwise("A")
        return self.order_heads.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("c_nationkey").alias("branch_id"),
            F.col("o_orderdate").alias("order_date"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("headcount"),
            status.alias("status"),
        )

    # -- dimensions --------------------------------------------------------

    @cached_property
    def branches(self) -> DataFrame:
        region = self.table("region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
        return self.table("nation").join(region, "n_regionkey").select(
            key_hash("n_nationkey").alias("branch_sk"),
            F.col("n_nationkey").alias("branch_id"),
            F.col("n_name").alias("branch_name"),
            F.left("r_name", F.lit(3)).alias("brand"),
            F.col("r_name").alias("sector"),
            F.lit(True).alias("is_active"),
        )

    @cached_property
    def clients(self) -> DataFrame:
        """Current versions of the client dimension."""
        division = F.lpad((F.col("c_custkey") % 100).cast("string"), 2, "0")
        return self.table("customer").select(
            key_hash("c_custkey").alias("client_sk"),
            F.col("c_custkey").alias("client_id"),
            F.col("c_name").alias("client_name"),
            F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("siren"),
            F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("nic"),
            F.concat(division, F.lit("10Z")).alias("naf_code"),
            F.col("c_mktsegment").alias("client_status"),
            F.col("c_nationkey").cast("string").alias("city"),
        )

    @cached_property
    def credit_exposures(self) -> DataFrame:
        """Credit used and granted per legal unit."""
        return self.table("customer").select(
            F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("siren"),
            F.col("c_acctbal").cast("decimal(18,2)").alias("credit_used"),
            F.lit(10000).cast("decimal(18,2)").alias("credit_limit"),
            F.lit("2001-08-01").cast("timestamp").alias("_loaded_at"),
        )

    @cached_property
    def workers(self) -> DataFrame:
        return self.table("supplier").select(
            key_hash("s_suppkey").alias("worker_sk"),
            F.col("s_suppkey").alias("worker_id"),
            F.col("s_name").alias("worker_name"),
            F.col("s_nationkey").alias("home_branch"),
            (F.col("s_acctbal") > 0).alias("is_active"),
        )

    @cached_property
    def trades(self) -> DataFrame:
        return self.table("part").select(
            key_hash("p_partkey").alias("trade_sk"),
            F.col("p_partkey").alias("trade_id"),
            F.col("p_type").alias("trade_name"),
            F.col("p_brand").alias("qualification"),
        )

    # -- worker pool (customers read as pool members) -------------------------

    @cached_property
    def pool_raw(self) -> DataFrame:
        """First, last-but-one and last sale per member, as the source system delivers them."""
        dates = (
            self.table("orders")
            .select("o_custkey", F.to_date("o_orderdate").alias("day"))
            .groupBy("o_custkey", "day")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        last_two = (
            top_per_group(dates, ["o_custkey"], [F.col("day").desc()], 2)
            .groupBy("o_custkey")
            .agg(
                F.max(F.when(F.col("position") == 1, F.col("day"))).alias("PINT_DERVENDTE"),
                F.max(F.when(F.col("position") == 2, F.col("day"))).alias("PINT_PREVENDTE"),
            )
        )
        first = dates.groupBy("o_custkey").agg(F.min("day").alias("PINT_CREATDTE"))
        sales = first.join(last_two, "o_custkey")
        return (
            self.table("customer")
            .join(sales, F.col("c_custkey") == F.col("o_custkey"), "left")
            .select(
                F.col("c_custkey").alias("PER_ID"),
                F.col("PINT_CREATDTE").cast("string").alias("PINT_CREATDTE"),
                F.col("PINT_PREVENDTE").cast("string").alias("PINT_PREVENDTE"),
                F.col("PINT_DERVENDTE").cast("string").alias("PINT_DERVENDTE"),
                F.lit("2001-08-01 00:00:00").alias("_loaded_at"),
            )
        )

    @cached_property
    def pool_assignments(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_custkey").alias("worker_id"),
            F.col("o_orderkey").alias("contract_id"),
            F.to_date("o_orderdate").alias("start_date"),
        )

    @cached_property
    def pool_portfolio(self) -> DataFrame:
        """Members with a high balance are followed by every branch of their region."""
        nation = self.table("nation")
        siblings = nation.select("n_regionkey", F.col("n_nationkey").alias("branch_id"))
        own = nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
        return (
            self.table("customer")
            .filter(F.col("c_acctbal") > 5000)
            .join(own, "c_nationkey")
            .join(siblings, "n_regionkey")
            .select(F.col("c_custkey").alias("worker_id"), "branch_id")
        )

    @cached_property
    def pool_home(self) -> DataFrame:
        """Home branch of the members; unknown while the balance is negative."""
        return self.table("customer").filter(F.col("c_acctbal") >= 0).select(
            F.col("c_custkey").alias("worker_id"), F.col("c_nationkey").alias("branch_id")
        )

