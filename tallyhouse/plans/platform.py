"""Wiring of a whole load: raw batches → silver tables → gold marts.

The builders stay pure; this module reads their inputs, writes their results and keeps the
order in which silver tables depend on each other.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators.dedup import current_versions
from tallyhouse.plans.gold import assignments as asg
from tallyhouse.plans.gold import branches as brn
from tallyhouse.plans.gold import clients as cli
from tallyhouse.plans.gold import dimensions as dim
from tallyhouse.plans.gold import operations as ops
from tallyhouse.plans.gold import receivables as rec
from tallyhouse.plans.gold import refresh as upkeep
from tallyhouse.plans.gold import reference as ref
from tallyhouse.plans.gold import revenue as rev
from tallyhouse.plans.gold import workforce as wrk
from tallyhouse.plans.silver import billing, branches, clients, loyalty, missions, skills, workers
from tallyhouse.sources.partitioned import PART, Layout, Merged, by_key, by_month, merge_partitions
from tallyhouse.sources.readers import InputMissing, read_or_none, read_raw, read_required, read_snapshot
from tallyhouse.sources.schemas import raw_schema
from tallyhouse.sources.scratch import delete_folder, staging, stored
from tallyhouse.sources.writers import overwrite_table

CALENDAR = (date(2020, 1, 1), date(2035, 12, 31))


@dataclass(frozen=True)
class Load:
    """One load: where the layers lie, which raw day to take (None: all history), the reference day."""

    spark: SparkSession
    raw_root: str
    silver_root: str
    gold_root: str
    as_of: date
    now: datetime
    salt: str
    day: date | None = None
    #: Tables that were left as they were, and why.
    skipped: dict[str, str] = field(default_factory=dict)
    #: What several tables of this load read, written once.
    stored_once: dict[str, DataFrame] = field(default_factory=dict)
    #: Which partitions of which tables were rewritten.
    merges: dict[str, Merged] = field(default_factory=dict)
    #: Tables that this load has stored for the first time: all their keys came with it.
    created: set[str] = field(default_factory=set)
    #: What this load brought to tables with keys, while it runs.
    brought: dict[str, DataFrame] = field(default_factory=dict)

    def required(self, table: str) -> DataFrame:
        """An input without which a table can't be built; raises `InputMissing`."""
        return read_required(self.spark, self.raw_root, table, raw_schema(table), self.day)

    def snapshot(self, table: str) -> DataFrame:
        """A table that every load extracts whole: the day's rows, or those of the newest extract."""
        return read_snapshot(self.spark, self.raw_root, table, raw_schema(table), self.day)

    def raw(self, table: str) -> DataFrame:
        return read_raw(self.spark, self.raw_root, table, raw_schema(table), self.day)

    def history(self, table: str) -> DataFrame:
        return read_raw(self.spark, self.raw_root, table, raw_schema(table))

    def optional(self, table: str) -> DataFrame | None:
        found = self.history(table)
        return None if found.isEmpty() else found

    def stored_silver(self, table: str) -> DataFrame | None:
        return read_or_none(lambda: self.silver(table))

    def silver(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.silver_root}/{table}").drop(PART)


@dataclass(frozen=True)
class SilverTable:
    """``keys`` and ``layout``: merge the load into the touched partitions of the stored table; without keys the result
    replaces it.  With keys ``build`` gives one row of a key.

    ``resolve`` makes one row of a key from its stored and fresh rows (by default the newest load wins).  With ``touched``
    (the keys that a load may have changed) the stored rows of these keys are replaced: for tables that are derived from
    others, whose newest load time says nothing.  What ``build`` gives has no other keys then.
    """

    build: Callable[[Load], DataFrame]
    keys: Sequence[str] = ()
    layout: Layout | None = None
    resolve: Callable[[DataFrame], DataFrame] | None = None
    touched: Callable[[Load], DataFrame] | None = None
    #: The result reads the stored table that it replaces.
    reads_itself: bool = False


def _keyed(build: Callable[[Load], DataFrame], *keys: str, month: str | None = None, **options) -> SilverTable:
    """A table merged by key, cut by the month of a date or by the first of its keys."""
    layout = by_month(month) if month else by_key(keys[:1])
    return SilverTable(build, keys, layout, **options)


def _client_versions(load: Load) -> DataFrame:
    staged = clients.client_staging(
        load.snapshot("wttieserv"), load.snapshot("wtclpt"), load.optional("sf_accounts")
    )
    return clients.client_versions(staged, load.stored_silver("client_versions"), load.now)


def _worker_versions(load: Load) -> DataFrame:
    staged = workers.worker_staging(
        load.snapshot("pypersonne"),
        load.snapshot("pysalarie"),
        load.snapshot("wtpint"),
        load.snapshot("wtugpint"),
        load.salt,
    )
    return workers.worker_versions(staged, load.stored_silver("worker_versions"), load.now)


def _skills(load: Load) -> DataFrame:
    return skills.skills(
        skills.trades(load.snapshot("wtpmet"), load.history("wtmet")),
        skills.certifications(load.snapshot("wtphab"), load.history("wtthab"), load.as_of),
        skills.degrees(load.snapshot("wtpdip"), load.history("wttdip")),
        skills.experiences(load.snapshot("wtexp")),
    )


def _order_times(load: Load) -> DataFrame:
    """Order times of this load; notes which orders are new, changed or gone since the stored ones."""
    fresh, known = missions.order_times(load.snapshot("wtcmd")), load.stored_silver("order_times")
    changed = fresh.select("order_id")
    if known is not None:
        old = known.select("order_id", F.struct("ordered_at").alias("old"))
        both = old.join(fresh.select("order_id", F.struct("ordered_at").alias("new")), "order_id", "full_outer")
        changed = both.filter(~F.col("old").eqNullSafe(F.col("new"))).select("order_id")
    load.stored_once["changed_orders"] = stored(changed, "changed-orders")
    return fresh


def _touched_assignments(load: Load) -> DataFrame:
    """Keys of assignments whose own row, contract amendments or order came with this load."""
    if "touched" not in load.stored_once:
        load.stored_once["touched"] = stored(_find_touched(load), "touched")
    return load.stored_once["touched"]


def _brought_keys(load: Load, table: str, raw: str) -> DataFrame:
    """Keys that came with this load: those of the rows that it brought to a table, or of the raw batch itself."""
    if table in load.created:
        return load.silver(table).select(*missions.KEY)
    if table in load.brought:
        return load.brought[table].select(*missions.KEY)
    return missions.delivered_keys(load.raw(raw))


def _find_touched(load: Load) -> DataFrame:
    frames = [_brought_keys(load, "assignment_heads", "wtmiss").dropna(), _brought_keys(load, "contract_spans", "wtcnti")]
    if "changed_orders" in load.stored_once:
        frames.append(load.silver("assignment_heads").join(load.stored_once["changed_orders"], "order_id", "left_semi"))
    return reduce(DataFrame.union, [f.select(*missions.KEY) for f in frames]).distinct()


def _touched_rows(load: Load, table: str) -> DataFrame:
    """The rows of a table whose keys this load has touched."""
    if table in load.created:
        return load.silver(table)
    return load.silver(table).join(_touched_assignments(load), missions.KEY, "left_semi")


def _assignments(load: Load) -> DataFrame:
    heads, spans = (_touched_rows(load, t) for t in ("assignment_heads", "contract_spans"))
    return missions.assignments_from(heads, spans, load.silver("order_times"))


def _assignment_ends(load: Load) -> DataFrame:
    heads, spans = (_touched_rows(load, t) for t in ("assignment_end_heads", "contract_spans"))
    return missions.assignment_ends_from(heads, spans, load.history("wtfinmiss"), load.history("pymtfcnt"))


# In dependency order: assignments read their heads, contract spans and order times, payments invoices, loyalty assignments.
# Tables of raw tables that every load extracts whole have no keys: the newest extract replaces them.
SILVER_TABLES: dict[str, SilverTable] = {
    "assignment_heads": _keyed(lambda x: missions.assignment_heads(x.raw("wtmiss")), *missions.KEY),
    "assignment_end_heads": _keyed(lambda x: missions.assignment_end_heads(x.raw("wtmiss")), *missions.KEY),
    "contract_spans": _keyed(
        lambda x: missions.contract_spans(x.required("wtcnti")), *missions.KEY, resolve=missions.merged_spans
    ),
    "order_times": SilverTable(_order_times),
    "assignments": _keyed(_assignments, *missions.KEY, month="start_date", touched=_touched_assignments),
    "contracts": _keyed(
        lambda x: missions.contracts(x.raw("wtcnti")), *missions.KEY, "amendment", month="start_date"
    ),
    "orders": SilverTable(lambda x: missions.orders(x.snapshot("wtcmd"))),
    "placements": SilverTable(lambda x: missions.placements(x.snapshot("wtplac"))),
    "assignment_ends": _keyed(_assignment_ends, *missions.KEY, month="actual_end", touched=_touched_assignments),
    "payroll_contracts": _keyed(
        lambda x: missions.payroll_contracts(x.raw("pycontrat")), *missions.KEY, month="start_date"
    ),
    "invoice_links": SilverTable(lambda x: missions.invoice_links(x.snapshot("wtfacinfo"))),
    "timesheets": _keyed(lambda x: billing.timesheets(x.raw("wtprh")), "sheet_id", month="modified_at"),
    "timesheet_lines": _keyed(lambda x: billing.timesheet_lines(x.raw("wtrhdon")), "sheet_id", "line_no"),
    "invoices": SilverTable(lambda x: billing.invoices(x.raw("wtefac")), ("invoice_id",), upkeep.INVOICES),
    "invoice_lines": SilverTable(
        lambda x: billing.invoice_lines(x.raw("wtlfac")), ("invoice_id", "line_no"), upkeep.INVOICE_LINES
    ),
    "payments": _keyed(lambda x: billing.payments(x.raw("wtefac"), x.silver("invoices")), "invoice_id"),
    "client_versions": SilverTable(_client_versions, reads_itself=True),
    "sites": SilverTable(lambda x: clients.sites(x.snapshot("wttieserv"))),
    "contacts": SilverTable(lambda x: clients.contacts(x.snapshot("wttieint"))),
    "credit_exposures": SilverTable(lambda x: clients.credit_exposures(x.snapshot("wtencoursg"))),
    "worker_versions": SilverTable(_worker_versions, reads_itself=True),
    "evaluations": _keyed(lambda x: workers.evaluations(x.raw("wtpeval")), "worker_id", "eval_id"),
    "contact_points": SilverTable(lambda x: workers.contact_points(x.snapshot("pycoordonnee"))),
    "portfolio": SilverTable(lambda x: workers.portfolio(x.snapshot("wtugpint"))),
    "loyalty": SilverTable(lambda x: loyalty.loyalty(x.snapshot("wtpint"), x.silver("assignments"), x.as_of)),
    "skills": SilverTable(_skills),
    "branches": SilverTable(
        lambda x: branches.branches(x.snapshot("pyregroupecnt"), x.optional("agence_gestion"))
    ),
    "territory": SilverTable(lambda x: branches.territory(x.history("agence_gestion"), x.history("secteurs"))),
}


PENDING = "states_pending"


def _note_contributions(load: Load) -> None:
    """Before a load: what the invoices that it touches add to the stored revenue state.

    The mark says that the states are behind the silver tables until `load_gold` has caught up.  If an earlier load left it,
    the states can't be brought up to date by changes, and are computed anew.
    """
    spark, mark = load.spark, f"{load.gold_root}/{PENDING}"
    behind = read_or_none(lambda: spark.read.parquet(mark)) is not None
    overwrite_table(spark.createDataFrame([(load.now,)], "since timestamp"), mark)
    if behind or any(load.stored_silver(t) is None for t in ("invoices", "invoice_lines", "assignments")):
        return
    heads, lines = billing.invoices(load.raw("wtefac")), billing.invoice_lines(load.raw("wtlfac"))
    load.stored_once["billed_ids"] = stored(heads.select("invoice_id").union(lines.select("invoice_id")).distinct(), "billed-ids")
    load.stored_once["billed_before"] = stored(_billed(load).contributions(load.stored_once["billed_ids"]), "billed-before")


def _billed(load: Load) -> upkeep.Billed:
    heads, lines = load.silver("invoices").schema, load.silver("invoice_lines").schema
    return upkeep.Billed(load.spark, f"{load.silver_root}/invoices", f"{load.silver_root}/invoice_lines", heads, lines)


def _assignments_of(load: Load, keys: DataFrame) -> DataFrame:
    return load.silver("assignments").join(keys, missions.KEY, "left_semi")


def refresh_states(load: Load) -> dict[str, list[str]]:
    """Bring the additive states of marts up to date; returns the months rewritten, nothing where all was rebuilt."""
    number, root, kept = int(load.now.timestamp()), load.gold_root, load.stored_once
    revenue, started, delays = upkeep.revenue_state(root), upkeep.started_state(root), upkeep.delay_state(root)
    done: dict[str, list[str]] = {}
    if "billed_before" in kept and "started_before" in kept:
        after = _billed(load).contributions(kept["billed_ids"])
        done["revenue"] = upkeep.refresh(revenue, kept["billed_before"], after, number)
        now = _assignments_of(load, kept["touched"])
        done["started"] = upkeep.refresh(started, kept["started_before"], rev.started_by_month(now), number)
        done["delays"] = upkeep.refresh(delays, kept["delays_before"], ops.delay_counts(now), number)
    elif read_or_none(lambda: load.spark.read.parquet(f"{root}/{PENDING}")) is not None:
        revenue.rebuild(rev.revenue_by_branch(load.silver("invoices"), load.silver("invoice_lines")), number)
        started.rebuild(rev.started_by_month(load.silver("assignments")), number)
        delays.rebuild(ops.delay_counts(load.silver("assignments")), number)
    delete_folder(load.spark, f"{root}/{PENDING}")
    for name in ("billed_before", "started_before", "delays_before"):
        kept.pop(name, None)
    return done


def load_silver(load: Load, only: Sequence[str] | None = None) -> list[str]:
    """Build and store the silver tables.

    A table whose load brought nothing, or without an input that it needs, keeps its stored rows; `load.skipped`
    says why.
    """
    written = []
    if only is None:
        _note_contributions(load)
    with staging(load.spark) as stage:
        for name, table in SILVER_TABLES.items():
            if only is not None and name not in only:
                continue
            try:
                fresh = table.build(load)
            except InputMissing as error:
                load.skipped[name] = str(error)
                continue
            known = load.stored_silver(name)
            gone = None if known is None or table.touched is None else table.touched(load)
            staged = known is not None and table.layout is not None
            if staged:
                fresh = load.brought[name] = stage(fresh, name)
            if name == "assignments" and "billed_before" in load.stored_once:
                before = _assignments_of(load, gone)
                load.stored_once["started_before"] = stored(rev.started_by_month(before), "started-before")
                load.stored_once["delays_before"] = stored(ops.delay_counts(before), "delays-before")
            if known is not None and (gone is None or gone.isEmpty()) and fresh.isEmpty():
                load.skipped[name] = "the load brought no rows"
                continue
            path = f"{load.silver_root}/{name}"
            if table.layout is None:
                overwrite_table(fresh, path, reads_target=table.reads_itself and known is not None)
            else:
                load.merges[name] = merge_partitions(
                    fresh, path, table.keys, table.layout, table.resolve, gone, unique=True, staged=staged
                )
            if known is None:
                load.created.add(name)
            written.append(name)
        load.brought.clear()
    return written


class Gold:
    """Every gold mart of a load as a lazy DataFrame over the stored silver tables."""

    def __init__(self, load: Load):
        self.load = load

    def _silver(self, name: str) -> DataFrame:
        return self.load.silver(name)

    @cached_property
    def clients(self) -> DataFrame:
        return current_versions(self._silver("client_versions"), "client_id")

    @cached_property
    def workers(self) -> DataFrame:
        return current_versions(self._silver("worker_versions"), "worker_id")

    @cached_property
    def contracts(self) -> DataFrame:
        return asg.contract_heads(self._silver("contracts"))

    @cached_property
    def contract_hours(self) -> DataFrame:
        return asg.hours_per_contract(self._silver("timesheets"), self._silver("timesheet_lines"))

    @cached_property
    def home(self) -> DataFrame:
        return self.workers.filter(F.col("home_branch").isNotNull()).select(
            "worker_id", F.col("home_branch").alias("branch_id")
        )

    def marts(self) -> dict[str, DataFrame]:
        s, as_of = self._silver, self.load.as_of
        invoices, lines = s("invoices"), s("invoice_lines")
        assignments, orders, payments = s("assignments"), s("orders"), s("payments")
        hours, contracts, people = self.contract_hours, self.contracts, self.workers
        by_branch, started = rev.revenue_by_branch(invoices, lines), rev.started_by_month(assignments)
        monthly = upkeep.monthly_revenue(self.load.spark, self.load.gold_root, by_branch.schema, started.schema, self.clients)
        detail = asg.assignment_detail(assignments, contracts, hours)
        scorecard = brn.branch_scorecard(invoices, lines, assignments, contracts, hours, orders)
        facts = rec.settlement_facts(invoices, payments, as_of)
        pool = (s("loyalty"), s("portfolio"), self.home)
        return {
            "calendar_dim": ref.calendar_dim(ref.day_series(self.load.spark, *CALENDAR)),
            "sector_ref": ref.sector_ref(self.load.spark),
            "branch_dim": dim.branch_dim(s("branches"), s("territory")),
            "client_dim": dim.client_dim(s("client_versions")),
            "worker_dim": dim.worker_dim(s("worker_versions")),
            "trade_dim": dim.trade_dim(self.load.history("wtmet"), self.load.history("wtqua")),
            "certification_dim": dim.certification_dim(s("skills")),
            "degree_dim": dim.degree_dim(s("skills")),
            "monthly_revenue_client": monthly,
            "weekly_revenue_branch": rev.weekly_revenue_branch(invoices, lines, assignments, s("branches")),
            "daily_revenue_branch_client": rev.daily_revenue_branch_client(invoices, lines, assignments),
            "client_concentration": rev.client_concentration(invoices, lines),
            "client_concentration_topn": rev.client_concentration_topn(monthly),
            "sector_revenue": rev.sector_revenue(invoices, lines, self.clients),
            "client_360": cli.client_360(self.clients, monthly, detail, s("credit_exposures"), invoices, as_of),
            "client_360_light": cli.client_360_light(monthly, self.clients, s("credit_exposures"), as_of),
            "client_retention": cli.client_retention(invoices, lines, assignments, self.clients, as_of),
            "client_retention_light": cli.client_retention_light(monthly),
            "client_profitability": cli.client_profitability(
                invoices, lines, assignments, contracts, hours, self.clients
            ),
            "branch_scorecard": scorecard,
            "branch_ranking": brn.branch_ranking(scorecard),
            "branch_trends": brn.branch_trends(scorecard),
            "fte_weekly": ops.fte_weekly(s("timesheets"), s("timesheet_lines"), assignments),
            "weekly_hours": ops.weekly_hours(s("timesheets"), s("timesheet_lines"), assignments),
            "order_pipeline": ops.order_pipeline(orders),
            "order_pipeline_detail": ops.order_pipeline_detail(orders, assignments),
            "placement_delay": upkeep.placement_delays(
                self.load.spark, self.load.gold_root, ops.delay_counts(assignments).schema
            ),
            "declaration_compliance": ops.declaration_compliance(assignments),
            "due_weekly": rec.due_weekly(invoices, lines),
            "dso_client": rec.dso_client(invoices, lines, payments, as_of),
            "aged_balance": rec.aged_balance(invoices, lines, as_of),
            "settlement_stats": rec.settlement_stats(facts),
            "aged_balance_wide": rec.aged_balance_wide(facts, rev.invoice_amounts(lines)),
            "termination_rate": asg.termination_rate(s("assignment_ends"), assignments),
            "assignment_duration": asg.assignment_duration(assignments, contracts),
            "billing_coefficient": asg.billing_coefficient(assignments, contracts, hours),
            "renewal_rate": asg.renewal_rate(assignments, contracts),
            "worker_activity": wrk.worker_activity(assignments, contracts, hours, people),
            "assignment_detail": detail,
            "assignment_margin": asg.assignment_margin(assignments, contracts, hours),
            "loyalty_summary": wrk.loyalty_summary(*pool),
            "pool_dynamics": wrk.pool_dynamics(*pool),
            "key_resolution_coverage": wrk.key_resolution_coverage(*pool),
            "skill_availability": wrk.skill_availability(s("skills"), people, assignments, s("branches"), as_of),
            "branch_staffing": wrk.branch_staffing(assignments, people, orders),
            "worker_turnover": wrk.worker_turnover(assignments, as_of),
        }


def load_gold(load: Load, only: Sequence[str] | None = None) -> list[str]:
    """Store the gold marts, each a full replacement; those with additive states are read from them."""
    refresh_states(load)
    marts = Gold(load).marts()
    names = [n for n in marts if only is None or n in only]
    for name in names:
        overwrite_table(marts[name], f"{load.gold_root}/{name}")
    return names
