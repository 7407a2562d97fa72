"""Query catalogue of the silver builders and the dimensions built on them."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame

from tallyhouse.operators.versions import scd2_first_load
from tallyhouse.plans.gold import dimensions as dim
from tallyhouse.plans.raw_views import RawViews
from tallyhouse.plans.silver import billing, branches, clients, missions, skills, workers
from tallyhouse.plans.staffing import AS_OF

FIRST_LOAD = datetime(2001, 1, 1)
# A salt for the sample tables only; a platform passes its own secret.
SAMPLE_SALT = "sample-tables-only-salt"


class Silver(RawViews):
    @cached_property
    def skill_table(self) -> DataFrame:
        return skills.skills(
            skills.trades(self.wtpmet, self.wtmet),
            skills.certifications(self.wtphab, self.wtthab, AS_OF),
            skills.degrees(self.wtpdip, self.wttdip),
            skills.experiences(self.wtexp),
        ).drop("_loaded_at")

    @cached_property
    def client_staging(self) -> DataFrame:
        return clients.client_staging(self.wttieserv, self.wtclpt, self.crm_accounts)

    @cached_property
    def client_versions(self) -> DataFrame:
        return scd2_first_load(self.client_staging, "client_id", clients.TRACKED, FIRST_LOAD, "client_sk")

    @cached_property
    def worker_staging(self) -> DataFrame:
        return workers.worker_staging(self.pypersonne, self.pysalarie, self.wtpint, self.wtugpint, SAMPLE_SALT)

    @cached_property
    def worker_versions(self) -> DataFrame:
        return workers.worker_versions(self.worker_staging, None, FIRST_LOAD)

    @cached_property
    def silver_branches(self) -> DataFrame:
        return branches.branches(self.pyregroupecnt, self.agence_gestion)

    @cached_property
    def territory(self) -> DataFrame:
        return branches.territory(self.agence_gestion, self.secteurs)

    @cached_property
    def silver_invoices(self) -> DataFrame:
        return billing.invoices(self.wtefac)

    @cached_property
    def trade_dim(self) -> DataFrame:
        return dim.trade_dim(self.wtmet, self.wtqua)


Build = Callable[[Silver], DataFrame]


def _plain(build: Build) -> Build:
    """Without the load bookkeeping columns."""
    return lambda s: build(s).drop("_batch_id", "_loaded_at")


SILVER: dict[str, Build] = {
    "silver_assignments": _plain(lambda s: missions.assignments(s.wtmiss, s.wtcnti, s.wtcmd)),
    "silver_contracts": _plain(lambda s: missions.contracts(s.wtcnti)),
    "silver_orders": _plain(lambda s: missions.orders(s.wtcmd)),
    "silver_placements": _plain(lambda s: missions.placements(s.wtplac)),
    "silver_assignment_ends": _plain(
        lambda s: missions.assignment_ends(s.wtmiss, s.wtcnti, s.wtfinmiss, s.pymtfcnt)
    ),
    "silver_payroll_contracts": _plain(lambda s: missions.payroll_contracts(s.pycontrat)),
    "silver_invoice_links": _plain(lambda s: missions.invoice_links(s.wtfacinfo)),
    "silver_timesheets": _plain(lambda s: billing.timesheets(s.wtprh)),
    "silver_timesheet_lines": _plain(lambda s: billing.timesheet_lines(s.wtrhdon)),
    "silver_invoices": _plain(lambda s: s.silver_invoices),
    "silver_invoice_lines": _plain(lambda s: billing.invoice_lines(s.wtlfac)),
    "silver_payments": _plain(lambda s: billing.payments(s.wtefac, s.silver_invoices)),
    "silver_clients": lambda s: s.client_staging,
    "silver_sites": _plain(lambda s: clients.sites(s.wttieserv)),
    "silver_contacts": _plain(lambda s: clients.contacts(s.wttieint)),
    "silver_credit_exposures": _plain(lambda s: clients.credit_exposures(s.wtencoursg)),
    "silver_workers": lambda s: s.worker_staging,
    "silver_evaluations": _plain(lambda s: workers.evaluations(s.wtpeval)),
    "silver_contact_points": _plain(lambda s: workers.contact_points(s.pycoordonnee)),
    "silver_portfolio": _plain(lambda s: workers.portfolio(s.wtugpint)),
    "skills_union": lambda s: s.skill_table,
    "silver_branches": _plain(lambda s: s.silver_branches),
    "text_bridge": lambda s: s.territory,
    "branch_dim": lambda s: dim.branch_dim(s.silver_branches, s.territory).drop("_batch_id", "_loaded_at"),
    "client_dim": lambda s: dim.client_dim(s.client_versions),
    "worker_dim": lambda s: dim.worker_dim(s.worker_versions),
    "trade_dim": lambda s: s.trade_dim,
    "certification_dim": lambda s: dim.certification_dim(s.skill_table),
    "degree_dim": lambda s: dim.degree_dim(s.skill_table),
}
