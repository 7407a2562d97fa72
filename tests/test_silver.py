from datetime import date, datetime
from decimal import Decimal

import pytest

from tallyhouse.plans.gold import dimensions as dim
from tallyhouse.plans.silver import billing, branches, clients, loyalty, missions, skills, workers
from tallyhouse.sources.schemas import RAW_COLUMNS, raw_schema

SALT = "a-salt-for-the-tests"


@pytest.fixture(scope="module")
def raw(spark):
    """A raw frame of a table from partial dict rows."""

    def build(table, *records):
        schema = raw_schema(table)
        data = [[{"_loaded_at": "2026-03-02 05:00:00", **r}.get(n) for n in schema.names] for r in records]
        return spark.createDataFrame(data, schema)

    return build


def test_every_raw_table_has_a_schema(spark):
    assert all("_loaded_at" in raw_schema(t).names for t in RAW_COLUMNS)


def test_assignments(raw):
    wtmiss = raw(
        "wtmiss",
        {"PER_ID": 1, "CNT_ID": 1, "TIE_ID": 7, "CMD_ID": 5.0, "FINMISS_CODE": " TN ", "MISS_FLAGDPAE": "2026-03-02 07:30:00"},
        {"PER_ID": 1, "CNT_ID": 1, "TIE_ID": 6, "CMD_ID": 5.0, "_loaded_at": "2026-03-01 05:00:00"},
        {"PER_ID": 2, "CNT_ID": 1, "MISS_FLAGDPAE": "not a date"},
        {"PER_ID": None, "CNT_ID": 1},
    )
    wtcnti = raw(
        "wtcnti",
        {"PER_ID": 1, "CNT_ID": 1, "CNTI_ORDRE": 1, "CNTI_DATEFFET": "2026-03-02 08:00:00"},
        {"PER_ID": 1, "CNT_ID": 1, "CNTI_ORDRE": 2, "CNTI_DATEFFET": "2026-03-09 08:00:00"},
    )
    wtcmd = raw(
        "wtcmd",
        {"CMD_ID": 5.0, "CMD_DTE": "2026-03-01 00:00:00"},
        {"CMD_ID": 5.0, "CMD_DTE": "2026-01-01 00:00:00", "_loaded_at": "2026-03-01 05:00:00"},
    )
    got = {r["worker_id"]: r for r in missions.assignments(wtmiss, wtcnti, wtcmd).collect()}
    assert set(got) == {1, 2}
    assert (got[1]["client_id"], got[1]["start_date"], got[1]["end_code"]) == (7, date(2026, 3, 2), "TN")
    assert (got[1]["declaration_gap_hours"], got[1]["placement_delay_hours"], got[1]["delay_class"]) == (-1, 32, "court")
    assert (got[2]["declared_at"], got[2]["delay_class"]) == (None, "inconnu")


def test_end_status(raw):
    codes = [("C1", "Fin prévue", "1"), ("C2", "Autre", "2"), ("C3", "Changement", "3"), ("C4", "Terme atteint", None), ("C5", "Abandon", None)]
    wtfinmiss = raw("wtfinmiss", *[{"FINMISS_CODE": c, "FINMISS_LIBELLE": t, "MTFCNT_ID": m} for c, t, m in codes])
    pymtfcnt = raw(
        "pymtfcnt",
        {"MTFCNT_ID": "1", "MTFCNT_LIBELLE": "Fin de Mission TT", "MTFCNT_FINCNT": "1"},
        {"MTFCNT_ID": "2", "MTFCNT_LIBELLE": "Démission", "MTFCNT_FINCNT": "1"},
        {"MTFCNT_ID": "3", "MTFCNT_LIBELLE": "Changement taux", "MTFCNT_FINCNT": "0"},
    )
    cases = {1: ("C1", 0), 2: ("C2", 0), 3: ("C3", None), 4: ("C4", 0), 5: ("C5", 0), 6: (None, 0), 7: ("C1", 1)}
    wtmiss = raw("wtmiss", *[{"PER_ID": k, "CNT_ID": 1, "FINMISS_CODE": c, "MISS_ANNULE": a} for k, (c, a) in cases.items()])
    wtcnti = raw("wtcnti", {"PER_ID": 1, "CNT_ID": 1, "CNTI_DATEFFET": "2026-01-01", "CNTI_DATEFINCNTI": "2026-01-11"})
    got = {r["worker_id"]: (r["end_status"], r["actual_days"]) for r in missions.assignment_ends(wtmiss, wtcnti, wtfinmiss, pymtfcnt).collect()}
    assert got == {
        1: ("TERME_NORMAL", 10), 2: ("RUPTURE", None), 3: ("EN_COURS", None), 4: ("TERME_NORMAL", None),
        5: ("RUPTURE", None), 6: ("EN_COURS", None), 7: ("ANNULEE", None),
    }


def test_billing(raw):
    heads = billing.invoices(
        raw("wtefac", {"EFAC_NUM": " F1 ", "EFAC_TYPF": "F ", "EFAC_DTEEDI": "2026-01-31", "EFAC_DTEECH": "2026-03-02", "EFAC_TAUXTVA": "oops"})
    )
    row = heads.first()
    assert (row["invoice_id"], row["doc_type"], row["vat_rate"], row["amount_net"]) == ("F1", "F", None, None)
    lines = billing.invoice_lines(raw("wtlfac", {"FAC_NUM": "F1", "LFAC_ORD": 1, "LFAC_MNT": Decimal("12.30")}, {"FAC_NUM": "X", "LFAC_ORD": 1}))
    assert billing.invoice_lines_since(lines, heads, date(2026, 1, 1)).count() == 1
    assert billing.invoice_lines_since(lines, heads, date(2026, 2, 1)).count() == 0
    paid = billing.payments(raw("wtefac", {"EFAC_NUM": "F1", "EFAC_DTEREGLF": "2026-03-12"}, {"EFAC_NUM": "F2"}), heads)
    assert {r["invoice_id"]: r["delay_days"] for r in paid.collect()} == {"F1": 10, "F2": None}
    sheet = billing.timesheets(raw("wtprh", {"PRH_BTS": 3, "PRH_FLAG_RH": "1", "PRH_MODIFDATE": "2026-01-05 10:00:00"})).first()
    assert (sheet["valid"], sheet["branch_id"], sheet["modified_at"]) == (True, None, datetime(2026, 1, 5, 10))
    assert "worker_id" not in billing.timesheet_lines(raw("wtrhdon", {"PRH_BTS": 3, "RHD_LIGNE": 1})).columns


def test_clients_with_and_without_crm(raw):
    sites = raw(
        "wttieserv",
        {"TIE_ID": 1, "TIES_SERV": 2, "TIES_DESIGNATION": " ACME ", "TIES_NIC": "123", "NAF2008": "7820Z", "TIES_VILLE": "Lyon"},
        {"TIE_ID": 1, "TIES_SERV": 1, "TIES_DESIGNATION": "ACME HQ", "TIES_NIC": "00012", "TIES_SIREN": "123456789"},
        {"TIE_ID": 2, "TIES_SERV": 1, "TIES_DESIGNATION": "Beta"},
    )
    attributes = raw("wtclpt", {"TIE_ID": 1, "CLPT_PROS": "INCONNU"}, {"TIE_ID": 2, "CLPT_PROS": "Prospect"})
    crm = raw("sf_accounts", {"ACCOUNT_CLIENT_ID": "1", "ACCOUNT_NAF_NAME": "Intérim", "ACCOUNT_STATUS": "Client"})
    plain = {r["client_id"]: r for r in clients.client_staging(sites, attributes).collect()}
    assert len(plain) == 2
    assert (plain[1]["client_name"], plain[1]["nic"], plain[1]["client_status"], plain[1]["naf_label"]) == ("ACME HQ", "00012", "INCONNU", "")
    enriched = {r["client_id"]: r for r in clients.client_staging(sites, attributes, crm).collect()}
    assert (enriched[1]["client_status"], enriched[1]["naf_label"]) == ("Client", "Intérim")
    assert enriched[2]["client_status"] == "Prospect"

    now, later = datetime(2026, 3, 1), datetime(2026, 3, 2)
    loaded = clients.client_versions(clients.client_staging(sites, attributes), None, now)
    again = clients.client_versions(clients.client_staging(sites, attributes, crm), loaded, later)
    current = {r["client_id"]: r for r in again.filter("is_current").collect()}
    assert again.count() == 3 and current[1]["valid_from"] == later and current[2]["valid_from"] == now
    gold = {r["client_id"]: r for r in dim.client_dim(again).collect()}
    assert gold[1]["siret"] == "12345678900012" and gold[2]["siret"] is None


def test_sites_contacts_exposures(raw):
    site = clients.sites(raw("wttieserv", {"TIE_ID": 1, "TIES_SERV": 1, "TIES_EMAIL": " A@B.FR ", "CLOT_DAT": "2026-01-01"})).first()
    assert (site["email"], site["country"], site["is_active"], site["closed_on"]) == ("a@b.fr", "FR", False, date(2026, 1, 1))
    contact = clients.contacts(raw("wttieint", {"TIE_ID": 1, "TIEI_ORDRE": 2, "TIEI_NOM": " Durand "})).first()
    assert (contact["last_name"], len(contact["contact_id"])) == ("Durand", 32)
    assert clients.credit_exposures(raw("wtencoursg", {"ENCGRP_ID": 4, "ENC_SIREN": " 1 "})).first()["siren"] == "1"


def test_workers_are_pseudonymised(raw):
    people = raw("pypersonne", {"PER_ID": 1, "PER_NOM": "X", "PER_NIR": "1850578006084"}, {"PER_ID": 2, "PER_NOM": "Y"})
    payroll = raw("pysalarie", {"PER_ID": 1, "SAL_ACTIF": "1"}, {"PER_ID": 2, "SAL_ACTIF": "?"})
    profiles = raw("wtpint", {"PER_ID": 1, "PINT_CANDIDAT": "true"})
    links = raw("wtugpint", {"PER_ID": 1, "RGPCNT_ID": 8}, {"PER_ID": 1, "RGPCNT_ID": 9, "_loaded_at": "2026-03-03 00:00:00"}, {"PER_ID": 2})
    staged = workers.worker_staging(people, payroll, profiles, links, SALT)
    assert "nir" not in staged.columns
    got = {r["worker_id"]: r for r in staged.collect()}
    assert len(got[1]["nir_hash"]) == 64 and got[2]["nir_hash"] is None
    assert (got[1]["is_active"], got[1]["is_candidate"], got[1]["home_branch"]) == (True, True, 9)
    assert (got[2]["is_active"], got[2]["is_permanent"], got[2]["home_branch"]) == (False, False, None)
    public = dim.worker_dim(workers.worker_versions(staged, None, datetime(2026, 3, 1)))
    assert not {"nir_hash", "birth_date", "address"} & set(public.columns)
    with pytest.raises(ValueError):
        workers.worker_staging(people, payroll, profiles, links, "short")
    assert workers.evaluations(raw("wtpeval", {"PER_ID": 1, "PEVAL_EVALUATION": "4.5"})).first()["grade"] == Decimal("4.50")
    assert workers.contact_points(raw("pycoordonnee", {"PER_ID": 1, "PER_TEL_NTEL": " 06 "})).first()["contact_value"] == "06"
    assert workers.portfolio(links).count() == 2


def test_loyalty_categories(raw, frame):
    as_of = date(2026, 3, 31)
    days = {1: "2025-12-31", 2: "2025-12-30", 3: "2025-03-31", 4: "2025-03-30", 5: None}
    profiles = raw("wtpint", *[{"PER_ID": k, "PINT_CREATDTE": "2025-01-01", "PINT_DERVENDTE": d} for k, d in days.items()])
    done = frame([(1, 10, date(2025, 4, 1)), (1, 11, date(2025, 3, 1))], "worker_id long, contract_id long, start_date date")
    got = {r["worker_id"]: r for r in loyalty.loyalty(profiles, done, as_of).collect()}
    assert {k: r["loyalty_category"] for k, r in got.items()} == {
        1: "actif_recent", 2: "actif_annee", 3: "actif_annee", 4: "inactif_long", 5: "inactif"
    }
    assert (got[1]["assignments_12m"], got[1]["loyalty_rate"]) == (1, round(1 / (364 / 30.0), 4))


def test_skills(raw, rows):
    as_of = date(2026, 3, 1)
    trades = skills.trades(
        raw("wtpmet", {"PER_ID": 1, "PMET_ORDRE": 1, "MET_ID": 5}, {"PER_ID": 1, "PMET_ORDRE": 2, "MET_ID": 6}, {"PER_ID": 1, "PMET_ORDRE": 3}),
        raw("wtmet", {"MET_ID": 5, "MET_LIBELLE": " Cariste "}, {"MET_ID": 6, "MET_LIBELLE": "Vieux", "MET_DELETE": "1"}),
    )
    assert rows(trades, "code", "label", "is_active") == [("", "Métier inconnu", True), ("5", "Cariste", True), ("6", "Vieux", False)]
    certifications = skills.certifications(
        raw("wtphab", {"PER_ID": 1, "THAB_ID": "H1", "PHAB_DELIVR": "2026-01-31"}, {"PER_ID": 1, "THAB_ID": "H2", "PHAB_EXPIR": "2026-03-01"}),
        raw("wtthab", {"THAB_ID": "H1", "THAB_NBMOIS": "1"}),
        as_of,
    )
    assert rows(certifications, "code", "expires_on", "is_active") == [("H1", date(2026, 2, 28), False), ("H2", date(2026, 3, 1), False)]
    degrees = skills.degrees(raw("wtpdip", {"PER_ID": 1, "TDIP_ID": "D"}), raw("wttdip", {"TDIP_ID": "D", "TDIP_LIB": "Bac", "TDIP_REF": ""}))
    assert rows(degrees, "label", "level") == [("Bac", None)]
    experiences = skills.experiences(raw("wtexp", {"PER_ID": None, "EXP_ORDRE": 1}, {"PER_ID": 1, "EXP_ORDRE": 1}))
    table = skills.skills(trades, certifications, degrees, experiences, trades)
    assert table.count() == 7 and table.select("skill_id").distinct().count() == 7
    assert dim.certification_dim(table).count() == 2 and dim.degree_dim(table).count() == 1


def test_branches_and_territory(raw, rows):
    heads = raw("pyregroupecnt", {"RGPCNT_ID": 1, "RGPCNT_LIBELLE": " Lyon "}, {"RGPCNT_ID": 2, "DATE_CLOTURE": "2025-01-01"})
    management = raw(
        "agence_gestion",
        {"ID_UG": 1, "NOM_UG": "Lyon ", "MARQUE": "M", "BRANCHE": " ", "DATE_UG_GEST": "2026-01-01"},
        {"ID_UG": 1, "NOM_UG": "Old", "MARQUE": "O", "DATE_UG_GEST": "2025-01-01"},
    )
    sectors = raw("secteurs", {"Agence de gestion": " LYON", "Secteur": "Sud "}, {"Agence de gestion": "lyon", "Secteur": "Sud"})
    table = branches.branches(heads, management)
    assert rows(table, "branch_id", "brand", "line", "is_active") == [(1, "M", None, True), (2, None, None, False)]
    assert rows(branches.branches(heads), "branch_id", "brand") == [(1, None), (2, None)]
    land = branches.territory(management, sectors)
    assert rows(land, "branch_id", "sector") == [(1, "Sud")]
    assert rows(dim.branch_dim(table, land), "branch_id", "sector") == [(1, "Sud"), (2, "")]
