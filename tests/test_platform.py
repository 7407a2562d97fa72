"""A small company end to end: raw JSON batches → silver tables → gold marts, over two days."""

from datetime import date, datetime
from decimal import Decimal

import pytest

from tallyhouse.plans.platform import SILVER_TABLES, Gold, Load, load_gold, load_silver, refresh_states
from tallyhouse.sources.schemas import RAW_COLUMNS, raw_schema
from tallyhouse.sources.writers import write_bucketed, write_raw

DAY1, DAY2 = date(2026, 3, 2), date(2026, 3, 3)
BATCHES = {
    DAY1: {
        "wtmiss": [
            {"PER_ID": 1, "CNT_ID": 1, "TIE_ID": 7, "RGPCNT_ID": 10, "CMD_ID": 5.0, "MISS_SAISIE_DTFIN": "2026-02-20",
             "FINMISS_CODE": "TN", "MISS_FLAGDPAE": "2026-02-01 10:00:00"},
            {"PER_ID": 2, "CNT_ID": 1, "TIE_ID": 7, "RGPCNT_ID": 10, "CMD_ID": 6.0},
        ],
        "wtcnti": [
            {"PER_ID": 1, "CNT_ID": 1, "CNTI_ORDRE": 1, "MET_ID": 3, "CNTI_DATEFFET": "2026-02-02", "CNTI_DATEFINCNTI": "2026-02-20",
             "CNTI_THPAYE": Decimal(12), "CNTI_THFACT": Decimal("15.5")},
            {"PER_ID": 2, "CNT_ID": 1, "CNTI_ORDRE": 1, "MET_ID": 3, "CNTI_DATEFFET": "2026-02-16"},
        ],
        "wtcmd": [{"CMD_ID": 5.0, "RGPCNT_ID": 10, "CMD_DTE": "2026-02-01", "CMD_NBSALS": 2, "STAT_CODE": "P"}],
        "wtplac": [{"PLAC_ID": 1, "RGPCNT_ID": 10}],
        "wtfinmiss": [{"FINMISS_CODE": "TN", "FINMISS_LIBELLE": "Terme", "MTFCNT_ID": "1"}],
        "pymtfcnt": [{"MTFCNT_ID": "1", "MTFCNT_LIBELLE": "Fin de mission TT", "MTFCNT_FINCNT": "1"}],
        "pycontrat": [{"PER_ID": 1, "CNT_ID": 1}],
        "wtfacinfo": [{"CNT_ID": 1, "FAC_NUM": "F1", "PER_ID": 1, "TIE_ID": 7}],
        "wtprh": [{"PRH_BTS": 100, "PER_ID": 1, "CNT_ID": 1, "TIE_ID": 7, "PRH_FLAG_RH": "1", "PRH_MODIFDATE": "2026-02-09 00:00:00"}],
        "wtrhdon": [{"PRH_BTS": 100, "RHD_LIGNE": 1, "RHD_ORIRUB": "HN", "RHD_BASEP": Decimal(35), "RHD_BASEF": Decimal(35)}],
        "wtefac": [
            {"EFAC_NUM": "F1", "RGPCNT_ID": 10, "TIE_ID": 7, "EFAC_TYPF": "F", "EFAC_DTEEDI": "2026-02-10", "EFAC_DTEECH": "2026-02-25"},
        ],
        "wtlfac": [{"FAC_NUM": "F1", "LFAC_ORD": 1, "LFAC_BASE": Decimal(35), "LFAC_MNT": Decimal("542.50")}],
        "wttieserv": [{"TIE_ID": 7, "TIES_SERV": 1, "TIES_DESIGNATION": "ACME", "TIES_SIREN": "123456789", "NAF": "7820Z", "TIES_VILLE": "Lyon"}],
        "wtclpt": [{"TIE_ID": 7, "CLPT_PROS": "Client"}],
        "wttieint": [{"TIE_ID": 7, "TIEI_ORDRE": 1}],
        "wtencoursg": [{"ENCGRP_ID": 1, "ENC_SIREN": "123456789"}],
        "pypersonne": [{"PER_ID": 1, "PER_NOM": "A", "PER_NIR": "1850578006084"}, {"PER_ID": 2, "PER_NOM": "B"}],
        "pysalarie": [{"PER_ID": 1, "SAL_ACTIF": "1"}, {"PER_ID": 2, "SAL_ACTIF": "1"}],
        "wtpint": [{"PER_ID": 1, "PINT_CREATDTE": "2025-01-01", "PINT_DERVENDTE": "2026-02-20"}],
        "wtugpint": [{"PER_ID": 1, "RGPCNT_ID": 10}, {"PER_ID": 2, "RGPCNT_ID": 10}],
        "wtpeval": [{"PER_ID": 1, "PEVAL_DU": "2026-02-20", "PEVAL_EVALUATION": "4"}],
        "pycoordonnee": [{"PER_ID": 1, "TYPTEL_CODE": "M", "PER_TEL_NTEL": "06"}],
        "wtpmet": [{"PER_ID": 1, "PMET_ORDRE": 1, "MET_ID": 3}],
        "wtmet": [{"MET_ID": 3, "MET_LIBELLE": "Cariste"}],
        "wtqua": [{"TQUA_ID": "Q", "TQUA_LIBELLE": "N1"}],
        "wtphab": [{"PER_ID": 1, "THAB_ID": "H", "PHAB_DELIVR": "2026-01-01"}],
        "wtthab": [{"THAB_ID": "H", "THAB_LIBELLE": "CACES", "THAB_NBMOIS": "60"}],
        "wtpdip": [{"PER_ID": 1, "TDIP_ID": "D"}],
        "wttdip": [{"TDIP_ID": "D", "TDIP_LIB": "Bac"}],
        "wtexp": [{"PER_ID": 1, "EXP_ORDRE": 1}],
        "pyregroupecnt": [{"RGPCNT_ID": 10, "RGPCNT_LIBELLE": "Lyon"}],
        "agence_gestion": [{"ID_UG": 10, "NOM_UG": "Lyon", "DATE_UG_GEST": "2026-01-01"}],
        "secteurs": [{"Agence de gestion": "LYON ", "Secteur": "Sud"}],
    },
    DAY2: {
        "wtefac": [{"EFAC_NUM": "F2", "RGPCNT_ID": 10, "TIE_ID": 7, "EFAC_TYPF": "F", "EFAC_DTEEDI": "2026-03-01", "EFAC_DTEECH": "2026-04-01"}],
        "wtlfac": [{"FAC_NUM": "F2", "LFAC_ORD": 1, "LFAC_BASE": Decimal(10), "LFAC_MNT": Decimal(100)}],
        "wttieserv": [{"TIE_ID": 7, "TIES_SERV": 1, "TIES_DESIGNATION": "ACME", "TIES_SIREN": "123456789", "NAF": "7820Z", "TIES_VILLE": "Paris"}],
        "wtclpt": [{"TIE_ID": 7, "CLPT_PROS": "Client"}],
    },
}


@pytest.fixture(scope="module")
def platform(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("platform"))
    for day, tables in BATCHES.items():
        for table, records in tables.items():
            schema = raw_schema(table)
            data = [[r.get(n) for n in schema.names] for r in records]
            batch = spark.createDataFrame(data, schema).select(*[f"`{f.name}`" for f in schema.fields if not f.name.startswith("_")])
            write_raw(batch.coalesce(1), f"{root}/raw", table, day, f"b{day.day}", f"{day} 05:00:00")

    def load(day, now):
        return Load(spark, f"{root}/raw", f"{root}/silver", f"{root}/gold", date(2026, 3, 15), now, "a-salt-for-the-tests", day)

    first = load(DAY1, datetime(2026, 3, 2))
    assert set(load_silver(first)) == set(SILVER_TABLES)
    assert load_gold(first, ["monthly_revenue_client"]) == ["monthly_revenue_client"]
    second = load(DAY2, datetime(2026, 3, 3))
    written = load_silver(second)
    return second, written


def test_second_day_rewrites_its_months_only(platform):
    load, _ = platform
    assert load.merges["invoices"].rewritten == ["m2026-03"] and len(load.merges["invoice_lines"].rewritten) == 1
    assert "assignments" in load.skipped and "timesheets" in load.skipped
    assert refresh_states(load) == {"revenue": ["m2026-03"], "started": [], "delays": []}
    assert refresh_states(load) == {}


def test_raw_schemas_are_all_fed():
    assert set(RAW_COLUMNS) - set(BATCHES[DAY1]) == {"sf_accounts"}


def test_second_day_merges_instead_of_replacing(platform, rows):
    load, written = platform
    assert {"invoices", "invoice_lines", "client_versions"} <= set(written) and "orders" not in written
    assert rows(load.silver("invoices"), "invoice_id") == [("F1",), ("F2",)]
    versions = rows(load.silver("client_versions"), "city", "is_current")
    assert versions == [("Lyon", False), ("Paris", True)]
    assert load.silver("assignments").count() == 2
    people = load.silver("worker_versions")
    assert "nir" not in people.columns and people.filter("nir_hash is not null").count() == 1


def test_gold_marts(platform, rows):
    load, _ = platform
    names = load_gold(load)
    assert len(names) == len(Gold(load).marts()) == 46
    gold = {n: load.spark.read.parquet(f"{load.gold_root}/{n}") for n in names}
    assert rows(gold["monthly_revenue_client"], "month", "net_revenue", "main_branch") == [
        (date(2026, 2, 1), Decimal("542.50"), 10), (date(2026, 3, 1), Decimal("100.00"), 10)
    ]
    card = {r["month"]: r for r in gold["branch_scorecard"].collect()}[date(2026, 2, 1)]
    assert (card["margin_rate"], card["active_workers"], card["conversion_rate"]) == (round(3.5 / 15.5, 4), 2, 1.0)
    profile = gold["client_360"].first()
    assert (profile["city"], profile["revenue_ytd"], profile["active_assignments"], profile["churn_risk"]) == ("Paris", Decimal("642.50"), 1, "LOW")
    assert rows(gold["fte_weekly"], "week", "fte") == [(date(2026, 2, 9), 1.0)]
    assert rows(gold["termination_rate"], "normal_ends") == [(1,)]
    assert rows(gold["branch_dim"], "branch_name", "sector") == [("Lyon", "Sud")]
    assert rows(gold["skill_availability"], "trade_id", "qualified", "available") == [(3, 1, 1)]
    assert rows(gold["key_resolution_coverage"]) == [(1, 1, 0, 0)]
    assert gold["calendar_dim"].count() == 5844


def test_bucketed_tables_join_without_a_shuffle(spark, frame):
    spark.sql("CREATE DATABASE IF NOT EXISTS buckets")
    data = [(i, i % 7, float(i)) for i in range(200)]
    for name in ("buckets.left_t", "buckets.right_t"):
        write_bucketed(frame(data, "worker_id long, contract_id long, x double"), name, ["worker_id", "contract_id"], 4)
    left, right = spark.table("buckets.left_t").hint("merge"), spark.table("buckets.right_t").withColumnRenamed("x", "y")
    joined = left.join(right, ["worker_id", "contract_id"])
    assert "Exchange" not in joined._jdf.queryExecution().sparkPlan().toString()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 200 and "Exchange hashpartitioning" not in plan
    spark.sql("DROP DATABASE buckets CASCADE")
