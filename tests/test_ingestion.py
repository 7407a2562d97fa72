from datetime import date, datetime

import pytest
from pyspark.errors import AnalysisException

from tallyhouse.operators.delta import EPOCH
from tallyhouse.plans.ingestion import CHILD_TABLES, DELTA_TABLES, RAW_TABLES, RawTable, ingest
from tallyhouse.sources.readers import read_raw
from tallyhouse.sources.schemas import RAW_COLUMNS, raw_schema

STATE = "pipeline string, table_name string, last_success timestamp, last_status string, last_error string, run_count long, rows_ingested long"


@pytest.fixture
def source(frame):
    tables = {
        "wtprh": frame(
            [(1, datetime(2022, 6, 1), "secret"), (2, datetime(2026, 3, 1), "secret"), (3, datetime(2026, 3, 2), "secret"), (4, None, "x")],
            "PRH_BTS long, PRH_MODIFDATE timestamp, internal string",
        ),
        "pycontrat": frame([(1, 1, date(2020, 1, 1)), (1, 2, None)], "PER_ID long, CNT_ID long, CNT_DATEFIN date"),
        "wtefac": frame([("F1", date(2026, 1, 1)), ("F0", date(2020, 1, 1))], "EFAC_NUM string, EFAC_DTEEDI date"),
        "wtlfac": frame([("F1", 1), ("F1", 2), ("F0", 1), ("orphan", 1)], "FAC_NUM string, LFAC_ORD int"),
        "wttdip": frame([("D", "Bac")], "TDIP_ID string, TDIP_LIB string"),
    }

    def read(name):
        df = tables[name]
        absent = [c for c in raw_schema(name).names if c not in df.columns and not c.startswith("_")]
        return df.selectExpr("*", *[f"cast(null as string) as `{c}`" for c in absent])

    return read


def by_name(state):
    return {r["table_name"]: r for r in state.collect()}


def test_every_raw_table_is_loaded_once():
    assert sorted(t.name for t in RAW_TABLES) == sorted(RAW_COLUMNS)


def test_delta_child_and_full_loads(spark, frame, source, tmp_path, rows):
    root, now = str(tmp_path), datetime(2026, 3, 5, 5)
    wanted = {"wtprh", "pycontrat", "wtlfac", "wttdip"}
    tables = [t for t in RAW_TABLES if t.name in wanted]
    state = ingest(spark.createDataFrame([], STATE), source, "bronze", root, date(2026, 3, 5), "b1", now, tables)
    got = by_name(state)
    assert {k: r["rows_ingested"] for k, r in got.items()} == {"wtprh": 2, "pycontrat": 1, "wtlfac": 2, "wttdip": 1}
    assert {r["last_success"] for r in got.values()} == {now}  # when the load began, whatever dates the rows bear
    sheets = read_raw(spark, root, "wtprh", raw_schema("wtprh"))
    assert "internal" not in sheets.columns and rows(sheets, "PRH_BTS", "_batch_id") == [(2, "b1"), (3, "b1")]
    assert rows(read_raw(spark, root, "wtlfac", raw_schema("wtlfac")), "FAC_NUM", "LFAC_ORD") == [("F1", 1), ("F1", 2)]

    stored = frame([tuple(r) for r in state.collect()], STATE)
    again = by_name(ingest(stored, source, "bronze", root, date(2026, 3, 6), "b2", datetime(2026, 3, 6, 5), tables))
    assert (again["wtprh"]["rows_ingested"], again["wtprh"]["run_count"]) == (2, 2)
    assert again["wttdip"]["last_success"] == datetime(2026, 3, 6, 5)


def test_future_dates_do_not_move_the_mark_beyond_the_load(spark, frame, tmp_path, rows):
    """A contract that ends next year must not hide one that is entered tomorrow and ends this year."""
    columns = [f.name for f in raw_schema("pycontrat").fields if not f.name.startswith("_")]

    def source(*contracts):
        df = frame([(1, n, end) for n, end in contracts], "PER_ID long, CNT_ID long, CNT_DATEFIN date")
        return lambda _: df.selectExpr("*", *[f"cast(null as string) as `{c}`" for c in columns if c not in df.columns])

    tables = [t for t in RAW_TABLES if t.name == "pycontrat"]
    first = [(1, date(2027, 12, 31))]
    state = ingest(spark.createDataFrame([], STATE), source(*first), "p", str(tmp_path), date(2026, 3, 5), "b1", datetime(2026, 3, 5, 5), tables)
    state = frame([tuple(r) for r in state.collect()], STATE)
    ingest(state, source(*first, (2, date(2026, 6, 30))), "p", str(tmp_path), date(2026, 3, 6), "b2", datetime(2026, 3, 6, 5), tables)
    found = read_raw(spark, str(tmp_path), "pycontrat", raw_schema("pycontrat")).select("CNT_ID").distinct()
    assert rows(found) == [(1,), (2,)]


def test_a_failing_table_does_not_stop_the_others(spark, source, tmp_path):
    def broken(name):
        if name == "wtprh":
            raise AnalysisException("no such table")
        return source(name)

    tables = [t for t in (*DELTA_TABLES, *CHILD_TABLES) if t.name in ("wtprh", "wtefac")]
    state = ingest(spark.createDataFrame([], STATE), broken, "bronze", str(tmp_path), date(2026, 3, 5), "b", datetime(2026, 3, 5), tables)
    got = by_name(state)
    assert (got["wtprh"]["last_status"], got["wtprh"]["last_success"]) == ("failed", EPOCH)
    assert (got["wtefac"]["last_status"], got["wtefac"]["rows_ingested"]) == ("success", 1)
    assert RawTable("x").delta is None
