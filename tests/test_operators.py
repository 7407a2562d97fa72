import random
from collections import defaultdict
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import delta, privacy, quality
from tallyhouse.operators import versions as ver
from tallyhouse.operators.dedup import current_versions, latest_loaded, merge_latest, top_per_group
from tallyhouse.operators.joins import (
    horizon_join,
    join_latest,
    join_preaggregated,
    keep_top,
    periods_per_member,
    resolve_key,
    text_bridge,
    without,
)
from tallyhouse.operators.quality import Rule
from tallyhouse.operators.windows import (
    latest_period,
    percent_rank_of,
    previous_in_chain,
    ranked_values,
    same_period_last_year,
)


def test_latest_wins_with_ties_and_missing_keys(frame, rows):
    df = frame(
        [(1, "b", "2026-01-02"), (1, "a", "2026-01-02"), (1, "c", "2026-01-01"), (2, "x", None), (None, "y", "2026-01-03")],
        "id int, v string, _loaded_at string",
    )
    assert rows(latest_loaded(df, ["id"])) == [(1, "a", "2026-01-02"), (2, "x", None)]


def test_merge_keeps_rows_absent_from_the_delta(frame, rows):
    old = frame([(1, "a", "1"), (2, "b", "1")], "id int, v string, _loaded_at string")
    new = frame([(2, "c", "2"), (3, "d", "2")], "id int, v string, _loaded_at string")
    assert rows(merge_latest(old, new, ["id"]), "id", "v") == [(1, "a"), (2, "c"), (3, "d")]


def test_preaggregated_join_does_not_multiply(frame, rows):
    sheets = frame([("s1", 1), ("s2", 1), ("s3", 2)], "sheet string, contract int")
    lines = frame([("s1", 35), ("s1", 28), ("s2", 21)], "sheet string, hours int")
    joined = join_preaggregated(sheets, lines, ["sheet"], [F.sum("hours").alias("hours")])
    assert rows(joined, "sheet", "hours") == [("s1", 63), ("s2", 21), ("s3", None)]
    assert rows(joined.groupBy("contract").agg(F.sum("hours"))) == [(1, 84), (2, None)]


def test_join_latest_and_bridge_and_resolve(frame, rows):
    left = frame([(1,), (2,)], "k int")
    right = frame([(1, "old", 1), (1, "new", 2), (None, "x", 3)], "k int, v string, t int")
    assert rows(join_latest(left, right, ["k"], [F.col("t").desc()]), "k", "v") == [(1, "new"), (2, None)]

    names = frame([(1, " Lyon Sud"), (2, "Brest")], "id int, name string")
    sectors = frame([("LYON SUD ", "A"), ("lyon sud", "A"), ("Nice", "B")], "agency string, sector string")
    assert rows(text_bridge(names, "name", sectors, "agency"), "id", "sector") == [(1, "A")]

    members = frame([(1,), (2,), (3,)], "w int")
    primary = frame([(1, 10)], "w int, b int")
    fallback = frame([(1, 99), (2, 20)], "w int, b int")
    assert rows(resolve_key(members, "w", primary, fallback, "b")) == [(1, 10, "primary"), (2, 20, "fallback")]
    assert len(rows(resolve_key(members, "w", primary, fallback, "b", keep_unresolved=True))) == 3


def test_horizon_top_and_anti(frame, rows):
    child = frame([(1, "a"), (2, "b"), (9, "orphan")], "fk int, v string")
    parent = frame([(1, date(2024, 1, 1)), (2, date(2023, 12, 31))], "id int, d date")
    assert rows(horizon_join(child, parent, {"fk": "id"}, "d", date(2024, 1, 1))) == [(1, "a")]
    ranking = frame([(1, 5), (2, 7), (9, 7)], "fk int, score int")
    assert rows(keep_top(child, "fk", ranking, [F.col("score").desc(), F.col("fk")], 1)) == [(2, "b")]
    assert rows(without(child, parent.select(F.col("id").alias("fk")), "fk")) == [(9, "orphan")]


def test_every_member_gets_every_period(frame, rows):
    members = frame([("x", 2), ("y", 1)], "b string, pool int")
    facts = frame([(date(2026, 1, 5),), (date(2026, 1, 12),), (date(2026, 1, 5),)], "week date")
    got = rows(periods_per_member(members, facts, "week"), "b", "week")
    assert got == [(b, w) for b in "xy" for w in (date(2026, 1, 5), date(2026, 1, 12))]


def brute_ranks(values):
    """(value → rank, dense rank, members) in descending order."""
    distinct = sorted(set(values), reverse=True)
    return {v: (1 + sum(x > v for x in values), 1 + distinct.index(v), values.count(v)) for v in distinct}


def test_ranked_values_match_brute_force_with_a_hot_group(frame):
    rng = random.Random(7)
    data = []
    for g, n in (("hot", 400), ("mid", 40), ("one", 1)):
        for _ in range(n):
            v = rng.choice([0, 5, -5, rng.randint(-10**7, 10**7), rng.randint(995, 1005), 10**9])
            data.append((g, Decimal(v).scaleb(-2)))
    got = ranked_values(frame(data, "g string, v decimal(18,2)"), ["g"], "v").collect()
    groups = defaultdict(list)
    for g, v in data:
        groups[g].append(v)
    assert len(got) == sum(len(set(v)) for v in groups.values())
    for r in got:
        assert (r["rank"], r["dense_rank"], r["members"]) == brute_ranks(groups[r["g"]])[r["v"]]
        assert r["group_members"] == len(groups[r["g"]])


def test_percent_rank_of_a_single_member(frame):
    df = ranked_values(frame([("a", Decimal("1.00"))], "g string, v decimal(18,2)"), ["g"], "v")
    assert df.select(percent_rank_of()).first()[0] == 0.0


def test_previous_in_chain_matches_a_plain_lag(frame):
    rng = random.Random(3)
    start = date(2020, 1, 1)
    data = []
    for i in range(600):
        key = None if i % 97 == 0 else ("hot" if i % 3 else f"k{i % 11}")
        day = start + timedelta(rng.randint(0, 900))
        data.append((key, day, day + timedelta(rng.randint(0, 20)), i))
    df = frame(data, "k string, d date, e date, id int")
    got = {r["id"]: r["prev"] for r in previous_in_chain(df, ["k"], "d", "e", ["id"], "prev").collect()}
    assert len(got) == len(data)
    chains = defaultdict(list)
    for row in sorted(data, key=lambda r: (r[1], r[3])):
        chains[row[0]].append(row)
    for chain in chains.values():
        for before, now in zip([None, *chain], chain, strict=False):
            assert got[now[3]] == (before[2] if before else None)


def test_last_year_respects_gaps(frame, rows):
    months = [(1, date(2025, m, 1), m) for m in (1, 3)] + [(1, date(2026, m, 1), 10 * m) for m in (1, 2, 3)]
    got = rows(same_period_last_year(frame(months, "b int, month date, x int"), ["b"], "month", ["x"]), "month", "x_last_year")
    assert dict(got)[date(2026, 1, 1)] == 1
    assert dict(got)[date(2026, 2, 1)] is None
    assert dict(got)[date(2026, 3, 1)] == 3


def test_top_and_latest_period(frame, rows):
    df = frame([("a", 3, 1), ("a", 3, 2), ("a", 1, 3), ("b", 9, 4)], "g string, x int, id int")
    assert rows(top_per_group(df, ["g"], [F.col("x").desc(), F.col("id")], 2), "g", "id", "position") == [
        ("a", 1, 1), ("a", 2, 2), ("b", 4, 1)
    ]
    assert rows(latest_period(df, "x"), "g") == [("b",)]


# -- versions ----------------------------------------------------------------

NOW = datetime(2026, 3, 1)
LATER = datetime(2026, 4, 1)
TRACKED = ("city", "status")
STAGING = "client_id int, city string, status string, note string"


def first(frame, data):
    return ver.scd2_first_load(frame(data, STAGING), "client_id", TRACKED, NOW, "sk")


def merged(frame, data, existing, now=LATER):
    return ver.scd2_merge(frame(data, STAGING), existing, "client_id", TRACKED, now, "sk")


def by_change(df):
    out = defaultdict(list)
    for r in df.collect():
        out[r["change"]].append(r)
    return out


def test_scd2_new_changed_unchanged_and_missing(frame):
    old = first(frame, [(1, "Lyon", "A", "x"), (2, "Nice", "A", "x"), (3, "Brest", "A", "x")])
    got = by_change(merged(frame, [(1, "Paris", "A", "x"), (2, "Nice", "A", "changed note"), (4, "Lille", "B", "x")], old))
    assert [r["client_id"] for r in got["new"]] == [4]
    assert [r["client_id"] for r in got["changed"]] == [1] and got["changed"][0]["city"] == "Paris"
    closed = got["closed"][0]
    assert (closed["city"], closed["is_current"], closed["valid_to"]) == ("Lyon", False, LATER)
    assert sorted(r["client_id"] for r in got["unchanged"]) == [2, 3]
    assert {r["note"] for r in got["unchanged"]} == {"x"}


def test_scd2_null_is_not_blank_and_rerun_changes_nothing(frame):
    old = first(frame, [(1, None, "A", "x")])
    assert set(by_change(merged(frame, [(1, "", "A", "x")], old))) == {"changed", "closed"}
    assert set(by_change(merged(frame, [(1, None, "A", "x")], old))) == {"unchanged"}


def test_scd2_invariants_over_several_loads(frame):
    rng = random.Random(1)
    dim = first(frame, [(i, "c0", "A", "n") for i in range(20)])
    for step in range(1, 4):
        staged = [(i, f"c{rng.randint(0, 1)}", "A", "n") for i in range(25) if rng.random() < 0.8]
        dim = merged(frame, staged, dim, NOW + timedelta(30 * step)).drop("change")
        dim = frame([tuple(r) for r in dim.collect()], dim.schema)
    per_key = defaultdict(list)
    for r in dim.collect():
        per_key[r["client_id"]].append(r)
    for versions in per_key.values():
        assert sum(r["is_current"] for r in versions) == 1
        ordered = sorted(versions, key=lambda r: r["valid_from"])
        for a, b in zip(ordered, ordered[1:], strict=False):
            assert a["valid_to"] is not None and a["valid_to"] <= b["valid_from"]
    assert current_versions(dim, "client_id").count() == len(per_key)
    assert ver.as_of_versions(dim, NOW).count() == 20


def test_enrichment_and_golden_record(frame, rows):
    dim = frame([(1, True, None), (1, False, 9.0), (2, True, 5.0), (3, True, None)], "id int, is_current boolean, lat double")
    updates = frame([(1, 1.5, 0.9), (2, 7.0, 0.5), (3, 3.0, 0.49)], "id int, lat double, score double")
    got = rows(ver.enrich_current(dim, updates, "id", ["lat"], "score", 0.5), "id", "is_current", "lat")
    assert got == [(1, False, 9.0), (1, True, 1.5), (2, True, 7.0), (3, True, None)]

    a = frame([(1, None, "x")], "id int, name string, city string")
    b = frame([(1, "B", "y"), (2, "C", None)], "id int, name string, city string")
    golden = ver.golden_record({"manual": a, "erp": b}, ["manual", "erp", "register"], "id", ["name", "city"])
    assert rows(golden, "id", "name", "name_source", "city", "city_source") == [
        (1, "B", "erp", "x", "manual"), (2, "C", "erp", None, None)
    ]


# -- delta -------------------------------------------------------------------

STATE = "pipeline string, table_name string, last_success timestamp, last_status string, last_error string, run_count long, rows_ingested long"
UPDATE = "pipeline string, table_name string, ok boolean, high_mark timestamp, error string, rows long"


def test_watermark_success_and_failure(frame):
    state = frame([("p", "a", NOW, "success", None, 3, 100), ("p", "b", NOW, "success", None, 1, 5)], STATE)
    updates = frame(
        [("p", "a", True, LATER, None, 7), ("p", "b", False, None, "e" * 2000, 0), ("p", "c", False, None, "x", 0)], UPDATE
    )
    got = {r["table_name"]: r for r in delta.apply_watermark_updates(state, updates).collect()}
    assert (got["a"]["last_success"], got["a"]["run_count"], got["a"]["rows_ingested"]) == (LATER, 4, 107)
    assert (got["b"]["last_success"], got["b"]["last_status"], len(got["b"]["last_error"])) == (NOW, "failed", 2000)
    assert got["b"]["run_count"] == 1
    assert got["c"]["last_success"] == delta.EPOCH
    usable = {r["table_name"]: r["last_success"] for r in delta.usable_watermark(delta.apply_watermark_updates(state, updates)).collect()}
    assert usable["c"] is None and usable["a"] == LATER


def test_delta_and_since_and_runs(frame, rows):
    df = frame([(1, NOW), (2, LATER), (3, None)], "id int, t timestamp")
    assert rows(delta.delta_extract(df, "t", LATER), "id") == [(2,)]
    assert rows(delta.delta_extract(df, "t", LATER, include_null=True), "id") == [(2,), (3,)]
    state = frame([("p", "a", LATER, "success", None, 1, 1), ("p", "b", delta.EPOCH, "failed", "x", 0, 0)], STATE)
    fallbacks = frame([("p", "a", NOW), ("p", "b", NOW), ("p", "c", None)], "pipeline string, table_name string, fallback_since timestamp")
    since = dict(rows(delta.resolve_since(state, fallbacks, datetime(2024, 1, 1)), "table_name", "since"))
    assert since == {"a": LATER, "b": NOW, "c": datetime(2024, 1, 1)}
    runs = frame(
        [("gold_x", NOW, NOW + timedelta(seconds=2), 0, 1), ("gold_x", LATER, LATER, 2, 1), ("solo", NOW, NOW, 1, 0)],
        "pipeline string, started_at timestamp, ended_at timestamp, tables_processed int, error_count int",
    )
    last = delta.last_run_per_pipeline(delta.run_records(runs))
    assert rows(last, "pipeline", "layer", "status") == [("gold_x", "gold", "partial"), ("solo", "unknown", "success")]


# -- quality and privacy -------------------------------------------------------


def test_expectations(frame):
    df = frame([(1, "a", 5.0), (2, "b", None), (2, None, 50.0)], "id int, kind string, x double")
    rules = [
        Rule("exists", "id"), Rule("exists", "ghost"), Rule("not_null", "kind", 0.6), Rule("unique", "id"),
        Rule("between", "x", 0.5, {"min": 0, "max": 10}), Rule("in_set", "kind", 1.0, {"values": ["a"]}),
        Rule("row_count", args={"min": 4}),
    ]
    got = {r["rule"]: (r["observed"], r["passed"]) for r in quality.run_expectations(df, rules).collect()}
    assert got["exists:id"] == (1.0, True) and got["exists:ghost"] == (0.0, False)
    assert got["not_null:kind"] == (0.666667, True)
    assert got["unique:id"] == (0.333333, False)
    assert got["between:x"] == (0.5, True)
    assert got["in_set:kind"] == (0.5, False)
    assert got["row_count"] == (3.0, False)


def test_reconcile(frame):
    actual = frame([("2026-01", 100.4), ("2026-02", 101.0), ("2026-03", 5.0)], "m string, v double")
    expected = frame([("2026-01", 100.0), ("2026-02", 100.0), ("2026-04", 8.0)], "m string, v double")
    got = {r["m"]: (r["delta_pct"], r["status"]) for r in quality.reconcile(actual, expected, "m", "v").collect()}
    assert got == {"2026-01": (0.4, "PASS"), "2026-02": (1.0, "FAIL"), "2026-03": (None, "UNCALIBRATED"), "2026-04": (100.0, "FAIL")}


def test_schema_drift(frame):
    expected = frame(
        [("d", "t1", "a", False), ("d", "t2", "a", False), ("d", "t2", "b", True), ("d", "t3", "a", False), ("d", "t3", "b", False), ("d", "t4", "a", False)],
        "domain string, table_name string, column_name string, uncertain boolean",
    )
    actual = frame([("t1", "a"), ("t1", "z"), ("t2", "a"), ("t3", "a")], "table_name string, column_name string")
    got = {r["table_name"]: (r["status"], r["missing"], r["extra"]) for r in quality.schema_drift(expected, actual).collect()}
    assert got == {"t1": ("PASS", "", "z"), "t2": ("WARN", "", ""), "t3": ("FAIL", "b", ""), "t4": ("NOT_FOUND", "a", "")}


def test_copy_probe_and_observed_counts(frame, rows):
    a, b = frame([(1,)] * 100, "x int"), frame([(1,)] * 98, "x int")
    assert rows(quality.copy_integrity({"t": a}, {"t": b}), "integrity", "passed") == [(0.98, False)]
    assert rows(quality.table_probe({"a": a})) == [("a", 100, 1)]
    observed, seen = quality.observe_rows(frame([(1,), (None,)], "x int"), F.col("x") > 0)
    observed.collect()
    assert seen.get == {"processed": 2, "rejected": 1}


def test_privacy(frame, rows):
    df = frame([(1, "nir-1", "x"), (2, "", "y")], "id int, nir string, v string")
    with pytest.raises(ValueError):
        privacy.pseudonymize(df, {"nir": "nir_hash"}, "changeme")
    hashed = privacy.pseudonymize(df, {"nir": "nir_hash"}, "a-long-enough-salt")
    assert "nir" not in hashed.columns
    assert [r["nir_hash"] is None for r in hashed.orderBy("id").collect()] == [False, True]

    columns = frame(
        [("gold", "t", "per_nir"), ("gold", "t", "email"), ("gold", "t", "ca_net"), ("silver", "s", "nom"), ("silver", "s", "x")],
        "layer string, table_name string, column_name string",
    )
    audit = privacy.privacy_audit(columns)
    assert rows(audit, "column_name", "privacy_class") == [
        ("ca_net", "INTERNAL"), ("email", "PERSONAL"), ("nom", "PERSONAL"), ("per_nir", "SENSITIVE"), ("x", "PUBLIC")
    ]
    assert rows(privacy.audit_status(audit), "layer", "violations", "status") == [("gold", 2, "FAIL"), ("silver", 0, "PASS")]

    left = privacy.forget_subjects({"a": df, "b": df.select("v")}, frame([(1,)], "id int"), "id")
    assert left["a"].count() == 1 and left["b"].count() == 2
    grants = frame([("ann", 1)], "username string, id int")
    assert rows(privacy.secure_view(df, grants, "ann", "id", {"viewer": ["nir"]}, "viewer")) == [(1, "x")]
    assert privacy.secure_view(df, grants, "ann", "id", {"viewer": ["nir"]}, "intern").columns == ["id"]


def test_pii_profile(frame, rows):
    df = frame([("mail me: a.b@c.fr",), ("call +33 6 12 34 56 78",), (None,), ("10.0.0.1 up",), ("plain",)], "t string")
    got = privacy.pii_profile(df, ["t"]).first()
    assert (got["filled"], got["email_hits"], got["phone_hits"], got["ip_address_hits"]) == (4, 1, 1, 1)
