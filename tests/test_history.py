"""Histories from observations in any order."""

import itertools
from datetime import datetime, timedelta

import pytest

from tallyhouse.operators import history
from tallyhouse.plans import incremental_catalog as catalog

SCHEMA = "k long, at timestamp, a string, b int, seq long"
OBSERVED = [
    (1, datetime(2026, 1, 5), "A", 1, 1),
    (1, datetime(2026, 2, 5), "B", 1, 2),
    (1, datetime(2026, 2, 20), "A", 1, 3),
    (1, datetime(2026, 4, 1), "A", 1, 4),
    (1, datetime(2026, 4, 1), "C", 2, 3),  # an older row of the same instant
    (2, datetime(2026, 3, 1), None, None, 1),
    (2, datetime(2026, 3, 2), "", None, 1),
    (3, datetime(2026, 1, 1), "X", 0, 1),
    (3, datetime(2026, 1, 1), "X", 0, 1),
]
EXPECTED = [
    (1, "A", datetime(2026, 1, 5), datetime(2026, 2, 5)),
    (1, "A", datetime(2026, 2, 20), None),
    (1, "B", datetime(2026, 2, 5), datetime(2026, 2, 20)),
    (2, "", datetime(2026, 3, 2), None),
    (2, None, datetime(2026, 3, 1), datetime(2026, 3, 2)),
    (3, "X", datetime(2026, 1, 1), None),
]


def run(frame, loads):
    """Recorded history after loads of observations."""
    known, dim = None, None
    for number, load in enumerate(loads):
        fresh = frame([OBSERVED[i] for i in load], SCHEMA)
        known = history.merge_observations(known, fresh, "k", "at", [history.F.col("seq").desc()])
        believed = history.versions(known.join(fresh.select("k"), "k", "left_semi"), "k", "at", ["a", "b"])
        dim = history.record(dim, believed, "k", datetime(2027, 1, 1 + number))
        known, dim = frame(known.collect(), known.schema), frame(dim.collect(), dim.schema)
    return dim


def plain(df):
    found = [(r["k"], r["a"], r["valid_from"], r["valid_to"]) for r in df.collect()]
    return sorted(found, key=lambda r: (r[0], r[1] is None, r[1] or "", r[2]))


@pytest.mark.parametrize("order", list(itertools.permutations(range(3))))
def test_any_order_gives_the_same_history(frame, order):
    parts = [[0, 3, 5, 7], [1, 4, 8], [2, 6]]
    dim = run(frame, [parts[i] for i in order])
    assert plain(dim.filter("recorded_to IS NULL")) == EXPECTED


def test_a_late_state_splits_a_version_and_the_old_belief_stays(frame):
    dim = run(frame, [[0, 3], [1], [2]])
    first, second, third = (plain(history.believed_at(dim, datetime(2027, 1, d, 12))) for d in (1, 2, 3))
    assert first == [(1, "A", datetime(2026, 1, 5), None)]
    assert second == [
        (1, "A", datetime(2026, 1, 5), datetime(2026, 2, 5)),
        (1, "A", datetime(2026, 4, 1), None),
        (1, "B", datetime(2026, 2, 5), datetime(2026, 4, 1)),
    ]
    assert third == [r for r in EXPECTED if r[0] == 1]
    assert dim.filter("recorded_from >= recorded_to").count() == 0


def test_confirmed_versions_are_not_rewritten(frame):
    dim = run(frame, [[0, 1, 5, 7], [0, 1, 8], [6]])
    kept = {(r["k"], r["valid_from"]): r["recorded_from"] for r in dim.filter("recorded_to IS NULL").collect()}
    assert kept[1, datetime(2026, 1, 5)] == kept[3, datetime(2026, 1, 1)] == datetime(2027, 1, 1)
    assert kept[2, datetime(2026, 3, 2)] == datetime(2027, 1, 3)


def test_versions_are_computed_once_per_load(spark, frame, tmp_path, monkeypatch):
    day = datetime(1996, 1, 1)
    orders = [(i, i % 5, "OFP"[i % 3], 1.0, day + timedelta(days=i * 7 % 60), f"{i % 2}-X") for i in range(60)]
    orders = frame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                           "o_orderdate timestamp_ntz, o_orderpriority string")  # fmt: skip
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    plans, stored = [], catalog.stored

    def noted(df, name):
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return stored(df, name)

    monkeypatch.setattr(catalog, "stored", noted)
    found = catalog.Incremental(spark, str(tmp_path)).late_history
    assert found.select("client_id").distinct().count() == 5
    recorded = [plan for name, plan in plans if name == "recorded"]
    assert len(recorded) == 3 and not any("Window" in plan for plan in recorded)
