"""Additive states stored by month."""

from contextlib import contextmanager
from datetime import date
from decimal import Decimal

import pytest

from tallyhouse.operators.additive import add_change, signed_change
from tallyhouse.sources import states
from tallyhouse.sources.scratch import fresh_path

SCHEMA = "k int, month date, n long, amount decimal(12,2)"
KEYS, SUMS = ("k", "month"), ("n", "amount")


def rows_of(*items):
    return [(k, month and date.fromisoformat(month + "-01"), n, Decimal(amount)) for k, month, n, amount in items]


def files(spark, path):
    found = {}
    for row in spark.read.parquet(path).select("part", "_metadata.file_path").distinct().collect():
        found.setdefault(row[0], set()).add(row[1])
    return found


def test_change_and_sum(frame, rows):
    before = frame(rows_of((1, "2026-01", 2, 10), (2, "2026-01", 1, 5), (None, None, 1, 1)), SCHEMA)
    after = frame(rows_of((1, "2026-01", 2, 10), (2, "2026-02", 1, 5), (None, None, 3, 1)), SCHEMA)
    change = signed_change(before, after, KEYS, SUMS)
    assert [(r[0], r[2], int(r[3])) for r in rows(change)] == [(2, -1, -5), (2, 1, 5), (None, 2, 0)]
    assert rows(add_change(before, change, KEYS, SUMS)) == rows(after)
    assert change.schema["amount"].dataType == before.schema["amount"].dataType


@pytest.fixture
def state(spark, frame):
    kept = states.MonthlyState(fresh_path(spark, "state"), KEYS, SUMS)
    kept.rebuild(frame(rows_of((1, "2026-01", 2, 10), (2, "2026-02", 1, 5), (3, "2026-03", 1, 7), (4, None, 1, 1)), SCHEMA), 1)
    return kept


def test_only_changed_months_are_written(spark, frame, rows, state):
    before = files(spark, state.path)
    change = frame(rows_of((1, "2026-01", 1, 2), (9, "2026-05", 1, 1)), SCHEMA)
    assert state.apply(change, 2) == ["m2026-01", "m2026-05"]
    after = files(spark, state.path)
    assert {p for p in after if after[p] != before.get(p)} == {"m2026-01", "m2026-05"}
    assert [(r[0], r[2], int(r[3])) for r in rows(state.read(spark, change.schema))] == [
        (1, 3, 12), (2, 1, 5), (3, 1, 7), (4, 1, 1), (9, 1, 1)
    ]


def test_a_repeated_load_adds_nothing(spark, frame, rows, state):
    change = frame(rows_of((1, "2026-01", 1, 2), (3, "2026-03", -1, -7)), SCHEMA)
    assert state.apply(change, 2) == ["m2026-01", "m2026-03"]
    once = rows(state.read(spark, change.schema))
    assert state.apply(change, 2) == []  # March is empty now, and knows of the load
    assert rows(state.read(spark, change.schema)) == once and {r[0] for r in once} == {1, 2, 4}
    assert state.apply(frame([], SCHEMA), 3) == []
    assert state.apply(frame(rows_of((3, "2026-03", 1, 7)), SCHEMA), 3) == ["m2026-03"]
    assert {r[0] for r in rows(state.read(spark, change.schema))} == {1, 2, 3, 4}


def test_plan_reads_only_touched_months(spark, frame, state, monkeypatch):
    plans = []
    write = states.overwrite_partitions
    monkeypatch.setattr(
        states, "overwrite_partitions", lambda df, *a, **k: (plans.append(df._jdf.queryExecution().toString()), write(df, *a, **k))
    )
    state.apply(frame(rows_of((1, "2026-01", 1, 2)), SCHEMA), 2)
    assert "PartitionFilters: [" in plans[0] and "m2026-01" in plans[0] and "m2026-02" not in plans[0]


def test_a_repeated_load_leaves_its_months_out_before_they_are_summed(spark, frame, state, monkeypatch):
    before, after = (frame(rows_of((1, "2026-01", n, 10), (2, "2026-02", n, 5)), SCHEMA) for n in (1, 2))
    assert state.apply(signed_change(before, after, KEYS, SUMS), 2) == ["m2026-01", "m2026-02"]
    staged, staging = [], states.staging

    @contextmanager
    def noted(spark):
        with staging(spark) as stage:
            yield lambda df, name: (staged.append(df._jdf.queryExecution().optimizedPlan().toString()), stage(df, name))[1]

    monkeypatch.setattr(states, "staging", noted)
    assert state.apply(signed_change(before, after, KEYS, SUMS), 2) == []
    # the months are named in a filter below the sum
    assert "m2026-01" in staged[0].split("Aggregate", 1)[1] if "Aggregate" in staged[0] else "LocalRelation <empty>" in staged[0]


def test_distinct_counts_roll_up(frame, rows):
    from tallyhouse.operators import bitmaps

    seen = [(b, date(2026, 1 + d % 3, 1 + d % 28), f"w{w}") for b in (1, None) for d in range(60) for w in (d % 7, d % 5, 40 + d)]
    seen += [(1, None, "w1"), (1, date(2026, 1, 1), None)] + [(2, date(2026, 1, 1), "w0")] * 50
    table = frame(seen, "b int, d date, w string")
    first, second = table.filter("dayofmonth(d) < 9"), table.filter("d IS NULL OR dayofmonth(d) >= 9")
    numbers = bitmaps.numbered(first, "w").cache()
    later = bitmaps.new_numbers(numbers, second, "w").cache()
    assert later.count() > 0 and later.join(numbers, "w").count() == 0
    every = numbers.unionByName(later).cache()
    assert every.select(bitmaps.NUMBER).distinct().count() == every.count() == len({w for _, d, w in seen if w})
    daily = bitmaps.merge_days(
        bitmaps.daily_bitmaps(first, numbers, ["b"], "d", "w"), bitmaps.daily_bitmaps(table, every, ["b"], "d", "w"), ["b"]
    )
    found = {(r["b"], r["grain"], r["period"]): r["n"] for r in bitmaps.rolled_up(daily, ["b"], "n", ("day", "month", "year")).collect()}
    expected = {}
    for b, d, w in seen:
        if d and w:
            for grain, period in (("day", d), ("month", d.replace(day=1)), ("year", date(2026, 1, 1))):
                expected.setdefault((b, grain, period), set()).add(w)
    assert found == {k: len(v) for k, v in expected.items()}
