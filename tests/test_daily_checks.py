"""Expectations from stored states, and facts joined in their buckets."""

import uuid
from datetime import date
from decimal import Decimal

from tallyhouse.operators import quality
from tallyhouse.operators.quality import Rule
from tallyhouse.plans.gold import assignments as asg
from tallyhouse.sources.writers import write_bucketed

RULES = [
    Rule("exists", "k"),
    Rule("exists", "absent"),
    Rule("not_null", "k"),
    Rule("not_null", "absent"),
    Rule("unique", "k", 0.6),
    Rule("between", "n", 0.5, {"min": 2}),
    Rule("length", "s", 0.0, {"value": 3}),
    Rule("in_set", "s", 0.9, {"values": ("abc", "x")}),
    Rule("row_count", args={"min": 3, "max": 7}),
]
SCHEMA = "k long, n int, s string"


def reported(df):
    return {r["rule"]: (r["observed"], r["threshold"], r["passed"]) for r in df.collect()}


def by_batches(batches):
    states = [quality.expectation_states(b, RULES) for b in batches]
    values = [quality.value_counts(b, RULES) for b in batches]
    every = [x[0] for x in (states, values)]
    for more in zip(states[1:], values[1:], strict=True):
        every = [a.unionByName(b) for a, b in zip(every, more, strict=True)]
    return reported(quality.report_from_states(*every, RULES))


def test_batches_give_the_report_of_the_whole(frame):
    rows = [(1, 1, "abc"), (2, 2, "x"), (2, None, None), (None, 5, "yyyy"), (3, 3, "abc"), (4, 0, ""), (1, 9, "abc")]
    whole = reported(quality.run_expectations(frame(rows, SCHEMA), RULES))
    for cuts in ((3,), (1, 4), (0, 7), (2, 2, 5)):
        edges = [0, *cuts, len(rows)]
        batches = [frame(rows[a:b], SCHEMA) for a, b in zip(edges, edges[1:], strict=False)]
        assert by_batches(batches) == whole
    assert whole["row_count"] == (7.0, 3.0, True) and not whole["unique:k"][2]


def test_report_of_nothing(frame):
    found = by_batches([frame([], SCHEMA)])
    assert found["row_count"] == (0.0, 3.0, False) and found["between:n"] == (1.0, 0.5, True)
    assert found["exists:absent"][2] is False and found["unique:k"] == (1.0, 0.6, True)


def test_facts_of_the_same_buckets_meet_without_a_shuffle(spark, frame):
    day, tag = date(2026, 1, 5), uuid.uuid4().hex
    assignments = [(i, i % 7, i % 3, 10, day) for i in range(300)]
    contracts = [(i, i % 7, Decimal(12), Decimal(15), 3) for i in range(0, 300, 2)]
    sheets = [(9000 + j, i, i % 7, Decimal(7), Decimal(8), Decimal(20)) for j, i in enumerate([*range(300), *range(50)])]
    tables = {
        f"a_{tag}": frame(assignments, "worker_id long, contract_id long, client_id long, branch_id long, start_date date"),
        f"c_{tag}": frame(contracts, "worker_id long, contract_id long, pay_rate decimal(10,4), bill_rate decimal(10,4), trade_id long"),
        f"s_{tag}": frame(
            sheets, "sheet_id long, worker_id long, contract_id long, paid decimal(12,2), billed decimal(12,2), rate decimal(10,4)"
        ),
    }
    for name, rows in tables.items():
        write_bucketed(rows, name, asg.KEY, 4)
    stored = [spark.table(name).hint("merge") for name in tables]
    facts = asg.contract_facts(*stored)
    plan = facts.hint("merge")._jdf.queryExecution().sparkPlan().toString()
    executed = facts._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.replace("BroadcastExchange", "") and "Exchange hashpartitioning" not in executed
    assert executed.count("SelectedBucketsCount: 4 out of 4") == 3
    found = {r["worker_id"]: (r["hours_paid"], r["pay_rate"]) for r in facts.collect()}
    assert len(found) == 300 and found[4] == (Decimal("14.00"), Decimal("12.0000")) and found[201] == (Decimal("7.00"), None)
