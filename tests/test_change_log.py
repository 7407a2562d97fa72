"""Folded batch partitions and the change log."""

from datetime import date
from decimal import Decimal

import pytest

from tallyhouse.sources.scratch import fresh_path
from tallyhouse.streaming import change_log, spans, weekly

CHANGE = "worker_id long, contract_id int, op string, ts_ms long, v string"
KEYS = ["worker_id", "contract_id"]
SUMS = "b int, week date, hours decimal(18,2), sheets long"


def sums(frame, number):
    return frame([(b, date(2026, 1, 5), Decimal(number), 1) for b in (1, number % 3)][: 1 + (number % 2)], SUMS)


def test_names_and_covered_spans():
    names = [spans.span_name(a, b) for a, b in ((0, 8), (0, 2), (3, 3), (9, 9), (9, 11), (12, 12))]
    assert spans.uncovered(names) == [spans.span_name(0, 8), spans.span_name(9, 11), spans.span_name(12, 12)]


def test_sums_stay_few_and_exact(spark, frame, rows):
    path, schema = fresh_path(spark, "sums"), frame([], SUMS).schema
    for number in range(40):
        weekly.store_sums(sums(frame, number), path, number, schema, ["b"], fan=3)
        if number in (3, 27, 30):  # a batch that is run again
            weekly.store_sums(sums(frame, number), path, number, schema, ["b"], fan=3)
    names = spans.span_names(spark, path)
    assert len(names) <= 3 * 4 and spans.span_name(0, 26) in names
    everything = frame([tuple(r) for n in range(40) for r in sums(frame, n).collect()], SUMS)
    expected = rows(weekly.weekly_totals(everything, ["b"]))
    assert rows(weekly.weekly_totals(weekly.stored_sums(spark, path, schema), ["b"])) == expected


def test_broken_fold(spark, frame, rows, monkeypatch):
    path, schema = fresh_path(spark, "sums"), frame([], SUMS).schema
    for number in range(3):
        spans.write_batch(sums(frame, number), path, number)
    before = rows(weekly.weekly_totals(weekly.stored_sums(spark, path, schema), ["b"]))
    drop = spans.drop_spans
    monkeypatch.setattr(spans, "drop_spans", lambda *_: None)  # the fold ends before it deletes
    assert spans.fold_batches(spark, path, schema, 3, lambda r: weekly.weekly_totals(r, ["b"]), 3) == [spans.span_name(0, 2)]
    assert len(spans.span_names(spark, path)) == 4
    assert rows(weekly.weekly_totals(weekly.stored_sums(spark, path, schema), ["b"])) == before
    monkeypatch.setattr(spans, "drop_spans", drop)
    spans.fold_batches(spark, path, schema, 3, lambda r: weekly.weekly_totals(r, ["b"]), 3)
    assert spans.span_names(spark, path) == [spans.span_name(0, 2)]


BATCHES = [
    [(1, 1, "c", 1, "a"), (2, 1, "c", 1, "x"), (3, 1, "r", 1, "y"), (None, 1, "c", 9, "no key")],
    [(1, 1, "u", 5, "b"), (2, 1, "d", 6, None), (4, 1, "c", 2, "z"), (4, 1, "x", 99, "unknown kind")],
    [(2, 1, "u", 4, "older than its deletion"), (3, 1, "u", 1, "tie"), (4, 1, "u", 3, "zz"), (4, 1, "u", 3, "zz")],
]


@pytest.mark.parametrize("folds", [(), (0,), (1,), (0, 1, 2), (2,)])
def test_reads_are_the_same_whatever_was_folded(spark, frame, rows, folds):
    path, schema = fresh_path(spark, "log"), frame([], CHANGE).schema
    for number, batch in enumerate(BATCHES):
        change_log.append_changes(frame(batch, CHANGE), path, KEYS, number)
        if number in folds:
            change_log.fold_changes(spark, path, schema, KEYS, buckets=4)
    expected = [(1, 1, "b"), (3, 1, "y"), (4, 1, "zz")]
    assert rows(change_log.current_rows(spark, path, schema, KEYS), "worker_id", "contract_id", "v") == expected
    change_log.append_changes(frame(BATCHES[1], CHANGE), path, KEYS, 1)  # a replay, perhaps after its fold
    assert rows(change_log.current_rows(spark, path, schema, KEYS), "worker_id", "contract_id", "v") == expected


def test_a_batch_writes_its_own_rows_and_a_fold_its_buckets(spark, frame):
    path, schema = fresh_path(spark, "log"), frame([], CHANGE).schema
    change_log.append_changes(frame([(i, 1, "c", 1, "a") for i in range(200)], CHANGE), path, KEYS, 0)
    assert change_log.fold_changes(spark, path, schema, KEYS, buckets=8) == list(range(8))
    base = set(spark.read.parquet(f"{path}/base").inputFiles())
    change_log.append_changes(frame([(7, 1, "u", 2, "b")], CHANGE), path, KEYS, 1)
    assert set(spark.read.parquet(f"{path}/base").inputFiles()) == base
    assert spark.read.parquet(f"{path}/changes").count() == 1
    touched = change_log.fold_changes(spark, path, schema, KEYS, buckets=8)
    after = set(spark.read.parquet(f"{path}/base").inputFiles())
    assert len(touched) == 1 and all(f"/bucket={touched[0]}/" in f for f in base ^ after)
    assert spans.span_names(spark, f"{path}/changes") == []
    assert change_log.current_rows(spark, path, schema, KEYS).count() == 200
    assert change_log.fold_changes(spark, path, schema, KEYS, buckets=8) == []
