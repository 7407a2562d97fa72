import os
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.plans.registry import queries
from tallyhouse.streaming import alerts, changes, ingest, weekly

T0 = datetime(2026, 3, 2)  # a Monday
CHANGE = "worker_id long, contract_id long, op string, ts_ms long, v string"


@pytest.fixture
def folder(frame, tmp_path):
    """Writes each list of rows as one Parquet file of an input folder."""
    path = str(tmp_path / "in")

    def add(rows, schema):
        frame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        return path

    return add


def run(stream, spark, tmp_path, name="out"):
    target, mark = str(tmp_path / name), str(tmp_path / f"{name}-mark")
    query = (
        stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", mark)
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(target)


def test_ingest_takes_every_file_once(spark, folder, tmp_path, rows):
    schema = "id int, ts timestamp"
    path = folder([(1, T0), (2, T0 + timedelta(days=1))], schema)
    target, mark = str(tmp_path / "t"), str(tmp_path / "m")
    stream = lambda: ingest.file_stream(spark, path, spark.createDataFrame([], schema).schema, files_per_batch=1)
    for _ in range(2):
        ingest.run_to_end(ingest.ingest_files(stream(), target, mark, "ts"))
    assert spark.read.parquet(target).count() == 2
    folder([(3, T0)], schema)
    ingest.run_to_end(ingest.ingest_files(stream(), target, mark, "ts"))
    assert rows(spark.read.parquet(target), "id") == [(1,), (2,), (3,)]
    assert spark.read.parquet(target).select("load_date").distinct().count() == 2


def test_upsert_over_batches_and_replay(spark, folder, frame, tmp_path, rows):
    first = [(1, 1, "c", 1, "a"), (1, 1, "u", 3, "b"), (2, 1, "r", 1, "x"), (None, 1, "c", 1, "lost")]
    second = [(1, 1, "u", 2, "late"), (2, 1, "d", 5, None), (3, 1, "c", 1, "new"), (3, 1, "?", 9, "unknown")]
    path = folder(first, CHANGE)
    target, mark = str(tmp_path / "t"), str(tmp_path / "m")
    schema = spark.createDataFrame([], CHANGE).schema
    keys = ["worker_id", "contract_id"]

    def live():
        return rows(changes.live_rows(spark.read.parquet(target)), "worker_id", "v")

    stream = lambda: ingest.file_stream(spark, path, schema, files_per_batch=1)
    ingest.run_to_end(changes.cdc_upsert(stream(), target, mark, keys, buckets=4))
    assert live() == [(1, "b"), (2, "x")]
    folder(second, CHANGE)
    ingest.run_to_end(changes.cdc_upsert(stream(), target, mark, keys, buckets=4))
    assert live() == [(1, "b"), (3, "new")]
    changes.merge_changes(frame(second, CHANGE), target, keys, 4)  # the same batch again
    assert live() == [(1, "b"), (3, "new")]
    changes.merge_changes(frame([(2, 1, "u", 4, "older than its deletion")], CHANGE), target, keys, 4)
    assert live() == [(1, "b"), (3, "new")]


def test_missing_declarations_batch_and_stream(spark, folder, frame, tmp_path, rows):
    hour = timedelta(hours=1)
    starts = [(1, T0 + 10 * hour, 1), (1, T0 + 30 * hour, 2), (2, T0 + 10 * hour, 3), (3, T0 + 16 * hour, 4)]
    declared = [(1, T0 + 2 * hour), (1, T0 + 9 * hour), (2, T0 + 1 * hour), (3, T0 + 8 * hour), (9, T0 + 90 * hour)]
    start_schema, decl_schema = "w long, started_at timestamp, id int", "w long, declared_at timestamp"
    batch = alerts.missing_declarations(frame(starts, start_schema), frame(declared, decl_schema), "w")
    assert rows(batch, "id") == [(2,), (3,)]

    left = folder([*starts, (9, T0 + 90 * hour, 5)], start_schema)
    right = str(tmp_path / "decl")
    frame(declared, decl_schema).write.parquet(right)
    s = ingest.file_stream(spark, left, spark.createDataFrame([], start_schema).schema).withWatermark("started_at", "1 hour")
    d = ingest.file_stream(spark, right, spark.createDataFrame([], decl_schema).schema).withWatermark("declared_at", "1 hour")
    assert rows(run(alerts.missing_declarations(s, d, "w"), spark, tmp_path), "id") == [(2,), (3,)]


def test_weekly_hours_drop_late_rows(spark, folder, tmp_path, rows):
    schema = "b int, ts timestamp, h decimal(10,2)"
    day = timedelta(days=1)
    path = folder([(1, T0, Decimal(35)), (1, T0 + 6 * day, Decimal(7)), (1, T0 - day, Decimal(2))], schema)
    stream = lambda: weekly.weekly_hours(
        ingest.file_stream(spark, path, spark.createDataFrame([], schema).schema, files_per_batch=1), ["b"], "ts", "h"
    )
    run(stream(), spark, tmp_path)
    folder([(1, T0 + 9 * day, Decimal(1))], schema)
    run(stream(), spark, tmp_path)
    folder([(1, T0 + day, Decimal(100)), (1, T0 + 20 * day, Decimal(5))], schema)  # the first one is late
    got = run(stream(), spark, tmp_path)
    assert rows(got, "week", "hours", "sheets") == [
        ((T0 - 7 * day).date(), Decimal("2.00"), 1),
        (T0.date(), Decimal("42.00"), 2),
        ((T0 + 7 * day).date(), Decimal("1.00"), 1),
    ]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="sample tables not present")
@pytest.mark.parametrize("files_per_batch", [1, 1000])
def test_results_do_not_depend_on_files_and_batches(spark, tmp_path, rows, files_per_batch):
    """Newest file first, one or all of them at once: sums and alerts are those of all events in one table."""
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    folder = str(tmp_path / "events")
    for part in (3, 2, 1, 0):
        events.filter(F.dayofyear("ts") % 4 == part).coalesce(1).write.mode("append").parquet(folder)
    stream = lambda: ingest.file_stream(spark, folder, events.schema, files_per_batch=files_per_batch)
    target = str(tmp_path / "sums")
    ingest.run_to_end(weekly.run_weekly_hours(stream(), target, str(tmp_path / "m1"), ["user_id"], "ts", "value"))
    sums = weekly.weekly_sums(events, ["user_id"], "ts", "value")
    totals = weekly.weekly_totals(weekly.stored_sums(spark, target, sums.schema), ["user_id"])
    assert rows(totals) == rows(sums)
    stored = str(tmp_path / "stored")
    ingest.run_to_end(ingest.ingest_files(stream(), stored, str(tmp_path / "m2"), "ts"))

    def alerted(table):
        starts = table.filter("event_type = 'purchase'").selectExpr("user_id AS w", "ts AS started_at", "event_id")
        declared = table.filter("event_type = 'view'").selectExpr("user_id AS w", "ts AS declared_at")
        return rows(alerts.missing_declarations(starts, declared, "w"), "event_id")

    found = alerted(spark.read.parquet(stored))
    assert found == alerted(events) and found


def test_repeated_deliveries(spark, folder, tmp_path, rows):
    schema = "k int, ts timestamp"
    path = folder([(1, T0), (1, T0 + timedelta(seconds=2)), (2, T0)], schema)
    stream = ingest.file_stream(spark, path, spark.createDataFrame([], schema).schema)
    got = run(changes.deduplicated(stream, ["k"], "ts"), spark, tmp_path)
    assert rows(got.groupBy("k").agg(F.count(F.lit(1)))) == [(1, 1), (2, 1)]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="sample tables not present")
def test_event_stream_reads_a_table_of_many_files(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    assert queries()["stream_ingest"](spark, str(tmp_path)).count() == events.count() > 0
    assert queries()["cdc_upsert"](spark, str(tmp_path)).count() > 0
