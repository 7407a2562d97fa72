"""Alerts of a live stream, raised by timers and withdrawn by late declarations."""

from datetime import datetime, timedelta

from tallyhouse.streaming import ingest, live_alerts

T0 = datetime(2026, 3, 2)
SCHEMA = "w long, kind string, at timestamp, event_id long"


def test_alerts_are_withdrawn_when_the_declaration_comes_late(spark, tmp_path, frame, rows):
    hour, source = timedelta(hours=1), str(tmp_path / "live")
    target, mark = str(tmp_path / "log"), str(tmp_path / "mark")

    def deliver(*items):
        frame(list(items), SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = ingest.file_stream(spark, source, frame([], SCHEMA).schema, files_per_batch=1)
        starts = stream.filter("kind = 's'").selectExpr("w", "at AS started_at", "event_id")
        declared = stream.filter("kind = 'd'").selectExpr("w", "at AS declared_at")
        log = live_alerts.watch(live_alerts.events(starts, declared, "w"), hold_ms=1)
        live_alerts.run_until_quiet(live_alerts.start_watch(log, target, mark), hold_ms=1, patience=120)
        return spark.read.parquet(target)

    first = deliver((1, "s", T0 + 10 * hour, 1), (1, "s", T0 + 30 * hour, 2), (2, "s", T0 + 10 * hour, 3), (3, "d", T0 + 3 * hour, None))
    assert rows(live_alerts.standing(first), "event_id") == [(1,), (2,), (3,)]
    # a late declaration for 1, one too early for 2, a start within and one beyond eight hours of a declaration
    second = deliver((1, "d", T0 + 9 * hour, None), (2, "d", T0 + 1 * hour, None), (3, "s", T0 + 11 * hour, 4), (3, "s", T0 + 12 * hour, 5))
    assert rows(live_alerts.standing(second), "event_id") == [(2,), (3,), (5,)]
    assert rows(second.filter("change = 'withdrawn'"), "event_id") == [(1,)]
