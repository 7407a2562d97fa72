"""Partitioned tables: what a merge writes, and what it leaves alone."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallyhouse.sources import erasure
from tallyhouse.sources import partitioned as tables
from tallyhouse.sources.scratch import discard, fresh_path, shared_folder, staging

SCHEMA = "id long, day date, value string, _loaded_at timestamp"


def load(frame, *rows, hour=1):
    return frame([(i, day and date.fromisoformat(day), value, datetime(2026, 1, 1, hour)) for i, day, value in rows], SCHEMA)


def files(spark, path):
    """Data files by partition."""
    found = {}
    for row in spark.read.parquet(path).select(tables.PART, "_metadata.file_path").distinct().collect():
        found.setdefault(row[0], set()).add(row[1])
    return found


def content(spark, path):
    found = tables.read_partitioned(spark, path).select("id", "value", tables.PART).collect()
    return sorted((r["id"], r["value"], r[tables.PART]) for r in found)


def index(spark, path):
    return sorted({(r["id"], r[tables.PART]) for r in spark.read.parquet(tables.index_path(path)).collect()})


@pytest.fixture
def stored(spark, frame):
    path = fresh_path(spark, "cut")
    rows = [(i, f"2026-{i % 6 + 1:02d}-05", f"v{i}") for i in range(60)]
    tables.merge_partitions(load(frame, *rows), path, ["id"], tables.by_month("day"))
    return path


def test_one_key_rewrites_one_partition(spark, frame, stored):
    before = files(spark, stored)
    done = tables.merge_partitions(load(frame, (7, "2026-02-09", "new"), hour=2), stored, ["id"], tables.by_month("day"))
    after = files(spark, stored)
    assert done.rewritten == ["m2026-02"] and {p for p in after if after[p] != before[p]} == {"m2026-02"}
    assert (7, "new", "m2026-02") in content(spark, stored) and len(content(spark, stored)) == 60


def test_a_key_that_moves_leaves_its_old_partition(spark, frame, stored):
    before = files(spark, stored)
    done = tables.merge_partitions(load(frame, (7, "2026-09-09", "moved"), hour=2), stored, ["id"], tables.by_month("day"))
    after = files(spark, stored)
    assert done.rewritten == ["m2026-02", "m2026-09"]
    assert {p for p in after if after[p] != before.get(p)} == {"m2026-02", "m2026-09"}
    assert [row for row in content(spark, stored) if row[0] == 7] == [(7, "moved", "m2026-09")]
    assert [pair for pair in index(spark, stored) if pair[0] == 7] == [(7, "m2026-09")]


def test_an_emptied_partition_is_empty(spark, frame, stored):
    rows = [(i, "2026-12-01", "z") for i in range(0, 60, 6)]  # all of January
    done = tables.merge_partitions(load(frame, *rows, hour=2), stored, ["id"], tables.by_month("day"))
    assert done.emptied == ["m2026-01"] and len(content(spark, stored)) == 60
    assert {p for _, _, p in content(spark, stored)} == {f"m2026-{m:02d}" for m in (2, 3, 4, 5, 6, 12)}
    # and can be filled again
    tables.merge_partitions(load(frame, (0, "2026-01-02", "back"), hour=3), stored, ["id"], tables.by_month("day"))
    assert (0, "back", "m2026-01") in content(spark, stored)


def test_stale_null_and_repeated_rows(spark, frame, stored):
    before = content(spark, stored)
    older = frame([(7, date(2026, 8, 1), "old", datetime(2025, 1, 1)), (None, None, "no key", datetime(2027, 1, 1))], SCHEMA)
    tables.merge_partitions(older, stored, ["id"], tables.by_month("day"))
    assert content(spark, stored) == before
    twice = load(frame, (99, None, "a"), (99, None, "a"), hour=2)
    for _ in range(2):
        tables.merge_partitions(twice, stored, ["id"], tables.by_month("day"))
    assert content(spark, stored) == sorted([*before, (99, "a", "m-none")])
    empty = load(frame)
    assert tables.merge_partitions(empty, stored, ["id"], tables.by_month("day")).rewritten == []


def test_gone_and_replaced_keys(spark, frame, stored):
    gone = frame([(3,), (4,), (1000,)], "id long")
    fresh = frame([(4, date(2026, 5, 5), "again", datetime(2020, 1, 1))], SCHEMA)  # replaces, however old
    done = tables.merge_partitions(fresh, stored, ["id"], tables.by_month("day"), gone=gone)
    assert done.rewritten == ["m2026-04", "m2026-05"]
    kept = {i: value for i, value, _ in content(spark, stored)}
    assert 3 not in kept and kept[4] == "again" and len(kept) == 59
    assert 3 not in {i for i, _ in index(spark, stored)}


def test_broken_merge_is_repaired_by_the_next_run(spark, frame, stored, monkeypatch):
    fresh = load(frame, (7, "2026-09-09", "moved"), hour=2)

    def fail(*args, **options):
        raise OSError("lost")

    write = tables.overwrite_partitions
    monkeypatch.setattr(tables, "overwrite_partitions", fail)
    with pytest.raises(OSError):
        tables.merge_partitions(fresh, stored, ["id"], tables.by_month("day"))
    assert [row for row in content(spark, stored) if row[0] == 7] == [(7, "v7", "m2026-02")]
    monkeypatch.setattr(tables, "overwrite_partitions", write)
    tables.merge_partitions(fresh, stored, ["id"], tables.by_month("day"))
    assert [row for row in content(spark, stored) if row[0] == 7] == [(7, "moved", "m2026-09")]


def test_layout_by_key_needs_no_index(spark, frame):
    path, layout = fresh_path(spark, "cut"), tables.by_key(["id"], 8)
    tables.merge_partitions(load(frame, *[(i, None, "a") for i in range(100)]), path, ["id"], layout)
    before = files(spark, path)
    done = tables.merge_partitions(load(frame, (5, None, "b"), hour=2), path, ["id"], layout, gone=frame([(6,)], "id long"))
    after = files(spark, path)
    assert {p for p in after if after[p] != before[p]} == set(done.rewritten) and len(done.rewritten) <= 2
    kept = {i: value for i, value, _ in content(spark, path)}
    assert kept[5] == "b" and 6 not in kept and len(kept) == 99
    assert tables.read_partitioned(spark, tables.index_path(path)) is None


def test_pushed_partition_filter(spark, stored):
    plan = tables.read_partitioned(spark, stored).filter(F.col(tables.PART) == "m2026-02")
    assert "PartitionFilters: [isnotnull(part" in plan._jdf.queryExecution().executedPlan().toString()


def test_staged_tables_are_deleted(spark, frame):
    with staging(spark) as stage:
        kept = stage(frame([(1,)], "a int"), "probe")
        path = kept.inputFiles()[0].rsplit("/", 1)[0]
        assert kept.count() == 1
    assert tables.read_or_none(lambda: spark.read.parquet(path)) is None
    with pytest.raises(ValueError):
        discard(spark, "/elsewhere")
    assert shared_folder(spark)


def test_erasure_touches_only_partitions_that_hold_a_subject(spark, frame):
    path = fresh_path(spark, "subjects")
    layout = tables.by_month("day", bloom=["value"])
    rows = [(i, f"2026-{i % 6 + 1:02d}-05", f"v{i % 30}") for i in range(600)] + [(1000, "2026-02-01", None)]
    tables.merge_partitions(load(frame, *rows), path, ["id"], layout)
    table = erasure.SubjectTable(path, ["id"], layout, "value")
    asked = frame([("v7",), ("v13",), (None,), ("nobody",)], "value string")  # v7 and v13 are in months 2 only
    before = files(spark, path)
    done = erasure.erase_subjects(spark, [table], asked)
    after = files(spark, path)
    assert done[path].rewritten == ["m2026-02"] and {p for p in after if after[p] != before[p]} == {"m2026-02"}
    left = content(spark, path)
    assert len(left) == 601 - 40 and not {v for _, v, _ in left} & {"v7", "v13"}
    assert {i for i, _ in index(spark, path)} == {i for i, _, _ in left}
    assert erasure.erase_subjects(spark, [table], asked)[path].rewritten == []


def test_erasure_of_many_subjects_and_of_a_whole_partition(spark, frame, monkeypatch):
    monkeypatch.setattr(erasure, "LISTED_SUBJECTS", 2)
    path, layout = fresh_path(spark, "subjects"), tables.by_key(["id"], 4)
    tables.merge_partitions(load(frame, *[(i, None, f"v{i % 5}") for i in range(100)]), path, ["id"], layout)
    table = erasure.SubjectTable(path, ["id"], layout, "value")
    erasure.erase_subjects(spark, [table], frame([(f"v{i}",) for i in range(4)], "value string"))
    assert {v for _, v, _ in content(spark, path)} == {"v4"}
    done = erasure.erase_subjects(spark, [table], frame([("v4",)], "value string"))
    assert len(done[path].emptied) == 4 and tables.read_partitioned(spark, path) is None
    assert erasure.erase_subjects(spark, [table], frame([("v4",)], "value string"))[path].rewritten == []
    # rows without a key can't be erased by it
    bad = fresh_path(spark, "subjects")
    load(frame, (None, None, "v1"), (2, None, "v2")).withColumn("part", F.lit("k0001")).write.partitionBy("part").parquet(bad)
    with pytest.raises(erasure.ErasureIncomplete):
        erasure.erase_subjects(spark, [erasure.SubjectTable(bad, ["id"], layout, "value")], frame([("v1",)], "value string"))


def written_plans(monkeypatch):
    """Optimized plans of what a merge writes to its table."""
    plans, write = [], tables.overwrite_partitions

    def noted(df, *args, **options):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        write(df, *args, **options)

    monkeypatch.setattr(tables, "overwrite_partitions", noted)
    return plans


def test_merge_by_key_gathers_once(spark, frame, monkeypatch):
    path, layout = fresh_path(spark, "cut"), tables.by_key(["id"], 4)
    old = [(1, "a", 2), (2, "b", 2), (3, "c", 2), (4, "d", 2), (5, None, 2), (5, None, 2), (6, "f", 1), (6, "g", 1)]
    new = [(1, "stale", 1), (2, "new", 3), (3, "old again", 1), (7, "x", 1), (7, "y", 2), (7, "y", 2), (8, None, 1), (None, "no key", 9)]
    first, second = ([(i, None, v, datetime(2026, 1, 1, h)) for i, v, h in some] for some in (old, new))
    plans = written_plans(monkeypatch)
    tables.merge_partitions(frame(first, SCHEMA), path, ["id"], layout)
    gone = frame([(3,), (4,), (4,), (99,), (None,)], "id long")
    tables.merge_partitions(frame(second, SCHEMA), path, ["id"], layout, gone=gone)
    assert [(i, v) for i, v, _ in sorted(content(spark, path), key=lambda r: r[0])] == [
        (1, "a"), (2, "new"), (3, "old again"), (5, None), (6, "f"), (7, "y"), (8, None)
    ]
    # stored rows and load meet in one shuffle, and no join follows
    assert len(plans) == 2 and all(plan.count("RepartitionByExpression") == 1 and "Join" not in plan for plan in plans)
    places = tables.read_partitioned(spark, path)
    assert places.filter(F.col(tables.PART) != layout.part()).isEmpty()


def test_rows_of_keys_that_only_go_are_not_compared(spark, frame, stored, monkeypatch):
    plans = written_plans(monkeypatch)
    gone = frame([(i,) for i in range(0, 60, 6)] + [(7,)], "id long")  # all of January and one of February
    done = tables.merge_partitions(load(frame), stored, ["id"], tables.by_month("day"), lambda rows: rows, gone=gone)
    assert done.rewritten == ["m2026-02"] and done.emptied == ["m2026-01"]
    kept = {i for i, _, _ in content(spark, stored)}
    assert kept == {i for i in range(60) if i % 6 and i != 7} == {i for i, _ in index(spark, stored)}
    # the kept rows come from one join, and none from the keys that go
    assert plans[0].count("Join LeftAnti") == 1 and "Union" not in plans[0] and "LeftSemi" not in plans[0]


def test_replaced_rows_are_gathered_once(spark, frame, stored, monkeypatch):
    plans = written_plans(monkeypatch)
    # 7 moves, 13 stays in its month, 19 only goes, 500 is new; 20 stands beside them
    fresh = load(frame, (7, "2026-09-09", "moved"), (13, "2026-02-11", "again"), (500, None, "new"), (None, None, "no key"), hour=0)
    gone = frame([(7,), (13,), (19,), (19,), (500,), (None,)], "id long")
    done = tables.merge_partitions(fresh, stored, ["id"], tables.by_month("day"), gone=gone, unique=True, staged=True)
    assert done.rewritten == ["m-none", "m2026-02", "m2026-09"]
    kept = {i: (value, part) for i, value, part in content(spark, stored)}
    assert len(content(spark, stored)) == len(kept) == 60 and 19 not in kept and kept[20] == ("v20", "m2026-03")
    assert [kept[i] for i in (7, 13, 500)] == [("moved", "m2026-09"), ("again", "m2026-02"), ("new", "m-none")]
    assert index(spark, stored) == sorted((i, part) for i, (_, part) in kept.items())
    assert plans[0].count("RepartitionByExpression") == 1 and "Join" not in plans[0]


def test_fresh_keys_beside_the_gone_ones_are_compared(spark, frame, stored):
    fresh = load(frame, (7, "2026-09-09", "stale"), (8, "2026-09-09", "replaced"), hour=0)
    tables.merge_partitions(fresh, stored, ["id"], tables.by_month("day"), gone=frame([(8,)], "id long"), unique=True)
    kept = {i: value for i, value, _ in content(spark, stored)}
    assert kept[7] == "v7" and kept[8] == "replaced" and len(kept) == 60


def test_resolved_rows_of_a_key_layout_are_gathered_without_a_join(spark, frame, monkeypatch):
    path, layout = fresh_path(spark, "cut"), tables.by_key(["id"], 4)

    def longest(rows):
        return rows.groupBy("id").agg(F.max("day").alias("day"), F.max("value").alias("value"), F.max("_loaded_at").alias("_loaded_at"))

    tables.merge_partitions(load(frame, *[(i, None, "m") for i in range(20)]), path, ["id"], layout, longest)
    plans = written_plans(monkeypatch)
    tables.merge_partitions(load(frame, (3, None, "a"), (3, None, "z"), (4, None, "a"), (None, None, "no key")), path, ["id"], layout, longest)
    kept = {i: value for i, value, _ in content(spark, path)}
    assert len(content(spark, path)) == len(kept) == 20 and kept[3] == "z" and kept[4] == "m" and "Join" not in plans[0]


def test_a_first_load_of_unique_keys_is_not_ranked(spark, frame, monkeypatch):
    plans = written_plans(monkeypatch)
    for layout in (tables.by_month("day"), tables.by_key(["id"], 4)):
        path = fresh_path(spark, "cut")
        tables.merge_partitions(load(frame, (1, "2026-01-05", "a"), (2, None, "b"), (None, None, "c")), path, ["id"], layout, unique=True)
        assert [(i, v) for i, v, _ in content(spark, path)] == [(1, "a"), (2, "b")]
    assert len(plans) == 2 and not any("Window" in plan for plan in plans)
