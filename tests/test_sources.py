import json
from datetime import date

import pytest
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tallyhouse.sources import readers, scratch, writers
from tallyhouse.sources.schemas import column_list, raw_schema

SCHEMA = StructType([StructField("id", IntegerType()), StructField("v", StringType())])


def test_raw_days_history_and_missing(frame, spark, tmp_path, rows):
    root = str(tmp_path)
    schema = StructType.fromDDL("id int, v string, _loaded_at string, _batch_id string, _source_table string")
    for day, batch in ((date(2026, 3, 1), "b1"), (date(2026, 3, 2), "b2")):
        writers.write_raw(frame([(day.day, "x")], "id int, v string"), root, "wtx", day, batch, f"{day} 05:00:00")
    one = readers.read_raw(spark, root, "wtx", schema, date(2026, 3, 2))
    assert rows(one, "id", "_batch_id", "_source_table") == [(2, "b2", "wtx")]
    assert readers.probe(one) == (1, 5)
    assert readers.read_raw(spark, root, "wtx", schema, date(2026, 3, 3), days_back=5).count() == 2
    assert readers.read_raw(spark, root, "wtx", schema).count() == 2
    assert readers.read_raw(spark, root, "none", schema).count() == 0
    writers.write_raw(frame([(9, "y")], "id int, v string"), root, "wtx", date(2026, 3, 2), "b3", "z")
    assert rows(readers.read_raw(spark, root, "wtx", schema, date(2026, 3, 2)), "id") == [(9,)]
    days = readers.load_partitions(readers.read_raw(spark, root, "wtx", schema))
    assert rows(days, "load_date", "row_count") == [("2026/03/01", 1), ("2026/03/02", 1)]


def test_rejects(spark, tmp_path, rows):
    (tmp_path / "in").mkdir()
    lines = [json.dumps({"id": 1, "v": "a"}), '{"id": 2, "v": ', "", json.dumps({"id": 3})]
    (tmp_path / "in" / "part.json").write_text("\n".join(lines))
    good, bad = readers.read_tolerant(spark, str(tmp_path / "in"), SCHEMA)
    assert rows(good) == [(1, "a"), (3, None)]
    assert rows(bad) == [('{"id": 2, "v": ',)]


def test_delimited_reference(spark, tmp_path, rows):
    path = tmp_path / "ref.csv"
    path.write_bytes("﻿MOIS;Ca_Net_HT\n2026-01;10.5\n2026-02;oops\n".encode())
    got = readers.read_delimited(spark, str(path), StructType.fromDDL("mois string, ca_net_ht double"))
    assert rows(got) == [("2026-01", 10.5), ("2026-02", None)]


def test_overwrite_merge_and_partitions(spark, frame, tmp_path, rows):
    path = str(tmp_path / "t")
    writers.overwrite_table(frame([(1, "a", "1"), (2, "b", "1")], "id int, v string, _loaded_at string"), path)
    writers.upsert_table(readers.read_table(spark, path), frame([(2, "c", "2")], "id int, v string, _loaded_at string"), ["id"], path)
    assert rows(readers.read_table(spark, path), "id", "v") == [(1, "a"), (2, "c")]
    assert not writers.overwrite_unless_empty(spark.createDataFrame([], SCHEMA), path)
    assert readers.read_table(spark, path).count() == 2

    dated = str(tmp_path / "d")
    writers.write_by_month(frame([(1, date(2026, 1, 5)), (2, date(2026, 2, 5))], "id int, d date"), dated, "d")
    writers.write_by_month(frame([(3, date(2026, 2, 6)), (4, date(2026, 2, 7))], "id int, d date"), dated, "d", spread=2)
    assert rows(readers.read_table(spark, dated), "id") == [(1,), (3,), (4,)]
    assert readers.read_optional_table(spark, str(tmp_path / "nothing"), SCHEMA).count() == 0


def test_checked_append(frame, spark, tmp_path):
    path = str(tmp_path / "a")
    df = frame([(1, "a"), (2, "b")], "id int, v string")
    assert writers.append_checked(df, path, dry_run=True)["added_rows"] == 0
    assert writers.append_checked(df, path) == {"source_rows": 2, "added_rows": 2}
    assert writers.append_checked(df, path)["added_rows"] == 2
    with pytest.raises(writers.CopyIncomplete):
        writers.append_checked(df, path, threshold=1.5)


def test_child_extraction(frame, rows):
    child = frame([("F1", 1, "x"), ("F2", 1, "y")], "FAC_NUM string, LFAC_ORD int, other string")
    parent = frame([("F1", date(2026, 1, 1)), ("F2", date(2025, 1, 1))], "EFAC_NUM string, EFAC_DTEEDI date")
    got = writers.extract_children(child, parent, {"FAC_NUM": "EFAC_NUM"}, "EFAC_DTEEDI", date(2026, 1, 1), ["FAC_NUM", "LFAC_ORD"])
    assert rows(got) == [("F1", 1)]
    assert column_list("wtlfac")[0] == "FAC_NUM" and "_loaded_at" in raw_schema("wtlfac").names


def test_shared_folder_and_stored(spark, frame, rows):
    assert scratch.fresh_path(spark, "x").startswith(scratch.shared_folder(spark))
    assert rows(scratch.stored(frame([(1, "a")], "id int, v string"), "s")) == [(1, "a")]
    assert rows(scratch.settle(frame([(1, "a")], "id int, v string"))) == [(1, "a")]
