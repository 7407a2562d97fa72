"""Every registered query against its SQL on the smallest sample tables."""

import os

import pytest

import __spark_entry__ as entry
from oracle.compare import database, difference

FOLDER = "/root/testdata/sf0.001"
QUERIES, TEXTS = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="sample tables not present")


@pytest.fixture(scope="module")
def db():
    return database(FOLDER)


def test_every_text_has_a_query():
    assert set(TEXTS) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    got = df.collect()
    if name in TEXTS:
        cursor = db.execute(TEXTS[name])
        columns = [d[0] for d in cursor.description]
        assert difference(df.columns, got, columns, cursor.fetchall()) == ""
