import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyhouse.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("tests", "8", **{"spark.sql.shuffle.partitions": "4"})


@pytest.fixture(scope="session")
def frame(spark):
    """A DataFrame from rows and a DDL schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def rows():
    """Rows of a DataFrame as sorted dicts."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))

    return collect
