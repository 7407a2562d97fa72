"""Ingestion of source tables into the raw layer, with high-water marks.

Delta tables take the rows since their mark, child tables without a date follow their parent, the
others are extracted whole.  The mark is the time at which a load began.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallyhouse.operators.delta import apply_watermark_updates, delta_extract, resolve_since
from tallyhouse.sources.schemas import RAW_COLUMNS, column_list
from tallyhouse.sources.writers import extract_children, write_raw

# Start of the first load of a table without a mark.
DEFAULT_SINCE = datetime(2023, 1, 1)
# How long after its business date a row may still be entered or changed.
LATE = timedelta(days=400)
UPDATES = "pipeline string, table_name string, ok boolean, high_mark timestamp, error string, rows long"


@dataclass(frozen=True)
class RawTable:
    """How a table is extracted: ``delta`` column, or (``parent``, keys, parent date), or whole.

    The mark of a table is the start of its last load.  ``overlap`` is how far before it a load looks again: change
    dates may have no time of day, and rows are entered later than the business date (an end, an invoice day) that
    some delta columns hold.
    """

    name: str
    delta: str | None = None
    overlap: timedelta = timedelta(days=1)
    include_null: bool = False
    first_since: datetime = DEFAULT_SINCE
    parent: str | None = None
    on: tuple[tuple[str, str], ...] = ()
    parent_date: str | None = None


# The tables with a change date, and the child that follows its parent.
DELTA_TABLES = (
    RawTable("wtmiss", "CNTI_CREATE"),
    RawTable("wtcnti", "CNTI_CREATE"),
    RawTable("wtefac", "EFAC_DTEEDI", LATE),
    RawTable("wtprh", "PRH_MODIFDATE"),
    RawTable("pycontrat", "CNT_DATEFIN", LATE, include_null=True),
    RawTable("wtrhdon", "RHD_DATED", LATE, first_since=datetime(2024, 1, 1)),
    RawTable("wtpeval", "PEVAL_DU", LATE),
    RawTable("agence_gestion", "DATE_UG_GEST", LATE, first_since=datetime(2022, 1, 1)),
)
CHILD_TABLES = (
    RawTable(
        "wtlfac",
        parent="wtefac",
        on=(("FAC_NUM", "EFAC_NUM"),),
        parent_date="EFAC_DTEEDI",
        first_since=datetime(2024, 1, 1),
    ),
)
_SPECIAL = {t.name for t in (*DELTA_TABLES, *CHILD_TABLES)}
FULL_TABLES = tuple(RawTable(name) for name in RAW_COLUMNS if name not in _SPECIAL)
RAW_TABLES = (*DELTA_TABLES, *CHILD_TABLES, *FULL_TABLES)

Source = Callable[[str], DataFrame]


def extract(table: RawTable, source: Source, since: datetime) -> DataFrame:
    """The whitelisted rows to load."""
    columns = [f"`{c}`" for c in column_list(table.name)]
    if table.parent:
        child = source(table.name)
        return extract_children(
            child, source(table.parent), dict(table.on), table.parent_date, table.first_since.date(), columns
        )
    rows = source(table.name)
    if table.delta is None:
        return rows.select(*columns)
    dated = rows.withColumn("__changed", F.col(table.delta).cast("timestamp"))
    return delta_extract(dated, "__changed", since - table.overlap, table.include_null).select(*columns)


def _load_table(
    table: RawTable, source: Source, since: datetime, root: str, day: date, batch_id: str, loaded_at: str
) -> int:
    """Write one batch; returns the row count."""
    rows = extract(table, source, since)
    seen = Observation(f"raw-{table.name}")
    observed = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    write_raw(observed, root, table.name, day, batch_id, loaded_at, replace_day=table.delta is None)
    return seen.get["rows"]


def ingest(
    state: DataFrame,
    source: Source,
    pipeline: str,
    root: str,
    day: date,
    batch_id: str,
    now: datetime,
    tables: Sequence[RawTable] = RAW_TABLES,
) -> DataFrame:
    """Load every table and return the new watermark state; a failing table does not stop the others.

    ``now`` is when the load began; it becomes the mark of every table that succeeds.
    """
    spark = state.sparkSession
    fallbacks = spark.createDataFrame(
        [(pipeline, t.name, t.first_since) for t in tables], "pipeline string, table_name string, fallback_since timestamp"
    )
    since = {r["table_name"]: r["since"] for r in resolve_since(state, fallbacks, DEFAULT_SINCE).collect()}
    outcomes = []
    for table in tables:
        start = since[table.name]
        try:
            count = _load_table(table, source, start, root, day, batch_id, now.isoformat(sep=" "))
        except PySparkException as error:
            outcomes.append((pipeline, table.name, False, None, str(error), 0))
            continue
        # Whatever dates the rows bear, all that the source held when the load began has been read.
        outcomes.append((pipeline, table.name, True, now, None, count))
    return apply_watermark_updates(state, spark.createDataFrame(outcomes, UPDATES))
