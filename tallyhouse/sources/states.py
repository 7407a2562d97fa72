"""Additive states stored by month, of which a load rewrites only the months it changes.

Every row of a stored month carries the number of the last load that changed the month.  A load that is run again skips the
months that bear its number, so a load that broke off between months is finished, not added twice.  The new files of all
changed months are staged by one job and swapped in when it commits.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tallyhouse.operators.additive import add_change, nothing_left
from tallyhouse.sources.partitioned import PART
from tallyhouse.sources.readers import read_or_none
from tallyhouse.sources.scratch import delete_folder, staging
from tallyhouse.sources.writers import overwrite_partitions

LOAD = "load_number"


@dataclass(frozen=True)
class MonthlyState:
    """``month`` is one of the keys: the first day of a month."""

    path: str
    keys: Sequence[str]
    sums: Sequence[str]
    month: str = "month"

    def _part(self):
        return F.coalesce(F.date_format(self.month, "'m'yyyy-MM"), F.lit("m-none"))

    def _stored(self, spark: SparkSession, schema: StructType) -> DataFrame | None:
        fields = [schema[c] for c in (*self.keys, *self.sums)]
        stored = StructType([*fields, StructField(LOAD, LongType()), StructField(PART, StringType())])
        return read_or_none(lambda: spark.read.schema(stored).parquet(self.path))

    def read(self, spark: SparkSession, schema: StructType) -> DataFrame:
        """The whole state."""
        found = self._stored(spark, schema)
        if found is None:
            return spark.createDataFrame([], StructType([schema[c] for c in (*self.keys, *self.sums)]))
        return found.select(*self.keys, *self.sums).filter(~nothing_left(self.sums))

    def rebuild(self, state: DataFrame, load: int) -> None:
        """Replace the whole state by one computed from all rows."""
        delete_folder(state.sparkSession, self.path)
        self.apply(state, load)

    def apply(self, change: DataFrame, load: int) -> list[str]:
        """Add a load's change; returns the months rewritten."""
        spark = change.sparkSession
        with staging(spark) as stage:
            fresh = change.select(*self.keys, *self.sums).withColumn(PART, self._part())
            known = self._stored(spark, fresh.schema)
            if known is not None:  # months that have the change already are left out before it is computed
                done = sorted(row[0] for row in known.filter(F.col(LOAD) == load).select(PART).distinct().collect())
                fresh = fresh.filter(~F.col(PART).isin(done)) if done else fresh
            fresh = stage(fresh, "change")
            months = {row[0] for row in fresh.select(PART).distinct().collect()}  # at most one for each month
            if not months:
                return []
            old = fresh.limit(0) if known is None else known.filter(F.col(PART).isin(sorted(months)))
            state = add_change(old, fresh, self.keys, self.sums).withColumn(LOAD, F.lit(load).cast("long"))
            state = state.withColumn(PART, self._part())
            emptied = sorted(months - {row[0] for row in state.select(PART).distinct().collect()})
            # A month without rows keeps one of nothing, which bears the number of the load.
            empty = spark.createDataFrame([(part,) for part in emptied], f"{PART} string").withColumns(
                {c: F.lit(None).cast(state.schema[c].dataType) for c in self.keys}
                | {c: F.lit(0).cast(state.schema[c].dataType) for c in (*self.sums, LOAD)}
            )
            empty = empty.withColumn(LOAD, F.lit(load).cast("long"))
            overwrite_partitions(state.unionByName(empty), self.path, [PART])
            return sorted(months)
