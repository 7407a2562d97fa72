"""Tables cut into partitions, of which a load rewrites only those that hold its keys.

A table is cut by a value that its key decides (`by_key`) or by one that may change, such as a month (`by_month`).  In the second
case an index beside the table names the partitions of every key: narrow rows (key, partition), themselves cut by a hash of the
key, so that a load reads the index of its own keys only.

A merge reads the touched partitions, replaces the rows of its keys and writes these partitions by dynamic partition overwrite:
Spark stages the new files and swaps them in when the job commits, so an executor that is lost finds the old files in place.
Stored rows and load meet in one shuffle by partition and key, and the same tasks write them; in tables with an index the places
that keys held mark the stored rows that go.
The index gets the new places of the keys before the data is written and loses the old ones after it.  It may name a partition
too many, never one too few, so a merge that broke off can be run again and gives the same table.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tallyhouse.operators.dedup import latest_by, latest_loaded, newest_load
from tallyhouse.sources.readers import read_or_none
from tallyhouse.sources.scratch import delete_folder, staging
from tallyhouse.sources.writers import overwrite_partitions, overwrite_table

PART, INDEX_BUCKET = "part", "key_bucket"
INDEX_BUCKETS = 64
# The writer task of a row in its partition, where a row of a merge comes from, and whether a key gets or leaves a place.
_TASK, _FROM, _ADDED = "__task", "__from", "__added"
_STORED, _FRESH, _GONE = 0, 1, 2


@dataclass(frozen=True)
class Layout:
    """The partition of a row, and whether its key alone decides it; ``spread`` writer tasks share one partition.

    Files carry bloom filters on the ``bloom`` columns.
    """

    part: Callable[[], Column]
    of_key: bool
    spread: int = 4
    bloom: Sequence[str] = ()


def by_month(column: str, spread: int = 4, bloom: Sequence[str] = ()) -> Layout:
    """A partition per month; rows without a date have one of their own."""
    return Layout(lambda: F.coalesce(F.date_format(column, "'m'yyyy-MM"), F.lit("m-none")), False, spread, bloom)


def by_key(keys: Sequence[str], buckets: int = 32, spread: int = 4, bloom: Sequence[str] = ()) -> Layout:
    """A partition per hash of the key."""
    return Layout(lambda: F.format_string("k%04d", F.pmod(F.xxhash64(*keys), F.lit(buckets))), True, spread, bloom)


@dataclass
class Merged:
    """What a merge did."""

    rewritten: list[str] = field(default_factory=list)
    emptied: list[str] = field(default_factory=list)


def index_path(path: str) -> str:
    return f"{path.rstrip('/')}_keys"


def read_partitioned(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """The table with its partition column, or None where nothing is stored yet."""

    def read() -> DataFrame:
        if schema is None:
            return spark.read.parquet(path)
        return spark.read.schema(StructType([*schema.fields, StructField(PART, StringType())])).parquet(path)

    return read_or_none(read)


def _bucketed(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.withColumn(INDEX_BUCKET, F.pmod(F.xxhash64(*keys), F.lit(INDEX_BUCKETS)).cast("int"))


def _one_of(column: str, values: Sequence) -> Column:
    return F.col(column).isin(list(values))


def _values(rows: DataFrame, column: str) -> list:
    """Distinct values of a partition column: at most as many as there are partitions."""
    return sorted(row[0] for row in rows.select(column).distinct().collect())


def write_index(table: DataFrame, path: str, keys: Sequence[str], unique: bool = False) -> None:
    """The index of a whole table; one of `unique` keys has no places to merge."""
    places = _by_bucket(_bucketed(table.select(*keys, PART), keys))
    overwrite_table(places if unique else places.distinct(), index_path(path), partitions=[INDEX_BUCKET])


def _by_bucket(rows: DataFrame) -> DataFrame:
    return rows.repartition(INDEX_BUCKET)


def _index(spark: SparkSession, path: str, like: StructType, keys: Sequence[str]) -> DataFrame:
    fields = [like[k] for k in keys] + [StructField(PART, StringType())]
    return spark.read.schema(StructType([*fields, StructField(INDEX_BUCKET, IntegerType())])).parquet(index_path(path))


def merge_partitions(
    fresh: DataFrame,
    path: str,
    keys: Sequence[str],
    layout: Layout,
    resolve: Callable[[DataFrame], DataFrame] | None = None,
    gone: DataFrame | None = None,
    unique: bool = False,
    staged: bool = False,
) -> Merged:
    """Merge a load into the table at ``path`` and rewrite only the partitions that hold, held or get its keys.

    ``resolve`` makes the rows to keep from the stored and the fresh rows of the load's keys (by default the newest load of
    a key wins); a row that is alone with its key it leaves as it is.  ``gone`` names keys whose stored rows go; a key that is also in ``fresh`` is replaced by its fresh rows.
    ``unique`` says that ``fresh`` holds one resolved row of a key; ``staged`` that ``fresh`` and ``gone`` are stored
    already, so reading them again computes nothing.
    """
    spark, keys = fresh.sparkSession, list(keys)
    newest = resolve or (lambda rows: latest_loaded(rows, keys))
    placed = {PART: layout.part()}
    by_task = layout.of_key and resolve is None
    with staging(spark) as stage:
        complete = fresh.dropna(subset=keys)
        known = read_partitioned(spark, path, complete.schema)
        if known is None:
            first = complete.withColumns(placed)
            if by_task:
                first = _gathered(first, keys, layout)
                first = first if unique else latest_by(first, [PART, _TASK, *keys], newest_load(complete, keys))
                first = first.drop(_TASK)
            elif not unique:
                first = newest(complete).withColumns(placed)
            overwrite_partitions(first, path, [PART], spread=layout.spread, bloom=layout.bloom, gathered=by_task)
            written = read_partitioned(spark, path, complete.schema)
            if written is not None and not layout.of_key:
                write_index(written, path, keys, unique or resolve is None)
            return Merged(rewritten=[] if written is None else sorted(_files(written)))

        delta = complete if staged else stage(complete, "delta")
        if gone is None:
            removed = None
        else:
            removed = gone.select(*keys).dropna() if staged else stage(gone.select(*keys).dropna().distinct(), "gone")
        changed = [delta.select(*keys)] + ([] if removed is None else [removed])
        if by_task:
            places = [some.select(layout.part().alias(PART)).distinct() for some in changed]
            touched = _values(reduce(DataFrame.union, places), PART)
            if not touched:
                return Merged()
            merged = _merged_by_task(known.filter(_one_of(PART, touched)), delta, removed, keys, layout)
            return _rewrite(spark, known, merged, path, touched, layout, gathered=True)
        if layout.of_key and removed is None:  # stored rows of other keys are alone with theirs
            touched = _values(delta.select(layout.part().alias(PART)), PART)
            if not touched:
                return Merged()
            rows = known.filter(_one_of(PART, touched)).drop(PART).unionByName(delta)
            return _rewrite(spark, known, newest(rows).withColumns(placed), path, touched, layout)

        replaced = removed is not None and delta.select(*keys).join(removed, keys, "left_anti").isEmpty()
        changed = removed if replaced else reduce(DataFrame.union, changed).distinct()
        held = stage(_places(spark, path, changed, keys, layout, delta.schema), "held")
        if removed is not None and delta.isEmpty():  # keys only go: their stored rows are not looked at
            touched = _values(held, PART)
            if not touched:
                return Merged()
            merged = known.filter(_one_of(PART, touched)).join(removed, keys, "left_anti")
            done = _rewrite(spark, known, merged, path, touched, layout)
            if not layout.of_key:
                _drop_places(spark, path, held, keys, delta.schema)
            return done
        if replaced and unique:
            result = delta.withColumns(placed)
        elif replaced:
            result = stage(newest(delta).withColumns(placed), "result")
        else:
            before = known.filter(_one_of(PART, _values(held, PART))).join(changed, keys, "left_semi").drop(PART)
            if removed is not None:
                before = before.join(removed, keys, "left_anti")
            result = stage(newest(before.unionByName(delta)).withColumns(placed), "result")
        touched = sorted({*_values(held, PART), *_values(result, PART)})
        if not touched:
            return Merged()
        if not layout.of_key:
            moves = stage(_moves(held, result, keys), "moves")
            rows = _by_bucket(_bucketed(moves.filter(_ADDED).drop(_ADDED), keys))
            rows.write.mode("append").option("compression", "zstd").partitionBy(INDEX_BUCKET).parquet(index_path(path))
        merged = _replaced_by_task(known.filter(_one_of(PART, touched)), held, result, keys, layout)
        done = _rewrite(spark, known, merged, path, touched, layout, gathered=True)
        left = None if layout.of_key else moves.filter(~F.col(_ADDED)).drop(_ADDED)
        if left is not None and not left.isEmpty():
            _drop_places(spark, path, left, keys, delta.schema)
        return done


def _gathered(rows: DataFrame, keys: Sequence[str], layout: Layout) -> DataFrame:
    """Rows of one partition and key in one task; `layout.spread` tasks share a partition."""
    return rows.withColumn(_TASK, F.pmod(F.hash(*keys), F.lit(layout.spread))).repartition(PART, _TASK)


def _merged_by_task(known: DataFrame, delta: DataFrame, removed: DataFrame | None, keys: list[str], layout: Layout) -> DataFrame:
    """The touched partitions after a load, in one shuffle; the newest load of a key wins, other keys' rows stay."""
    rows = known.withColumn(_FROM, F.lit(_STORED)).unionByName(
        delta.withColumns({PART: layout.part(), _FROM: F.lit(_FRESH)})
    )
    if removed is not None:
        marks = removed.withColumns({PART: layout.part(), _FROM: F.lit(_GONE)})
        rows = rows.unionByName(marks, allowMissingColumns=True)
    rows = _gathered(rows, keys, layout)
    group, origin, position = Window.partitionBy(PART, _TASK, *keys), F.col(_FROM), "__position"
    ordered = group.orderBy(origin == _GONE, *newest_load(delta, keys))
    # One pass over the sorted rows of a key: all windows have the same order.
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    kinds = rows.withColumns({position: F.row_number().over(ordered), "__last": F.max(origin).over(whole)})
    best = F.lit(1)
    if removed is not None:
        kinds = kinds.withColumn("__first_fresh", F.min(F.when(origin == _FRESH, F.col(position))).over(whole))
        best = F.when(F.col("__last") == _GONE, F.col("__first_fresh")).otherwise(best)
    kept = (F.col("__last") == _STORED) | (F.col(position) == best)
    return kinds.filter(kept).select(*delta.columns, PART)


def _moves(held: DataFrame, result: DataFrame, keys: list[str]) -> DataFrame:
    """Places of keys that change with a load: those that they get (`_ADDED`) and those that they leave."""
    was, now = (rows.select(*keys, PART, F.lit(fresh).alias(_ADDED)) for rows, fresh in ((held, False), (result, True)))
    added = F.col(_ADDED)
    found = was.unionByName(now).groupBy(*keys, PART).agg(F.min(added).alias("__was"), F.max(added).alias(_ADDED))
    return found.filter(F.col("__was") == added).drop("__was")


def _replaced_by_task(known: DataFrame, held: DataFrame, result: DataFrame, keys: list[str], layout: Layout) -> DataFrame:
    """The touched partitions with `result` in place of the stored rows of the keys that `held` names, in one shuffle."""
    rows = known.withColumn(_FROM, F.lit(_STORED)).unionByName(result.withColumn(_FROM, F.lit(_FRESH)))
    marks = held.select(*keys, PART, F.lit(_GONE).alias(_FROM))
    rows = _gathered(rows.unionByName(marks, allowMissingColumns=True), keys, layout)
    group, origin = Window.partitionBy(PART, _TASK, *keys), F.col(_FROM)
    marked = rows.withColumn("__last", F.max(origin).over(group))
    stays = (origin == _FRESH) | ((origin == _STORED) & (F.col("__last") != _GONE))
    return marked.filter(stays).select(*result.columns)


def _files(table: DataFrame, column: str = PART) -> dict[str, set[str]]:
    """The files of a table by partition, as they are listed."""
    found: dict[str, set[str]] = {}
    for file in table.inputFiles():
        part = re.search(f"/{column}=([^/]+)/", file)
        if part:
            found.setdefault(part[1], set()).add(file)
    return found


def _rewrite(
    spark: SparkSession, known: DataFrame, merged: DataFrame, path: str, touched: list[str], layout: Layout, gathered: bool = False
) -> Merged:
    """Overwrite the touched partitions; those that got no row are deleted.

    The new files are staged while the old ones are read, and swapped in when the job commits.
    """
    before = _files(known)
    overwrite_partitions(merged, path, [PART], spread=layout.spread, bloom=layout.bloom, gathered=gathered)
    after = _files(read_partitioned(spark, path, known.drop(PART).schema))
    emptied = _drop_unwritten(spark, path, touched, before, after)
    return Merged(rewritten=[part for part in touched if part not in emptied and part in after], emptied=emptied)


def _drop_unwritten(
    spark: SparkSession, path: str, touched: list[str], before: dict[str, set[str]], after: dict[str, set[str]], column: str = PART
) -> list[str]:
    """Delete the touched partitions that got no row: one without rows is not overwritten by itself and has its old files."""
    emptied = [part for part in touched if part in before and before[part] == after.get(part)]
    for part in emptied:
        delete_folder(spark, f"{path}/{column}={part}")
    return emptied


def _places(
    spark: SparkSession, path: str, changed: DataFrame, keys: list[str], layout: Layout, like: StructType
) -> DataFrame:
    """(key, partition) of the stored rows of some keys."""
    if layout.of_key:
        return changed.withColumn(PART, layout.part())
    wanted = _bucketed(changed, keys)
    index = _index(spark, path, like, keys).filter(_one_of(INDEX_BUCKET, _values(wanted, INDEX_BUCKET)))
    # Distinct by bucket too, where the join has left the rows.
    return index.join(wanted, [*keys, INDEX_BUCKET], "left_semi").distinct().select(*keys, PART)


def _drop_places(spark: SparkSession, path: str, left: DataFrame, keys: list[str], like: StructType) -> None:
    """Rewrite the parts of the index that still name partitions which keys have left."""
    buckets = _values(_bucketed(left, keys), INDEX_BUCKET)
    known = _index(spark, path, like, keys)
    before = _files(known, INDEX_BUCKET)
    kept = known.filter(_one_of(INDEX_BUCKET, buckets)).join(left, [*keys, PART], "left_anti").distinct()
    overwrite_partitions(kept, index_path(path), [INDEX_BUCKET])
    after = _files(_index(spark, path, like, keys), INDEX_BUCKET)
    _drop_unwritten(spark, index_path(path), [str(bucket) for bucket in buckets], before, after, INDEX_BUCKET)


def rows_of(
    spark: SparkSession, path: str, wanted: DataFrame, keys: Sequence[str], layout: Layout, schema: StructType
) -> DataFrame:
    """Stored rows of some keys, read from the partitions that hold them; `schema` is the table's, without the partition."""
    known = read_partitioned(spark, path, schema)
    if known is None:
        return spark.createDataFrame([], schema)
    asked = wanted.select(*keys).dropna()
    places = _places(spark, path, asked if layout.of_key else asked.distinct(), list(keys), layout, schema)
    return known.filter(_one_of(PART, _values(places, PART))).join(wanted.select(*keys), list(keys), "left_semi").drop(PART)
