"""Erasure of data subjects from stored tables.

A table that names subjects is written with a bloom filter on the subject column (`Layout.bloom`), so a search for a few subjects skips
the row groups that can't hold them and reads two columns of the others.  Only partitions that hold a subject are rewritten;
the files of all others stay as they are, byte for byte.  The index of the table loses the erased keys, and a scan of the
rewritten table proves that no row is left.  A run that broke off can be repeated: what is gone already is not found again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.sources.partitioned import PART, Layout, Merged, merge_partitions, read_partitioned
from tallyhouse.sources.scratch import staging

#: Up to so many subjects are looked for by value, which reaches the bloom filters; more of them by a join.
LISTED_SUBJECTS = 1000


class ErasureIncomplete(RuntimeError):
    """A stored table still holds a subject."""


@dataclass(frozen=True)
class SubjectTable:
    """A stored table that names subjects in a column."""

    path: str
    keys: Sequence[str]
    layout: Layout
    subject: str


def holding(spark: SparkSession, table: SubjectTable, subjects: DataFrame) -> DataFrame | None:
    """Keys and partition of the rows of some subjects (a column named as in the table); None without any file."""
    known = read_partitioned(spark, table.path)
    if known is None:
        return None
    wanted = subjects.select(table.subject).dropna().distinct()
    few = wanted.limit(LISTED_SUBJECTS + 1).collect()
    if len(few) <= LISTED_SUBJECTS:
        found = known.filter(F.col(table.subject).isin([row[0] for row in few]))
    else:
        found = known.join(wanted, table.subject, "left_semi")
    return found.select(*dict.fromkeys([*table.keys, PART]))


def erase_subjects(spark: SparkSession, tables: Sequence[SubjectTable], subjects: DataFrame) -> dict[str, Merged]:
    """Remove all rows of some subjects; says which partitions of which table were rewritten.

    Rows without a key can't be told apart by it and raise `ErasureIncomplete` if they name a subject.
    """
    done = {}
    with staging(spark) as stage:
        asked = stage(subjects, "subjects")
        for table in tables:
            held = holding(spark, table, asked)
            found = None if held is None else stage(held, f"holding-{len(done)}")
            if found is None or found.isEmpty():
                done[table.path] = Merged()
                continue
            stored = read_partitioned(spark, table.path).drop(PART)
            nothing = spark.createDataFrame([], stored.schema)
            done[table.path] = merge_partitions(nothing, table.path, table.keys, table.layout, lambda rows: rows, gone=found)
            left = holding(spark, table, asked)
            if left is not None and not left.isEmpty():
                raise ErasureIncomplete(f"{table.path} still holds a subject")
    return done
