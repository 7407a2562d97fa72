"""Readers.

Raw batches lie under ``<root>/raw_<table>/<yyyy>/<mm>/<dd>/`` as one JSON object per line.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"
LOAD_DATE_PATTERN = r"(\d{4}/\d{2}/\d{2})/[^/]+$"


def raw_path(root: str, table: str, day: date | None = None) -> str:
    base = f"{root}/raw_{table}"
    return base if day is None else f"{base}/{day:%Y/%m/%d}"


def _json(spark: SparkSession, paths: Sequence[str], schema: StructType) -> DataFrame:
    reader = spark.read.schema(schema).option("recursiveFileLookup", True).option("mode", "PERMISSIVE")
    return reader.option("columnNameOfCorruptRecord", CORRUPT).json(list(paths))


def is_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_or_empty(read, spark: SparkSession, schema: StructType) -> DataFrame:
    """An optional source: an empty frame with the declared schema when its path does not exist."""
    try:
        return read()
    except AnalysisException as error:
        if not is_missing(error):
            raise
        return spark.createDataFrame([], schema)


def read_or_none(read) -> DataFrame | None:
    """A table, or None where its path does not exist or holds no file."""
    try:
        return read()
    except AnalysisException as error:
        if not is_missing(error) and error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return None


def read_raw(
    spark: SparkSession, root: str, table: str, schema: StructType, day: date | None = None, days_back: int = 0
) -> DataFrame:
    """One day of a raw table, the days up to it, or (``day`` None) its whole history.

    Missing days are empty, not an error.
    """
    if day is None:
        return read_or_empty(lambda: _json(spark, [raw_path(root, table)], schema), spark, schema)
    frames = [
        read_or_empty(lambda p=raw_path(root, table, day - timedelta(n)): _json(spark, [p], schema), spark, schema)
        for n in range(days_back + 1)
    ]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


class InputMissing(RuntimeError):
    """A load has no batch of a table that it can't do without."""


def read_required(
    spark: SparkSession, root: str, table: str, schema: StructType, day: date | None = None
) -> DataFrame:
    """A raw table that must have been delivered, with at least one row; raises `InputMissing` if it wasn't."""
    found = read_raw(spark, root, table, schema, day)
    if found.isEmpty():
        raise InputMissing(f"{table}: no batch of {day or 'any day'}")
    return found


def read_snapshot(
    spark: SparkSession, root: str, table: str, schema: StructType, day: date | None = None
) -> DataFrame:
    """The rows of one full extract: that of the day, or (``day`` None) the newest one.

    Earlier extracts hold rows that the source has removed since.
    """
    found = read_required(spark, root, table, schema, day)
    if day is not None:
        return found
    dated = found.select("*", F.regexp_extract("_metadata.file_path", LOAD_DATE_PATTERN, 1).alias("__load_date"))
    newest = dated.agg(F.max("__load_date")).first()[0]
    return dated.filter(F.col("__load_date") == newest).drop("__load_date")


def read_tolerant(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Good rows and rejects (the raw text of lines that are not valid records).

    Lines are read as text and parsed once per side, so each side reads only what it needs.
    """
    declared = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    lines = spark.read.option("recursiveFileLookup", True).text(path).filter(F.trim("value") != "")
    rows = lines.select("value", F.from_json("value", declared, options).alias("row"))
    valid = F.col(f"row.{CORRUPT}").isNull() & F.col("row").isNotNull()
    good = rows.filter(valid).select("row.*").drop(CORRUPT)
    rejects = rows.filter(~valid).select(F.col("value").alias("raw_text"))
    return good, rejects


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_optional_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return read_or_empty(lambda: spark.read.schema(schema).parquet(path), spark, schema)


def read_delimited(spark: SparkSession, path: str, schema: StructType, separator: str = ";") -> DataFrame:
    """Delimited reference file with a header; a byte-order mark and the case of the headers do not matter."""
    reader = spark.read.option("sep", separator).option("header", True).option("encoding", "UTF-8")
    text = reader.csv(path)
    by_name = {c.lstrip("﻿").strip().lower(): c for c in text.columns}
    return text.select(
        *[
            F.col(f"`{by_name[f.name.lower()]}`").try_cast(f.dataType.simpleString()).alias(f.name)
            if f.name.lower() in by_name
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def read_database(spark: SparkSession, options: dict[str, str], table: str, columns: Sequence[str]) -> DataFrame:
    """A source table over JDBC, whitelisted columns only; pass partition options for large tables."""
    return spark.read.format("jdbc").options(**options).option("dbtable", table).load().select(*columns)


def load_partitions(df: DataFrame, pattern: str = LOAD_DATE_PATTERN) -> DataFrame:
    """Files and rows per load day, the day taken from the file path."""
    path = F.col("_metadata.file_path")
    return (
        df.select(F.regexp_extract(path, pattern, 1).alias("load_date"), path.alias("file_path"))
        .groupBy("load_date", "file_path")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("load_date")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("n").alias("row_count"))
    )


def probe(df: DataFrame) -> tuple[int, int]:
    """Rows and columns of a builder's result, without writing it."""
    return df.count(), len(df.columns)
