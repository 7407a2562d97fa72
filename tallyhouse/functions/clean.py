"""Cleaning, classification and hashing expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

# Stands for NULL inside a change fingerprint; every other part begins with its length.
NULL_MARK = "-"


def as_col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_blank(c: ColumnLike) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(F.trim(as_col(c).cast("string")), F.lit(""))


def empty_if_null(c: ColumnLike) -> Column:
    """Trimmed text, '' for NULL."""
    return F.trim(F.coalesce(as_col(c).cast("string"), F.lit("")))


def code_or_null(c: ColumnLike, length: int) -> Column:
    """Trimmed code, NULL unless it has exactly ``length`` characters."""
    trimmed = F.trim(as_col(c).cast("string"))
    return F.when(F.length(trimmed) == length, trimmed)


def composite_id(first: ColumnLike, first_length: int, second: ColumnLike, second_length: int) -> Column:
    """first‖second when both parts are valid codes, else NULL."""
    a, b = code_or_null(first, first_length), code_or_null(second, second_length)
    return F.concat(a, b)


def safe_bool(c: ColumnLike, default: bool = False) -> Column:
    return F.coalesce(as_col(c).try_cast("boolean"), F.lit(default))


def concat_skip_null(*parts: ColumnLike) -> Column:
    """Concatenate, reading NULL as ''."""
    return F.concat(*[F.coalesce(as_col(p).cast("string"), F.lit("")) for p in parts])


def key_hash(*parts: ColumnLike) -> Column:
    """Surrogate key: MD5 over the non-NULL parts joined by '|'."""
    return F.md5(F.concat_ws("|", *[as_col(p).cast("string") for p in parts]))


def change_hash(columns: Sequence[ColumnLike]) -> Column:
    """Fingerprint of the tracked columns; each part carries its length, so no two lists of values read alike."""
    values = [as_col(c).cast("string") for c in columns]
    marked = [F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit(NULL_MARK)) for v in values]
    return F.md5(F.concat(*marked))


def salted_hash(c: ColumnLike, salt: str) -> Column:
    """SHA-256 of value‖salt; NULL and '' stay NULL."""
    value = as_col(c).cast("string")
    return F.when(value.isNotNull() & (value != ""), F.sha2(F.concat(value, F.lit(salt)), 256))


def bucketize(
    c: ColumnLike,
    steps: Sequence[tuple[float, str]],
    otherwise: str,
    null_label: str | None = None,
) -> Column:
    """Ordered threshold buckets: the first ``c <= upper`` wins; NULL gets its own label."""
    value = as_col(c)
    expr = F.when(value.isNull(), F.lit(null_label))
    for upper, label in steps:
        expr = expr.when(value <= upper, F.lit(label))
    return expr.otherwise(F.lit(otherwise))
