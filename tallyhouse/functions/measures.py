"""Aggregate and ratio expressions used by the marts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse.functions.clean import ColumnLike, as_col

INVOICE, CREDIT_NOTE = "F", "A"


def money(c: ColumnLike, precision: int = 18, scale: int = 2) -> Column:
    return as_col(c).cast(f"decimal({precision},{scale})")


def round_to(c: ColumnLike, digits: int) -> Column:
    """Half-away-from-zero rounding of a double on its scaled value."""
    scale = F.lit(float(10**digits))
    return F.round(as_col(c).cast("double") * scale) / scale


def ratio(num: ColumnLike, den: ColumnLike, digits: int | None = None, default: float | None = None) -> Column:
    """num / den on doubles; NULL (or ``default``) when the denominator is 0 or NULL."""
    value = F.try_divide(as_col(num).cast("double"), as_col(den).cast("double"))
    if digits is not None:
        value = round_to(value, digits)
    return value if default is None else F.coalesce(value, F.lit(float(default)))


def count_if(condition: Column) -> Column:
    return F.count_if(condition)


def sum_if(condition: Column, value: ColumnLike) -> Column:
    """Sum of ``value`` over the rows that meet the condition; 0 when none does."""
    return F.sum(F.when(condition, as_col(value)).otherwise(F.lit(0)))


def percent_if(condition: Column, digits: int = 1) -> Column:
    """Share of rows meeting the condition, in percent."""
    return round_to(F.count_if(condition).cast("double") / F.count(F.lit(1)) * 100, digits)


def invoiced(amount: ColumnLike, doc_type: ColumnLike = "doc_type") -> Column:
    return sum_if(as_col(doc_type) == INVOICE, amount)


def credit(amount: ColumnLike, doc_type: ColumnLike = "doc_type") -> Column:
    return sum_if(as_col(doc_type) == CREDIT_NOTE, amount)


def signed(amount: ColumnLike, doc_type: ColumnLike = "doc_type") -> Column:
    """+amount for invoices, −amount for credit notes, 0 otherwise (row level)."""
    kind, value = as_col(doc_type), as_col(amount)
    return F.when(kind == INVOICE, value).when(kind == CREDIT_NOTE, -value).otherwise(F.lit(0))


def clamp01(c: ColumnLike) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), as_col(c)))
