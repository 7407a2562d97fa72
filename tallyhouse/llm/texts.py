"""Column expressions on texts that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
GAP = r"[\x20\x09-\x0D]+"


def whole(text: Column | str) -> Column:
    """The text, empty for null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column | str) -> Column:
    """The words of a text in order; none for a null or empty text."""
    return F.array_remove(F.split(whole(text), GAP), "")


def word_count(text: Column | str) -> Column:
    return F.size(words(text)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once per row, however often and deep inside lambdas `body` reads it.

    A column of an inner projection would do the same until a filter is pushed below the projection, which puts the
    column's definition inside the lambdas.
    """
    return F.transform(F.array(value), body)[0]
