"""Casts at the edge of the system, code lookups and exact means."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decimal_to_int(value: Column) -> Column:
    return value.cast("int")


def decimal_to_long(value: Column) -> Column:
    return value.cast("long")


def decimal_to_double(value: Column) -> Column:
    return value.cast("double")


def to_decimal(value: Column, precision: int = 18, scale: int = 4) -> Column:
    return value.cast(f"decimal({precision},{scale})")


def timestamp_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text of a timestamp."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def text_timestamp(text: Column) -> Column:
    return text.cast("timestamp_ntz")


def date_text(ts: Column) -> Column:
    """``yyyy-MM-dd`` text of a timestamp or date."""
    return F.date_format(ts, "yyyy-MM-dd")


def load_type(code: Column) -> Column:
    """Load type of a meter category code: 1 industrial, 2 commercial, 3 residential, else 0."""
    # Fixed values.
    return F.when(code == "01", 1).when(code == "02", 2).when(code == "11", 3).otherwise(0)


def mean(value: Column | str) -> Column:
    """Average as a double.

    Decimal readings are summed exactly and divided once, so the mean does not depend on the
    order in which partial sums arrive: a task that runs again gives the same bits, and the
    k-means labels built on these means stay stable.
    """
    return F.sum(value).cast("double") / F.count(value)
