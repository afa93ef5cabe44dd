"""Calendar helpers with the SQL semantics the date dimension was written for."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pg_day_of_week(d: Column) -> Column:
    """Day of week with Sunday = 0 .. Saturday = 6 (Spark's dayofweek is 1-based)."""
    return (F.dayofweek(d) - 1).cast("int")


def pg_day_name(d: Column) -> Column:
    """English day name blank-padded to 9 characters, e.g. ``'Sunday   '``."""
    return F.rpad(F.date_format(d, "EEEE"), 9, " ")


def date_spine(start: Column, end: Column) -> Column:
    """Array of every day in ``[start, end]``; empty when start > end or a bound is NULL.

    ``sequence`` raises on a reversed range where a series function returns no
    rows, so the guard keeps the empty-range behaviour.
    """
    return F.when(start <= end, F.sequence(start, end, F.expr("interval 1 day")))
