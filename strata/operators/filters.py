"""Filters kept in a form that reaches the file scan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def date_range(
    df: DataFrame,
    column: str,
    start: dt.date | None = None,
    end: dt.date | None = None,
    half_open: bool = False,
    directories: tuple[str, str] | None = None,
) -> DataFrame:
    """Rows dated from ``start`` to ``end``; ``half_open`` leaves ``end`` out.

    The bounds are compared with the bare column, never with a part of it, so
    they reach the scan and skip row groups. Where the table is laid out in
    ``directories`` by the year and month of the date, the bounds are repeated
    on those and skip whole directories.
    """
    day = F.col(column).cast("date")
    year, month = directories or (None, None)
    if start is not None:
        df = df.where(day >= F.lit(start))
        if year:
            df = df.where((F.col(year) >= start.year) & (_months(year, month) >= _number(start)))
    if end is not None:
        df = df.where(day < F.lit(end) if half_open else day <= F.lit(end))
        if year:
            df = df.where((F.col(year) <= end.year) & (_months(year, month) <= _number(end)))
    return df


def _months(year: str, month: str) -> Column:
    return F.col(year) * 12 + F.col(month)


def _number(date: dt.date) -> int:
    return date.year * 12 + date.month


def optional_equal(df: DataFrame, column: str, value) -> DataFrame:
    """Rows with ``column == value``; all rows if no value is given."""
    return df if value is None else df.where(F.col(column) == F.lit(value))


def unless_exists(df: DataFrame, blockers: DataFrame) -> DataFrame:
    """``df``, or no rows at all if ``blockers`` has any row."""
    return df.where(~blockers.select(F.lit(1)).exists())
