"""Calendar expressions over date columns, and date bounds for parameters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.fixed import DATE_FORMAT, MONTH_NAMES


def month_name_es(month: Column) -> Column:
    """Spanish name of a month number; NULL outside 1..12."""
    return F.get(F.array(*[F.lit(name) for name in MONTH_NAMES]), month - 1)


def iso_week(date: Column) -> Column:
    return F.weekofyear(date)


def calendar_year(date: Column, iso: bool = False) -> Column:
    """Calendar year, or the year the ISO week belongs to."""
    return F.extract(F.lit("YEAROFWEEK"), date) if iso else F.year(date)


def format_dmy(date: Column) -> Column:
    return F.date_format(date, DATE_FORMAT)


def month_bounds(year: Column, month: Column) -> tuple[Column, Column, Column]:
    """First day, first day of the next month and last day of a month."""
    first = F.make_date(year, month, F.lit(1))
    return first, F.add_months(first, 1), F.last_day(first)


def month_span(year: int, month: int | None = None) -> tuple[dt.date, dt.date]:
    """Half-open span of one month, or of the whole year without a month."""
    start = dt.date(year, month or 1, 1)
    last = month or 12
    end = dt.date(year + last // 12, last % 12 + 1, 1)
    return start, end
