"""Periods, promotion ends and run stamps."""

from __future__ import annotations

import calendar
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F


def period_bounds(period: str) -> tuple[date, date]:
    """First and last day of a ``yyyyMM`` period."""
    year, month = int(period[:4]), int(period[4:6])
    return date(year, month, 1), date(year, month, calendar.monthrange(year, month)[1])


def period_of(day: date) -> str:
    return day.strftime("%Y%m")


def in_period(col: Column, period: str) -> Column:
    """Whether a date or timestamp falls in the period, its last day included in full."""
    first, last = period_bounds(period)
    return (col >= F.lit(first)) & (col < F.lit(last + timedelta(days=1)))


def promo_end(start: Column, interval: Column, duration: Column) -> Column:
    """Start plus ``duration`` months (interval M) or days (D); null otherwise."""
    return F.when(interval == "M", F.add_months(start, duration)).when(
        interval == "D", F.date_add(start, duration)
    )


def stamps(
    df: DataFrame, as_of: date, run_ts: datetime | None = None, period: str | None = None
) -> DataFrame:
    """Add FECHA_PROC and PERIODO. Without ``run_ts`` FECHA_PROC is the date itself."""
    stamp = F.lit(run_ts.strftime("%Y%m%d %H:%M:%S") if run_ts else as_of)
    return df.withColumns({"FECHA_PROC": stamp, "PERIODO": F.lit(period or period_of(as_of))})
