"""Dates and periods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col


def compact_date(value: Column | str) -> Column:
    """Cleaned ``ddMMyyyy`` text to a date; anything else is null."""
    return F.when(F.length(col(value)) == 8, F.try_to_date(col(value), "ddMMyyyy"))


def lenient_timestamp(value: Column | str) -> Column:
    """Generic date text to a timestamp, invalid text to null.

    With slashes the month comes first, and the day only where it cannot be a month. Eight digits
    are year, month and day.
    """
    text = col(value).cast("string")
    forms = [F.try_to_timestamp(text, F.lit(form)) for form in ("MM/dd/yyyy", "dd/MM/yyyy")]
    compact = F.when(F.trim(text).rlike(r"\A\d{8}\z"), F.try_to_timestamp(F.trim(text), F.lit("yyyyMMdd")))
    return F.coalesce(compact, text.try_cast("timestamp"), *forms)


def month_start(value: Column | str) -> Column:
    return F.trunc(col(value).cast("date"), "month")


def year_month(year: Column | str, month: Column | str) -> Column:
    return F.format_string("%04d-%02d", col(year).cast("int"), col(month).cast("int"))


def month_from_text(period: Column | str) -> Column:
    """``YYYY-MM`` to the first of that month."""
    return F.try_to_date(F.concat(col(period), F.lit("-01")), "yyyy-MM-dd")


def months_between(first: Column, last: Column) -> Column:
    """Every first-of-month from ``first`` to ``last``, both included."""
    return F.sequence(first, last, F.expr("interval 1 month"))


def in_observation_window(onset: Column | str, first: Column, last_month: Column) -> Column:
    """Onset known, not before ``first`` and not after the last day of ``last_month``."""
    day = col(onset).cast("timestamp")
    ends = F.last_day(last_month).cast("timestamp")
    return F.coalesce((day >= first.cast("timestamp")) & (day <= ends), F.lit(False))
