"""Period labels and the named-period dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import (
    BREAKS, PERIODS, PRODUCT_PERIOD_DEFAULT, PRODUCT_PERIOD_STATUS, SECTION_PERIOD_DEFAULT, SECTION_PERIOD_STATUS,
    outcome_definitions,
)
from ..session import dimension
from .text import col


def _first_range(year: Column, ranges: list[tuple[Column, int, int, str]], default: str) -> Column:
    label = F.lit(default)
    for applies, first, last, text in reversed(ranges):
        label = F.when(applies & year.between(first, last), F.lit(text)).otherwise(label)
    return label


def death_period_status(year: Column | str, outcome_id: Column | str) -> Column:
    """Context label of a death year, which depends on the outcome's section."""
    members: dict[str, list[str]] = {}
    for outcome in outcome_definitions():
        if "SIM" in outcome.sources:
            members.setdefault(outcome.section, []).append(outcome.id)
    ranges = [
        (col(outcome_id).isin(members[section]), first, last, text)
        for section, first, last, text in SECTION_PERIOD_STATUS
    ]
    return _first_range(col(year), ranges, SECTION_PERIOD_DEFAULT)


def product_period_status(product: str, year: Column | str) -> Column:
    """Provisional, partial or complete label of a year in one data product."""
    ranges = [
        (F.lit(True), first, last, text)
        for name, first, last, text in PRODUCT_PERIOD_STATUS if name == product
    ]
    return _first_range(col(year), ranges, PRODUCT_PERIOD_DEFAULT[product])


def period_dimension(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    schema = "section string, period_id string, start string, end string, status string"
    return dimension(spark, rows or PERIODS, schema)


def period_years(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    """Named periods unrolled to one row per (section, year).

    The unrolled form turns the usual "year between start and end" lookup into an
    equality join, which hashes instead of comparing every row with every period.
    """
    expanded = [
        (section, year, period_id, status)
        for section, period_id, start, end, status in (rows or PERIODS)
        for year in range(int(start[:4]), int(end[:4]) + 1)
    ]
    return dimension(spark, expanded, "section string, year int, period_id string, status string")


#: Month number behind every other, the end of a period that has none.
_NO_END = 2**31 - 1


def month_number(text: str) -> int:
    """``YYYY-MM`` as months since year zero."""
    return int(text[:4]) * 12 + int(text[5:7]) - 1


def month_of(date: Column | str) -> Column:
    return F.year(col(date)) * 12 + F.month(col(date)) - 1


def period_intervals(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    """One row per section: its periods as sorted arrays of half-open month ranges; a null end is open.

    Periods of a section may touch and leave gaps; overlapping ones raise.
    """
    sections: dict[str, list[tuple]] = {}
    for section, period_id, start, end, status in rows or PERIODS:
        sections.setdefault(section, []).append((month_number(start), _NO_END if end is None else month_number(end) + 1, period_id, status))
    lookup = []
    for section, periods in sections.items():
        periods.sort()
        for before, after in zip(periods, periods[1:], strict=False):
            if after[0] < before[1]:
                raise ValueError(f"{section}: {before[2]} and {after[2]} overlap")
        lookup.append((section, *[list(values) for values in zip(*periods, strict=True)]))
    return dimension(spark, lookup, "section string, starts array<int>, ends array<int>, period_ids array<string>, statuses array<string>")


def with_period(df: DataFrame, date: str, rows: list[tuple] | None = None) -> DataFrame:
    """``df`` (with a section) and the period_id and period_status its month falls in, null in gaps.

    Sections join by equality; inside one, the month's place among the sorted starts finds the period.
    """
    month = month_of(date)
    place = F.size(F.filter("starts", lambda start: start <= month))
    inside = (place > 0) & (month < F.element_at("ends", F.greatest(place, F.lit(1))))
    found = [F.when(inside, F.element_at(values, F.greatest(place, F.lit(1)))).alias(name) for values, name in (("period_ids", "period_id"), ("statuses", "period_status"))]
    return df.join(period_intervals(df.sparkSession, rows), "section", "left").select(*df.columns, *found)


def break_dimension(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    """(break_id, break_month): the dates at which series may break, as rows."""
    return dimension(spark, rows or BREAKS, "break_id string, break_month string")


def break_sides(date: Column | str, rows: list[tuple] | None = None) -> Column:
    """One struct per break: its id and whether the month lies at or after it."""
    month = month_of(date)
    return F.array(*[F.struct(F.lit(name).alias("break_id"), (month >= month_number(at)).alias("after")) for name, at in rows or BREAKS])


def data_status(source: Column | str, year: Column | str, period_status: Column | str) -> Column:
    provisional = F.contains(col(period_status), F.lit("provisional")) | ((col(source) == "SIH") & (col(year) >= 2025))
    return F.when(provisional, F.lit("provisional")).otherwise(F.lit("source_observed"))
