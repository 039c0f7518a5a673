"""Age, sex and outcome-status decoding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import (
    AGE_GROUPS, AGE_STARTS, DEATH_SEX_CODES, NOTIFICATION_SEX_CODES, NOTIFICATION_STATUS, STATUS_MISSING, UNKNOWN,
)
from .text import col, normalize_code


def literal_map(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def lookup(values: dict[str, str], key: Column, default: str | None = None) -> Column:
    """Value of a small fixed table, or the default for unknown keys."""
    found = F.try_element_at(literal_map(values), key)
    return found if default is None else F.coalesce(found, F.lit(default))


def age_bucket(years: Column | str) -> Column:
    """Completed years to the eight broad groups; unknown age keeps its own label.

    Below zero counts as under one, as in the published tables.
    """
    value = col(years)
    label = F.lit(UNKNOWN)
    for start, group in zip(AGE_STARTS, AGE_GROUPS):
        reached = value.isNotNull() if start == 0 else value >= start
        label = F.when(reached, F.lit(group)).otherwise(label)
    return label


def death_age_years(raw: Column | str, day_codes: tuple[int, int] = (0, 399), year_base: int = 400) -> Column:
    """Coded age: low codes are days, ``400`` to ``499`` are completed years, the rest is unknown."""
    code = col(raw).try_cast("double")
    return (
        F.when(code.between(*day_codes), code / 365)
        .when(code.between(year_base, year_base + 99), code - year_base)
    )


def notification_age_years(raw: Column | str, unit: Column | str) -> Column:
    """Age with its unit: 3 years, 2 months, 1 day."""
    value = col(raw).try_cast("double")
    code = normalize_code(unit)
    return F.when(code == "3", value).when(code == "2", value / 12).when(code == "1", value / 365)


def death_age_group(raw: Column | str) -> Column:
    return age_bucket(death_age_years(raw))


def notification_age_group(raw: Column | str, unit: Column | str) -> Column:
    return age_bucket(notification_age_years(raw, unit))


def sex_label(raw: Column | str, source: str) -> Column:
    codes = DEATH_SEX_CODES if source == "SIM" else NOTIFICATION_SEX_CODES
    return lookup(codes, normalize_code(raw), UNKNOWN)


def outcome_status_label(raw: Column | str) -> Column:
    return lookup(NOTIFICATION_STATUS, normalize_code(raw), STATUS_MISSING)


def age_order(group: Column | str) -> Column:
    """Display position of an age group, unknown labels last."""
    return _position(AGE_GROUPS + [UNKNOWN], group)


def sex_order(sex: Column | str) -> Column:
    return _position(["masculino", "feminino", UNKNOWN], sex)


def _position(order: list[str], value: Column | str) -> Column:
    found = F.array_position(F.array(*[F.lit(x) for x in order]), col(value))
    return F.when(found > 0, found - 1).otherwise(F.lit(len(order))).cast("int")
