"""Residence checks and geography labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import (
    COUNTRY_TOTAL, OUTSIDE_COUNTRY, OUTSIDE_STATE, REST_OF_COUNTRY, REST_OF_STATE, SELECTED, STATE_TOTAL, Territory,
)
from .text import clean_text, col, normalize_code

STATE_PARTS = [SELECTED, REST_OF_STATE]
COUNTRY_PARTS = [SELECTED, REST_OF_STATE, REST_OF_COUNTRY]


def residence_code_valid(code: Column | str) -> Column:
    return F.coalesce(col(code).rlike(r"\A[0-9]{6}\z"), F.lit(False))


def in_state(code: Column | str, territory: Territory, digits: int = 6) -> Column:
    rest = digits - len(territory.state_prefix)
    return F.coalesce(col(code).rlike(rf"\A{territory.state_prefix}[0-9]{{{rest}}}\z"), F.lit(False))


def classify_geography(code: Column | str, territory: Territory) -> Column:
    """Selected city, rest of its state, rest of the country, or outside it."""
    clean = normalize_code(code)
    return (
        F.when(~residence_code_valid(clean), F.lit(OUTSIDE_COUNTRY))
        .when(clean == territory.selected_code6, F.lit(SELECTED))
        .when(clean.startswith(territory.state_prefix), F.lit(REST_OF_STATE))
        .otherwise(F.lit(REST_OF_COUNTRY))
    )


def classify_state_geography(code: Column | str, territory: Territory) -> Column:
    """Selected city, rest of its state, or outside the state."""
    clean = clean_text(code)
    return (
        F.when(clean == territory.selected_code6, F.lit(SELECTED))
        .when(in_state(clean, territory), F.lit(REST_OF_STATE))
        .otherwise(F.lit(OUTSIDE_STATE))
    )


def eligible_code(code: Column | str, source: str, territory: Territory) -> Column:
    """``eligible_residence`` told from the code alone: cheap enough to filter before labelling."""
    clean = normalize_code(code)
    return residence_code_valid(clean) if source == "SIM" else in_state(clean, territory)


def eligible_residence(geography: Column | str, source: str) -> Column:
    """Deaths count anywhere in the country; notifications only inside the state."""
    label = col(geography)
    return label != OUTSIDE_COUNTRY if source == "SIM" else label.isin(STATE_PARTS)


def territory_membership(geography: Column | str, national: bool = True) -> Column:
    """Every published area a row adds to: its own label plus the totals that contain it.

    ``national=False`` leaves the country total out, for inputs that only cover the state.
    """
    label = col(geography)
    parts = [label, F.when(label.isin(STATE_PARTS), F.lit(STATE_TOTAL))]
    if national:
        parts.append(F.when(label.isin(COUNTRY_PARTS), F.lit(COUNTRY_TOTAL)))
    return F.array_compact(F.array(*parts))
