"""Indicator identifiers and the short texts shown next to figures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import DIRECTION_TEXTS, RELATIVE_TEXTS, SYNONYMS, outcome_definitions
from .demographics import lookup
from .text import col


def indicator_id(source: Column | str, outcome_id: Column | str) -> Column:
    return F.concat_ws("-", F.lower(col(source)), F.translate(col(outcome_id), "_", "-"))


def outcome_theme(outcome_id: Column | str) -> Column:
    return lookup({o.id: o.section for o in outcome_definitions()}, col(outcome_id))


def outcome_label(outcome_id: Column | str, labels: dict[str, str] | None = None) -> Column:
    return lookup(labels or {o.id: o.label for o in outcome_definitions()}, col(outcome_id))


def synonym_array(outcome_id: Column | str, label: Column | str) -> Column:
    """Sorted distinct search words: the label itself plus the fixed extras."""
    extras = F.lit(None).cast("array<string>")
    for key, words in SYNONYMS.items():
        extras = F.when(col(outcome_id) == key, F.array(*[F.lit(w) for w in words])).otherwise(extras)
    own = F.array(F.lower(col(label)))
    return F.array_sort(F.array_distinct(F.concat(own, F.coalesce(extras, F.array().cast("array<string>")))))


def ratio_guarded(value: Column | str, comparator: Column | str) -> Column:
    """Value over comparator, null when the comparator is missing or not positive."""
    return F.when(col(comparator) > 0, col(value) / col(comparator))


def percent_change(value: Column | str, reference: Column | str) -> Column:
    """Relative change in percent, zero against a reference that is not positive."""
    base = col(reference)
    return F.when(base > 0, (col(value) / F.when(base > 0, base) - 1) * 100).when(base.isNotNull(), F.lit(0.0))


def relative_difference_label(ratio: Column | str) -> Column:
    value = col(ratio)
    points = F.floor(F.abs((value - 1) * 100) + 0.5).cast("long")
    unknown, equal, above, below = RELATIVE_TEXTS
    side = F.when(value > 1, F.lit(above)).otherwise(F.lit(below))
    return (
        F.when(value.isNull(), F.lit(unknown))
        .when(points == 0, F.lit(equal))
        .otherwise(F.concat(points.cast("string"), F.lit("% "), side))
    )


def direction_label(change: Column | str, stable: float = 5.0) -> Column:
    value = col(change)
    steady, above, below = DIRECTION_TEXTS
    return (
        F.when(F.abs(value) < stable, F.lit(steady))
        .when(value > 0, F.lit(above))
        .otherwise(F.lit(below))
    )
