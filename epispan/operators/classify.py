"""Diagnosis classification and counting.

An event may count in several outcomes. Rows are therefore first counted per
code and dimension, and only those counts are unrolled to outcomes: the facts
shuffle once, already combined on the map side, and never multiply.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import NOTIFICATION_OUTCOMES, Outcome
from ..functions.icd import with_outcomes
from ..functions.labels import outcome_label
from ..functions.text import clean_text, normalize_code


def cause_map(events: DataFrame, code: str, definitions: list[Outcome], strict: bool = True) -> DataFrame:
    """(cause, outcome) pairs over the distinct codes present."""
    causes = events.select(normalize_code(code).alias("cause")).distinct()
    return with_outcomes(causes, "cause", definitions, strict)


def classified_events(events: DataFrame, code: str, definitions: list[Outcome], strict: bool = True) -> DataFrame:
    """One row per fact and outcome it counts in: one scan, joined to the bounded category lookup."""
    return with_outcomes(events.withColumn("cause", normalize_code(code)), "cause", definitions, strict)


def classified_counts(
    events: DataFrame, code: str, definitions: list[Outcome], keys: list[str], strict: bool = True
) -> DataFrame:
    """Events per outcome and key, null keys kept as their own group."""
    per_code = events.groupBy(normalize_code(code).alias("cause"), *keys).agg(F.count(F.lit(1)).alias("n"))
    counted = with_outcomes(per_code, "cause", definitions, strict).groupBy(*keys, "outcome_id").agg(F.sum("n").alias("count"))
    labels = {d.id: d.label for d in definitions}
    return counted.withColumn("outcome_label", outcome_label("outcome_id", labels))


def notification_outcomes(classification: Column | str) -> Column:
    """Every notification counts once overall, and again under its final classification."""
    code = clean_text(classification)
    marks = [F.lit(i) if c is None else F.when(code == c, F.lit(i)) for i, _, c in NOTIFICATION_OUTCOMES]
    return F.array_compact(F.array(*marks))


def notification_counts(events: DataFrame, classification: str, keys: list[str], deaths: Column | None = None) -> DataFrame:
    """Notifications per outcome and key, with deaths among them when ``deaths`` marks them."""
    measures = [F.count(F.lit(1)).alias("count")]
    if deaths is not None:
        measures.append(F.sum(deaths.cast("long")).alias("death_any_count"))
    per_class = events.groupBy(clean_text(classification).alias("_class"), *keys).agg(*measures)
    unrolled = per_class.withColumn("outcome_id", F.explode(notification_outcomes("_class")))
    sums = [F.sum(m).alias(m) for m in (["count"] if deaths is None else ["count", "death_any_count"])]
    labels = {i: label for i, label, _ in NOTIFICATION_OUTCOMES}
    return (
        unrolled.groupBy(*keys, "outcome_id").agg(*sums)
        .withColumn("outcome_label", outcome_label("outcome_id", labels))
    )
