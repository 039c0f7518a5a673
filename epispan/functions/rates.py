"""Rates, ratios and their intervals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import RATE_MULTIPLIER, Z_975
from .text import col


def crude_rate(count: Column | str, population: Column | str) -> Column:
    """Events per 100 000; null where the denominator is missing or zero."""
    return F.try_divide(col(count).cast("double"), col(population).cast("double")) * F.lit(RATE_MULTIPLIER)


def rate_ratio(rate: Column | str, comparator: Column | str) -> Column:
    """Ratio of two rates, null instead of infinite against a zero rate."""
    return F.try_divide(col(rate), col(comparator))


def rate_difference(rate: Column | str, comparator: Column | str) -> Column:
    return col(rate) - col(comparator)


def log_ratio_interval(count: Column, rest_count: Column, population: Column, rest_population: Column) -> Column:
    """Struct of log-normal limits for a rate ratio; null unless all four inputs are positive."""
    usable = (count > 0) & (rest_count > 0) & (population > 0) & (rest_population > 0)
    a, b = (c.cast("double") for c in (count, rest_count))
    log_ratio = F.log(a / population.cast("double")) - F.log(b / rest_population.cast("double"))
    spread = F.lit(Z_975) * F.sqrt(F.lit(1.0) / a + F.lit(1.0) / b)
    limits = F.struct(F.exp(log_ratio - spread).alias("lower"), F.exp(log_ratio + spread).alias("upper"))
    return F.when(usable, limits)


def notification_rate(count: Column | str, population: Column | str) -> Column:
    return crude_rate(count, population)


def monthly_rate(count: Column | str, population: Column | str) -> Column:
    """Monthly events per 100 000 against a twelfth of the annual population."""
    return F.try_divide(col(count).cast("double"), col(population).cast("double") / 12) * F.lit(RATE_MULTIPLIER)


def share_pct(part: Column | str, whole: Column | str) -> Column:
    """Percentage, null for an empty whole."""
    return F.try_divide(col(part).cast("double"), col(whole).cast("double")) * 100
