"""Adding rates, exact intervals and comparisons to a table of counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import REST_OF_STATE, SELECTED
from ..functions.poisson import with_poisson_interval
from ..functions.rates import crude_rate, log_ratio_interval, rate_difference, rate_ratio
from .joins import wide_comparators


def add_rates(df: DataFrame, count: str = "count", population: str = "population") -> DataFrame:
    """Crude rate per 100 000 with exact Poisson limits.

    The interval comes from a listed table of fixed size and an expression, so it adds neither a
    shuffle nor a Python worker.
    """
    limits = F.col("_limits")
    return (
        with_poisson_interval(df, count, "_limits")
        .withColumn("rate_per_100k", crude_rate(count, population))
        .withColumn("rate_ci_lower_per_100k", crude_rate(limits["lower"], population))
        .withColumn("rate_ci_upper_per_100k", crude_rate(limits["upper"], population))
        .drop("_limits")
    )


def add_comparison(df: DataFrame, keys: list[str], geographies: list[str], population: str = "population") -> DataFrame:
    """Comparator figures beside every row, and the selected city against the rest of its state."""
    wide = wide_comparators(df, keys, geographies, ["count", "rate_per_100k", population])
    city, rest = SELECTED, REST_OF_STATE
    limits = log_ratio_interval(
        F.col(f"count_{city}"), F.col(f"count_{rest}"), F.col(f"{population}_{city}"), F.col(f"{population}_{rest}")
    )
    return (
        wide.withColumn("rate_ratio_vr_vs_rest", rate_ratio(f"rate_per_100k_{city}", f"rate_per_100k_{rest}"))
        .withColumn(
            "rate_difference_vr_minus_rest_per_100k",
            rate_difference(f"rate_per_100k_{city}", f"rate_per_100k_{rest}"),
        )
        .withColumn("_ratio", limits)
        .withColumn("rate_ratio_ci_lower", F.col("_ratio")["lower"])
        .withColumn("rate_ratio_ci_upper", F.col("_ratio")["upper"])
        .drop("_ratio")
    )
